"""Presence and abundance metrics of a call against the truth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRESENT_AT = 0.5


def present(probability: Column) -> Column:
    return probability >= PRESENT_AT


def presence_metrics(calls: DataFrame, by: Sequence[str] = (), also: Mapping[str, Column] | None = None) -> DataFrame:
    """Jaccard, precision, recall, F1 and number of calls from boolean columns pred and truth, and also other aggregates.

    An empty union has Jaccard 1; other empty denominators give 0. Nulls count as absent; a null in by is a group.
    """
    also = also or {}
    p, t = F.coalesce("pred", F.lit(False)), F.coalesce("truth", F.lit(False))
    more = [c.alias(name) for name, c in also.items()]
    n = calls.groupBy(*by).agg(F.count_if(p & t).alias("tp"), F.count_if(p | t).alias("either"), F.count_if(p).alias("n_pred"), F.count_if(t).alias("n_true"), *more)
    over = lambda a, b, other: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(other))
    tp = F.col("tp").cast("double")
    out = n.withColumn("jaccard", over(tp, F.col("either"), 1.0)).withColumn("precision", over(tp, F.col("n_pred"), 0.0)).withColumn("recall", over(tp, F.col("n_true"), 0.0))
    total = F.col("precision") + F.col("recall")
    f1 = F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(0.0)
    return out.select(*by, "jaccard", "precision", "recall", f1.alias("f1"), "n_pred", *also)


def score_row(calls: DataFrame, low: str, high: str, by: Sequence[str] = ()) -> DataFrame:
    """Metrics of each fit with the L1 error and whether both members of a pair were called.

    calls: genome, pred, truth, theta, true_theta.
    """
    hit = lambda g: F.max(F.when((F.col("genome") == g) & F.col("pred"), 1).otherwise(0))
    return presence_metrics(calls, by, {"l1": F.sum(F.abs(F.col("theta") - F.col("true_theta"))), "pair_low": hit(low), "pair_high": hit(high)})


def sweep_summary(scores: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Means of each setting (null is a setting), best Jaccard first."""
    return scores.groupBy(*by).agg(*(F.avg(v).alias(v) for v in values)).orderBy(F.desc("jaccard"), *by)


def best_setting(summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """The best setting that never lost the low member of the pair."""
    return summary.where("pair_low = 1").orderBy(F.desc("jaccard"), *by).limit(1)
