"""Observed counts that follow a stream of hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import sized


def running_counts(hits: DataFrame, refs: DataFrame, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Counts per sample and reference of a streaming hit table; write it in update or complete mode."""
    return hits.join(sized(refs.select(F.col("refseq").alias("hit"))), "hit", "left_semi").groupBy(*by, "hit").agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(hits: DataFrame, refs: DataFrame, time: str, window: str, late: str) -> DataFrame:
    """Counts per time window; windows close when the watermark passes them, so state stays bounded."""
    known = hits.join(sized(refs.select(F.col("refseq").alias("hit"))), "hit", "left_semi")
    return known.withWatermark(time, late).groupBy(F.window(time, window), "hit").agg(F.count(F.lit(1)).alias("n"))
