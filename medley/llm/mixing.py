"""Mixing sources to target weights by temperature (DataFrame functions only).

A source's weight is its token share to an exponent, normalised. The exponent between 0 (equal weights) and 1 (natural
weights) is found by bisection: entropy and repetition both move one way with it, so the smallest exponent
that meets both targets is wanted. Each pass evaluates a grid of exponents over the table of sources, which is several
bisection steps at once; only the sums come to the driver.

The weights are realised under a token budget. Documents are hashed into blocks of their source; each epoch visits the
blocks of a source in another permutation, and the last, partial epoch stops at the source's quota: whole blocks, then
documents of one boundary block in hash order. The share of a quota that is done when a block starts is its
position, so ordering by position interleaves all sources at their weights.

Defined results: a null source is a source of its own; a document without words has no tokens and is never drawn;
rows that repeat an id are drawn together and count each; a document may be drawn several times, once per epoch; an empty
table gives an empty result. A quota is met to within the tokens of one document. A budget that would need more than
max_repeats passes over all there is is cut to that many, so no source is ever passed over more often. Texts are counted whole.

Blocks hold about BLOCK_TOKENS tokens; a source has MAX_BLOCKS of them at most, so those of larger sources are larger. All draws are
ordered by MD5 of their keys: the same for every partitioning, and SQL can say it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.uniform import hash_order
from ._shared import sized, words_of, written

BLOCK_TOKENS = 1 << 16
MAX_BLOCKS = 1 << 16
GRID = 64
PASSES = 5


def token_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def _sums(sources: DataFrame, grid: list[float]) -> dict[float, tuple[float, float]]:
    """Per exponent: the sum of share^exponent and of share^exponent * log(share)."""
    power = F.pow("share", F.col("e"))
    rows = sources.withColumn("e", F.explode(F.array(*(F.lit(float(e)) for e in grid))))
    rows = rows.groupBy("e").agg(F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("l")).collect()
    return {r["e"]: (r["z"], r["l"]) for r in rows}


def exponent(sources: DataFrame, *, budget_passes: float, entropy_gain: float | None, max_repeats: float | None) -> float:
    """The smallest exponent in [0, 1] that meets the targets.

    entropy_gain is where the entropy has to be at most, between the natural (0) and the uniform one (1); max_repeats bounds
    how often any source is passed over. budget_passes is the budget over all tokens.
    """
    if (n := sources.count()) <= 1:
        return 1.0
    least = sources.agg(F.min("share")).first()[0]
    natural = -_sums(sources, [1.0])[1.0][1]
    target = math.inf if entropy_gain is None else natural + entropy_gain * (math.log(n) - natural)

    def met(e: float, z: float, l: float) -> bool:
        entropy = math.log(z) - e * l / z
        repeats = budget_passes * math.pow(least, e - 1) / z
        return entropy <= target + 1e-12 and (max_repeats is None or repeats <= max_repeats * (1 + 1e-12))

    lo, hi = 0.0, 1.0
    if met(0.0, float(n), 0.0):
        return 0.0
    for _ in range(PASSES):
        grid = [lo + (hi - lo) * i / GRID for i in range(1, GRID)]
        sums = _sums(sources, grid)
        first = next((i for i, e in enumerate(grid) if met(e, *sums[e])), GRID - 1)
        lo, hi = ([lo, *grid][first], [*grid, hi][first])
    return hi


def _order(*cols: Column, seed: int) -> Column:
    """The first 60 bits of the MD5 of seed and columns (nulls left out)."""
    return F.conv(F.substring(hash_order(seed, *cols), 1, 15), 16, 10).cast("long")


def token_table(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """_k, _source and _tokens of every row, written."""
    return written(docs.select(F.col(key).alias("_k"), F.col(source).alias("_source"), token_count(F.col(text)).alias("_tokens")), "tokens")


@dataclass
class Schedule:
    """Per source its weight and blocks, and per block and epoch its position and how far it is drawn."""

    plan: DataFrame
    visits: DataFrame
    seed: int

    def placed(self, rows: DataFrame) -> DataFrame:
        """rows with the plan of their _source and with their _block."""
        p = self.plan.withColumnRenamed("_source", "_p")
        out = rows.join(p, rows["_source"].eqNullSafe(p["_p"])).drop("_p")
        return out.withColumn("_block", F.pmod(_order(F.col("_k"), seed=self.seed), F.col("_n_blocks")))

    def cut_order(self) -> Column:
        return _order(F.col("_k"), F.col("_full"), seed=self.seed + 1)

    def drawn(self, rows: DataFrame) -> DataFrame:
        """rows (with _k and _source), one for each epoch in which they are drawn, with _epoch, _block, _position and _weight."""
        visits = self.visits.withColumnsRenamed({"_source": "_s2", "_block": "_b2"})
        out = self.placed(rows).join(visits, F.col("_source").eqNullSafe(F.col("_s2")) & (F.col("_block") == F.col("_b2")))
        return out.where(F.col("_whole") | (self.cut_order() <= F.col("_cut")))


def scheduled(tokens: DataFrame, *, budget: float | None, entropy_gain: float | None, max_repeats: float | None, seed: int) -> Schedule | None:
    """The schedule of a token table; None if there are no tokens."""
    sources = tokens.groupBy("_source").agg(F.sum("_tokens").alias("_t")).where("_t > 0")
    total = sources.agg(F.sum("_t")).first()[0] or 0
    if not total:
        return None
    budget = float(total if budget is None else budget)
    budget = budget if max_repeats is None else min(budget, max_repeats * total)
    sources = written(sources.withColumn("share", F.col("_t") / F.lit(float(total))), "sources")
    e = exponent(sources, budget_passes=budget / total, entropy_gain=entropy_gain, max_repeats=max_repeats)
    z = _sums(sources, [e])[e][0]

    weight = F.pow("share", F.lit(e)) / F.lit(z)
    quota = weight * F.lit(budget)
    n_blocks = F.least(F.ceil(F.col("_t") / BLOCK_TOKENS), F.lit(MAX_BLOCKS))
    plan = sources.select("_source", "_t", weight.alias("_weight"), quota.alias("_quota"), F.floor(quota / F.col("_t") + 1e-9).cast("int").alias("_full"), n_blocks.alias("_n_blocks"))
    out = Schedule(sized(written(plan, "plan")), plan, seed)

    blocks = out.placed(tokens).groupBy("_source", "_block", "_t", "_weight", "_quota", "_full").agg(F.sum("_tokens").alias("_bt"))
    visits = blocks.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_full"))))
    order = _order(F.col("_source"), F.col("_block"), F.col("_epoch"), seed=seed + 2)
    w = Window.partitionBy("_source", "_epoch").orderBy(order, "_block").rowsBetween(Window.unboundedPreceding, -1)  # MAX_BLOCKS rows at most
    done = F.coalesce(F.sum("_bt").over(w), F.lit(0)) + F.col("_epoch") * F.col("_t")
    visits = visits.withColumn("_done", done).where("_done < _quota")
    visits = visits.withColumn("_left", F.col("_quota") - F.col("_done")).withColumn("_position", F.col("_done") / F.col("_quota"))
    visits = written(visits.select("_source", "_block", "_epoch", "_position", "_left", "_bt"), "visits")

    # the boundary block of a source: its documents in hash order up to the quota
    edge = visits.where("_left < _bt").select(F.col("_source").alias("_e"), F.col("_block").alias("_eb"), "_epoch", "_left")
    inside = out.placed(tokens).join(sized(edge), F.col("_source").eqNullSafe(F.col("_e")) & (F.col("_block") == F.col("_eb")))
    upto = Window.partitionBy("_source", "_block").orderBy("_cut").rangeBetween(Window.unboundedPreceding, 0)
    cuts = inside.withColumn("_cut", out.cut_order()).withColumn("_sum", F.sum("_tokens").over(upto)).where("_sum <= _left")
    cuts = cuts.groupBy(F.col("_source").alias("_e"), F.col("_block").alias("_eb"), F.col("_epoch").alias("_ee")).agg(F.max("_cut").alias("_cut"))
    visits = visits.join(cuts, visits["_source"].eqNullSafe(cuts["_e"]) & (visits["_block"] == cuts["_eb"]) & (visits["_epoch"] == cuts["_ee"]), "left")
    visits = visits.select("_source", "_block", "_epoch", "_position", (F.col("_left") >= F.col("_bt")).alias("_whole"), "_cut")
    out.visits = sized(written(visits, "schedule"))
    return out


def mixed(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", budget: float | None = None, entropy_gain: float | None = 0.5, max_repeats: float | None = 4.0, seed: int = 42) -> DataFrame:
    """The drawn rows of docs, one per epoch in which a row is drawn, with _epoch, _block, _position and _weight.

    budget is in tokens; by default as many as there are.
    """
    schedule = scheduled(token_table(docs, key, text, source), budget=budget, entropy_gain=entropy_gain, max_repeats=max_repeats, seed=seed)
    if schedule is None:
        none = {"_epoch": "int", "_block": "long", "_position": "double", "_weight": "double"}
        return docs.limit(0).select("*", *(F.lit(None).cast(kind).alias(c) for c, kind in none.items()))
    # rows without words are never drawn; the others need not be counted again
    rows = docs.where(F.col(text).rlike(r"[^\x20\x09-\x0D]")).withColumns({"_k": F.col(key), "_source": F.col(source)})
    return schedule.drawn(rows).select(*docs.columns, "_epoch", "_block", "_position", "_weight")


def mixing_report(docs: DataFrame, *, budget: float | None = None, entropy_gain: float | None = 0.5, max_repeats: float | None = 4.0, seed: int = 42) -> DataFrame:
    """One row per drawn document and epoch: doc_id, source, epoch, n_tokens, block, position and weight."""
    tokens = token_table(docs, "doc_id", "text", "source")
    schedule = scheduled(tokens, budget=budget, entropy_gain=entropy_gain, max_repeats=max_repeats, seed=seed)
    if schedule is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, source string, epoch int, n_tokens long, block long, position double, weight double")
    out = schedule.drawn(tokens.where("_tokens > 0"))
    return out.select(F.col("_k").alias("doc_id"), F.col("_source").alias("source"), F.col("_epoch").alias("epoch"), F.col("_tokens").alias("n_tokens"), F.col("_block").alias("block"), F.round("_position", 9).alias("position"), F.round("_weight", 9).alias("weight"))


def drawn(docs: DataFrame, **options) -> DataFrame:
    """The drawn rows with the columns of docs."""
    return mixed(docs, **options).select(*docs.columns)
