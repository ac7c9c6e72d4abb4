"""Sampling and simulation by hashed uniforms: without order, repeatable, independent of partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import sized, written
from ..functions.sequence import BASES, fragment, is_acgt
from ..functions.uniform import hash_order, uniform


#: Hex digits of the hash by which a cut is looked for: 65,536 bins of each group.
BIN_DIGITS = 4


def reservoir(rows: DataFrame, k: int, seed: int, keys: Sequence[str], by: Sequence[str] = (), shuffled: bool = False) -> DataFrame:
    """k rows (of each group) uniformly without replacement; k = 0 takes all. shuffled adds their random order.

    Those with the least hashes are taken. A histogram of the hashes' first digits says up to which bin a group's rows
    can be among them; only the rows up to there, about k, are ranked, whatever k and the group's size.
    """
    at = hash_order(seed, *(F.col(c) for c in keys))
    if k:
        bins = rows.select(*by, F.substring(at, 1, BIN_DIGITS).alias("_bin")).groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        cuts = bins.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < k)
        cuts = cuts.groupBy(*by).agg(F.max("_bin").alias("_cut"))  # one row per group
        if by:
            cuts = sized(written(cuts.select(F.struct(*by).alias("_g"), "_cut"), "cuts"))
            rows = rows.join(cuts, F.struct(*by).eqNullSafe(F.col("_g"))).drop("_g")
        else:
            rows = rows.join(F.broadcast(cuts))
        rows = rows.where(F.substring(at, 1, BIN_DIGITS) <= F.col("_cut")).drop("_cut").withColumn("_h", at)
        w = Window.partitionBy(*by).orderBy("_h", *keys)
        rows = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r", "_h")
    if shuffled:
        w = Window.partitionBy(*by).orderBy(hash_order(seed + 1, *(F.col(c) for c in keys)), *keys)
        rows = rows.withColumn("position", F.row_number().over(w) - 1)
    return rows


#: Ordinals of records that are numbered together: those that begin in 16 MB of a file (an ordinal is a byte times 65,536).
RUN = 1 << 40


def running_index(rows: DataFrame, group: str, file: str, ordinal: str, into: str) -> DataFrame:
    """Rows with their place, from 0 on, among those of a group in order of file and ordinal.

    Runs of RUN ordinals are numbered each for itself and moved by the counts of the runs before, so no task orders a whole group.
    """
    rows = rows.withColumn("_run", F.floor(F.col(ordinal) / RUN))
    counts = rows.groupBy(group, file, "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy(file, "_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized(written(counts.select(group, file, "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "runs"))
    within = F.row_number().over(Window.partitionBy(group, file, "_run").orderBy(ordinal)) - 1
    return rows.withColumn("_at", within).join(starts, [group, file, "_run"]).withColumn(into, F.col("_start") + F.col("_at")).drop("_run", "_at", "_start")


def mutated(seq: Column, key: Sequence[Column], seed: int | Column, sub: float | Column, ins: float, dele: float) -> Column:
    """A sequence under a flat error model: per base a deletion or else a substitution by another base, then a geometric
    number of inserted bases after a base that stays."""

    def base(i: Column) -> Column:
        b = F.substring(seq, i + 1, F.lit(1))
        u = uniform(seed, *key, i, "m")
        at = F.instr(F.lit(BASES), b)
        other = F.substring(F.lit(BASES), F.pmod(at + F.floor(uniform(seed, *key, i, "s") * 3), F.lit(4)).cast("int") + 1, F.lit(1))
        kept = F.when((u < sub + dele) & (at > 0), other).otherwise(b)
        if ins > 0:
            n = F.floor(F.log(F.greatest(uniform(seed, *key, i, "i"), F.lit(2.0**-33))) / F.log(F.lit(ins))).cast("int")
            more = F.transform(F.sequence(F.lit(1), n), lambda j: F.substring(F.lit(BASES), F.floor(uniform(seed, *key, i, "b", j) * 4).cast("int") + 1, F.lit(1)))
            kept = F.concat(kept, F.when(n > 0, F.array_join(more, "")).otherwise(""))
        return F.when(u < dele, "").otherwise(kept)

    return F.when(F.length(seq) > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.length(seq) - 1), base), "")).otherwise("")


def simulated_reads(refs: DataFrame, n_per_ref: int, seed: int, *, read_len: int | None = None, sub: float = 0.005, ins: float = 0.0005, dele: float = 0.0005) -> DataFrame:
    """refseq, name, sequence of n reads per reference (refseq, sequence); unusable and empty ones are left out."""
    reads = refs.select("refseq", "sequence").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_per_ref - 1))))
    reads = reads.withColumn("_f", fragment(F.col("sequence"), read_len, uniform(seed, F.col("refseq"), F.col("i"), "f")))
    reads = reads.where(is_acgt(F.col("_f")))
    out = reads.select("refseq", F.concat_ws(":", "refseq", F.col("i").cast("string")).alias("name"), mutated(F.col("_f"), [F.col("refseq"), F.col("i")], seed, sub, ins, dele).alias("sequence"))
    return out.where(F.length("sequence") > 0)


def cumulated(classes: DataFrame, order: str, value: str) -> DataFrame:
    """classes with _lo and _hi: the sums of a value before and up to each row in order.

    Ranges of rows are summed each for itself and moved by the sums of the ranges before, so no task orders all rows.
    """
    ranges = written(classes.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = ranges.groupBy("_range").agg(F.sum(value).alias("_s"))
    starts = sums.select("_range", F.coalesce(F.sum("_s").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_start"))  # a row for each range
    within = F.sum(value).over(Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    out = ranges.withColumn("_upto", within).join(F.broadcast(starts), "_range").withColumn("_hi", F.col("_start") + F.col("_upto"))
    return out.withColumn("_lo", F.col("_hi") - F.col(value)).drop("_range", "_upto", "_start")


def categorical(draws: DataFrame, classes: DataFrame, *, u: str = "u", item: str = "item", p: str = "p") -> DataFrame:
    """Each draw's class by inverse cumulative probability over the classes in order; a draw without one has a null.

    The cumulative table is cut into as many stretches of equal width as there are classes, or up to twice as many, and joined on
    them: a class has a row for each stretch that it touches. A draw meets two classes on average, whatever their number and weights.
    """
    table = classes.where(F.col(p) > 0).select(F.col(item).cast("string").alias(item), F.col(p).cast("double").alias(p))
    table = written(cumulated(table, item, p), "cumulated")
    n, total = table.agg(F.count(F.lit(1)), F.max("_hi")).first()
    stretches = 1 << max(n - 1, 1).bit_length()
    total = float(total or 1.0)
    at = lambda x: F.floor(x / F.lit(total) * stretches)
    table = table.withColumn("_at", F.explode(F.sequence(at(F.col("_lo")), at(F.col("_hi"))))).select("_at", "_lo", "_hi", F.col(item).alias("_item"))
    rows = draws.drop(item).withColumn("_x", F.col(u) * F.lit(total)).withColumn("_cell", at(F.col("_x")))
    meets = (F.col("_cell") == F.col("_at")) & (F.col("_x") >= F.col("_lo")) & (F.col("_x") < F.col("_hi"))
    return rows.join(sized(written(table, "stretches")) if n else table, meets, "left").drop("_x", "_cell", "_at", "_lo", "_hi").withColumnRenamed("_item", item)


def random_truth(genomes: DataFrame, pair: tuple[str, str], n_present: int, low: float, seed: int) -> DataFrame:
    """A composition with exact zeros: a pair that is always present, its first member at a low share, and others drawn at
    random with log-uniform weights."""
    others = reservoir(genomes.where(~F.col("genome").isin(*pair)), n_present - 2, seed, ["genome"])
    present = others.select("genome").unionByName(genomes.where(F.col("genome") == pair[1]).select("genome"))
    weight = F.pow(F.lit(10.0), F.lit(-1.5) + F.lit(1.5) * uniform(seed, F.col("genome"), "w"))
    present = present.withColumn("_w", weight)
    total = present.agg(F.sum("_w").alias("_t"))
    present = present.join(F.broadcast(total)).select("genome", (F.col("_w") / F.col("_t") * (1.0 - low)).alias("theta"))
    present = present.unionByName(genomes.where(F.col("genome") == pair[0]).select("genome", F.lit(low).alias("theta")))
    return genomes.select("genome").join(present, "genome", "left").withColumn("theta", F.coalesce("theta", F.lit(0.0)))
