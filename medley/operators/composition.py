"""Counts, matrices and compositions as relations.

Matrices are long (row, column, value) tables; a missing entry is zero. None comes to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import sized, written
from ..functions.sequence import genome_of, read_source
from ..functions.uniform import uniform

FLOOR = 1e-4


def share(value: Column, *by: str) -> Column:
    """A value over the sum of all (of its group)."""
    return value / F.sum(value).over(Window.partitionBy(*by))


def shares_of(df: DataFrame, value: str, by: Sequence[str] = (), into: str = "share") -> DataFrame:
    """df with a value over its group's total, in one pass; a group has as many rows as there are references at most."""
    if by:
        return df.withColumn(into, share(F.col(value), *by))
    total = df.agg(F.sum(value).alias("_total"))  # one row
    return df.join(F.broadcast(total)).withColumn(into, F.col(value) / F.col("_total")).drop("_total")


def observed_counts(hits: DataFrame, refs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hits per reference (of each sample), zero for references without any; hits of others do not count.

    hits: hit (and the columns by); refs: refseq.
    """
    counts = hits.groupBy(*by, F.col("hit").alias("refseq")).agg(F.count(F.lit(1)).alias("n"))
    every = refs.select("refseq").distinct()
    if by:  # each sample with every reference: the result has that many rows
        every = hits.select(*by).distinct().join(sized(every))
    return every.join(counts, [*by, "refseq"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def translation_table(refs: DataFrame) -> DataFrame:
    """genome, refseq, weight: a genome's copies share its abundance evenly."""
    refs = refs if "genome" in refs.columns else refs.withColumn("genome", genome_of(F.col("refseq")))
    copies = F.count(F.lit(1)).over(Window.partitionBy("genome"))
    return refs.select("genome", "refseq", (F.lit(1.0) / copies).alias("weight"))


def rollup(observed: DataFrame, refs: DataFrame, value: str = "rel", by: Sequence[str] = ()) -> DataFrame:
    """A reference measure summed to genomes."""
    return observed.join(refs.select("refseq", "genome"), "refseq").groupBy(*by, "genome").agg(F.sum(value).alias(value))


def floored_start(shares: DataFrame, value: str = "rel", floor: float = FLOOR) -> DataFrame:
    """Starting abundances: lifted to a floor, then made to sum to one."""
    return shares_of(shares.withColumn("_lift", F.greatest(F.col(value), F.lit(floor))), "_lift", into="start").drop("_lift")


def pair_counts(hits: DataFrame) -> DataFrame:
    """src, dst, n of simulated reads (query, hit): counted first, so that later joins meet pairs and not reads."""
    return hits.groupBy(read_source(F.col("query")).alias("src"), F.col("hit").alias("dst")).agg(F.count(F.lit(1)).alias("n"))


def confusion_counts(hits: DataFrame, refs: DataFrame) -> DataFrame:
    """src, dst, n of simulated reads (query, hit) whose source and hit are both known."""
    known = refs.select("refseq")
    out = pair_counts(hits)
    return out.join(known, out["src"] == known["refseq"], "left_semi").join(known, out["dst"] == known["refseq"], "left_semi")


def unknown_counts(hits: DataFrame, refs: DataFrame) -> DataFrame:
    """src, dst, n of simulated reads whose source or hit is no reference."""
    known = refs.select(F.col("refseq").alias("_r"), F.lit(True).alias("_known")).distinct()
    out = pair_counts(hits)
    out = out.join(known.toDF("src", "_s"), "src", "left").join(known.toDF("dst", "_d"), "dst", "left")
    return out.where(F.col("_s").isNull() | F.col("_d").isNull()).select("src", "dst", "n")


def row_stochastic(counts: DataFrame, refs: DataFrame) -> DataFrame:
    """src, dst, p: rows sum to one; a reference without reads maps to itself."""
    p = shares_of(counts.select("src", "dst", "n"), "n", ["src"], "p")
    every = refs.select(F.col("refseq").alias("src")).distinct()
    return every.join(p, "src", "left").select("src", F.coalesce("dst", "src").alias("dst"), F.coalesce("p", F.lit(1.0)).alias("p"))


def identity(refs: DataFrame) -> DataFrame:
    return refs.select(F.col("refseq").alias("src"), F.col("refseq").alias("dst"), F.lit(1.0).alias("p"))


def mean_diagonal(matrix: DataFrame, refs: DataFrame) -> DataFrame:
    n = refs.agg(F.count_distinct("refseq").alias("_n"))
    return matrix.agg(F.sum(F.when(F.col("src") == F.col("dst"), F.col("p")).otherwise(0.0)).alias("_d")).join(F.broadcast(n)).select((F.col("_d") / F.col("_n")).alias("mean_diagonal"))


def vector_matrix(vector: DataFrame, matrix: DataFrame, *, on: tuple[str, str], out: str, value: str, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Row vector times matrix: entries whose keys meet are multiplied and summed by the matrix's other key."""
    left, right = on
    joined = vector.join(matrix.withColumnRenamed(right, left) if left != right else matrix, left)
    return joined.groupBy(*by, out).agg(F.sum(F.col(value) * F.col(weight)).alias(value))


def composed(translation: DataFrame, matrix: DataFrame) -> DataFrame:
    """genome, dst, a: the translation table times the confusion matrix."""
    joined = translation.join(matrix, translation["refseq"] == matrix["src"])
    return joined.groupBy("genome", "dst").agg(F.sum(F.col("weight") * F.col("p")).alias("a"))


def damped(matrix: DataFrame, refs: DataFrame, s: float) -> DataFrame:
    """(1 - s) I + s M, clamped at zero, rows made to sum to one again."""
    both = matrix.select("src", "dst", (F.col("p") * s).alias("p")).unionByName(identity(refs).withColumn("p", F.lit(1.0 - s)))
    both = both.groupBy("src", "dst").agg(F.greatest(F.sum("p"), F.lit(0.0)).alias("p"))
    return shares_of(both, "p", ["src"], "_p").select("src", "dst", F.col("_p").alias("p"))


def distances(a: DataFrame, b: DataFrame) -> DataFrame:
    """Frobenius and L1 distance of two matrices."""
    both = a.select("src", "dst", F.col("p").alias("pa")).join(b.select("src", "dst", F.col("p").alias("pb")), ["src", "dst"], "full")
    d = F.coalesce("pa", F.lit(0.0)) - F.coalesce("pb", F.lit(0.0))
    return both.agg(F.sqrt(F.sum(d * d)).alias("frobenius"), F.sum(F.abs(d)).alias("l1"))


def wide(matrix: DataFrame, row: str, column: str, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A long matrix with a column per value of column; for small matrices at the edge."""
    return matrix.groupBy(row).pivot(column, list(columns) if columns else None).agg(F.first(value)).na.fill(0.0)


def long(matrix: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """The reverse of wide; zeros stay."""
    return matrix.unpivot(row, [f"`{c}`" for c in matrix.columns if c != row], column, value)


def amplifiability(index: DataFrame) -> DataFrame:
    """References, those that amplify, genomes, and genomes with a reference that amplifies."""
    ok = F.col("amplifiable")
    return index.agg(F.count(F.lit(1)).alias("n_refs"), F.count_if(ok).alias("n_amplifiable"), F.count_distinct("genome").alias("n_genomes"), F.count_distinct(F.when(ok, F.col("genome"))).alias("n_amplifiable_genomes"))


#: Entries of a composed matrix that may be packed into one row and sent to every task.
PACKED = 500_000


def em(observed: DataFrame, matrix: DataFrame, iterations: int, by: Sequence[str] = (), packed: int = PACKED) -> DataFrame:
    """Maximum-likelihood abundances of each sample by expectation-maximisation.

    observed: refseq, n (and the columns by); matrix: genome, dst, a. A matrix of up to so many entries goes to
    every task once, a sample brings its counts only, and its iterations run inside one expression with no shuffle
    between them. A larger matrix stays a relation, and each iteration is two joins and two sums.
    """
    a = written(matrix.where("a > 0").select("genome", F.col("dst").alias("refseq"), "a"), "composed")
    counts = observed.where("n > 0").groupBy(*by, "refseq").agg(F.sum("n").cast("double").alias("n"))
    counts = counts.join(a.select("refseq").distinct(), "refseq", "left_semi")
    return (em_packed if a.limit(packed + 1).count() <= packed else em_joined)(counts, a, iterations, by)


def em_packed(counts: DataFrame, a: DataFrame, iterations: int, by: Sequence[str]) -> DataFrame:
    g = a.select("genome").distinct().withColumn("g", F.row_number().over(Window.orderBy("genome")) - 1)
    j = a.select("refseq").distinct().withColumn("j", F.row_number().over(Window.orderBy("refseq")) - 1)
    cells = a.join(F.broadcast(g), "genome").join(F.broadcast(j), "refseq")  # fewer rows than the packed matrix

    def lines(row: str, column: str) -> DataFrame:
        """One row: the non-zero entries of each line of the matrix, in order."""
        each = cells.groupBy(row).agg(F.collect_list(F.struct(F.col(column).alias("i"), "a")).alias("xs"))
        return each.agg(F.transform(F.sort_array(F.collect_list(F.struct(row, "xs"))), lambda x: x["xs"]).alias(f"by_{row}"))

    pack = lines("j", "g").join(F.broadcast(lines("g", "j"))).join(F.broadcast(g.agg(F.sort_array(F.collect_list("genome")).alias("genomes"))))
    ys = counts.join(F.broadcast(j), "refseq").groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("j", "n"))).alias("ys"), F.sum("n").alias("total"))
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    # counts of all references in order: each after the zeros since the one before
    filled = F.transform("ys", lambda y, i: F.concat(zeros(y["j"] - F.when(i > 0, F.col("ys")[i - 1]["j"]).otherwise(-1) - 1), F.array(y["n"])))
    filled = F.concat(F.flatten(filled), zeros(F.size("by_j") - F.element_at("ys", -1)["j"] - 1))
    rows = ys.join(F.broadcast(pack)).withColumn("y", filled)

    def dot(xs: Column, values: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x["a"] * values[x["i"]])

    def step(theta: Column, _: Column) -> Column:
        # each reference's count over its expected rate, then each genome's part of it
        over = F.zip_with("y", "by_j", lambda n, xs: F.when(n > 0, n / dot(xs, theta)).otherwise(0.0))
        return F.transform(F.array(over), lambda w: F.zip_with(theta, "by_g", lambda t, xs: t * dot(xs, w) / F.col("total")))[0]

    start = F.transform("genomes", lambda x: F.lit(1.0) / F.size("genomes"))
    theta = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step)
    out = rows.select(*by, F.explode(F.arrays_zip(F.col("genomes").alias("genome"), theta.alias("theta"))).alias("x"))
    return out.select(*by, "x.genome", "x.theta")


def em_joined(counts: DataFrame, a: DataFrame, iterations: int, by: Sequence[str], every: int = 4) -> DataFrame:
    """The same as relations; theta is written every few rounds, which cuts its lineage."""
    counts = written(counts, "counts")
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_total"))
    genomes = F.broadcast(a.agg(F.collect_set("genome").alias("_genomes")))  # one row
    theta = totals.join(genomes).select(*by, F.explode("_genomes").alias("genome"), (F.lit(1.0) / F.size("_genomes")).alias("theta"))
    for i in range(iterations):
        rate = theta.join(a, "genome").groupBy(*by, "refseq").agg(F.sum(F.col("theta") * F.col("a")).alias("_rate"))
        over = counts.join(rate, [*by, "refseq"]).select(*by, "refseq", (F.col("n") / F.col("_rate")).alias("_w"))
        part = over.join(a, "refseq").groupBy(*by, "genome").agg(F.sum(F.col("a") * F.col("_w")).alias("_part"))
        theta = theta.join(part, [*by, "genome"], "left").join(totals, list(by)) if by else theta.join(part, "genome", "left").join(F.broadcast(totals))
        theta = theta.select(*by, "genome", (F.col("theta") * F.coalesce("_part", F.lit(0.0)) / F.col("_total")).alias("theta"))
        if i % every == every - 1:
            theta = written(theta, "theta")
    return theta


def replicates(observed: DataFrame, n: int, seed: int, by: Sequence[str] = ()) -> DataFrame:
    """Poisson bootstrap: each count n times drawn anew, with a column replicate; for intervals of any estimate by counts.

    Small counts by inversion of the Poisson distribution, from 30 on by a rounded normal.
    """
    out = observed.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(n))))
    key = [F.col(c) for c in by] + [F.col("refseq"), F.col("replicate")]
    u, v, mean = F.greatest(uniform(seed, *key, "u"), F.lit(2.0**-33)), uniform(seed, *key, "v"), F.col("n").cast("double")
    normal = F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * v)
    large = F.greatest(F.round(mean + F.sqrt(mean) * normal), F.lit(0.0))
    # k is the number of cumulated probabilities that u lies above
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0.0).alias("k"))
    more = lambda acc, i: F.struct((acc["p"] * mean / i).alias("p"), (acc["cdf"] + acc["p"] * mean / i).alias("cdf"), (acc["k"] + F.when(u > acc["cdf"], 1.0).otherwise(0.0)).alias("k"))
    small = F.aggregate(F.sequence(F.lit(1), F.lit(100)), start, more, lambda acc: acc["k"])
    return out.withColumn("n", F.when(mean >= 30, large).otherwise(small).cast("long"))


def posterior_summary(draws: DataFrame, by: Sequence[str], value: str = "theta") -> DataFrame:
    """Mean and exact 5 and 95 % quantiles per group."""
    q = F.percentile(value, F.array(F.lit(0.05), F.lit(0.95)))
    return draws.groupBy(*by).agg(F.avg(value).alias("mean"), q.alias("_q")).select(*by, "mean", F.col("_q")[0].alias("lo"), F.col("_q")[1].alias("hi"))


def largest_known(df: DataFrame, value: str, into: str) -> DataFrame:
    """The largest value that is a number."""
    return df.agg(F.max(F.when(~F.isnan(value), F.col(value))).alias(into))


def best_model(table: DataFrame) -> DataFrame:
    """The maximum-likelihood model with the least AIC, the first of equals; blank AICs are skipped."""
    rows = table.where((F.col("inference") == "maximum_likelihood") & F.col("aic").isNotNull())
    return rows.agg(F.min_by("model_id", F.struct("aic", "ordinal")).alias("model_id"))
