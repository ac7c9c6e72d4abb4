"""Experiments with a planted truth: how fits depend on the error rate of the matrix and on the gate's prior."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import written
from ..functions.sequence import fragment, is_acgt, read_source
from ..functions.uniform import uniform
from ..operators import composition as C
from ..operators import map_fit, metrics
from ..operators.mapper import cluster_references, map_reads, usable_hits
from ..operators.posterior import infer
from ..operators.sampling import categorical, mutated
from .options import Options
from .run import build_matrix

# The grids of the two published experiments.
FLAT_RATES = (0.0001, 0.001, 0.005, 0.01, 0.02, 0.05, 0.15)
PRIORS = (0.5, 0.1, 0.05, 0.01, 0.001)
TEMPERATURES = (0.1, 0.5, 1.0, 2.0)
CUTOFFS = (1e-4, 1e-3, 1e-2)


def planted_hits(refs: DataFrame, truth: DataFrame, n_reads: int, o: Options, index=None, sub_rates: Mapping[str, float] | None = None) -> DataFrame:
    """Observed counts (sample, refseq, n) of reads drawn from a truth (sample, genome, theta), mutated and mapped.

    sub_rates: the substitution rate of each sample, instead of the one of the options. All samples are mapped together.
    """
    spread = truth.join(C.translation_table(refs.select("refseq", "genome")), "genome").select("sample", "refseq", (F.col("theta") * F.col("weight")).alias("p")).where("p > 0")
    index = index or cluster_references(refs, o.mapper)
    out = []
    for name in sorted(r[0] for r in truth.select("sample").distinct().collect()):  # a grid has a handful of truths
        u = uniform(o.seed, F.lit(name), F.col("id"), "draw")
        drawn = categorical(refs.sparkSession.range(n_reads).withColumn("u", u), spread.where(F.col("sample") == name), item="refseq").drop("u")
        reads = drawn.join(refs.select("refseq", "sequence"), "refseq")
        reads = reads.withColumn("sequence", mutated(F.col("sequence"), [F.lit(name), F.col("id")], o.seed, o.flat_sub_rate if sub_rates is None else sub_rates[name], o.flat_ins_rate, o.flat_del_rate))
        out.append(reads.select(F.concat_ws(":", F.lit(name), "id").alias("query"), F.lit(name).alias("sample"), "sequence"))
    reads = written(reduce(DataFrame.unionByName, out), "planted-reads")
    hits = usable_hits(map_reads(reads.select("query", "sequence"), index, o.mapper), o.min_identity)
    return written(C.observed_counts(hits.withColumn("sample", F.split_part("query", F.lit(":"), F.lit(1))), refs, ["sample"]), "planted-counts")


def observed_shares(counts: DataFrame, refs: DataFrame) -> DataFrame:
    """sample, genome, theta by counts alone."""
    return C.rollup(C.shares_of(counts, "n", ["sample"], "theta"), refs, "theta", ["sample"])


def errors(estimate: DataFrame, truth: DataFrame) -> DataFrame:
    """sample, l1 of an estimate (sample, genome, theta)."""
    both = estimate.join(truth.select("sample", "genome", F.col("theta").alias("true_theta")), ["sample", "genome"], "full")
    return both.groupBy("sample").agg(F.sum(F.abs(F.coalesce("theta", F.lit(0.0)) - F.coalesce("true_theta", F.lit(0.0)))).alias("l1"))


def cell_matrices(refs: DataFrame, cells: Sequence[tuple[str, float, int]], o: Options, index=None) -> DataFrame:
    """cell, src, dst, p: the confusion matrices of several cells (name, substitution rate, seed), simulated, mapped and counted in one job."""
    grid = F.array(*(F.struct(F.lit(name).alias("cell"), F.lit(float(rate)).alias("rate"), F.lit(seed).alias("seed")) for name, rate, seed in cells))
    reads = refs.select("refseq", "sequence", F.explode(grid).alias("c")).select("refseq", "sequence", "c.*").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(o.sim_n_per_ref - 1))))
    reads = reads.withColumn("_f", fragment(F.col("sequence"), o.sim_read_len, uniform(F.col("seed"), F.col("refseq"), F.col("i"), "f"))).where(is_acgt(F.col("_f")))
    seq = mutated(F.col("_f"), [F.col("refseq"), F.col("i")], F.col("seed"), F.col("rate"), o.flat_ins_rate, o.flat_del_rate)
    # the cell is part of the read's name, so equal sequences of all cells are mapped once and ties are split within each cell
    reads = written(reads.select(F.concat_ws("\t", "cell", F.concat_ws(":", "refseq", "i")).alias("query"), seq.alias("sequence")).where(F.length("sequence") > 0), "cell-reads")
    hits = usable_hits(map_reads(reads, index or cluster_references(refs, o.mapper), o.mapper), o.min_identity)
    hits = hits.select(F.split_part("query", F.lit("\t"), F.lit(1)).alias("cell"), read_source(F.split_part("query", F.lit("\t"), F.lit(2))).alias("src"), F.col("hit").alias("dst"))
    counts = hits.groupBy("cell", "src", "dst").agg(F.count(F.lit(1)).alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy("cell", "src"))  # a row of a matrix
    known = counts.withColumn("p", p).select("cell", "src", "dst", "p")
    every = refs.select(F.col("refseq").alias("src"), F.explode(F.array(*(F.lit(name) for name, _, _ in cells))).alias("cell"))
    return written(every.join(known, ["cell", "src"], "left").select("cell", "src", F.coalesce("dst", "src").alias("dst"), F.coalesce("p", F.lit(1.0)).alias("p")), "cell-matrices")


def error_rate_grid(refs: DataFrame, theta: DataFrame, o: Options, *, generators: Sequence[float] = (0.005, 0.01), candidates: Sequence[float] = FLAT_RATES, n_reads: int = 50_000, fit: map_fit.MapOptions = map_fit.MapOptions()) -> DataFrame:
    """The columns of error_rate_sensitivity with point estimates, its grid being one relation: one job simulates and maps all matrices, and one
    fits all pairs of generator and candidate. Candidate null is the observed shares alone, 'reseeded' the first generator's matrix anew.
    """
    index = cluster_references(refs, o.mapper)
    names = [str(g) for g in generators]
    truth = theta.select(F.explode(F.array(*(F.lit(x) for x in names))).alias("sample"), "genome", "theta")
    counts = planted_hits(refs, truth, n_reads, o, index, dict(zip(names, generators, strict=True)))
    cells = [("base", generators[0], o.seed), ("reseeded", generators[0], o.seed + 57), *((str(c), c, o.seed) for c in candidates)]
    matrices = cell_matrices(refs, cells, o, index)
    base = matrices.where("cell = 'base'").select("src", "dst", F.col("p").alias("base"))
    others = matrices.where("cell <> 'base'")
    # entries of a cell, and those of the base that it lacks
    both = others.select("cell", "src", "dst", "p").unionByName(others.select("cell").distinct().join(F.broadcast(base.select("src", "dst"))).withColumn("p", F.lit(0.0)))
    both = both.groupBy("cell", "src", "dst").agg(F.sum("p").alias("p")).join(base, ["src", "dst"], "left")
    facts = both.groupBy("cell").agg(F.sqrt(F.sum(F.pow(F.col("p") - F.coalesce("base", F.lit(0.0)), 2))).alias("m_dist"), (F.sum(F.when(F.col("src") == F.col("dst"), F.col("p")).otherwise(0.0)) / F.count_distinct("src")).alias("mean_diag"))
    fits = map_fit.fitted(counts, C.translation_table(refs.select("refseq", "genome")), others, refs, fit)
    estimates = fits.select("sample", "cell", "genome", "theta").join(truth.withColumnRenamed("theta", "true_theta"), ["sample", "genome"], "left")
    l1 = estimates.groupBy("sample", "cell").agg(F.sum(F.abs(F.col("theta") - F.coalesce("true_theta", F.lit(0.0)))).alias("l1"))
    out = l1.join(F.broadcast(facts), "cell").select(F.col("sample").alias("generator"), F.col("cell").alias("candidate"), "l1", "m_dist", "mean_diag")  # a row for each cell
    none = lambda kind: F.lit(None).cast(kind)
    alone = errors(observed_shares(counts, refs), truth).select(F.col("sample").alias("generator"), none("string").alias("candidate"), "l1", none("double").alias("m_dist"), none("double").alias("mean_diag"))
    return alone.unionByName(out)


def presence_grid(refs: DataFrame, truth: DataFrame, pair: tuple[str, str], o: Options, *, priors: Sequence[float] = PRIORS, temperatures: Sequence[float] = TEMPERATURES, n_reads: int = 50_000, fit: map_fit.MapOptions = map_fit.MapOptions()) -> DataFrame:
    """Score rows of the gate at each prior and temperature and replicate, from one fit: what a fit loses without a genome gives its presence under
    any setting, so settings are columns."""
    counts = planted_hits(refs, truth, n_reads, o)
    matrix, _ = build_matrix(refs, o)
    fits = written(map_fit.fitted(counts, C.translation_table(refs.select("refseq", "genome")), matrix, refs, fit), "grid-fit")
    grid = F.array(*(F.struct(F.lit(float(p)).alias("prior"), F.lit(float(t)).alias("temp")) for p in priors for t in temperatures))
    rows = fits.select("sample", "genome", "theta", "lost", F.explode(grid).alias("x")).select("sample", "genome", "theta", "lost", "x.*")
    rows = rows.withColumn("pred", metrics.present(map_fit.presence(F.col("lost"), F.col("prior"), F.col("temp")))).withColumn("theta", F.when(F.col("pred"), F.col("theta")).otherwise(0.0))
    total = F.sum("theta").over(Window.partitionBy("sample", "prior", "temp"))  # a row for each genome
    rows = rows.withColumn("theta", F.coalesce(F.try_divide("theta", total), F.lit(0.0)))
    settings = truth.select("sample", "genome", F.col("theta").alias("true_theta"), F.explode(grid).alias("x")).select("sample", "genome", "true_theta", "x.*")
    rows = settings.join(rows.select("sample", "genome", "prior", "temp", "theta", "pred"), ["sample", "genome", "prior", "temp"], "left")
    calls = rows.select(F.lit("gate").alias("method"), "prior", "temp", F.col("sample").alias("replicate"), "genome", F.coalesce("theta", F.lit(0.0)).alias("theta"), "true_theta", F.coalesce("pred", F.lit(False)).alias("pred"), (F.col("true_theta") > 0).alias("truth"))
    return metrics.score_row(calls, *pair, by=["method", "prior", "temp", "replicate"])


def error_rate_sensitivity(refs: DataFrame, theta: DataFrame, o: Options, *, generators: Sequence[float] = (0.005, 0.01), candidates: Sequence[float] = FLAT_RATES, n_reads: int = 50_000) -> DataFrame:
    """generator, candidate, l1, m_dist, mean_diag: fits of reads made at each generator rate by matrices of each candidate rate.

    refs: refseq, genome, sequence; theta: genome, theta. Candidate null is the observed shares alone; 'reseeded' is the
    first generator's matrix simulated anew, the floor of m_dist.
    """
    index = cluster_references(refs, o.mapper)
    at = lambda rate: replace(o, flat_sub_rate=rate)
    counts = [planted_hits(refs, theta.select(F.lit(str(g)).alias("sample"), "genome", "theta"), n_reads, at(g), index) for g in generators]
    counts = written(reduce(DataFrame.unionByName, counts), "generators")
    truth = reduce(DataFrame.unionByName, [theta.select(F.lit(str(g)).alias("sample"), "genome", "theta") for g in generators])
    none = lambda kind: F.lit(None).cast(kind)
    out = [errors(observed_shares(counts, refs), truth).select(F.col("sample").alias("generator"), none("string").alias("candidate"), "l1", none("double").alias("m_dist"), none("double").alias("mean_diag"))]
    base, _ = build_matrix(refs, at(generators[0]), index)
    matrices = {str(c): build_matrix(refs, at(c), index)[0] for c in candidates}
    matrices["reseeded"] = build_matrix(refs, replace(at(generators[0]), seed=o.seed + 57), index)[0]
    for name, m in matrices.items():
        fits = infer(counts, C.translation_table(refs.select("refseq", "genome")), m, replace(o.infer, presence=False))
        l1 = errors(fits.composition.select("sample", F.col("genome_id").alias("genome"), F.col("inferred_mean").alias("theta")), truth)
        facts = C.distances(m, base).select(F.col("frobenius").alias("m_dist")).join(C.mean_diagonal(m, refs).withColumnRenamed("mean_diagonal", "mean_diag"))  # one row each
        out.append(l1.join(F.broadcast(facts)).select(F.col("sample").alias("generator"), F.lit(name).alias("candidate"), "l1", "m_dist", "mean_diag"))
    return reduce(DataFrame.unionByName, out)


def presence_sweep(refs: DataFrame, truth: DataFrame, pair: tuple[str, str], o: Options, *, priors: Sequence[float] = PRIORS, temperatures: Sequence[float] = TEMPERATURES, cutoffs: Sequence[float] = CUTOFFS, n_reads: int = 50_000) -> DataFrame:
    """Score rows of every setting and replicate: method, prior, temp, replicate and the columns of metrics.score_row.

    refs: refseq, genome, sequence; truth: sample (the replicate), genome, theta. Besides the gate at each prior and temperature
    there are the ungated fit and the observed shares, called present over each cutoff.
    """
    counts = planted_hits(refs, truth, n_reads, o)
    matrix, _ = build_matrix(refs, o)
    table = C.translation_table(refs.select("refseq", "genome"))
    known = truth.select("sample", "genome", F.col("theta").alias("true_theta"))

    def calls(estimate: DataFrame, pred, method: str, prior: float | None, temp: float | None) -> DataFrame:
        rows = known.join(estimate, ["sample", "genome"], "left").withColumn("theta", F.coalesce("theta", F.lit(0.0)))
        setting = (F.lit(method).alias("method"), F.lit(prior).cast("double").alias("prior"), F.lit(temp).cast("double").alias("temp"))
        return rows.select(*setting, F.col("sample").alias("replicate"), "genome", "theta", "true_theta", F.coalesce(pred, F.lit(False)).alias("pred"), (F.col("true_theta") > 0).alias("truth"))

    fit = lambda **more: infer(counts, table, matrix, replace(o.infer, **more)).composition.select("sample", F.col("genome_id").alias("genome"), F.col("inferred_mean").alias("theta"), "presence_prob")
    out = []
    for method, estimate in (("ungated fit", fit(presence=False)), ("naive observed", observed_shares(counts, refs))):
        out += [calls(estimate, F.col("theta") > c, f"{method} (>{c:g})", None, None) for c in cutoffs]
    for p in priors:
        for t in temperatures:
            out.append(calls(fit(presence=True, presence_prior=p, presence_temp=t), metrics.present(F.col("presence_prob")), "gate", p, t))
    rows = written(reduce(DataFrame.unionByName, out), "sweep")
    return metrics.score_row(rows, *pair, by=["method", "prior", "temp", "replicate"])


def sweep_result(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The summary of a sweep, best first, and the best gate setting that kept the pair's low member in every replicate."""
    by = ["method", "prior", "temp"]
    summary = metrics.sweep_summary(scores, by, ["jaccard", "precision", "recall", "l1", "n_pred", "pair_low"])
    return summary, metrics.best_setting(summary.where("method = 'gate'"), by)
