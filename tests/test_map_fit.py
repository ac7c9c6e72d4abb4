"""Relational point estimates against the same steps in numpy, and planted compositions."""

import math

import numpy as np
from pyspark.sql import functions as F

from medley.operators import map_fit as P
from medley.operators.posterior import digamma as digamma_of

T = np.array([[0.5, 0.5, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1.0]])
M = np.array([[0.7, 0.2, 0.1, 0], [0.1, 0.7, 0.1, 0.1], [0.1, 0.1, 0.7, 0.1], [0, 0, 0.3, 0.7]])


def frames(spark, counts):
    translation = spark.createDataFrame([(f"g{i}", f"r{j}", float(T[i, j])) for i in range(3) for j in range(4) if T[i, j]], "genome string, refseq string, weight double")
    matrix = spark.createDataFrame([(f"r{i}", f"r{j}", float(M[i, j])) for i in range(4) for j in range(4)], "src string, dst string, p double")
    observed = spark.createDataFrame([(s, f"r{j}", int(n)) for s, ys in counts.items() for j, n in enumerate(ys)], "sample string, refseq string, n long")
    return observed, translation, matrix, spark.createDataFrame([(f"r{i}",) for i in range(4)], "refseq string")


def plain(y, o):
    """The same search in numpy: theta, s, kappa, log joint."""
    best, n = None, y.sum()
    lg = np.vectorize(math.lgamma)
    for s in o.s_grid:
        m = np.maximum((1 - s) * np.eye(4) + s * M, 0)
        a = T @ (m / m.sum(1, keepdims=True))
        for kappa in o.kappa_grid:
            theta = np.full(3, 1 / 3)
            for _ in range(o.iterations):
                c = kappa * n * (theta @ a) + 1e-6
                w = kappa * n * (digamma_of(c + y) - digamma_of(c))
                theta = np.maximum(theta * (a @ w) + o.alpha - 1, 0)
                theta /= theta.sum()
            c = kappa * n * (theta @ a) + 1e-6
            fit = (lg(c + y) - lg(c)).sum()
            value = fit + math.lgamma(kappa * n) - math.lgamma(kappa * n + n) - 0.5 * (math.log(s) / 0.3) ** 2 - math.log(s) - 0.5 * (math.log(kappa) - 1.1) ** 2 - math.log(kappa)
            if best is None or value > best[3] + 1e-9:
                lost = [fit - (lg(x + y) - lg(x)).sum() if theta[g] else 0.0 for g in range(3) for x in [np.maximum((c - 1e-6 - kappa * n * theta[g] * a[g]) / max(1 - theta[g], 1e-12), 0) + 1e-6]]
                best = theta, s, kappa, value, lost
    return best


def test_fits_agree_with_numpy(spark):
    r = np.random.default_rng(1)
    counts = {f"s{i}": r.multinomial(5000, np.array(w) @ T @ M) for i, w in enumerate(([0.2, 0.5, 0.3], [1.0, 0, 0], [0, 0.97, 0.03], [0.6, 0.4, 0]))}
    counts["few"], counts["none"] = np.array([3, 0, 0, 1]), np.zeros(4, int)
    observed, *rest = frames(spark, counts)
    extra = spark.createDataFrame([("s0", "unknown", 500), ("s0", "r0", 0)], observed.schema)
    o = P.MapOptions(iterations=60)
    got = {}
    for x in P.fitted(observed.unionByName(extra).withColumn("theta", F.lit(1)), *rest, o).collect():
        got.setdefault(x["sample"], {})[x.genome] = x
    assert set(got) == set(counts) - {"none"}
    for s, rows in got.items():
        theta, best_s, kappa, value, lost = plain(counts[s].astype(float), o)
        assert [(x.s, x.kappa) for x in rows.values()] == [(best_s, kappa)] * 3 and abs(rows["g0"].log_joint - value) < 1e-6
        for g in range(3):
            assert abs(rows[f"g{g}"].theta - theta[g]) < 1e-7 and abs(rows[f"g{g}"].lost - lost[g]) < 1e-5
    assert abs(got["s0"]["g1"].theta - 0.5) < 0.03 and got["s1"]["g0"].presence > 0.99 > 0.1 > got["s1"]["g1"].presence and got["s2"]["g2"].presence > 0.9
    assert P.fitted(observed.limit(0), *rest, o).count() == 0


def test_intervals_and_cells_in_one_job(spark):
    observed, translation, matrix, refs = frames(spark, {"a": [900, 500, 400, 200], "b": [90, 50, 40, 20]})
    cells = matrix.withColumn("cell", F.lit("m")).unionByName(matrix.withColumn("p", (F.col("src") == F.col("dst")).cast("double")).withColumn("cell", F.lit("none")))
    o = P.MapOptions(iterations=30, s_grid=(1.0,), kappa_grid=(3.0,))
    fits = {(x["sample"], x.cell, x.genome): x.theta for x in P.fitted(observed, translation, cells, refs, o).collect()}
    assert len(fits) == 12 and fits["a", "m", "g0"] > fits["a", "none", "g0"] + 0.05
    rows = {(x["sample"], x.genome): x for x in P.intervals(observed, translation, matrix, refs, o, draws=30).collect()}
    for (s, g), x in rows.items():
        assert x.lo <= x.mean <= x.hi and abs(x.mean - fits[s, "m", g]) < 0.08
    assert rows["b", "g0"].hi - rows["b", "g0"].lo > rows["a", "g0"].hi - rows["a", "g0"].lo


def test_functions(spark):
    xs = [1e-6, 0.3, 1.0, 2.5, 40.0, 1e6]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", P.digamma(F.col("x")).alias("d"), P.log_gamma(F.col("x")).alias("l")).collect()
    for r in got:
        assert abs(r.d - digamma_of(np.array([r.x]))[0]) < 1e-8 * max(1, abs(r.d)) and abs(r.l - math.lgamma(r.x)) < 1e-9 * max(1, abs(r.l))
