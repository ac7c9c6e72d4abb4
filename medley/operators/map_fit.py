"""Point estimates of compositions under the Dirichlet-multinomial model, as one relation over samples and settings.

Counts y of a sample are Dirichlet-multinomial around r = theta A, A = T M', M' = (1 - s) I + s M made non-negative with rows
that sum to one; the concentration is kappa times the number of reads. For given s and kappa theta is found by fixed-point steps

    E_g = theta_g * sum_j A_gj * w_j,  w_j = kappa n (digamma(c_j + y_j) - digamma(c_j)),  c = kappa n r,

theta_g being proportional to E_g + alpha - 1, or zero where that is negative; each step raises the posterior. s and kappa lie on grids with the
log-normal weights of their priors, and the best pair wins. A genome's presence is the logistic of the prior's logit plus what the log
likelihood loses, over the temperature, when the genome is left out and the others are scaled up.

Settings are columns: a row is a sample, a cell (for instance an error rate, with its own matrix), s and kappa. A row brings its counts, the
packed matrix of its cell and s goes to every task once, and all steps run inside one expression, so any number of samples, cells
and bootstrap replicates is one job with no shuffle between steps. Matrices beyond PACKED entries take em, which has a form by joins.

Defined results: samples without counts on known references have no row; counts on other references are left out; zero counts
are as good as missing ones; several rows of a reference are added up; a genome that no reference has cannot be found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import written
from .composition import PACKED, posterior_summary, replicates

# The priors' locations and scales of log s and log kappa.
S_SCALE, K_MEAN, K_SCALE = 0.3, 1.1, 1.0
SHIFT = 10


@dataclass(frozen=True)
class MapOptions:
    alpha: float = 0.5
    iterations: int = 300
    s_grid: tuple[float, ...] = (0.6, 0.8, 1.0, 1.25, 1.6)
    kappa_grid: tuple[float, ...] = (1.0, 3.0, 9.0)
    presence_prior: float = 0.01
    presence_temp: float = 1.0

    def __post_init__(self):
        if not self.s_grid or not self.kappa_grid or min(*self.s_grid, *self.kappa_grid, self.alpha, self.presence_temp) <= 0 or self.iterations < 1:
            raise ValueError("grids are not empty; s, kappa, alpha, temperature and iterations are over zero")
        if not 0 < self.presence_prior < 1:
            raise ValueError("presence_prior lies between zero and one")


def digamma(x: Column) -> Column:
    """By recurrence over SHIFT, then the asymptotic series; x over zero."""
    y = x + SHIFT
    z = 1.0 / (y * y)
    series = F.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z / 240)))
    return series - sum((1.0 / (x + k) for k in range(1, SHIFT)), 1.0 / x)


def log_gamma(x: Column) -> Column:
    """By recurrence over SHIFT, then Stirling's series; x over zero."""
    y = x + SHIFT
    z = 1.0 / (y * y)
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return series - sum((F.log(x + k) for k in range(1, SHIFT)), F.log(x))


def scaled(matrix: DataFrame, refs: DataFrame, s_grid: Sequence[float]) -> DataFrame:
    """cell, s, src, dst, p: (1 - s) I + s M of each cell's matrix (cell, src, dst, p), clamped at zero, rows made to sum to one."""
    grid = F.explode(F.array(*(F.lit(float(s)) for s in s_grid)))
    ids = matrix.select("cell").distinct().join(F.broadcast(refs.agg(F.collect_set("refseq").alias("ids")))).select("cell", F.explode("ids").alias("src"))
    stay = ids.withColumn("s", grid).select("cell", "s", "src", F.col("src").alias("dst"), (1.0 - F.col("s")).alias("p"))
    moved = matrix.withColumn("s", grid).select("cell", "s", "src", "dst", (F.col("s") * F.col("p")).alias("p"))
    both = moved.unionByName(stay).groupBy("cell", "s", "src", "dst").agg(F.greatest(F.sum("p"), F.lit(0.0)).alias("p"))
    total = F.sum("p").over(Window.partitionBy("cell", "s", "src"))  # a row of a matrix
    return both.withColumn("p", F.col("p") / total)


def packed(translation: DataFrame, matrices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The composed matrices, a row for each cell and s: genomes, by_j and by_g (their lines, of (i, a) in order); and refseq with its place j."""
    a = matrices.join(translation, F.col("refseq") == F.col("src")).groupBy("cell", "s", "genome", "dst").agg(F.sum(F.col("weight") * F.col("p")).alias("a"))
    a = written(a, "composed")
    settings = a.select("cell", "s").distinct().count()
    if (n := a.count()) > PACKED * max(1, settings):
        raise ValueError(f"{n} entries of composed matrices; em has a form by joins")
    g = a.select("genome").distinct().withColumn("g", F.row_number().over(Window.orderBy("genome")) - 1)
    j = written(a.select(F.col("dst").alias("refseq")).distinct().withColumn("j", F.row_number().over(Window.orderBy("refseq")) - 1), "places")
    cells = a.join(F.broadcast(g), "genome").join(F.broadcast(j.withColumnRenamed("refseq", "dst")), "dst")

    def lines(row: str, column: str) -> DataFrame:
        each = cells.groupBy("cell", "s", row).agg(F.sort_array(F.collect_list(F.struct(F.col(column).alias("i"), "a"))).alias("xs"))
        return each.groupBy("cell", "s").agg(F.transform(F.sort_array(F.collect_list(F.struct(row, "xs"))), lambda x: x["xs"]).alias(f"by_{row}"))

    names = g.agg(F.sort_array(F.collect_list("genome")).alias("genomes"))
    return written(lines("j", "g").join(lines("g", "j"), ["cell", "s"]).join(F.broadcast(names)), "packed"), j


def dense(xs: Column, size: Column, at: str, value: str) -> Column:
    """Values at their places, in order, with zeros between."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n.cast("int"))
    before = lambda i: F.when(i > 0, F.get(xs, i - 1)[at]).otherwise(-1)
    return F.concat(F.flatten(F.transform(xs, lambda x, i: F.concat(zeros(x[at] - before(i) - 1), F.array(x[value])))), zeros(size - F.element_at(xs, -1)[at] - 1))


def fitted(observed: DataFrame, translation: DataFrame, matrix: DataFrame, refs: DataFrame, o: MapOptions = MapOptions(), by: Sequence[str] = ("sample",)) -> DataFrame:
    """by, cell, genome, theta, presence, lost, s, kappa, log_joint: the best fit of each sample and cell.

    observed: by, refseq, n; translation: genome, refseq, weight; matrix: src, dst, p, and cell if there are several; refs: refseq.
    lost is what the log likelihood loses without the genome, from which the presence under other priors follows.
    """
    matrix = matrix if "cell" in matrix.columns else matrix.withColumn("cell", F.lit(""))
    pack, places = packed(translation, scaled(matrix.select("cell", "src", "dst", "p"), refs.select("refseq").distinct(), o.s_grid))
    counts = observed.where("n > 0").groupBy(*by, "refseq").agg(F.sum("n").cast("double").alias("n")).join(F.broadcast(places), "refseq")
    ys = counts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("j", "n"))).alias("ys"), F.sum("n").alias("total"))
    rows = ys.join(F.broadcast(pack)).withColumn("y", dense(F.col("ys"), F.size("by_j"), "j", "n")).drop("ys")  # as many rows of pack as settings
    rows = rows.withColumn("kappa", F.explode(F.array(*(F.lit(float(k)) for k in o.kappa_grid))))
    mass = F.col("kappa") * F.col("total")

    def dot(xs: Column, values: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x["a"] * values[x["i"]])

    def rates(theta: Column) -> Column:
        return F.transform("by_j", lambda xs: mass * dot(xs, theta) + 1e-6)

    def step(theta: Column, _: Column) -> Column:
        w = F.zip_with("y", rates(theta), lambda y, c: F.when(y > 0, mass * (digamma(c + y) - digamma(c))).otherwise(0.0))
        raw = F.transform(F.array(w), lambda w: F.zip_with(theta, "by_g", lambda t, xs: F.greatest(t * dot(xs, w) + (o.alpha - 1.0), F.lit(0.0))))
        return F.transform(raw, lambda e: F.transform(e, lambda x: x / F.greatest(F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v), F.lit(1e-300))))[0]

    start = F.transform("genomes", lambda x: F.lit(1.0) / F.size("genomes"))
    rows = rows.withColumn("theta", F.aggregate(F.sequence(F.lit(1), F.lit(o.iterations)), start, step))

    def fits(c: Column) -> Column:
        """The part of the log likelihood that depends on the rates."""
        return F.aggregate(F.zip_with("y", c, lambda y, x: F.when(y > 0, log_gamma(x + y) - log_gamma(x)).otherwise(0.0)), F.lit(0.0), lambda acc, v: acc + v)

    rows = rows.withColumn("_c", rates(F.col("theta"))).withColumn("_fit", fits(F.col("_c")))
    log_normal = lambda x, mean, scale: -0.5 * F.pow((F.log(x) - mean) / scale, 2) - F.log(x)
    joint = F.col("_fit") + log_gamma(mass) - log_gamma(mass + F.col("total")) + log_normal(F.col("s"), 0.0, S_SCALE) + log_normal(F.col("kappa"), K_MEAN, K_SCALE)
    rows = rows.withColumn("log_joint", joint)
    best = rows.groupBy(*by, "cell").agg(F.max_by(F.struct("theta", "by_g", "genomes", "y", "_c", "_fit", "total", "s", "kappa", "log_joint"), F.struct("log_joint", F.negative("s"), F.negative("kappa"))).alias("x"))
    rows = best.select(*by, "cell", "x.*")

    def lost(t: Column, xs: Column) -> Column:
        """What the fit loses without a genome: its part leaves the rates, and the rest is scaled up."""
        without = F.zip_with("_c", dense(xs, F.size("y"), "i", "a"), lambda c, a: F.greatest((c - 1e-6 - mass * t * a) / F.greatest(1.0 - t, F.lit(1e-12)), F.lit(0.0)) + 1e-6)
        return F.when(t > 0, F.col("_fit") - fits(without)).otherwise(0.0)

    cells = F.arrays_zip(F.col("genomes").alias("genome"), F.col("theta").alias("theta"), F.zip_with("theta", "by_g", lost).alias("lost"))
    out = rows.select(*by, "cell", F.explode(cells).alias("g"), "s", "kappa", "log_joint").select(*by, "cell", "g.genome", "g.theta", "g.lost", "s", "kappa", "log_joint")
    return out.withColumn("presence", presence(F.col("lost"), o.presence_prior, o.presence_temp))


def presence(lost: Column, prior: float | Column, temp: float | Column) -> Column:
    """The chance that a genome is there, from what the fit loses without it."""
    prior, temp = (x if isinstance(x, Column) else F.lit(float(x)) for x in (prior, temp))
    return 1.0 / (1.0 + F.exp(-F.greatest(F.least((F.log(prior / (1.0 - prior)) + lost) / temp, F.lit(500.0)), F.lit(-500.0))))


def intervals(observed: DataFrame, translation: DataFrame, matrix: DataFrame, refs: DataFrame, o: MapOptions = MapOptions(), by: Sequence[str] = ("sample",), draws: int = 100, seed: int = 42) -> DataFrame:
    """by, cell, genome, mean, lo, hi of theta over bootstrap replicates of the counts, all fitted in one job."""
    drawn = replicates(observed.groupBy(*by, "refseq").agg(F.sum("n").alias("n")), draws, seed, list(by))
    out = fitted(drawn, translation, matrix, refs, o, [*by, "replicate"])
    return posterior_summary(out, [*by, "cell", "genome"])
