"""Rules over tables: each gives the rows that break it, so that a job can report or raise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import taxonomy_is_valid, taxonomy_levels


class Violation(ValueError):
    """Raised by require() with the first rows that break a rule."""


def require(violations: DataFrame, what: str, shown: int = 5) -> None:
    if rows := violations.take(shown):
        raise Violation(f"{what}: {[r.asDict() for r in rows]}")


def genome_violations(genomes: DataFrame) -> DataFrame:
    """id, rule of genome definitions (id, taxonomy, fasta) that break a rule."""
    rules = {
        "id is missing": F.coalesce("id", F.lit("")) == "",
        "id holds a bar or blank": F.col("id").rlike(r"[|\s]"),
        "taxonomy is missing": F.coalesce("taxonomy", F.lit("")) == "",
        "taxonomy has an empty level": (F.coalesce("taxonomy", F.lit("")) != "") & ~taxonomy_is_valid(taxonomy_levels(F.col("taxonomy"))),
        "fasta is missing": F.coalesce("fasta", F.lit("")) == "",
    }
    broken = genomes.select("id", F.explode(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())))).alias("rule"))
    twice = genomes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and id is not null").select("id", F.lit("id is not unique").alias("rule"))
    return broken.unionByName(twice)


def duplicate_ids(refs: DataFrame, column: str = "refseq") -> DataFrame:
    return refs.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def matrix_violations(matrix: DataFrame, refs: DataFrame, rtol: float = 1e-6, atol: float = 1e-8) -> DataFrame:
    """id, rule of a supplied matrix (src, dst, p) that does not fit the references or is not row-stochastic."""
    ids = refs.select(F.col("refseq").alias("id")).distinct()
    rows, cols = (matrix.select(F.col(c).alias("id")).distinct() for c in ("src", "dst"))
    say = lambda df, what: df.select("id", F.lit(what).alias("rule"))
    # a long matrix needs no entry for a zero, so a reference that is never hit has no column here
    out = say(ids.join(rows, "id", "left_anti"), "row is missing")
    out = out.unionByName(say(rows.join(ids, "id", "left_anti"), "row is unknown")).unionByName(say(cols.join(ids, "id", "left_anti"), "column is unknown"))
    out = out.unionByName(say(matrix.groupBy(F.col("src").alias("id"), "dst").count().where("count > 1").select("id").distinct(), "entry is repeated"))
    bad = matrix.where(F.col("p").isNull() | F.isnan("p") | (F.abs("p") == float("inf")) | (F.col("p") < 0))
    out = out.unionByName(say(bad.select(F.col("src").alias("id")).distinct(), "entry is no probability"))
    sums = matrix.groupBy(F.col("src").alias("id")).agg(F.sum("p").alias("s")).where(F.abs(F.col("s") - 1) > atol + rtol)
    return out.unionByName(say(sums, "row does not sum to one"))


def sample_violations(samples: DataFrame, scopes: tuple[str, ...] = ("per-sample", "pooled"), platforms: tuple[str, ...] = ("illumina", "nanopore", "pacbio")) -> DataFrame:
    """id, rule of samples (id, reads, platform, references) that break a rule."""
    rules = {
        "id is missing": F.coalesce("id", F.lit("")) == "",
        "reads are missing": F.coalesce(F.size("reads"), F.lit(0)) < 1,
        "references are missing": F.coalesce("references", F.lit("")) == "",
        "platform is unknown": F.col("platform").isNotNull() & ~F.lower("platform").isin(*platforms),
    }
    broken = samples.select("id", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())))).alias("rule"))
    twice = samples.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", F.lit("id is not unique").alias("rule"))
    return broken.unionByName(twice)
