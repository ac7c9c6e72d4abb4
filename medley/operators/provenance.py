"""Content-addressed grouping: one matrix per distinct reference set, settings and error model."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import sized, written


#: Records, or digests, that one row of a digest tree gathers; ordinals whose records are ranked together (16 MB of a file).
GATHERED, SPAN = 4096, 1 << 40


def content_hash(rows: DataFrame, by: list[str], order: str, *parts: str, gathered: int = GATHERED, span: int = SPAN) -> DataFrame:
    """SHA-256 per group over its rows as FASTA text, in order, as the root of a tree of digests.

    Each row is hashed; runs of so many hashes in order are joined and hashed, and runs of those again, until a group has one. So a group
    of up to gathered rows has the digest of all its hashes, and no row gathers more of them, however many there are. Rows are
    ranked span by span of the order column, a number, and moved by the counts of the spans before.
    """
    line = F.sha2(F.concat_ws("\n", *(F.col(p) for p in parts)), 256)
    lines = rows.select(*by, F.col(order).alias("_o"), line.alias("_h"), F.floor(F.col(order) / span).alias("_span"))
    lines = written(lines, "record-hashes")
    counts = lines.groupBy(*by, "_span").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)  # a row for each span of a group
    starts = written(counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))), "spans")
    most = starts.agg(F.max(F.col("_start") + F.col("_n"))).first()[0] or 0
    key = F.struct(*by, "_span")
    ranked = lines.withColumn("_k", key).join(sized(starts.select(key.alias("_k"), "_start")), "_k").drop("_k")
    rank = F.row_number().over(Window.partitionBy(*by, "_span").orderBy("_o", "_h")) - 1
    level = ranked.select(*by, (F.col("_start") + rank).alias("_at"), "_h")
    first = True
    while first or most > 1:
        run = F.floor(F.col("_at") / gathered)
        joined = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_h"))), lambda x: x["_h"]), "\n"), 256)
        # above the records, what stands alone is the digest already
        digest = joined if first else F.when(F.count(F.lit(1)) == 1, F.min("_h")).otherwise(joined)
        level = level.groupBy(*by, run.alias("_run")).agg(digest.alias("_h")).withColumnRenamed("_run", "_at")
        most, first = -(-most // gathered), False
    return level.select(*by, F.col("_h").alias("reference_sha256"))


def settings_text(settings: Mapping[str, object]) -> str:
    """Settings as sorted k=v lines."""
    return "\n".join(sorted(f"{k}={'null' if v is None else v}" for k, v in settings.items()))


def matrix_key(reference: Column, settings: str, identity: Column) -> Column:
    """SHA-256 of the reference digest, the settings and the digest of the error model's identity."""
    return F.sha2(F.concat_ws("\n", reference, F.lit(settings), F.sha2(identity, 256)), 256)


def model_identity(samples: DataFrame, error_model: str, scope: str, supplied: str | None = None) -> DataFrame:
    """samples with identity: supplied, flat, per-sample:<id> or pooled:<platform>; a sample's own model wins."""
    own = F.col("error_model").isNotNull()
    if supplied is not None:
        out = F.lit("supplied")
    elif error_model == "flat":
        out = F.lit("flat")
    elif scope == "per-sample":
        out = F.when(own, F.lit("supplied")).otherwise(F.concat(F.lit("per-sample:"), F.col("id")))
    elif scope == "pooled":
        out = F.when(own, F.lit("supplied")).otherwise(F.concat(F.lit("pooled:"), F.col("platform")))
    else:
        raise ValueError(f"unknown scope {scope}")
    return samples.withColumn("identity", out)


def matrix_groups(samples: DataFrame) -> DataFrame:
    """One row per matrix key of samples (id, platform, matrix_key, reference_sha256, identity).

    The least sample id represents the group; members are in order of id.
    """
    members = F.sort_array(F.collect_list(F.struct("id", "platform")))
    out = samples.groupBy("matrix_key").agg(
        F.min("id").alias("representative"), F.min("reference_sha256").alias("reference_sha256"), F.min(F.split_part("identity", F.lit(":"), F.lit(1))).alias("model_scope"), members.alias("members")
    )
    return out.withColumn("source", F.when(F.col("model_scope") == "supplied", "supplied").otherwise("generated"))


def provenance(groups: DataFrame, settings: Mapping[str, object]) -> DataFrame:
    """matrix_key and its provenance as JSON."""
    fixed = F.from_json(F.lit(json.dumps({k: None if v is None else str(v) for k, v in sorted(settings.items())})), F.lit("map<string,string>"))
    return groups.select("matrix_key", F.to_json(F.struct("matrix_key", "reference_sha256", "model_scope", "source", fixed.alias("settings"), "members")).alias("provenance"))


def group_records(groups: DataFrame) -> DataFrame:
    """The index of matrix bundles."""
    ids = F.array_join(F.transform("members", lambda m: m["id"]), ",")
    return groups.select("matrix_key", "reference_sha256", "model_scope", "source", F.concat(F.lit("mismapping/"), "matrix_key", F.lit("/mismapping_matrix.csv")).alias("matrix_path"), ids.alias("samples"))


def group_members(groups: DataFrame) -> DataFrame:
    """sample_id, platform, matrix_key of every member: a matrix's fan-out to its samples."""
    return groups.select("matrix_key", F.explode("members").alias("m")).select(F.col("m.id").alias("sample_id"), F.col("m.platform").alias("platform"), "matrix_key")
