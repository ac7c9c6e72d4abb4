"""Reference databases: amplicons of references, and genome lists made into a reference set with lineages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..functions.scratch import sized
from .validation import duplicate_ids, genome_violations, require


def reference_index(refs: DataFrame, forward: str, reverse: str, mismatches: int, keep: Sequence[str] = ()) -> DataFrame:
    """ordinal, refseq, genome, amplicon, amplicon_len, amplifiable: one row per reference, those that fail included."""
    cut = refs.select(*keep, "ordinal", F.col("header").alias("refseq"), S.amplicon(F.col("sequence"), forward, reverse, mismatches).alias("amplicon"))
    return cut.select(*keep, "ordinal", "refseq", S.genome_of(F.col("refseq")).alias("genome"), "amplicon", F.coalesce(F.length("amplicon"), F.lit(0)).alias("amplicon_len"), F.col("amplicon").isNotNull().alias("amplifiable"))


def amplified(index: DataFrame) -> DataFrame:
    """refseq, genome, sequence, lineage of the references that amplify; an error if none does or ids repeat."""
    require(duplicate_ids(index), "reference ids repeat")
    out = index.where("amplifiable")
    if out.isEmpty():
        raise ValueError("no reference amplifies")
    return out.select("ordinal", "refseq", "genome", F.col("amplicon").alias("sequence"), S.lineage(F.col("refseq")).alias("lineage"))


def with_reference_ids(records: DataFrame) -> DataFrame:
    """Ids genome|copy|header of records (id, ordinal, header): copies are counted per genome in file order."""
    copy = F.row_number().over(Window.partitionBy("id").orderBy("ordinal")) - 1
    return records.withColumn("refseq", F.concat_ws("|", "id", copy.cast("string"), "header"))


def genome_database(genomes: DataFrame, records: DataFrame) -> tuple[DataFrame, str]:
    """Reference set (refseq, sequence, lineage; entry and ordinal if given) and taxonomy header of genomes (id, taxonomy,
    fasta) and their records (id, ordinal, header, sequence)."""
    require(genome_violations(genomes), "genome definitions")
    order = [c for c in ("entry", "ordinal") if c in genomes.columns or c in records.columns]
    levels = genomes.select("id", *(c for c in order if c in genomes.columns), S.taxonomy_levels(F.col("taxonomy")).alias("levels"))
    depth = levels.agg(F.max(F.size("levels"))).first()[0]
    out = with_reference_ids(records).join(sized(levels), "id")
    out = out.select(*order, "refseq", "sequence", F.array_join(S.padded_lineage(F.col("levels"), F.col("id"), F.lit(depth)), ";").alias("lineage"))
    require(duplicate_ids(out), "reference ids repeat")
    names = S.level_names(depth)
    return out, taxonomy_header(names)


def genome_records(spark: SparkSession, genomes: DataFrame) -> tuple[DataFrame, str]:
    """The reference set of a genome list (entry, id, taxonomy, fasta), read from its FASTA files, and its taxonomy header."""
    from ..sources.sequences import register

    register(spark)
    require(genome_violations(genomes), "genome definitions")
    listed = genomes.collect()  # a genome list
    each = [spark.read.format("fasta").option("strict", "true").load(g["fasta"]).withColumn("id", F.lit(g["id"])) for g in listed]
    return genome_database(genomes, reduce(DataFrame.unionByName, each))


def taxonomy_header(names: list[str]) -> str:
    """The three comment lines of a taxonomy file."""
    return "\n".join([f"#cutoff: {' '.join('0.00:0.00' for _ in names)}", "#name: NCBI", f"#levels: {' '.join(names)}"])
