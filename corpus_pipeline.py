"""The corpus pipeline: quality rules, near-duplicate removal, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the columns of
documents. A stage reads its other tables from sf_dir.

Defined results: a row with a null text, or with under 50 words, falls to the quality rules; a null id is judged like any other, is never
a near copy and keeps a place in the token files; rows that repeat an id are judged each for itself, and all stay if their id is
that of their group; of a group of near copies the least id stays; a null language or source is a value of its own; no labels
leave the base rules alone, no benchmark item cleans nothing; an empty table gives an empty result. Texts are read whole by every
stage; other columns pass through, and may have any name that does not begin with an underscore.

Each operator frees the scratch tables that its result does not read before it returns, so a stage leaves its decisions and
small tables, no copy of its documents.
Stages share nothing: any number of them and of whole runs can go on in one session. run() frees a stage's docs once the next
stage's are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medley.functions.scratch import freed, written
from medley.llm import decontaminate, mixing, ngram_join, quality_rules, wavelet
from medley.llm._shared import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return quality_rules.passing(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join: that with the least id."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its error budget."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the sources' target weights; one row per epoch in which a document is drawn."""
    return mixing.drawn(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: one row per document with its place and checksum."""
    return wavelet.token_report(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
    ("token files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            freed(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


#: Exact binomial bounds, edit matching and sub-word vocabularies have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
