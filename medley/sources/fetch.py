"""Random access to FASTA files through an index: chosen records, and parts of them, by coalesced range reads."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import sized
from .sequences import file_system

#: Bytes between two ranges that are read with them, and bytes of one read.
GAP, READ = 64 << 10, 8 << 20
FETCHED = "header string, start long, stop long, sequence string"


def fasta_index(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A row per record of plain FASTA files: path, file_no, ordinal, header, and where its sequence is. Made in one pass over split files.

    Write the table once; it serves every later fetch.
    """
    from .sequences import register

    register(spark)
    return spark.read.format("fasta_index").options(**options).load(path)


def fetched(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """header, start, stop, sequence of wanted (header, start, stop): bases from start up to stop, 0-based; null start or stop: the end.

    Ranges are cut to the record. Headers that the index lacks have no row; those that it has several times have one for each. Only the bytes of the wanted bases
    are read where a record's lines are even, else its record. Wanted ranges are dealt in order of file and byte, and each task reads ranges that
    lie within GAP of each other at once.
    """
    w = wanted.select("header", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"))
    rows = index.join(sized(w), "header")
    first = F.least(F.greatest(F.coalesce("start", F.lit(0)), F.lit(0)), F.col("length"))
    rows = rows.withColumn("_first", first).withColumn("_last", F.greatest(F.least(F.coalesce("stop", "length"), F.col("length")), F.col("_first")))
    at = lambda base: F.col("offset") + F.floor(F.col(base) / F.col("line_bases")) * F.col("line_bytes") + F.col(base) % F.col("line_bases")
    even = F.col("line_bases").isNotNull() & (F.col("line_bases") > 0)
    rows = rows.withColumn("_from", F.when(even, at("_first")).otherwise(F.col("offset")))
    rows = rows.withColumn("_upto", F.when(even, at("_last")).otherwise(F.col("offset") + F.col("bytes")))
    # of a record that is read whole, the bases before and after the wanted ones are cut off
    rows = rows.withColumn("_cut", F.when(even, 0).otherwise(F.col("_first"))).withColumn("_size", F.col("_last") - F.col("_first"))
    rows = rows.select("path", "_from", "_upto", "_cut", "_size", "header", "start", "stop")
    # a range that many rows want is dealt to several tasks
    dealt = rows.withColumn("_deal", F.xxhash64("start", "stop")).repartitionByRange("path", "_from", "_deal").sortWithinPartitions("path", "_from")
    return dealt.drop("_deal").mapInPandas(_read, FETCHED)


def _read(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    opened, name = None, None

    def taken(group: list) -> pd.DataFrame:
        nonlocal opened, name
        if group[0].path != name:
            if opened is not None:
                opened.close()
            system, at = file_system(group[0].path)
            opened, name = system.open_input_file(at), group[0].path
        base = group[0].from_
        opened.seek(base)
        data = opened.read(max(r.upto for r in group) - base)
        bases = (b"".join(x.strip() for x in data[r.from_ - base : r.upto - base].split(b"\n")).upper().decode()[r.cut : r.cut + r.size] for r in group)
        return pd.DataFrame([(r.header, r.start, r.stop, b) for r, b in zip(group, bases, strict=True)], columns=["header", "start", "stop", "sequence"]).astype({"start": "Int64", "stop": "Int64"})

    group: list = []
    for pdf in frames:
        pdf = pdf.astype({"start": "Int64", "stop": "Int64"}).rename(columns={"_from": "from_", "_upto": "upto", "_cut": "cut", "_size": "size"})
        for r in pdf.itertuples(index=False):
            if group and (r.path != group[0].path or r.from_ > max(group[-1].upto, group[0].from_) + GAP or r.upto - group[0].from_ > READ):
                yield taken(group)
                group = []
            group.append(r)
    if group:
        yield taken(group)
    if opened is not None:
        opened.close()
