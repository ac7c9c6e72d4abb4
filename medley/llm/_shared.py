"""Helpers of the training-data operators: shared scratch tables, sized broadcasts, file access."""

from __future__ import annotations

import gc
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import BROADCAST_ROWS, freed, new_dir, removed, shared_dir, sized, written

__all__ = ["BLANKS", "BLANK_RUN", "BROADCAST_ROWS", "bound", "counted_join", "folders", "freed", "new_dir", "open_fs", "put_file", "removed", "shared_dir", "sized", "spread_join", "table", "text_slices", "words_of", "worker_dropped", "worker_held", "written"]

#: The six characters that separate words in every contract: \x20 and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder; none if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().toString() for f in fs.listStatus(where) if f.isDirectory()) if fs.exists(where) else []


def bound(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text (null: none): runs of other characters than BLANKS."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def open_fs(uri: str):
    """(file system, path) of a URI such as file:/x, s3a://b/x, gs://b/x or hdfs://h/x.

    Spark's connectors know object stores by other schemes than pyarrow does.
    """
    from pyarrow import fs

    for theirs, ours in (("s3a:", "s3:"), ("s3n:", "s3:"), ("abfss:", "abfs:")):
        if uri.startswith(theirs):
            uri = ours + uri[len(theirs) :]

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def put_file(uri: str, chunks) -> None:
    """Write a file under another name, then move it: a task that is tried again leaves one whole file."""
    system, path = open_fs(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(part, path)


#: Parts into which the rows of one key are dealt where the other side is too large to be sent to every task.
SALTS = 16


def spread_join(rows: DataFrame, small: DataFrame, on: str, by: Column, how: str = "left") -> DataFrame:
    """rows joined with small, which has each key once: by broadcast if small is, else by key and salt, the hash of by.

    So a key that a third of the rows share is never one task's. The salted join asks for a shuffle: Spark goes by the bytes of the
    files of small, whose rows may be many more than are broadcast here and are SALTS times as many in that join.
    """
    if (sent := sized(small)) is not small:
        return rows.join(sent, on, how)
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS))).join(small.withColumn("_salt", F.explode(salts)).hint("merge"), [on, "_salt"], how).drop("_salt")


#: Rows of one key from which that key is joined apart from the others.
HOT = 1000


def counted_join(rows: DataFrame, small: DataFrame, on: str, n: str, by: Column) -> DataFrame:
    """rows left-joined with small, a written table that has each key once and, in n, how many rows have it; n is dropped.

    By broadcast if small is. Else keys of more than HOT rows, of which there are few, are broadcast and the others join by key, so
    no task gets more than HOT rows of one. If even those are too many to send, all keys are salted by the hash of by.
    """
    if (sent := sized(small)) is not small:
        return rows.join(sent.drop(n), on, "left")
    hot = small.where(F.col(n) > HOT).drop(n)
    if (sent := sized(hot)) is hot:
        return spread_join(rows, small.drop(n), on, by)
    cold = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(small.where(F.col(n) <= HOT).drop(n).hint("merge"), on, "left")
    return rows.join(sent, on).unionByName(cold)


def text_slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """Runs of texts of so many bytes at most, or of one text."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
        yield texts.slice(lo, hi - lo)
        lo = hi


def worker_held(name: str, key: object, make, place: int = 0):
    """What make() gave for this key in this worker process: it outlives a task. One value is held for each place of a name.

    Values of other names are dropped, so a worker that serves several operators one after the other has the memory of one.
    """
    held = sys.modules.setdefault("medley_worker", types.ModuleType("medley_worker")).__dict__
    if held.get("name") != name:
        held["name"], held["values"] = name, {}
        gc.collect()
        pa.default_memory_pool().release_unused()
    if held["values"].get(place, (None,))[0] != key:
        held["values"].pop(place, None)
        held["values"][place] = (key, make())
    return held["values"][place][1]


def worker_dropped() -> None:
    """Drop what other operators hold in this worker process."""
    worker_held("", 0, lambda: None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
