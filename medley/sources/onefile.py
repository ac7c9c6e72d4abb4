"""A sink that leaves one named file: df.write.format("one_file").save(path), lines in the order of the partitions.

Each task writes its rows as a part beside the file; the commit joins the parts in the order of the partitions under another name and moves
that over the old file, so a reader sees the old file or the whole new one. If a path ends with .gz every part is a gzip member; members that
follow each other are one gzip file. The join reads and writes a few megabytes at a time. Options: header (lines that come first).

For what other programs take as a file: reference sets, taxonomies. Tables that grow with the data stay folders.
"""

from __future__ import annotations

import gzip
import uuid
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .sequences import PIECE, file_system


@dataclass
class Written(WriterCommitMessage):
    partition: int
    path: str


class Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.header = options["path"], options.get("header", "")
        folder, _, name = self.path.rpartition("/")
        self.folder = f"{folder or '.'}/.{name}.{uuid.uuid4().hex}"

    def packed(self, text: str) -> bytes:
        return gzip.compress(text.encode(), 6, mtime=0) if self.path.endswith(".gz") else text.encode()

    def write(self, batches) -> Written:
        task = TaskContext.get()
        at = f"{self.folder}/{task.partitionId():08d}-{task.taskAttemptId()}"  # an attempt that does not count leaves a part that is not joined
        system, name = file_system(at)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        with system.open_output_stream(name, compression=None) as out:
            for batch in batches:
                if batch.num_rows:
                    out.write(self.packed("".join(f"{x}\n" for x in batch.column(0).to_pylist())))
        return Written(task.partitionId(), at)

    def commit(self, messages) -> None:
        system, final = file_system(self.path)
        new = f"{self.folder}.part"
        _, joined = file_system(new)
        system.create_dir(joined.rpartition("/")[0], recursive=True)
        with system.open_output_stream(joined, compression=None) as out:
            if self.header:
                out.write(self.packed(self.header.rstrip("\n") + "\n"))
            for m in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
                with system.open_input_stream(file_system(m.path)[1], compression=None) as part:
                    while piece := part.read(PIECE):
                        out.write(piece)
        system.move(joined, final)
        self.abort(messages)

    def abort(self, messages) -> None:
        removed(self.path, file_system(self.folder)[1])


class OneFile(DataSource):
    @classmethod
    def name(cls):
        return "one_file"

    def schema(self):
        return "value string"

    def writer(self, schema, overwrite):
        return Writer(self.options)


def write_one_file(lines: DataFrame, path: str, header: str = "") -> None:
    """A column of lines as one file; an existing file is replaced."""
    spark: SparkSession = lines.sparkSession
    spark.dataSource.register(OneFile)
    lines.toDF("value").write.format("one_file").option("header", header).mode("append").save(path)


def replaced(new: list[tuple[str, str]]) -> None:
    """Move files (from, to) into place, all or none: old ones are kept aside until all are there, and come back if a move fails."""
    moved: list[tuple[str, str, str | None]] = []
    try:
        for source, target in new:
            system, at = file_system(target)
            aside = f"{at}.{uuid.uuid4().hex}.old" if system.get_file_info(at).type.name != "NotFound" else None
            if aside:
                system.move(at, aside)
            moved.append((source, target, aside))
            system.move(file_system(source)[1], at)
    except BaseException:
        for _, target, aside in reversed(moved):
            system, at = file_system(target)
            if aside:
                system.move(aside, at)
            elif system.get_file_info(at).type.name != "NotFound":
                system.delete_file(at)
        raise
    for _, target, aside in moved:
        if aside:
            removed(target, aside)


def removed(near: str, at: str) -> None:
    """Delete a file or folder of a path's file system, if it is there."""
    system, _ = file_system(near)
    kind = system.get_file_info(at).type.name
    if kind == "Directory":
        system.delete_dir(at)
    elif kind == "File":
        system.delete_file(at)
