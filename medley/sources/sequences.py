"""FASTA and FASTQ as Spark data sources: spark.read.format("fastq").load(path).

Options: path (a file, folder or glob, or several joined by commas), strict ("true" raises on broken records), splitBytes (bytes of
a file that one task reads; 64 MB). Plain text is split anywhere: a task looks for the first record that begins after its
part's first line end, and reads on beyond its part until its last record is whole. Block gzip (a gzip member per 64 KB, each
with its length) is split at its blocks; other gzip has one task per file. A record belongs to the part that holds the line end
before it, so rows are the same for any splitBytes.

Rows leave a task as Arrow batches. A schema given to the reader chooses the columns that are made (sequences alone need no quality);
filters on path and file_no leave files out, those on name are applied before rows are handed over.

Columns: path; file_no (files in order of their paths); ordinal, where the record begins, which orders the records of a file:
the byte times 65,536, in block gzip the block's byte times 65,536 plus the byte within the block. Any file system that pyarrow knows can be read.
"""

from __future__ import annotations

import fnmatch
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

FASTA = "path string, file_no int, ordinal long, header string, sequence string"
FASTQ = "path string, file_no int, ordinal long, name string, sequence string, quality string"
FASTA_INDEX = "path string, file_no int, ordinal long, header string, offset long, bytes long, length long, line_bases long, line_bytes long"
#: Bytes of a file for one task, and of one read.
SPLIT, PIECE = 64 << 20, 4 << 20
#: What a gzip member with a block length begins with, and more than the longest block has.
BLOCK_MAGIC, LONGEST_BLOCK = b"\x1f\x8b\x08\x04", 1 << 17
PLAIN, GZIP, BLOCKS = "plain", "gzip", "blocks"


def file_system(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(paths: str) -> list[tuple[str, int]]:
    """Files of comma-separated paths, folders and globs with their sizes, sorted."""
    from pyarrow import fs

    out = []
    for one in paths.split(","):
        system, path = file_system(one.strip())
        prefix = one.strip()[: len(one.strip()) - len(path)] if one.strip().endswith(path) else ""
        if any(c in path for c in "*?["):
            folder = path[: path.index(next(c for c in path if c in "*?["))].rpartition("/")[0] or "."
            infos = system.get_file_info(fs.FileSelector(folder, recursive=True))
            found = [i for i in infos if i.is_file and fnmatch.fnmatch(i.path, path)]
        else:
            info = system.get_file_info(path)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(one)
            infos = system.get_file_info(fs.FileSelector(path)) if info.type == fs.FileType.Directory else [info]
            found = [i for i in infos if i.is_file and (len(infos) == 1 or not i.base_name.startswith(("_", ".")))]
        out += [(prefix + i.path, i.size) for i in found]
    return sorted(out)


# ---- parts of files ------------------------------------------------------------------------------------------------


class Part(InputPartition):
    def __init__(self, path: str, number: int, start: int, end: int, kind: str):
        self.path, self.number, self.start, self.end, self.kind = path, number, start, end, kind


def block_size(raw: bytes, at: int) -> int | None:
    """Bytes of the gzip block that begins at a place, from its extra field; None if none begins there or it is cut off."""
    if raw[at : at + 4] != BLOCK_MAGIC or len(raw) < at + 12:
        return None
    extra, i = raw[at + 12 : at + 12 + int.from_bytes(raw[at + 10 : at + 12], "little")], 0
    while i + 4 <= len(extra):
        size = int.from_bytes(extra[i + 2 : i + 4], "little")
        if extra[i : i + 2] == b"BC" and size == 2:
            return int.from_bytes(extra[i + 4 : i + 6], "little") + 1
        i += 4 + size
    return None


def parts_of(path: str, number: int, size: int, split: int) -> list[Part]:
    """The parts of a file that tasks read."""
    kind = PLAIN
    if path.endswith(".gz"):
        system, name = file_system(path)
        with system.open_input_file(name) as f:
            kind = BLOCKS if block_size(f.read(64), 0) else GZIP
    if kind == GZIP or split <= 0 or size <= split:
        return [Part(path, number, 0, max(size, 1) if kind != GZIP else 1 << 62, kind)]
    return [Part(path, number, at, min(at + split, size), kind) for at in range(0, size, split)]


Piece = tuple[bytes, list[int], list[int]]


def pieces(part: Part) -> Iterator[Piece]:
    """The bytes of a file from a part's start on: data, and places in the file (or of blocks) with where they are in data."""
    system, name = file_system(part.path)
    if part.kind == GZIP:
        with system.open_input_stream(name, compression="gzip") as f:
            at = 0
            while data := f.read(PIECE):
                yield data, [0], [at]
                at += len(data)
        return
    with system.open_input_file(name) as f:
        at, size = part.start, f.size()
        if part.kind == PLAIN:
            f.seek(at)
            while data := f.read(PIECE):
                yield data, [0], [at]
                at += len(data)
            return
        at = first_block(f, at, size)
        while at < size:
            f.seek(at)
            raw, i, data, starts, places = f.read(PIECE), 0, [], [], []
            held = 0
            while (n := block_size(raw, i)) and i + n <= len(raw):
                extra = int.from_bytes(raw[i + 10 : i + 12], "little")
                data.append(zlib.decompress(raw[i + 12 + extra : i + n - 8], -zlib.MAX_WBITS))
                starts.append(held)
                places.append(at + i)
                held += len(data[-1])
                i += n
            if not i:
                raise ValueError(f"{part.path}: no gzip block at byte {at}")
            yield b"".join(data), starts, places
            at += i


def first_block(f, at: int, size: int) -> int:
    """Where the first block at or after a byte begins: its length must lead to another block or to the end."""
    if at == 0:
        return 0
    f.seek(at)
    raw, i = f.read(2 * LONGEST_BLOCK), -1
    while (i := raw.find(BLOCK_MAGIC, i + 1)) >= 0:
        if (n := block_size(raw, i)) and (at + i + n == size or block_size(raw, i + n)):
            return at + i
    return size


class Window:
    """A part's bytes that are not used up yet."""

    def __init__(self, part: Part):
        self.part, self.pieces, self.data, self.ended = part, pieces(part), b"", False
        self.starts = self.places = np.zeros(0, np.int64)

    def more(self) -> bool:
        if (piece := next(self.pieces, None)) is None:
            self.ended = True
            self.data += b"\n" * (not self.data.endswith(b"\n") and self.data != b"")  # the last line needs no end
            return False
        data, starts, places = piece
        self.starts = np.concatenate([self.starts, np.array(starts, np.int64) + len(self.data)])
        self.places = np.concatenate([self.places, np.array(places, np.int64)])
        self.data += data
        return True

    def drop(self, n: int) -> None:
        self.data, starts = self.data[n:], self.starts - n
        k = max(int(np.searchsorted(starts, 0, "right")) - 1, 0)
        self.starts, self.places = starts[k:], self.places[k:]

    def where(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of places in data: their bytes in the file (in block gzip, of their blocks), and their ordinals."""
        k = np.searchsorted(self.starts, i, "right") - 1
        within = i - self.starts[k]
        if self.part.kind == BLOCKS:
            return self.places[k], (self.places[k] << 16) | within
        at = self.places[k] + within
        return at, at << 16

    def begun(self) -> int | None:
        """Drop the rest of the line in which the part begins; the byte of that line's end (-1 at a file's start), or None if it is not the part's."""
        if not self.part.start:
            return -1
        while (k := self.data.find(b"\n")) < 0:
            if not self.more():
                return None
        at = int(self.where(np.array([k]))[0][0])
        self.drop(k + 1)
        return at if at < self.part.end else None


def line_ends(w: Window) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(w.data, np.uint8) == 10)


# ---- records -------------------------------------------------------------------------------------------------------


def aligned(w: Window, before: int) -> int | None:
    """Drop lines up to the first record of a part that begins within a file: the byte of the line end before it, or None."""
    while len(ends := line_ends(w)) < 8 and w.more():
        pass
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    lines = [w.data[a:b].rstrip(b"\r") for a, b in zip(starts[:8], ends[:8], strict=True)]
    found = [i for i in range(min(4, len(lines) - 2)) if lines[i].startswith(b"@") and lines[i + 2].startswith(b"+")]
    if not found:
        if len(lines) >= 8:
            raise ValueError(f"{w.part.path}: no record begins after byte {w.part.start}; read it with splitBytes 0")
        return None
    # a quality that begins with '@' stands two lines before a sequence; were that one to begin with '+', lengths decide
    i = next((i for i in found if i + 3 < len(lines) and len(lines[i + 1]) == len(lines[i + 3])), found[0])
    if i:
        before = int(w.where(ends[i - 1 : i])[0][0])
        w.drop(int(starts[i]))
    return before if before < w.part.end else None


def first_word(lines: pa.Array, where: str) -> pa.Array:
    """The first word of header lines, without their mark."""
    words = pc.struct_field(pc.extract_regex(lines, r"(?s)^.\s*(?P<w>\S+)"), "w")
    if words.null_count:
        raise ValueError(f"{where}: a header is empty")
    return words


def upper(lines: pa.Array) -> pa.Array:
    return pc.ascii_upper(pc.utf8_trim_whitespace(lines))


def fastq_batches(part: Part, strict: bool, columns: list[str], names: set[str] | None = None) -> Iterator[dict[str, pa.Array]]:
    """Columns of a part's four-line records. strict wants '@' and '+' lines, equal lengths and whole records; in both modes
    nothing but blank lines may follow a blank line that stands where a record should begin."""
    w = Window(part)
    before = w.begun()
    if before is None or (part.start and (before := aligned(w, before)) is None):
        return
    while True:
        ends = line_ends(w)
        if len(ends) < 4 and not w.ended:
            w.more()
            continue
        if not w.data.strip():
            if w.ended or not w.more():
                return
            continue
        n = len(ends) // 4
        if w.ended and len(ends) % 4 and w.data[ends[4 * n - 1] + 1 if n else 0 :].strip():
            # lines that are missing at the end of a file are empty
            if strict:
                raise ValueError(f"{part.path}: broken record at the end")
            w.data += b"\n" * (4 - len(ends) % 4)
            ends, n = line_ends(w), n + 1
        if not n:
            return
        ends = ends[: 4 * n]
        starts = np.concatenate([[0], ends[:-1] + 1])
        heads = starts[0::4]
        lines_before = np.concatenate([[before], w.where(heads[1:] - 1)[0]]) if n > 1 else np.array([before])
        own = int(np.searchsorted(lines_before, part.end, "left"))
        offsets = np.append(starts, ends[-1] + 1).astype(np.int64)
        lines = pa.Array.from_buffers(pa.large_binary(), 4 * n, [None, pa.py_buffer(offsets), pa.py_buffer(w.data)])
        head, seq, plus, quality = (pc.utf8_rtrim(lines.take(pa.array(np.arange(i, 4 * own, 4))).cast(pa.large_string()), "\r\n") for i in range(4))
        blank = pc.equal(pc.utf8_trim_whitespace(head), "")
        if (k := pc.index(blank, True).as_py()) >= 0:
            while not w.data[heads[k] :].strip() and w.more():
                pass
            if w.data[heads[k] :].strip():
                raise ValueError(f"{part.path}: a record begins with a blank line")
            own, head, seq, plus, quality = k, *(x[:k] for x in (head, seq, plus, quality))
        if strict:
            fits = pc.and_(pc.and_(pc.starts_with(head, "@"), pc.starts_with(plus, "+")), pc.equal(pc.utf8_length(seq), pc.utf8_length(quality)))
            if (bad := pc.index(fits, False).as_py()) >= 0:
                raise ValueError(f"{part.path}: broken record at {head[bad]}")
        made = {"name": lambda head=head: first_word(head, part.path), "sequence": lambda seq=seq: upper(seq), "quality": lambda quality=quality: quality, "ordinal": lambda heads=heads[:own]: pa.array(w.where(heads)[1])}
        if own:
            keep = None if names is None else pc.is_in(first_word(head, part.path), pa.array(sorted(names), pa.large_string()))
            out = {c: f() for c, f in made.items() if c in columns}
            out["_rows"] = pa.nulls(own)
            yield out if keep is None else {c: x.filter(keep) for c, x in out.items()}
        if own < n:
            return
        before = int(w.where(ends[-1:])[0][0])
        w.drop(int(ends[-1]) + 1)
        if before >= part.end:
            return
        w.more()


def fasta_spans(part: Part, strict: bool) -> Iterator[tuple[int, bytes, bytes, int]]:
    """(ordinal, header line, sequence lines, byte at which these begin) of a part's records.

    What stands before the first header is left out; strict raises on it, and on files without a record.
    """
    w = Window(part)
    if w.begun() is None:
        return
    first, seen = not part.start, False
    while True:
        raw = np.frombuffer(w.data, np.uint8)
        heads = np.flatnonzero(raw == ord(">"))
        heads = heads[(heads == 0) | (raw[heads - 1] == 10)]
        if first and strict and w.data[: heads[0] if len(heads) else None].strip():
            raise ValueError(f"{part.path}: sequence before the first header")
        if len(heads):
            first, seen = False, True
            # a header at the start of the window is known to be the part's
            own = np.where(heads > 0, w.where(np.maximum(heads - 1, 0))[0], -1) < part.end
            ordinals, bounds = w.where(heads)[1], np.append(heads, len(w.data))
            for i in range(len(heads) if w.ended else len(heads) - 1):
                if not own[i]:
                    return
                record = w.data[bounds[i] : bounds[i + 1]]
                head = record[: record.find(b"\n")]
                yield int(ordinals[i]), head, record[len(head) + 1 :], (int(ordinals[i]) >> 16) + len(head) + 1
            if not own[-1]:
                return
            w.drop(int(heads[-1]))
        elif (cut := w.data.rfind(b"\n")) > 0:
            # lines of the record before the part's first; the last line end stays, as it may be the one before a header
            if int(w.where(np.array([cut]))[0][0]) >= part.end:
                return
            w.drop(cut)
        if w.ended:
            break
        w.more()
    if strict and not part.start and not seen:
        raise ValueError(f"{part.path}: no record")


def header_of(line: bytes, where: str) -> str:
    if not (words := line[1:].split()):
        raise ValueError(f"{where}: a header is empty")
    return words[0].decode()


def fasta_batches(part: Part, strict: bool, columns: list[str], names: set[str] | None = None) -> Iterator[dict[str, pa.Array]]:
    """Columns of a part's records: a header is its line's first word, sequences are upper-cased lines without outer blanks."""

    def batch(rows: list[tuple[int, str, str]]) -> dict[str, pa.Array]:
        ordinals, headers, sequences = zip(*rows, strict=True)
        made = {"ordinal": pa.array(ordinals, pa.int64()), "header": pa.array(headers, pa.large_string()), "sequence": pa.array(sequences, pa.large_string())}
        return {c: x for c, x in made.items() if c in columns} | {"_rows": pa.nulls(len(rows))}

    rows, size = [], 0
    for ordinal, head, body, _ in fasta_spans(part, strict):
        header = header_of(head, part.path)
        seq = b"".join(x.strip() for x in body.split(b"\n")).upper().decode()
        if strict and not seq:
            raise ValueError(f"{part.path}: record {header} is empty")
        if names is None or header in names:
            rows.append((ordinal, header, seq))
            size += len(seq)
        if size >= PIECE or len(rows) >= 10_000:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


def index_batches(part: Part, strict: bool, columns: list[str], names: set[str] | None = None) -> Iterator[dict[str, pa.Array]]:
    """Where each record's sequence is: its first byte, its bytes, its bases, and the bases and bytes of a line.

    A record whose lines differ (but for the last), or have blanks in them, has null line_bases and is fetched whole.
    """
    if part.kind != PLAIN:
        raise ValueError(f"{part.path}: an index wants plain text")
    rows = []
    for ordinal, head, body, at in fasta_spans(part, strict):
        lines = body.split(b"\n")
        while lines and not lines[-1].strip():
            lines.pop()
        bases, step = (len(lines[0].strip()), len(lines[0]) + 1) if lines else (0, 1)
        even = all(len(x) + 1 == step and len(x.strip()) == bases for x in lines[:-1]) and (not lines or len(lines[-1].strip()) <= bases and lines[-1][:1].strip() != b"" and lines[0][:1].strip() != b"")
        length = sum(len(x.strip()) for x in lines)
        rows.append({"ordinal": ordinal, "header": header_of(head, part.path), "offset": at, "bytes": len(body), "length": length, "line_bases": bases if even else None, "line_bytes": step if even else None})
    if rows:
        kinds = {"header": pa.large_string()}
        made = {c: pa.array([r[c] for r in rows], kinds.get(c, pa.int64())) for c in rows[0] if c in columns}
        yield made | {"_rows": pa.nulls(len(rows))}


# ---- sources -------------------------------------------------------------------------------------------------------


class Reader(DataSourceReader):
    """Reads the parts of files by one of the functions above; name: the column whose filters that function applies."""

    def __init__(self, options, schema, batches: Callable, name: str):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.files = [(p, i, size) for i, (p, size) in enumerate(listed(options.get("path") or ""))]
        self.strict = str(options.get("strict", "false")).lower() == "true"
        self.split = int(options.get("splitBytes", SPLIT))
        self.schema, self.batches, self.name, self.names = to_arrow_schema(schema), batches, name, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if wanted is None or f.attribute not in (("path",), ("file_no",), (self.name,)):
                yield f
            elif f.attribute == (self.name,):
                self.names = wanted if self.names is None else self.names & wanted
            else:
                at = ("path", "file_no").index(f.attribute[0])
                self.files = [x for x in self.files if x[at] in wanted]

    def partitions(self):
        return [p for path, number, size in self.files for p in parts_of(path, number, size, self.split)]

    def read(self, partition):
        if partition is None:  # no file is left
            return
        columns = self.schema.names
        for found in self.batches(partition, self.strict, columns, self.names):
            n = len(found["_rows"])
            fixed = {"path": lambda: pa.repeat(pa.scalar(partition.path), n), "file_no": lambda: pa.repeat(pa.scalar(partition.number, pa.int32()), n)}
            arrays = [(found[f.name] if f.name in found else fixed[f.name]()).cast(f.type) for f in self.schema]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


class FastaSource(DataSource):
    COLUMNS, BATCHES, NAME = FASTA, staticmethod(fasta_batches), "header"

    @classmethod
    def name(cls):
        return "fasta"

    def schema(self):
        return self.COLUMNS

    def reader(self, schema):
        return Reader(self.options, schema, self.BATCHES, self.NAME)


class FastaIndexSource(FastaSource):
    COLUMNS, BATCHES, NAME = FASTA_INDEX, staticmethod(index_batches), ""

    @classmethod
    def name(cls):
        return "fasta_index"


class FastqSource(FastaSource):
    COLUMNS, BATCHES, NAME = FASTQ, staticmethod(fastq_batches), "name"

    @classmethod
    def name(cls):
        return "fastq"


def register(spark: SparkSession) -> None:
    """Make the sources known to a session; filters reach Python sources under a setting of Spark's."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (FastaSource, FastaIndexSource, FastqSource):
        spark.dataSource.register(source)
