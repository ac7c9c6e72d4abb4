"""WARC archives with an index first: what is wanted is chosen in the index, then read by coalesced byte ranges.

Records are gzip members of their own, so each can be read alone. The index is a table with the file, offset, length,
URL and digest of every record. Reading takes rows of the index, joins neighbours in a file into ranges (a gap of up to
GAP bytes is read through, a range stays under RANGE bytes) and parses the records out of each range.

Of records with equal payloads of at least LEAST bytes, the one with the smallest page_id is a response and the others
revisit it, with no payload of their own. Defined results: a null html counts as empty; a null url is left out; a null
page_id is never anyone's revisit and never revisited, and its records are all named urn:page:none; rows that repeat a
page_id keep a record each, under one WARC-Record-ID; those that repeat the smallest page_id with the same payload are all
responses; an empty table gives no archive and an empty result; long pages are written whole. A task that is tried
again writes files of other names, and the index, which Spark commits, names those that count.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import new_dir, open_fs, sized, spread_join, written

LEAST = 100
FILE_BYTES = 1 << 26
GAP = 1 << 16
RANGE = 1 << 23
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, digest string, file string, offset long, length long"
INDEX_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parsed(member: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, length of the full payload by its HTTP header, and the payload that the record itself holds."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return fields, length, payload


def write_archives(pages: DataFrame, out_dir: str, *, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) as archives into out_dir; the index."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    digests = pages.where((F.octet_length("html") >= LEAST) & F.col("page_id").isNotNull()).select("page_id", "digest")
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("last > refers_to")
    firsts = written(firsts.select("digest", "refers_to"), "firsts")
    revisits = spread_join(digests, firsts, "digest", F.col("page_id"), "inner").where("page_id > refers_to").distinct()
    # by page and digest, so a payload that a third of the pages share lies all over
    pages = pages.join(sized(written(revisits, "revisits")), ["page_id", "digest"], "left")

    def archives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # an attempt that does not count leaves files of its own, to which no committed index points
        part, seq, out, at, rows = f"{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}", 0, None, 0, []
        system, folder = open_fs(out_dir)
        system.create_dir(folder, recursive=True)

        def close() -> pa.RecordBatch:
            nonlocal out, seq, at, rows
            out.close()
            system.move(temp, f"{folder}/{name}")
            done, out, seq, at, rows = pa.RecordBatch.from_pylist(rows, INDEX_ARROW), None, seq + 1, 0, []
            return done

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name = f"part-{part}-{seq:05d}.warc.gz"
                    temp = f"{folder}/{name}.{uuid.uuid4().hex}.part"
                    out = system.open_output_stream(temp, compression=None)
                member = record(r["page_id"], r["url"], r["html"].encode(), r["digest"], r["refers_to"], date)
                out.write(member)
                rows.append({"page_id": r["page_id"], "url": r["url"], "digest": r["digest"], "file": f"{out_dir}/{name}", "offset": at, "length": len(member)})
                at += len(member)
                if at >= file_bytes:
                    yield close()
        if out is not None:
            yield close()

    pages.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(archives, INDEX).write.parquet(f"{out_dir}/index")
    return spark.read.schema(INDEX).parquet(f"{out_dir}/index")


def ranges(index: DataFrame, *, gap: int = GAP, most: int = RANGE) -> DataFrame:
    """Rows of the index as byte ranges: file, lo, hi and the offsets and lengths of the records in it."""
    from pyspark.sql import Window

    w = Window.partitionBy("file").orderBy("offset")
    ends = F.lag(F.col("offset") + F.col("length")).over(w)
    runs = index.select("file", "offset", "length").distinct().withColumn("new", (F.col("offset") - F.coalesce(ends, F.lit(-gap - 1)) > gap).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(w)).withColumn("slab", F.floor(F.col("offset") / most))
    return runs.groupBy("file", "run", "slab").agg(F.min("offset").alias("lo"), F.max(F.col("offset") + F.col("length")).alias("hi"), F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))


def read_records(index: DataFrame) -> DataFrame:
    """The records that rows of the index point to, read from the archives.

    page_id, payload_bytes and payload_digest (of the full payload), record_type, refers_to, url, payload (null for revisits).
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])

    def number(urn: str | None) -> int | None:
        last = (urn or "none").rstrip(">").rpartition(":")[2]
        return None if last == "none" else int(last)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = open_fs(row["file"])
                with system.open_input_file(path) as f:
                    raw = f.read_at(row["hi"] - row["lo"], row["lo"])
                rows, size = [], 0
                for r in row["records"]:
                    at = r["offset"] - row["lo"]
                    fields, length, payload = parsed(raw[at : at + r["length"]])
                    revisit = fields["WARC-Type"] == "revisit"
                    digest = fields["WARC-Payload-Digest"].partition(":")[2]
                    if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{row['file']} at {r['offset']}: the payload does not have its digest")
                    rows.append((number(fields["WARC-Record-ID"]), length, digest, fields["WARC-Type"], number(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI"), None if revisit else payload))
                    size += len(payload)
                    if size > RANGE:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    spark = index.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = ranges(index).repartition(n, "file", "run", "slab")
    return spread.select("file", "lo", "hi", "records").mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def archive_report(pages: DataFrame, out_dir: str | None = None) -> DataFrame:
    """Write all pages, then read all records back: one row per page."""
    index = write_archives(pages, out_dir or new_dir(pages.sparkSession, "warc"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
