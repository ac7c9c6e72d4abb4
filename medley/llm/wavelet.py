"""Token ids in wavelet matrix files, one compressed file per shard.

Documents are ordered by id, tokenised, and cut into shards of whole documents. A shard's ids become bit planes
(one per bit of the id, each stably partitioned by the plane above), stored in separately compressed chunks with the
count of ones before each chunk. So a token, the count of an id in a prefix, and the k-th occurrence of an id each
read one chunk per plane. A document directory maps documents to positions.

Defined results: a null text counts as empty and holds the end id only; null ids sort first; rows with equal ids are
ordered by a hash of the text, then by the text, and all stay; an empty table gives an empty result. A text is encoded whole, however long.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import new_dir, open_fs, put_file, text_slices, worker_dropped, worker_held

MAGIC = b"WAVELET1"
CHUNK_BITS = 1 << 16
#: A shard is closed by the document that brings it to this many ids.
SHARD_TOKENS = 1 << 22
END_ID = 1
#: Encoded pieces that a worker remembers, and the longest piece that is remembered.
CACHED, CACHED_CHARS = 200_000, 64
#: Bytes of texts that are encoded together.
SLICE = 3 << 19
#: Words that normalisers and splits leave whole, after lower(): each letter is one code point that NFC keeps.
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Letters and digits after which a mark begins a new piece in any case.
BEFORE_MARKS = frozenset(c for c in map(chr, range(256)) if LATIN.fullmatch(c) or c in string.digits)
#: The same as patterns of Arrow: a whole word, the end of one that a mark may follow.
LATIN_WORD, MARKS_MAY_FOLLOW = rf"\A{LATIN.pattern}\z", r"[0-9A-Za-zÀ-ÖØ-öø-ÿ]\z"


# ---- the file format -----------------------------------------------------------------------------------------------


def packed(ids: np.ndarray, doc_ids: list, counts: np.ndarray) -> Iterator[bytes]:
    """The bytes of a shard file: header, plane chunks, directory."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    squeeze = zstandard.ZstdCompressor(level=1)
    n_chunks = -(-len(ids) // CHUNK_BITS)
    at = np.zeros((bits, n_chunks + 1), np.uint64)
    ones = np.zeros((bits, n_chunks + 1), np.uint64)
    n, where, cur = len(ids), len(MAGIC) + 8, ids.astype(np.uint16) if bits <= 16 else ids
    del ids
    bodies = []
    for level in range(bits):
        mask = (cur & cur.dtype.type(1 << (bits - 1 - level))).astype(bool)
        plane = np.packbits(mask, bitorder="little")
        for c in range(n_chunks):
            raw = plane[c * CHUNK_BITS // 8 : (c + 1) * CHUNK_BITS // 8]
            body = squeeze.compress(raw.tobytes())
            at[level, c] = where
            ones[level, c + 1] = ones[level, c] + np.uint64(np.bitwise_count(raw).sum())
            where += len(body)
            bodies.append(body)
        at[level, n_chunks] = where
        cur = np.concatenate([cur[~mask], cur[mask]])
    known = np.array([d is not None for d in doc_ids], bool)
    keys = np.array([d or 0 for d in doc_ids], np.int64)
    parts = [x.tobytes() for x in (at, ones, np.packbits(known), keys, counts.astype(np.uint64))]
    directory = squeeze.compress(struct.pack("<QQQ", n, bits, len(doc_ids)) + b"".join(parts))
    yield MAGIC + struct.pack("<Q", where)
    yield from bodies
    yield directory


class Shard:
    """Reads one shard file by byte ranges: access, rank, select and documents."""

    def __init__(self, uri: str):
        system, path = open_fs(uri)
        self.file = system.open_input_file(path)
        head = self.file.read_at(len(MAGIC) + 8, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{uri} is no shard file")
        (self.body_end,) = struct.unpack("<Q", head[len(MAGIC) :])
        raw = zstandard.decompress(self.file.read_at(self.file.size() - self.body_end, self.body_end))
        self.n, self.bits, n_docs = struct.unpack_from("<QQQ", raw)
        n_chunks = -(-self.n // CHUNK_BITS)
        pos = 24

        def taken(dtype, size, shape=None):
            nonlocal pos
            out = np.frombuffer(raw, dtype, size, pos)
            pos += out.nbytes
            return out.reshape(shape) if shape else out

        shape = (self.bits, n_chunks + 1)
        self.at, self.ones = taken(np.uint64, shape[0] * shape[1], shape).astype(int), taken(np.uint64, shape[0] * shape[1], shape).astype(int)
        known = np.unpackbits(taken(np.uint8, -(-n_docs // 8)), count=n_docs).astype(bool)
        keys, self.counts = taken(np.int64, n_docs), taken(np.uint64, n_docs).astype(np.int64)
        self.doc_ids = [int(k) if ok else None for k, ok in zip(keys, known, strict=True)]
        self.zeros = [self.n - int(self.ones[level, -1]) for level in range(self.bits)]
        self.held: dict[tuple[int, int], np.ndarray] = {}

    def __enter__(self) -> Shard:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def chunk(self, level: int, c: int) -> np.ndarray:
        if (level, c) not in self.held:
            if len(self.held) > 256:
                self.held.clear()
            lo, hi = self.at[level, c], self.at[level, c + 1]
            self.held[level, c] = np.frombuffer(zstandard.decompress(self.file.read_at(hi - lo, lo)), np.uint8)
        return self.held[level, c]

    def bit(self, level: int, i: int) -> int:
        c, r = divmod(i, CHUNK_BITS)
        return int(self.chunk(level, c)[r >> 3] >> (r & 7)) & 1

    def rank1(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        c, r = divmod(i, CHUNK_BITS)
        if not r:
            return int(self.ones[level, c])
        raw = self.chunk(level, c)
        part = int(np.bitwise_count(raw[: r >> 3]).sum())
        if r & 7:
            part += (int(raw[r >> 3]) & ((1 << (r & 7)) - 1)).bit_count()
        return int(self.ones[level, c]) + part

    def select(self, level: int, value: int, k: int) -> int:
        """Position of the k-th (from 0) bit equal to value."""
        before = self.ones[level] if value else np.minimum(np.arange(self.ones.shape[1]) * CHUNK_BITS, self.n) - self.ones[level]
        c = bisect_right(before, k) - 1
        found = np.unpackbits(self.chunk(level, c), bitorder="little") == value
        return c * CHUNK_BITS + int(np.flatnonzero(found)[k - before[c]])

    def access(self, i: int) -> int:
        """The id at position i."""
        out = 0
        for level in range(self.bits):
            b = self.bit(level, i)
            out = out << 1 | b
            i = self.zeros[level] + self.rank1(level, i) if b else i - self.rank1(level, i)
        return out

    def _range(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        if symbol >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self.rank1(level, lo), self.rank1(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if symbol >> (self.bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in positions lo to hi."""
        lo, hi = self._range(symbol, lo, self.n if hi is None else hi)
        return hi - lo

    def locate(self, symbol: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of an id."""
        lo, hi = self._range(symbol, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in reversed(range(self.bits)):
            b = symbol >> (self.bits - 1 - level) & 1
            i = self.select(level, b, i - self.zeros[level] if b else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids in order, from the last plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        cur = np.zeros(self.n, kind)
        for level in reversed(range(self.bits)):
            raw = b"".join(zstandard.decompress(self.file.read_at(hi - lo, lo)) for lo, hi in zip(self.at[level], self.at[level, 1:]))
            mask = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n, bitorder="little").astype(bool)
            out = np.empty(self.n, kind)
            out[~mask], out[mask] = cur[: self.zeros[level]], cur[self.zeros[level] :] | kind(1 << (self.bits - 1 - level))
            cur = out
        return cur


# ---- tokens --------------------------------------------------------------------------------------------------------


# The normaliser and the split of vocabularies that drop blanks and never join what stands on both sides of one.
BLANK_FREE = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
)


def separable(tokenizer_path: str) -> bool:
    """Whether a text's ids are those of its pieces between spaces and line feeds, one after the other."""
    with open(tokenizer_path, encoding="utf-8") as f:
        found = json.load(f)
    added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and not set(t["content"]) & set(" \n") for t in found["added_tokens"])
    return added and not found["truncation"] and not found["post_processor"] and (found["normalizer"], found["pre_tokenizer"]) == BLANK_FREE


def byte_letters() -> dict[int, str]:
    """For str.translate: a letter of Latin-1 as the byte-level split writes its UTF-8 bytes (a byte without a visible letter has one over 255)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


def set_apart(text: str, mark: str) -> str:
    """text with a space before each mark that a space follows and a letter or digit precedes."""
    apart, as_is = f" {mark} ", mark + " "
    parts = text.split(as_is)
    last = parts.pop()
    return "".join([x + (apart if x[-1:] in BEFORE_MARKS else as_is) for x in parts]) + last


class Known:
    """Ids (little-endian uint32) of what has been encoded: at most CACHED short strings, and as many that were used before them."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode, self.newer, self.older = encode, {}, {}

    def of(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each. What is not known is encoded in one go, while the library's tables are at hand."""
        out = list(map(self.newer.get, texts))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            text = texts[i]
            out[i] = ids = self.older.get(text) or self.encode(text)
            if len(text) <= CACHED_CHARS:
                if len(self.newer) >= CACHED:
                    self.older, self.newer = self.newer, {}
                self.newer[text] = ids
        return out


def strings(texts: pa.Array) -> np.ndarray:
    return texts.to_numpy(zero_copy_only=False)


def spread(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the runs at these places, one after the other, and how many each has. ids: all runs, which have these sizes."""
    n = sizes[at]
    ends = np.cumsum(n)
    places = np.repeat((np.cumsum(sizes) - sizes)[at] - (ends - n), n)
    places += np.arange(len(places))
    return ids[places], n


class Encoder:
    """Encodes texts by the library.

    Where the vocabulary drops blanks, texts are cut at blanks, and of texts that come together each distinct piece is
    encoded once: a letter or digit and a mark after it are always split, so the marks that end a piece stand for themselves;
    words of Latin letters are put in lower case, and the model alone gets them as its normaliser and split would leave
    them; what the library gave for something short is remembered. Any other vocabulary gets whole texts.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_piece = Tokenizer.from_file(tokenizer_path), separable(tokenizer_path)
        self.words = self.tokenizer.model.tokenize  # what its normaliser and its split leave as it is needs the model alone
        self.letters, self.known = byte_letters(), Known(self.encoded)
        # marks of special tokens stay where they are
        self.marks = "".join(set(string.punctuation) - {c for t in self.tokenizer.get_added_tokens_decoder().values() for c in t.content})
        self.often = [c for c in ",." if c in self.marks]  # set apart before texts are cut, so there are fewer distinct pieces

    def whole(self, text: str) -> bytes:
        # the call for batches also has a form that keeps no offsets
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def encoded(self, text: str) -> bytes:
        """Of a text without blanks; a word of Latin letters is in lower case."""
        if LATIN.fullmatch(text):
            return array("I", [t.id for t in self.words(text if text.isascii() else text.translate(self.letters))]).tobytes()
        return self.whole(text)

    def many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each has."""
        if not self.by_piece:
            held = [self.whole(t) for t in texts]
            return np.frombuffer(b"".join(held), "<u4"), np.array([len(b) // 4 for b in held], np.int64)
        apart = []
        for text in texts:
            text = text.replace("\n", " ")
            for mark in self.often:
                text = set_apart(text, mark)
            apart.append(text)
        cut = pc.split_pattern(pa.array(apart, pa.large_string()), " ")
        pieces = cut.values.dictionary_encode()
        # a piece is a word and the marks that end it, or all a word
        bare = pc.utf8_rtrim(pieces.dictionary, self.marks)
        bare = pc.if_else(pc.match_substring_regex(bare, MARKS_MAY_FOLLOW), bare, pieces.dictionary)
        marked = pc.not_equal(bare, pieces.dictionary).to_numpy(zero_copy_only=False).nonzero()[0]
        ends = [p[len(b) :] for p, b in zip(strings(pieces.dictionary.take(marked)), strings(bare.take(marked)), strict=True)]
        bare = pc.if_else(pc.match_substring_regex(bare, LATIN_WORD), pc.utf8_lower(bare), bare)
        parts = pa.concat_arrays([bare, pa.array(ends, pa.large_string())]).dictionary_encode()
        held = self.known.of(strings(parts.dictionary))
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        at = parts.indices.to_numpy()
        order = np.argsort(np.concatenate([np.arange(len(bare)), marked]), kind="stable")
        ids, n = spread(np.frombuffer(b"".join(held), "<u4"), sizes, at[order])
        starts = np.arange(len(bare)) + np.searchsorted(marked, np.arange(len(bare)))
        ids, n = spread(ids, np.add.reduceat(n, starts) if len(starts) else n, pieces.indices.to_numpy())
        return ids, np.diff(np.concatenate([[0], np.cumsum(n)])[cut.offsets.to_numpy()])

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0].tobytes()


def make_encoder(tokenizer_path: str) -> Encoder:
    return Encoder(tokenizer_path)


def write_shards(docs: DataFrame, out_dir: str, tokenizer_path: str, *, key: str = "doc_id", text: str = "text", end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards of docs into out_dir; the manifest: part, seq, file, n_docs, n_tokens, start."""
    spark = docs.sparkSession

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_held("encoder", tokenizer_path, lambda: make_encoder(tokenizer_path)), TaskContext.get().partitionId()
        attempt = TaskContext.get().taskAttemptId()  # an attempt that does not count leaves files that no manifest names
        rows, keys, held, sizes, size = [], [], [], [], 0

        def close() -> None:
            nonlocal keys, held, sizes, size
            counts, ids = np.concatenate(sizes).astype(np.uint64), [np.concatenate(held)]
            name, doc_ids = f"{out_dir}/part-{part:06d}-{attempt}-{len(rows):05d}.wavelet", keys
            keys, held, sizes, size = [], [], [], 0  # the ids are there once
            put_file(name, packed(ids.pop(), doc_ids, counts))
            rows.append({"part": part, "seq": len(rows), "file": name, "n_docs": len(doc_ids), "n_tokens": int(counts.sum())})

        for batch in batches:
            ids_of, done = batch.column(0), 0
            for some in text_slices(batch.column(1), SLICE):
                ids, counts = encoder.many([t or "" for t in some.to_pylist()])
                ends = np.cumsum(counts)
                ids, ends, counts = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1), counts + 1
                some_keys, lo, before = ids_of.slice(done, len(some)).to_pylist(), 0, 0
                done += len(some)
                while lo < len(ends):
                    hi = min(len(ends), int(np.searchsorted(ends, before + shard_tokens - size)) + 1)
                    keys += some_keys[lo:hi]
                    held.append(ids[before : ends[hi - 1]])
                    sizes.append(counts[lo:hi])
                    size += int(ends[hi - 1]) - before
                    lo, before = hi, int(ends[hi - 1])
                    if size >= shard_tokens:
                        close()
        if keys:
            close()
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    ordered = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).withColumn("h", F.xxhash64("t"))
    # an id that many rows repeat is dealt to several ranges by the hash of the text
    ordered = ordered.repartitionByRange("k", "h").sortWithinPartitions("k", "h", "t").select("k", "t")
    made = ordered.mapInArrow(shards, "part int, seq int, file string, n_docs long, n_tokens long")
    made.write.parquet(f"{out_dir}/manifest")
    manifest = spark.read.parquet(f"{out_dir}/manifest")
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("_part"))  # one row per task that wrote
    parts = parts.select("part", F.coalesce(F.sum("_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    out = manifest.join(parts, "part").withColumn("start", F.col("_base") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return out.drop("_base")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        worker_dropped()  # what the writing remembered is not needed to read
        for batch in batches:
            for row in batch.to_pylist():
                with Shard(row["file"]) as shard:
                    raw = memoryview(shard.decode().astype("<u4")).cast("B")
                    ends = np.cumsum(shard.counts)
                    starts = ends - shard.counts
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(starts + row["start"]), pa.array(shard.counts), pa.array(crc, pa.int64())], schema=schema)

    n = manifest.count()
    spread = manifest.select("file", "start").repartitionByRange(max(1, min(n, 100_000)), "start")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_report(docs: DataFrame, tokenizer_path: str | None = None, out_dir: str | None = None, **options) -> DataFrame:
    """Encode, write, read back: one row per document."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    spark: SparkSession = docs.sparkSession
    return read_documents(write_shards(docs, out_dir or new_dir(spark, "tokens"), tokenizer_path, **options))
