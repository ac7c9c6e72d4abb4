"""Token counts through a cache of digests.

The cache is a folder of Parquet tables, one folder per tokenizer version (the SHA-256 of its library's name and its file), with a row
(digest of the normalised content, number of tokens) for each content that was ever encoded. A run digests its texts, joins the
distinct digests to the stored counts, encodes one text of each digest that is missing, appends those counts, and joins
all counts back to the rows. So a copy costs a digest, and a second run over the same texts encodes nothing.

Content is normalised only as far as the tokenizer does so itself: a model that drops blanks at the ends and after other
blanks counts texts that differ in those alone alike. Other models get texts as they are.

One row of each missing digest is chosen by the least hash of its key. If the chosen ones are few they are sent to the scan and no
text moves; else texts are dealt by digest and that hash. Counts of frequent digests are joined apart from the others. Appends are
committed folders: a run that ends before its commit leaves nothing that counts, and two runs at once may both append a digest,
with equal counts, of which a reader takes one.

Defined results: a null text counts as empty; a null id keeps its row; copies get equal counts; repeated rows stay repeated; an
empty table gives an empty result and appends nothing; texts of any length are counted whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import counted_join, new_dir, sized, worker_held, written

#: Tokens over which a text is too long for one context.
LIMIT = 4096
#: Characters of text that go to the library at once.
AT_ONCE = 1 << 22


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer as its file's bytes, so tasks need no file; the file is a few megabytes."""

    library: str
    body: bytes

    @staticmethod
    def of(path: str) -> Tokenizer:
        libraries = {".json": "tokenizers", ".model": "sentencepiece"}
        if (end := Path(path).suffix) not in libraries:
            raise ValueError(f"a .json or .model file is wanted: {path}")
        return Tokenizer(libraries[end], Path(path).read_bytes())

    @property
    def version(self) -> str:
        return hashlib.sha256(self.library.encode() + b"\0" + self.body).hexdigest()

    def counter(self) -> Callable[[list[str]], list[int]]:
        """The numbers of tokens of texts, without begin, end or added special tokens, cut or padded nowhere."""
        if self.library == "sentencepiece":
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_proto=self.body)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        from tokenizers import Tokenizer as Library

        made = Library.from_str(self.body.decode())
        made.no_truncation()
        made.no_padding()
        return lambda texts: [len(e.ids) for e in made.encode_batch(texts, add_special_tokens=False)]

    def normalised(self, text: Column) -> Column:
        """Texts that become equal by this have equal counts."""
        if self.library != "sentencepiece":
            return text
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        drops = ModelProto.FromString(self.body).normalizer_spec.remove_extra_whitespaces
        return F.trim(F.regexp_replace(text, "\x20+", " ")) if drops else text


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(_digest, _tokens) of all that the cache holds for a tokenizer version, each digest once."""
    schema = "_digest binary, _tokens long"
    try:
        found = spark.read.schema(schema).parquet(f"{cache}/{version}/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).select(F.lit(None).cast("binary").alias("_digest"), F.lit(None).cast("long").alias("_tokens"))
    return found.groupBy("_digest").agg(F.min("_tokens").alias("_tokens"))


def encoded(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(_digest, _tokens) of rows (_digest, _text); of equal digests that meet in a batch one is encoded."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_held("token_counter", tokenizer.version, tokenizer.counter)
        for batch in batches:
            once = {d: i for i, d in enumerate(batch.column(0).to_pylist())}
            places, at = list(once.values()), 0
            counts: list[int] = []
            while at < len(places):
                some, size = [], 0
                while at < len(places) and (not some or size < AT_ONCE):
                    some.append(batch.column(1)[places[at]].as_py())
                    size += len(some[-1])
                    at += 1
                counts += counter(some)
            yield pa.RecordBatch.from_arrays([pa.array(list(once), pa.binary()), pa.array(counts, pa.int64())], names=["_digest", "_tokens"])

    return texts.select("_digest", "_text").mapInArrow(count, "_digest binary, _tokens long")


def counted(docs: DataFrame, cache: str, tokenizer: Tokenizer, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_key, _bytes, _tokens) of every row of docs; the cache gets the counts that it lacked."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), F.octet_length(content).cast("long").alias("_bytes"), tokenizer.normalised(content).alias("_text"))
    rows = rows.select("_key", "_bytes", F.unhex(F.sha2("_text", 256)).alias("_digest"), "_text")
    keys = written(rows.drop("_text"), "digests")

    distinct = keys.groupBy("_digest").agg(F.min(F.xxhash64("_key")).alias("_at"), F.count(F.lit(1)).alias("_n"))
    distinct = written(distinct.join(cached(spark, cache, tokenizer.version), "_digest", "left"), "distinct")
    missing = distinct.where("_tokens is null").select("_digest", "_at")
    known = distinct.where("_tokens is not null").select("_digest", "_n", "_tokens")
    if not missing.isEmpty():
        chosen = rows.select("_digest", F.xxhash64("_key").alias("_at"), "_text").join(sized(missing), ["_digest", "_at"], "left_semi")
        # rows that repeat both id and text are encoded each and counted once
        added = f"{cache}/{tokenizer.version}/{new_dir(spark, 'counts').rpartition('/')[2]}"
        encoded(chosen, tokenizer).write.parquet(added)
        new = spark.read.schema("_digest binary, _tokens long").parquet(added).groupBy("_digest").agg(F.min("_tokens").alias("_tokens"))
        known = written(known.unionByName(distinct.where("_tokens is null").select("_digest", "_n").join(new, "_digest")), "counts")
    return counted_join(keys, known, "_digest", "_n", F.col("_key")).select("_key", "_bytes", "_tokens")


def count_report(docs: DataFrame, cache: str | None = None, tokenizer_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: its bytes, its tokens and whether they are more than limit."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("piece_bpe_32k.model")
    out = counted(docs, cache or new_dir(docs.sparkSession, "token-cache"), Tokenizer.of(tokenizer_path))
    return out.select(F.col("_key").alias("doc_id"), F.col("_bytes").alias("n_bytes"), F.col("_tokens").alias("n_tokens"), (F.col("_tokens") > limit).alias("over_limit"))
