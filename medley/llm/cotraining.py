"""Quality classifier by co-training of two views.

The text view sees hashed words and shape buckets of the text's content, the metadata view language, source and length; no feature is in
both. Both are logistic regressions. Over some rounds each labels the unlabelled texts that it is surest about for the
other one; then each is calibrated on a labelled holdout and a last logistic regression combines the calibrated views.
There are two heads, quality and toxicity; a document is kept when it is likelier good than not and likelier harmless
than not.

Models are fitted on bounded samples, chosen by a hash of the id: about max_labelled labelled documents at most, and
pool_share times as many unlabelled ones as there are labelled ones in the sample. In each round a view passes on per_round of
the pool, in the proportion of the classes, if it is sure enough. All documents are scored, whole, in one pass.

The rows of the sample are sorted by id, and the holdout (one in FOLDS) goes by a hash of the text, so the result
does not depend on partitions, and copies of a text lie on one side of the split.

Defined results: a null text counts as empty; null metadata is a value of its own; labels that are null are dropped
and of several labels of one id the best quality and the worst toxicity count; of several documents with one id that with the
least hash is fitted on, and each is scored; a head without both classes in its labels gives its constant rate; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import sized, written

#: Most labelled documents that are fitted on, unlabelled ones per labelled one, and the holdout's share.
MAX_LABELLED, POOL_SHARE, FOLDS = 8_000, 0.5, 5
BITS = 20
N_SHAPES = 64
META_BITS = 12
#: Rounds of exchange, the share of the pool that a view labels in each, and how sure it has to be.
ROUNDS, PER_ROUND, SURE = 3, 0.075, 0.95
LEAST_DF, LEAST_CHI2 = 3, 12.0
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>!^~=_")] = True
CACHED = 400_000


class WordIndex(dict):
    """Word (bytes) -> hashed feature."""

    def __missing__(self, word: bytes) -> int:
        h = N_SHAPES + (zlib.crc32(word) * 0x9E3779B1 >> 8) % ((1 << BITS) - N_SHAPES)
        if len(self) >= CACHED:
            self.clear()
        self[word] = h
        return h


def text_features(text: str, index: WordIndex) -> np.ndarray:
    """Distinct features of a text: buckets of its shape (not of its length), then its words without case and outer punctuation."""
    raw = text.encode()
    b = np.frombuffer(raw, np.uint8)
    words = raw.lower().split()
    n = max(1, len(words))
    letters = max(1, int(((b | 32) >= 97).sum()))
    shapes = (
        int(10 * SYMBOLS[b].sum() / n), int(20 * ((b >= 65) & (b <= 90)).sum() / letters),
        int(10 * len(set(words)) / n), int(len(raw) / n), int(20 * ((b >= 48) & (b <= 57)).sum() / max(1, len(raw))),
    )
    sizes = (10, 10, 11, 14, 9)
    out, at = [], 0
    for v, size in zip(shapes, sizes, strict=True):
        out.append(at + min(max(v, 0), size - 1))
        at += size
    found = np.fromiter(map(index.__getitem__, (w.strip(b".,;:!?\"'()#*$%&|<>") for w in set(words))), np.int64)
    return np.concatenate([np.array(out, np.int64), np.unique(found)])


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    size = -1 if n_chars is None else int(n_chars).bit_length()
    keys = (f"l{lang}", f"s{source}", f"n{size}", f"ln{lang}|{size}")
    return sorted({zlib.crc32(k.encode()) % (1 << META_BITS) for k in keys})


@dataclass
class Linear:
    """Logistic regression on sets of features, then a scale and a shift that calibrate it."""

    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        return self.scale * (np.array([self.weights[r].sum() for r in rows]) + self.bias) + self.shift


def fitted(rows: list[np.ndarray], y: np.ndarray, dim: int, *, least_df: int = 1, least_chi2: float = 0.0, steps: int = 80, rate: float = 0.1, ridge: float = 1e-3) -> Linear:
    """Adam on the whole sample; features of few rows or with little relation to the class get no weight."""
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    used, cols = np.unique(flat, return_inverse=True)
    df, df1 = np.bincount(cols, minlength=len(used)), np.bincount(cols, np.repeat(y, np.diff(at)), len(used))
    n, n1 = len(rows), y.sum()
    chi2 = (df1 * n - df * n1) ** 2 / np.maximum(df * n1 * (n - n1) * (1 - df / (n + 1)), 1e-9)
    keep = (df >= least_df) & (chi2 >= least_chi2)
    row_of = np.repeat(np.arange(len(rows)), np.diff(at))
    pick = keep[cols]
    cols, row_of = (np.cumsum(keep) - 1)[cols[pick]], row_of[pick]
    used = used[keep]
    w, bias = np.zeros(len(used)), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row_of, w[cols], len(rows)) + bias
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / max(1, len(rows))
        gw, gb = np.bincount(cols, g[row_of], len(used)) + ridge * w, g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    out = np.zeros(dim, np.float32)
    out[used] = w
    return Linear(out, bias)


def newton(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights (the last one the constant) of a small dense logistic regression."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), x.T @ (p - y) + ridge * beta)
    return beta


@dataclass
class Head:
    text: Linear
    meta: Linear
    mix: np.ndarray

    def scores(self, text_rows: list[np.ndarray], meta_rows: list[np.ndarray]) -> np.ndarray:
        z = np.stack([np.clip(self.text.logits(text_rows), -20, 20), np.clip(self.meta.logits(meta_rows), -20, 20)], 1)
        return 1 / (1 + np.exp(-np.clip(z @ self.mix[:2] + self.mix[2], -30, 30)))


def cotrained(text: list[np.ndarray], meta: list[np.ndarray], y: np.ndarray, held: np.ndarray, pool_text: list[np.ndarray], pool_meta: list[np.ndarray], rounds: int = ROUNDS, per_round: float = PER_ROUND, sure_at: float = SURE) -> Head:
    """One head from labelled rows, of which those in held calibrate and the others are fitted on, and an unlabelled pool."""
    rate = float(y.mean()) if len(y) else 0.5
    both = lambda v: 0.0 < v.mean() < 1.0 if len(v) else False
    if len(y) < 20 or not both(y[held]) or not both(y[~held]):
        flat = lambda dim: Linear(np.zeros(dim, np.float32), 0.0)
        rate = min(max(rate, 1e-3), 1 - 1e-3)
        return Head(flat(1 << BITS), flat(1 << META_BITS), np.array([0.0, 0.0, np.log(rate / (1 - rate))]))
    train = np.flatnonzero(~held)
    pseudo: tuple[dict[int, float], dict[int, float]] = ({}, {})  # by place in the pool: what the text view and the metadata view are given
    views = ((text, pool_text, 1 << BITS, LEAST_DF, LEAST_CHI2), (meta, pool_meta, 1 << META_BITS, 1, 0.0))
    models: list[Linear] = []
    for turn in range(rounds + 1):
        models = []
        for (rows, pool, dim, least, chi2), given in zip(views, pseudo, strict=True):
            models.append(fitted([rows[i] for i in train] + [pool[i] for i in given], np.concatenate([y[train], np.array(list(given.values()))]), dim, least_df=least, least_chi2=chi2))
        if turn == rounds or not pool_text:
            break
        for view, other in ((0, 1), (1, 0)):
            p = 1 / (1 + np.exp(-models[view].logits(views[view][1])))
            # the surest of each class, in the proportion of the labels
            for label, sure, quota in ((1.0, p, per_round * len(p) * rate), (0.0, 1 - p, per_round * len(p) * (1 - rate))):
                order = [i for i in np.argsort(-sure, kind="stable") if sure[i] >= sure_at and i not in pseudo[other]]
                pseudo[other].update((int(i), label) for i in order[: max(1, int(quota))])
    h = np.flatnonzero(held)
    logits = []
    for model, (rows, *_) in zip(models, views, strict=True):
        model.scale, model.shift = newton(model.logits([rows[i] for i in h])[:, None], y[h])
        logits.append(model.logits([rows[i] for i in h]))
    return Head(models[0], models[1], newton(np.clip(np.stack(logits, 1), -20, 20), y[h]))


def _features(rows: DataFrame) -> DataFrame:
    names = ["_id", "quality", "toxic", "fold"]

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = WordIndex()
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns, strict=True))
            t = [text_features(x.as_py() or "", index) for x in cols["text"]]
            m = [meta_features(*x) for x in zip(*(cols[c].to_pylist() for c in ("lang", "source", "n_chars")), strict=True)]
            found = [pa.array([x.tolist() for x in t], pa.list_(pa.int32())), pa.array(m, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(cols[c] for c in names), *found], names=[*names, "t", "m"])

    return rows.select(*names, "text", "lang", "source", "n_chars").mapInArrow(build, "_id long, quality int, toxic int, fold int, t array<int>, m array<int>")


def sample(ids: DataFrame, most: float, seed: int) -> DataFrame:
    """About most rows of ids (all if there are fewer), by a hash of the id."""
    n = ids.count()
    return ids if n <= most else ids.where(F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * most / n))


def trained(docs: DataFrame, labels: DataFrame, seed: int = 42, max_labelled: int = MAX_LABELLED, pool_share: float = POOL_SHARE, rounds: int = ROUNDS, per_round: float = PER_ROUND) -> tuple[Head, Head]:
    """The quality and the toxicity head."""
    docs = docs.withColumnRenamed("doc_id", "_id")
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
    chosen = written(sample(marked, max_labelled, seed), "labelled")
    free = docs.select("_id").where("_id is not null").join(sized(written(marked.select("_id"), "marked")), "_id", "left_anti").distinct()
    pool = written(sample(written(free, "free"), pool_share * chosen.count(), seed + 1), "pool")
    none = F.lit(None).cast("int")
    wanted = sized(written(chosen.unionByName(pool.select("_id", none.alias("quality"), none.alias("toxic"))), "wanted"))
    # one row per id, so what comes to the driver is bounded by the two samples
    found = docs.join(wanted, "_id").withColumn("fold", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int"))
    columns = ["quality", "toxic", "fold", "text", "lang", "source", "n_chars"]
    one = found.groupBy("_id").agg(F.min_by(F.struct(*columns), F.struct(F.xxhash64("text", "lang", "source", "n_chars"), "text")).alias("r")).select("_id", "r.*")
    rows = _features(one).orderBy("_id").toPandas()
    text, meta = [np.asarray(x, np.int64) for x in rows["t"]], [np.asarray(x, np.int64) for x in rows["m"]]
    unmarked = np.flatnonzero((rows["quality"].isna() & rows["toxic"].isna()).to_numpy())
    heads = []
    for name in ("quality", "toxic"):
        have = np.flatnonzero(rows[name].notna().to_numpy())
        y, held = rows[name].to_numpy(float)[have], rows["fold"].to_numpy()[have] == 0
        heads.append(cotrained([text[i] for i in have], [meta[i] for i in have], y, held, [text[i] for i in unmarked], [meta[i] for i in unmarked], rounds, per_round))
    return heads[0], heads[1]


def scored(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, quality and toxicity scores, kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    parts = lambda m: (m.weights, m.bias, m.scale, m.shift)
    shared = docs.sparkSession.sparkContext.broadcast([(parts(h.text), parts(h.meta), h.mix) for h in trained(docs, labels, **options)])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = WordIndex()
        heads = [Head(Linear(*text), Linear(*meta), mix) for text, meta, mix in shared.value]
        for batch in batches:
            t = [text_features(x.as_py() or "", index) for x in batch.column(1)]
            m = [np.array(meta_features(*x), np.int64) for x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            q, x = (head.scores(t, m).round(6) for head in heads) if t else (np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(q), pa.array(x), pa.array((q >= 0.5) & (x < 0.5))], names=["doc_id", "quality_score", "toxic_score", "kept"])

    return docs.mapInArrow(score, "doc_id long, quality_score double, toxic_score double, kept boolean")
