"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with runs of blanks as one space. An item of m characters may differ from a passage by
k = floor(RATE * m) edits. It is cut into k + 1 pieces, so a passage within budget holds one piece exactly. An automaton
finds all pieces in one pass over a text; each hit gives a window in which the item would lie, windows that
cannot hold enough of the item's q-grams are dropped (k edits destroy at most q * k of them), and the rest are verified by
Myers' bit-parallel distance of the item to any substring.

An item so short that its budget is no edit at all must stand as whole words: no letter or digit may touch its ends.

Items are a stated query set that is searched in all rows, in blocks of at most BLOCK_CHARS characters; a block is what is sent to
every task, and a worker makes its automaton once.

Defined results: null and empty texts hold nothing; empty items are not searched, nor, if least is given, those with fewer
characters than that; of repeated items each is reported under its id (a null id as null), rows with equal ids and equal texts
once; every document row that holds an item gives a row per item; an empty table gives an empty result. Texts are
searched whole, however long.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import worker_held

RATE = 0.08
Q = 4
#: Characters of items that one automaton may hold; a larger set goes against all rows in several blocks.
BLOCK_CHARS = 8_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def myers(item: str, window: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Least edit distance of item to a substring of window, and where the first such substring ends."""
    m = len(item)
    masks = peq(item) if masks is None else masks
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for i, c in enumerate(window):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
        if score < best:
            best, end = score, i + 1
    return best, end


def peq(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


class Matcher:
    """Finds items of one block in texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        import ahocorasick

        self.items = items
        self.budget = [int(len(t) * rate) for _, t in items]
        self.masks: dict[int, dict[str, int]] = {}
        self.grams: dict[int, list[str]] = {}
        self.automaton = ahocorasick.Automaton()
        for i, (_, t) in enumerate(items):
            parts = self.budget[i] + 1
            for j in range(parts):
                a, b = j * len(t) // parts, (j + 1) * len(t) // parts
                if t[a:b] in self.automaton:
                    self.automaton.get(t[a:b])[1].append((i, a))
                else:
                    self.automaton.add_word(t[a:b], (b - a, [(i, a)]))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per item, merged windows that can hold it."""
        found: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.automaton.iter(text):
            for i, offset in places:
                start, k = last + 1 - size - offset, self.budget[i]
                found.setdefault(i, []).append([max(0, start - k), min(len(text), start + len(self.items[i][1]) + k)])
        for i, spans in found.items():
            spans.sort()
            merged = [spans[0]]
            for s in spans[1:]:
                if s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(s)
            found[i] = merged
        return found

    @staticmethod
    def words_at(text: str, item: str, lo: int, hi: int) -> Iterator[int]:
        """Ends of the places in a window where an item stands as whole words."""
        at = text.find(item, lo, hi)
        while at >= 0:
            end = at + len(item)
            if not (at and text[at - 1].isalnum() and item[0].isalnum()) and not (text[end : end + 1].isalnum() and item[-1].isalnum()):
                yield end
            at = text.find(item, at + 1, hi)

    def find(self, text: str) -> Iterator[tuple[int | None, int, int]]:
        """(item id, edits, end of the passage) of each item within budget; the best passage, the first among equals."""
        for i, spans in self.windows(text).items():
            item_id, item = self.items[i]
            k, best = self.budget[i], None
            if k == 0:
                ends = (end for lo, hi in spans for end in self.words_at(text, item, lo, hi))
                if (end := next(ends, None)) is not None:
                    yield item_id, 0, end
                continue
            if i not in self.grams:
                self.grams[i] = [item[j : j + Q] for j in range(len(item) - Q + 1)]
                self.masks[i] = peq(item)
            need = len(self.grams[i]) - Q * k
            for lo, hi in spans:
                window = text[lo:hi]
                if need > 0:
                    there = {window[j : j + Q] for j in range(len(window) - Q + 1)}
                    if sum(g in there for g in self.grams[i]) < need:
                        continue
                edits, end = myers(item, window, self.masks[i])
                if edits <= k and (best is None or edits < best[0]):
                    best = edits, lo + end
            if best:
                yield item_id, *best


def blocks(items: DataFrame, least: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded size, one after the other."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where("text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b).collect()
        block = sorted({(r["item_id"], normal(r["text"])) for r in rows}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        if block := [x for x in block if len(x[1]) >= max(1, least)]:
            yield block


def searched(rows: DataFrame, place: int, block: list[tuple[int | None, str]], rate: float, ddl, found) -> DataFrame:
    """rows mapped by found(matcher, batches) for a block of items; place is its number."""
    shared = rows.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, block))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, items = shared.value
        yield from found(worker_held("matcher", key, lambda: Matcher(items, rate), place), batches)

    return rows.mapInArrow(search, ddl)


MATCHES = "doc_id long, item_id long, edits int, end long"


def matches(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", rate: float = RATE, least: int = 1) -> DataFrame:
    """doc_id, item_id, edits and end (in the normalised text) of every benchmark item that a document holds."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("end", pa.int64())])

    def found(matcher: Matcher, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, *m) for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in matcher.find(normal(t.as_py() or ""))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    each = [searched(rows, i, block, rate, MATCHES, found) for i, block in enumerate(blocks(items, least))]
    return reduce(DataFrame.unionByName, each) if each else docs.sparkSession.createDataFrame([], MATCHES)


def clean(docs: DataFrame, items: DataFrame, *, text: str = "text", rate: float = RATE, least: int = 1) -> DataFrame:
    """The rows of docs that hold no item, with the columns of docs."""
    at = docs.columns.index(text)

    def kept(matcher: Matcher, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([next(matcher.find(normal(t.as_py() or "")), None) is None for t in batch.column(at)], pa.bool_()))

    out = docs
    for i, block in enumerate(blocks(items, least)):  # rows that one block finds are not searched for the next
        out = searched(out, i, block, rate, docs.schema, kept)
    return out
