"""Audit of how filters interact, over every order in which they can be applied (DataFrame functions).

Each document gets a mask, a bit per filter that it fails; documents are counted by part and mask, so that what follows works on
2^k cells a part at most. The cells are unpivoted against the steps of all k! orders. Along an order a running bit-or over the bits
that a cell fails tells which filters have removed it before; conditional sums over the cells give the counts of a step, and a
window over a filter's steps in all orders gives the sum of what it removes, which is its Shapley value times k!.

Texts are read once. Duplicates are told by SHA-256: the table of digests with more than one id is joined to the rows with
its frequent digests apart, so a text that a third of the rows hold is no single task's. The long form is made after the shuffle
by part and needs no other.

Defined results: a null text counts as empty; a null part counts as the empty string; a null id is no duplicate, makes no other row
one and has no label; rows that repeat an id are counted each, and none is a duplicate of another of the same id; of several labels of an id one that
says good (or toxic) is enough; labels without a document count nowhere; an empty table gives an empty result; other columns are
not read. Each part that has a row gets all its steps, zeros included.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import counted_join, spread_join, words_of, written

#: The letter of the filter that removes later copies of a text; the others judge a text by itself.
COPY = "E"
MOST_FILTERS = 6


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """The condition under which a text fails each filter, by the filter's letter."""
    n, capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * n.cast("long"),
        "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def mask_of(conditions: Mapping[str, Column]) -> Column:
    """A bit per condition that holds; the first condition has the lowest."""
    return sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions.values())), F.lit(0))


def masked(docs: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "source", filters=text_filters) -> tuple[DataFrame, str]:
    """(_key, _part, _digest, _mask) of every row, and the letters of the mask's bits; copies are its last bit."""
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", words_of(F.col("_text")))
    conditions = filters(F.col("_text"), F.col("_words"))
    rows = written(rows.select("_key", "_part", F.unhex(F.sha2("_text", 256)).alias("_digest"), mask_of(conditions).alias("_mask")), "masks")
    texts = rows.groupBy("_digest").agg(F.min("_key").alias("_first"), F.max("_key").alias("_last"), F.count(F.lit(1)).alias("_n"))
    texts = written(texts.where("_first < _last").select("_digest", "_first", "_n"), "copies")
    out = counted_join(rows, texts, "_digest", "_n", F.col("_key"))
    copy = F.when(F.col("_key") > F.col("_first"), F.lit(1 << len(conditions))).otherwise(F.lit(0))
    return out.select("_key", "_part", "_digest", (F.col("_mask") + copy).alias("_mask")), "".join(conditions) + COPY


def cells(masks: DataFrame, labels: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """(_part, _mask, _n, _good, _toxic): the documents of each part and mask, and how many of them are labelled good and toxic."""
    says = lambda c: F.max(F.when(F.col(c) == 1, F.lit(1)).otherwise(F.lit(0)))
    told = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(says("quality").alias("_good"), says("toxic").alias("_toxic"))
    told = written(told.where("_good = 1 or _toxic = 1"), "labelled")
    rows = spread_join(masks, told, "_key", F.col("_digest"))
    return rows.groupBy("_part", "_mask").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.coalesce("_good", F.lit(0))).alias("_good"), F.sum(F.coalesce("_toxic", F.lit(0))).alias("_toxic"))


def evaluated(counts: DataFrame, letters: str) -> DataFrame:
    """The steps of all orders of the filters, with their counts, for each part of a table of cells.

    letters names the bits of the masks, from the lowest. There are k! orders of k steps, so MOST_FILTERS filters are the most.
    """
    if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"one to {MOST_FILTERS} filters, each with its letter: {letters!r}")
    orders = ["".join(p) for p in permutations(sorted(letters))]
    steps = counts.repartition("_part").withColumn("filter_order", F.explode(F.array(*(F.lit(o) for o in orders))))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    steps = steps.withColumn("_filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    bit = F.element_at(F.create_map(*(F.lit(x) for i, c in enumerate(letters) for x in (c, 1 << i))), F.col("_filter"))
    steps = steps.withColumn("_bit", bit).withColumn("_fails", F.col("_mask").bitwiseAND(F.col("_bit")))
    along = Window.partitionBy("_part", "_mask", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("_earlier", F.coalesce(F.bit_or("_fails").over(along), F.lit(0)))
    fails, before = F.col("_fails") != 0, F.col("_earlier") != 0
    total = lambda c, which: F.sum(F.when(which, F.col(c)).otherwise(F.lit(0).cast("long")))
    out = steps.groupBy("_part", "filter_order", "step", "_filter").agg(
        total("_n", ~fails & ~before).alias("kept"),
        total("_n", fails & ~before).alias("removed"),
        total("_n", fails & before).alias("redundant"),
        total("_n", F.col("_mask") == F.col("_bit")).alias("unique_fails"),
        total("_good", fails & ~before).alias("good_lost"),
        total("_toxic", fails & ~before).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("_part", "_filter"))
    return out.select(F.col("_part").alias("part"), "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"))


def audit_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order and step: what its filter removes, keeps, would have removed, alone fails and costs."""
    masks, letters = masked(docs)
    return evaluated(written(cells(masks, labels), "cells"), letters)
