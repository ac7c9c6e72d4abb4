"""N-gram Jaccard self-join by prefix trees: all links between texts whose shingle sets overlap by a threshold.

A text's set holds its distinct word n-grams as 64-bit hashes. All sets are ordered by one global order: the most frequent
n-grams of the corpus first (a bounded table, from counts over all texts), then the others by hash. Stored in that order, similar
sets share their beginnings, so a trie over them shares the work; and the far end of the order, the rare n-grams, is
what two similar sets must have in common (prefix filter): a set of n can only link with sets that share one of its last
n - ceil(t * n) + 1 members.

1. Equal sets become one class, so exact copies cost nothing further.
2. Classes that share a rare-end member are grouped by it. A first round links each class to one leader of its groups
   (a star, not all pairs) and so collapses large groups of near copies into components.
3. Groups within one component are done. The others are joined whole: small groups by pairs, large ones by pairs of
   blocks of similar size. What two sets share in their rare ends and what can lie beyond bounds their overlap; pairs
   whose bound is too low are left out. No step drops a candidate that could link.
4. What is left of a group goes into tries, each pair in the one group of its least shared n-gram: a task builds a trie over the
   group's targets, walks it with all its probes, carries the overlap of the shared path down, and prunes subtrees whose
   remaining lengths cannot reach the overlap that the threshold asks for. Large groups are dealt to several tries by target and
   probe.

Components of the links come from alternating star contraction. Defined results: texts with fewer words than n have their
whole sequence as one shingle; texts without words (or null) have an empty set and link with nothing; rows
with a null id get a null component and link with nothing; rows that repeat an id count as one document with several
texts; an empty table gives an empty result; texts are read whole; other columns are not read. Distinct n-grams are told apart
by a 64-bit hash.

An n-gram outside the table of frequent ones was found under COUNTED_FROM times in each run of COUNTED n-grams, or less often
than all in the table, so none that a fixed share of the texts hold is among those whose holders one task orders.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import freed, sized, text_slices, worker_dropped, written

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Entries of the table of frequent n-grams, and from how many texts on an n-gram is in it.
FREQUENT, FREQUENT_FROM = 1 << 18, 20
#: N-grams counted together in a task, and how often one must come there to be counted at all.
COUNTED, COUNTED_FROM = 1 << 22, 3
#: Groups up to SMALL are joined by pairs, larger ones by blocks of so many sets or n-grams, over BY_SIZE apart by size.
SMALL, WIDE_BLOCK, BLOCK_NGRAMS, BY_SIZE = 24, 256, 20_000_000, 4096
#: Most targets of one trie, probes that walk it, and n-grams of either.
BLOCK, WALKS, TRIE_NGRAMS = 256, 1024, 5_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD6E8FEB86659FD93


# ---- sets of one batch ---------------------------------------------------------------------------------------------


def mixed_bits(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as many as have been needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            fill = lambda b: np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, b, np.uint64))])
            self.up, self.down = fill(BASE), fill(pow(BASE, -1, 1 << 64))
        return self.up[:n], self.down[:n]


def shingles(texts: pa.Array, powers: Powers, n: int = WORDS) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its n-grams; words are split at ASCII blanks, A-Z lower-cased."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    bounds = offsets - lo
    b = raw.copy()
    b[(b >= 65) & (b <= 90)] |= 32
    word = (b != 32) & ((b < 9) | (b > 13))
    cut = np.zeros(len(b) + 1, bool)
    cut[bounds] = True
    before = np.concatenate([[False], word[:-1]]) if len(word) else word
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.concatenate([word[1:], [False]]) if len(word) else word
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    up, down = powers.to(max(1, len(b)))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)])])
    h = mixed_bits((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    chain = h[: max(0, len(h) - n + 1)].copy()
    for j in range(1, n):
        chain = chain * MULTIPLIER + h[j : len(h) - n + 1 + j]
    chain = mixed_bits(chain)
    first = np.searchsorted(starts, bounds)
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if z - a >= n:
            yield np.unique(chain[a : z - n + 1])
        elif z > a:
            one = np.array([z - a], np.uint64)
            for j in range(a, z):
                one = mixed_bits(one * MULTIPLIER + h[j : j + 1])
            yield one
        else:
            yield np.zeros(0, np.uint64)


class Order:
    """The global order: frequent n-grams get their rank as code, the others keep their hash."""

    def __init__(self, frequent: np.ndarray):
        rank = np.argsort(frequent, kind="stable")
        self.hashes, self.ranks = frequent[rank], rank.astype(np.uint64)

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes) or not len(hashes):
            return hashes
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes
        if not hit.any():
            return hashes
        return np.sort(np.where(hit, self.ranks[at], hashes))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


# ---- the trie ------------------------------------------------------------------------------------------------------


class Node:
    __slots__ = ("part", "depth", "kids", "ends", "least", "most", "group")

    def __init__(self, part: np.ndarray, depth: int):
        self.part, self.depth, self.kids, self.ends = part, depth, [], []
        self.least = self.most = 0
        self.group = None


def trie(sets: list[np.ndarray], groups: list[int], ids: Iterable[int]) -> Node:
    """A path-compressed trie over ordered sets; a node knows the sizes below it, and their group if they have one."""
    ids = sorted(ids, key=lambda i: sets[i].astype(">u8").tobytes())
    root = Node(np.zeros(0, np.uint64), 0)
    work = [(root, ids, 0)]
    made = [root]
    while work:
        node, mine, depth = work.pop()
        i = 0
        while i < len(mine) and len(sets[mine[i]]) == depth:
            node.ends.append(mine[i])
            i += 1
        while i < len(mine):
            first, j = sets[mine[i]], i + 1
            while j < len(mine) and sets[mine[j]][depth] == first[depth]:
                j += 1
            last = sets[mine[j - 1]]
            m = min(len(first), len(last))
            differs = np.flatnonzero(first[depth:m] != last[depth:m])
            reach = depth + int(differs[0]) if len(differs) else m
            kid = Node(first[depth:reach], reach)
            node.kids.append(kid)
            made.append(kid)
            work.append((kid, mine[i:j], reach))
            i = j
    for node in reversed(made):
        sizes = [len(sets[e]) for e in node.ends] + [k.least for k in node.kids] + [k.most for k in node.kids]
        node.least, node.most = (min(sizes), max(sizes)) if sizes else (0, 0)
        below = {groups[e] for e in node.ends} | {k.group for k in node.kids}
        node.group = below.pop() if len(below) == 1 else None
    return root


def trie_links(sets: list[np.ndarray], groups: list[int], sides: list[int], percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Pairs of places that link, but for those in a component that is already known.

    sides: 0 probes, 1 targets, 2 both; groups: the component that each is known to be in.
    """
    up: dict[int, int] = {}

    def find(g: int) -> int:
        while (p := up.get(g, g)) != g:
            up[g] = up.get(p, p)
            g = p
        return g

    root = trie(sets, groups, [i for i, s in enumerate(sides) if s])
    for i, side in enumerate(sides):
        if side == 1 or not len(sets[i]):
            continue
        x, n = sets[i], len(sets[i])
        stack = [(root, 0)]
        while stack:
            node, shared = stack.pop()
            if node.group is not None and find(node.group) == find(groups[i]):
                continue
            used = 0
            if len(node.part):
                at = np.searchsorted(x, node.part)
                shared += int((x[np.minimum(at, n - 1)] == node.part).sum())
                used = int(np.searchsorted(x, node.part[-1], "right"))
            # (100 + percent) * overlap >= percent * (n + m) for some m below this node
            if (100 + percent) * (shared + min(n - used, node.most - node.depth)) < percent * (n + node.least):
                continue
            for e in node.ends:
                if e != i and find(groups[e]) != find(groups[i]) and (100 + percent) * shared >= percent * (n + len(sets[e])):
                    up[find(groups[e])] = find(groups[i])
                    yield i, e
            stack += [(k, shared) for k in node.kids if percent * n <= 100 * k.most and percent * k.least <= 100 * n]


# ---- components ----------------------------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id in links (a, b): the least id reachable, by alternating star contraction."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    mark = None
    while True:
        # large star: what is greater than a node goes to its least neighbour
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = written(large, "large-star")
        freed(edges)
        # small star: a node and its smaller neighbours go to the least of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        edges = large.join(least, "hi").select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        edges = written(edges, "small-star")
        freed(large)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo") % 1_000_000_007)).first()
        if now == mark:
            break
        mark = now
    out = written(edges.select(F.col("hi").alias("id"), F.col("lo").alias("root")), "roots")
    freed(edges)
    return out


# ---- the join ------------------------------------------------------------------------------------------------------


def frequent_ngrams(texts: DataFrame, n: int = WORDS) -> np.ndarray:
    """Hashes of the most frequent n-grams, most frequent first; at most FREQUENT."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_dropped()
        powers, held, size = Powers(), [], 0

        def counted() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            often = c >= COUNTED_FROM
            return pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(c[often].astype(np.int64))], names=["h", "c"])

        for batch in batches:
            for some in text_slices(batch.column(0)):
                for s in shingles(some, powers, n):
                    held.append(s)
                    size += len(s)
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    counts = texts.mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT_FROM)
    rows = counts.orderBy(F.desc("c"), "h").limit(FREQUENT).select("h").toPandas()
    return rows["h"].to_numpy(np.int64).view(np.uint64)


def with_sets(texts: DataFrame, frequent, keep: str, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, text) as id, n and two 64-bit digests of the set, with its rare end (keep="rare") or whole (keep="all")."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_dropped()
        powers, order = Powers(), Order(frequent.value)
        for batch in batches:
            ids, done = batch.column(0), 0
            for some in text_slices(batch.column(1)):
                sets = [order.codes(s) for s in shingles(some, powers, n)]
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                keys = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                held = [s[len(s) - prefix_length(len(s), percent) :][::-1] for s in sets] if keep == "rare" else sets
                at = np.concatenate([[0], np.cumsum([len(h) for h in held])]).astype(np.int32)
                # the last member of the rare end, in an order that signed comparison keeps
                ends = np.array([int(s[len(s) - prefix_length(len(s), percent)]) - (1 << 63) if len(s) else 0 for s in sets], np.int64)
                codes = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(held).view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(done, len(some)), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(ends), codes], names=["id", "n", "k1", "k2", "end", "codes"])
                done += len(some)

    return texts.mapInArrow(build, "id long, n long, k1 long, k2 long, end long, codes array<long>")


def verified(units: DataFrame, texts: DataFrame, frequent, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) within units (unit, id, group, side), each unit a trie join in one task."""
    units = written(units, "units")
    needed = written(units.select("id").distinct(), "needed")
    wanted = with_sets(texts.join(sized(needed), "id", "left_semi"), frequent, "all", n, percent).select("id", "codes")

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["id"].tolist()
        sets = [np.asarray(c, np.int64).view(np.uint64) for c in pdf["codes"]]
        found = [(ids[i], ids[j]) for i, j in trie_links(sets, pdf["group"].tolist(), pdf["side"].tolist(), percent)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    links = written(units.join(wanted, "id").groupBy("unit").applyInPandas(join, "a long, b long"), "links")
    freed(units, needed)
    return links


def compatible(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can link."""
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs: id, n (size of its set), component (least id reachable by links). Options as in joined()."""
    return joined(docs, **options)[0]


def joined(docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of jaccard_components(), and the written tables that they still read: a row per text and one per class.

    All other tables are freed as soon as what reads them is written.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_ngrams(texts.select("text"), n))
    n_frequent = len(frequent.value)
    ends = written(with_sets(texts, frequent, "rare", n, percent), "rare-ends")
    rows = written(ends.drop("codes"), "sets")
    texts = texts.where("id is not null")

    # 1. classes of equal sets, named by their least id
    known = rows.where("id is not null and n > 0")
    classes = written(known.groupBy("k1", "k2").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("copies")), "classes")
    copied = written(classes.where("copies > 1"), "copied")
    copies = known.select("id", "k1", "k2").join(sized(copied), ["k1", "k2"]).where(F.col("id") != F.col("class"))
    copies = written(copies.select("id", "k1", "k2").distinct(), "copies")
    freed(copied)
    first = lambda sets: sets.where("id is not null and n > 0").join(sized(copies), ["id", "k1", "k2"], "left_anti")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    entries = first(ends).select("id", "n", F.posexplode("codes").alias("pos", "code"))

    # 2. groups of classes that share a member of their rare ends. Rare members have small groups, so one shuffle brings
    # each together; groups of frequent ones, FREQUENT at most, are summed before they meet their members.
    is_frequent = (F.col("code") >= 0) & (F.col("code") < n_frequent)
    by_code, by_band = Window.partitionBy("code"), Window.partitionBy("code", "band")
    rare = entries.where(~is_frequent).withColumn("m", F.count(F.lit(1)).over(by_code)).where("m > 1")
    rare = rare.withColumn("band", band).withColumn("lead", F.min("id").over(by_band))
    often = written(entries.where(is_frequent).withColumn("band", band), "frequent-entries")
    sizes = written(often.groupBy("code").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "frequent-groups")  # FREQUENT rows at most
    leads = written(often.groupBy("code", "band").agg(F.min("id").alias("lead")), "frequent-leads")
    shared = rare.unionByName(often.join(F.broadcast(sizes), "code").join(sized(leads), ["code", "band"]).select(*rare.columns))
    shared = written(shared, "shared")
    freed(ends, often, sizes, leads)

    # a star per class: the leader with which it shares most
    best = shared.where("lead < id").groupBy("id", "lead").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
    best = best.groupBy("id").agg(F.max(F.struct("c", F.negative("lead").alias("l"))).alias("s"), F.first("n").alias("n"))
    stars = written(best.where(F.col("s.c") * 400 >= (100 - percent) * F.col("n")).select("id", F.negative("s.l").alias("lead")), "stars")
    chunks = stars.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("chunks"))
    unit = F.xxhash64("lead", F.col("chunk"))
    targets = stars.join(chunks, "lead").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    probes = chunks.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    units = targets.select(unit.alias("unit"), "id", F.col("id").alias("group"), F.lit(1).alias("side"))
    units = units.unionByName(probes.select(unit.alias("unit"), F.col("lead").alias("id"), F.col("lead").alias("group"), F.lit(0).alias("side")))
    links = verified(units, texts, frequent, n, percent)
    roots = components(links)
    freed(stars, links)

    # 3. groups that still hold several components
    sharing = written(shared.select("id").distinct(), "sharing")
    last = written(first(rows).select("id", "end").join(sized(sharing), "id", "left_semi"), "ends")
    placed = shared.drop("band", "lead").join(sized(roots), "id", "left").withColumn("group", F.coalesce("root", "id")).drop("root").join(sized(last), "id")
    g1, g2 = F.min("group"), F.max("group")
    rare = placed.where(~is_frequent).withColumn("g1", g1.over(by_code)).withColumn("g2", g2.over(by_code)).where("g1 <> g2")
    often = placed.where(is_frequent)
    stats = written(often.groupBy("code").agg(g1.alias("g1"), g2.alias("g2")).where("g1 <> g2"), "frequent-stats")
    placed = written(rare.unionByName(often.join(F.broadcast(stats), "code").select(*rare.columns)), "placed")
    freed(shared, sharing, last, stats, copies)
    open_small = placed.where(F.col("m") <= SMALL)
    # of large groups with the same members one is enough, with the place nearest the rare end that each set has in any of them
    large = placed.where(F.col("m") > SMALL)
    alike = large.groupBy("code").agg(F.first("m").alias("m"), F.min("g1").alias("g1"), F.max("g2").alias("g2"), F.sum(F.xxhash64("id") % (1 << 40)).alias("sig"))
    one = alike.withColumn("one", F.min("code").over(Window.partitionBy("m", "sig", "g1", "g2"))).where("one <> code").select("code", "one")
    one = written(one, "alike-groups")
    merged = large.join(sized(one), "code", "left").groupBy(F.coalesce("one", "code").alias("code"), "id")
    open_large = written(merged.agg(F.first("n").alias("n"), F.first("m").alias("m"), F.min("pos").alias("pos"), F.count(F.lit(1)).alias("big")), "large-entries")
    large_counts = open_large.groupBy("id").agg(F.sum("big").alias("big"))

    a = open_small.select("code", F.col("id").alias("a"), F.col("n").alias("na"), F.col("end").alias("ea"), F.col("pos").alias("pa"), F.col("group").alias("ga"))
    b = open_small.select("code", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("end").alias("eb"), F.col("pos").alias("pb"), F.col("group").alias("gb"))
    pairs = a.join(b, "code").where((F.col("a") < F.col("b")) & (F.col("ga") != F.col("gb")) & compatible(F.col("na"), F.col("nb"), percent))
    pairs = pairs.groupBy("a", "b", "na", "nb", "ea", "eb", "ga", "gb").agg(F.count(F.lit(1)).alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.min("code").alias("code"))
    large_counts = written(large_counts, "large-counts")
    big = sized(large_counts)
    pairs = pairs.join(big.select(F.col("id").alias("a"), F.col("big").alias("ba")), "a", "left").join(big.select(F.col("id").alias("b"), F.col("big").alias("bb")), "b", "left")
    # What they can have in common: what their rare ends share, and what lies beyond. The rare end that stops first in the
    # order has all its common members in the other's, so only the rest of that set can add to them; and nothing
    # adds that does not come after the last one shared.
    both = F.col("c") + F.least(F.coalesce("ba", F.lit(0)), F.coalesce("bb", F.lit(0)))
    rest = lambda n: F.ceil(F.col(n) * percent / 100) - 1
    beyond = F.when(F.col("ea") == F.col("eb"), F.least(rest("na"), rest("nb"))).when(F.col("ea") > F.col("eb"), rest("na")).otherwise(rest("nb"))
    most = both + F.least(beyond, F.col("na") - F.col("pa") - 1, F.col("nb") - F.col("pb") - 1)
    pairs = pairs.where((100 + percent) * most >= percent * (F.col("na") + F.col("nb"))).select("a", "b", "na", "nb", "ga", "gb", "code")
    pairs = pairs.unionByName(block_pairs(open_large, placed, percent))
    pairs = written(pairs.groupBy("a", "b", "na", "nb", "ga", "gb").agg(F.min("code").alias("code")), "pairs")
    freed(placed, one, open_large, large_counts)
    units, parts = group_units(pairs)
    more = verified(units, texts, frequent, n, percent)
    freed(pairs, *parts)

    # components over both rounds; classes that stand alone need no row
    final = components(more.unionByName(roots.select(F.col("id").alias("a"), F.col("root").alias("b"))))
    special = classes.join(final.withColumnRenamed("id", "class"), "class", "left").where("copies > 1 or root is not null")
    special = written(special.select("k1", "k2", F.coalesce("root", "class").alias("component")), "components")
    frequent.unpersist()
    freed(more, roots, final, classes)
    out = rows.select("id", "n", "k1", "k2").join(sized(special), ["k1", "k2"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id")))
    return out.select("id", "n", component.alias("component")), [rows, special]


def group_units(pairs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Units (unit, id, group, side) for pairs (a, b, na, nb, ga, gb, code): per code its a as probes and its b as targets; and what they read.

    A code with many of either is dealt to several units, and only to those in which a pair of its own meets.
    """

    def dealt(side: str, most: int) -> DataFrame:
        """Per code the number of parts into which its sets of a side are dealt."""
        sets = pairs.select("code", F.col(side).alias("id"), F.col(f"n{side}").alias("n")).distinct()
        parts = F.greatest(F.ceil(F.count(F.lit(1)) / most), F.ceil(F.sum("n") / TRIE_NGRAMS))
        return sets.groupBy("code").agg(parts.alias(f"{side}_parts")).where(F.col(f"{side}_parts") > 1)

    rows, parts = pairs, [written(dealt(side, most), "parts") for side, most in (("a", WALKS), ("b", BLOCK))]
    for p in parts:
        rows = rows.join(sized(p), "code", "left")
    part = lambda side: F.pmod(F.xxhash64(side), F.coalesce(f"{side}_parts", F.lit(1)))
    rows = rows.withColumn("unit", F.xxhash64("code", part("a"), part("b")))
    both = rows.select("unit", F.explode(F.array(*(F.struct(F.col(s).alias("id"), F.col(f"g{s}").alias("group"), F.lit(i).alias("target")) for i, s in enumerate("ab")))).alias("x"))
    sides = both.groupBy("unit", "x.id", "x.group").agg(F.min("x.target").alias("least"), F.max("x.target").alias("most"))
    return sides.select("unit", "id", "group", F.when(F.col("least") < F.col("most"), 2).otherwise(F.col("most")).alias("side")), parts


def block_units(entries: DataFrame, percent: int) -> DataFrame:
    """Units over large groups (code, id, n, m): all pairs of their blocks; very large ones only those of compatible sizes."""
    ratio = (100.0 / percent) ** 0.5
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(ratio)))
    # the smaller set of a pair shares one of its first n - ceil(2tn / (1 + t)) + 1 members in the order of rare ends
    probe = F.col("pos") <= F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent))
    placed = entries.select("code", "id", "n", probe.alias("probe"), F.when(F.col("m") > BY_SIZE, size).otherwise(F.lit(0)).alias("size"))
    sizes = placed.groupBy("code", "size").agg(F.greatest(F.ceil(F.count(F.lit(1)) / WIDE_BLOCK), F.ceil(F.sum("n") / BLOCK_NGRAMS)).alias("salts"))
    all_sizes = sizes.groupBy("code").agg(F.collect_list(F.struct("size", "salts")).alias("sizes"))  # as many as there are size classes
    placed = placed.join(sizes, ["code", "size"]).join(all_sizes, "code").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
    # sizes that can link lie at most three classes of the square root of the ratio apart
    near = F.filter("sizes", lambda s: F.abs(s["size"] - F.col("size")) <= 3)
    other = placed.withColumn("near", F.explode(near)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("near.salts") - 1)))
    mine, theirs = F.struct("size", "salt"), F.struct(F.col("near.size").alias("size"), F.col("other").alias("salt"))
    unit = F.xxhash64("code", F.least(mine, theirs), F.greatest(mine, theirs))
    block = F.when(mine == theirs, 2).when(mine < theirs, 0).otherwise(1)
    return other.select(unit.alias("unit"), "code", "id", "probe", block.alias("block"))


def block_pairs(entries: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb, ga, gb, code) of large groups that can link.

    A unit brings two blocks together with what each of their sets shares of its rare end, a small part of the set; so what a pair
    has in common there is known exactly, and what may lie beyond is bounded by the size of the other part.
    """
    units = block_units(entries, percent)
    ends = shared.groupBy("id").agg(F.first("n").alias("n"), F.first("end").alias("end"), F.first("group").alias("group"), F.sort_array(F.collect_list("code")).alias("codes"))
    units = units.join(ends, "id")

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n")
        ids, n, end, group, probe, block = (pdf[c].to_numpy() for c in ("id", "n", "end", "group", "probe", "block"))
        codes = pdf["codes"].tolist()
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
        flat, owner = np.concatenate(codes), np.repeat(np.arange(len(codes)), np.diff(offsets))
        rest = -(-percent * n // 100) - 1
        out = []
        for i in np.flatnonzero(probe):
            # partners of at least its size, up to the largest that can link
            lo, hi = np.searchsorted(n, n[i]), np.searchsorted(n, 100 * n[i] // percent, "right")
            mine, theirs = codes[i], flat[offsets[lo] : offsets[hi]]
            hit = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
            common = np.bincount(owner[offsets[lo] : offsets[hi]][hit] - lo, minlength=hi - lo)
            r, e = rest[lo:hi], end[lo:hi]
            beyond = np.where(e == end[i], np.minimum(r, rest[i]), np.where(e > end[i], r, rest[i]))
            can = (common > 0) & ((100 + percent) * (common + beyond) >= percent * (n[lo:hi] + n[i]))
            can &= (group[lo:hi] != group[i]) & (ids[lo:hi] != ids[i]) & ((block[lo:hi] != block[i]) | (block[i] == 2))
            for t in np.flatnonzero(can) + lo:
                a, b = (i, t) if ids[i] < ids[t] else (t, i)
                out.append((ids[a], ids[b], n[a], n[b], group[a], group[b], pdf["code"].iloc[0]))
        return pd.DataFrame(out, columns=["a", "b", "na", "nb", "ga", "gb", "code"], dtype="int64").drop_duplicates()

    return units.groupBy("unit").applyInPandas(pairs, "a long, b long, na long, nb long, ga long, gb long, code long")


def jaccard_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    out = jaccard_components(docs, **options)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """The rows of docs whose id is the least of its component, with the columns of docs; rows with a null id stay."""
    out, tables = joined(docs, key=key, **options)
    gone = written(out.where("component <> id").select(F.col("id").alias("_gone")).distinct(), "gone")
    freed(*tables)
    return docs.join(sized(gone), F.col(key) == F.col("_gone"), "left_anti")
