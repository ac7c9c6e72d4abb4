"""Mapping reads to near-identical references: a similarity join with the best hit per read.

Reads and references are cut into k-mers. References with equal sequences count once, and k-mers that the same references
hold form a class. No pair of a read and a reference is made that cannot win:

1. Of each read a few seeds are scored: the first holders of its two rarest classes, and of the classes with most of its k-mers.
2. A winner is no further off than the best seed, so it has at most E edits, and an edit destroys at most k k-mers of the read. What no
   reference holds is missing for all; so a winner lacks at most k * E less those of the read's other k-mers. It must hold one of the
   rarest classes that together have more k-mers than that (a prefix filter over classes, the rarest first). Only their holders are
   candidates: classes that nearly all references share are looked at only if nothing rarer decides.
3. References are clustered once around centers, with their edit distance to it. A read is compared with the centers of its candidates, and
   with a member only if the triangle inequality leaves room for it to win.

Ties between references are split by a hash of read and reference, so identical references share their reads evenly. The same
function maps simulated and observed reads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import freed, sized, written
from ..functions.uniform import hash_order

READ = ["r1", "r2"]
CLASS = ["c1", "c2"]


@dataclass(frozen=True)
class MapperOptions:
    k: int = 11
    min_shared: int = 1
    #: Most edits between a reference and the center of its cluster.
    radius: int = 16

    def __post_init__(self):
        if self.k < 1 or self.min_shared < 1 or self.radius < 0:
            raise ValueError("k and min_shared are at least 1, radius at least 0")


@dataclass(frozen=True)
class ReferenceIndex:
    """References made ready for mapping, as written tables; those that are small are marked for broadcast, once."""

    #: kmer, its class (c1, c2), holders and lead: k-mers of one class are held by the same sequences, so many, the least of which is lead.
    kmers: DataFrame
    #: class and rep, the least id among references of one sequence.
    classes: DataFrame
    #: refseq, rep, ref_seq.
    references: DataFrame
    #: rep, center, apart (the edit distance of both), bases (the length of rep).
    clusters: DataFrame
    #: The length of the longest reference.
    longest: int


def kmers(seq: Column, k: int) -> Column:
    """The distinct k-mers of a sequence; the whole sequence if it is shorter."""
    each = F.transform(F.sequence(F.lit(1), F.length(seq) - k + 1), lambda i: F.substring(seq, i, F.lit(k)))
    return F.when(F.length(seq) >= k, F.array_distinct(each)).otherwise(F.array(seq))


def similarity_clusters(once: DataFrame, options: MapperOptions) -> DataFrame:
    """rep, center, apart, bases of references (rep, ref_seq): each joins the least reference whose least k-mer hash is its own.

    Near-identical references mostly agree in that; one that is further than radius from its center is a center itself. Any
    clustering serves: it spares edit distances and changes no hit.
    """
    least = F.array_min(F.transform(kmers(F.col("ref_seq"), options.k), lambda x: F.xxhash64(x)))
    rows = once.select("rep", "ref_seq", least.alias("bucket"))
    centers = rows.groupBy("bucket").agg(F.min(F.struct("rep", "ref_seq")).alias("center"))
    rows = rows.join(centers, "bucket").withColumn("apart", F.levenshtein("ref_seq", "center.ref_seq", options.radius))
    near = F.col("apart") >= 0
    return rows.select("rep", F.when(near, F.col("center.rep")).otherwise(F.col("rep")).alias("center"), F.when(near, F.col("apart")).otherwise(0).alias("apart"), F.length("ref_seq").alias("bases"))


def cluster_references(refs: DataFrame, options: MapperOptions = MapperOptions()) -> ReferenceIndex:
    """The index of references (refseq, sequence); make it once and use it for all reads."""
    rep = F.min("refseq").over(Window.partitionBy("sequence"))
    references = written(refs.select("refseq", rep.alias("rep"), F.col("sequence").alias("ref_seq")), "references")
    once = references.where("refseq = rep").select("rep", "ref_seq")
    held = once.select(F.explode(kmers(F.col("ref_seq"), options.k)).alias("kmer"), "rep")
    # the digest of a k-mer's holders is its class; it is built up without collecting them
    digest = (F.bit_xor(F.xxhash64("rep")).alias("c1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("c2"))
    by_kmer = written(held.groupBy("kmer").agg(*digest, F.count(F.lit(1)).alias("holders"), F.min("rep").alias("lead")), "kmers")
    first = by_kmer.groupBy(*CLASS).agg(F.min("kmer").alias("kmer"))
    classes = written(held.join(first, "kmer").select(*CLASS, "rep"), "classes")
    clusters = written(similarity_clusters(once, options), "clusters")
    longest = clusters.agg(F.max("bases")).first()[0] or 0
    return ReferenceIndex(sized(by_kmer), sized(classes), sized(references), sized(clusters), longest)


def read_classes(distinct: DataFrame, index: ReferenceIndex, options: MapperOptions) -> DataFrame:
    """The classes of each read (r1, r2, sequence), the rarest first: n of its k-mers, those of rarer ones before, lead, holders, place."""
    each = distinct.select(*READ, F.explode(kmers(F.col("sequence"), options.k)).alias("kmer")).join(index.kmers, "kmer")
    found = each.groupBy(*READ, *CLASS).agg(F.count(F.lit(1)).alias("n"), F.first("holders").alias("holders"), F.first("lead").alias("lead"))
    rarest = Window.partitionBy(*READ).orderBy("holders", *CLASS)  # as many rows as a read has k-mers at most
    before = F.coalesce(F.sum("n").over(rarest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.withColumn("before", before).withColumn("place", F.row_number().over(rarest))


def scored(pairs: DataFrame, distinct: DataFrame, index: ReferenceIndex, options: MapperOptions) -> DataFrame:
    """pairs (r1, r2, rep and what else) with edits, identity and shared, the k-mers that both hold."""
    once = index.references.where("refseq = rep").select("rep", "ref_seq")
    rows = pairs.join(distinct, READ).join(once, "rep")
    edits = F.levenshtein("sequence", "ref_seq")
    shared = F.size(F.array_intersect(kmers(F.col("sequence"), options.k), kmers(F.col("ref_seq"), options.k)))
    rows = rows.withColumn("edits", edits).withColumn("identity", 1 - F.col("edits") / F.greatest(F.length("sequence"), F.length("ref_seq")))
    return rows.withColumn("shared", shared).drop("sequence", "ref_seq")


def seeded(distinct: DataFrame, classes: DataFrame, index: ReferenceIndex, options: MapperOptions) -> DataFrame:
    """r1, r2, bases, reached, allowed: the best identity of a read's seeds, and how many of the k-mers that references hold a winner may lack."""
    rare = classes.where("place <= 2").select(*READ, F.col("lead").alias("rep"))
    most = classes.groupBy(*READ, "lead").agg(F.sum("n").alias("n")).groupBy(*READ).agg(F.max_by("lead", F.struct("n", "lead")).alias("rep"))
    seeds = scored(rare.unionByName(most).distinct(), distinct, index, options).where(F.col("shared") >= options.min_shared)
    best = seeds.groupBy(*READ).agg(F.max("identity").alias("reached"))
    hits = classes.groupBy(*READ).agg(F.sum("n").alias("hits"))
    rows = distinct.select(*READ, F.length("sequence").alias("bases"), F.size(kmers(F.col("sequence"), options.k)).alias("size")).join(hits, READ).join(best, READ, "left")
    # a reference much longer than the read cannot reach that identity
    longest = F.least(F.greatest(F.col("bases"), F.lit(index.longest)).cast("double"), F.col("bases") / F.col("reached"))
    edits = F.floor((1 - F.col("reached")) * longest + 1e-6)
    allowed = F.when(F.col("reached") > 0, options.k * edits - (F.col("size") - F.col("hits"))).otherwise(F.col("size"))
    return rows.select(*READ, "bases", F.coalesce("reached", F.lit(0.0)).alias("reached"), allowed.alias("allowed"))


def candidates(classes: DataFrame, seeds: DataFrame, index: ReferenceIndex) -> DataFrame:
    """r1, r2, rep of the references that can win: the holders of a read's prefix of classes."""
    prefix = classes.select(*READ, *CLASS, "before").join(seeds.select(*READ, "allowed"), READ).where("before <= allowed")
    return prefix.select(*READ, *CLASS).join(index.classes, CLASS).select(*READ, "rep").distinct()


def winners(pairs: DataFrame, distinct: DataFrame, seeds: DataFrame, index: ReferenceIndex, options: MapperOptions) -> DataFrame:
    """r1, r2, rep, shared, identity of the candidates that win; ties are all there."""
    rows = pairs.join(index.clusters, "rep").join(seeds.select(*READ, F.col("bases").alias("read_bases"), "reached"), READ)
    centers = written(scored(rows.select(*READ, F.col("center").alias("rep")).distinct(), distinct, index, options), "centers")
    known = rows.where("rep = center").select(*READ, "rep").join(centers, [*READ, "rep"])
    apart = centers.select(*READ, F.col("rep").alias("center"), F.col("edits").alias("center_edits"))
    members = rows.where("rep <> center").join(apart, [*READ, "center"])
    room = 1 - F.abs(F.col("center_edits") - F.col("apart")) / F.greatest("read_bases", "bases") >= F.col("reached") - 1e-9
    members = scored(members.where(room).select(*READ, "rep"), distinct, index, options)
    every = known.unionByName(members).where(F.col("shared") >= options.min_shared)
    best = F.max("identity").over(Window.partitionBy(*READ))  # a row for each candidate that the bounds leave
    return every.withColumn("_best", best).where("identity = _best").select(*READ, "rep", "shared", "identity")


def map_reads(reads: DataFrame, refs: DataFrame | ReferenceIndex, options: MapperOptions = MapperOptions()) -> DataFrame:
    """query, hit, score, identity: the best reference of each read (query, sequence); reads that share nothing have no row.

    refs: references (refseq, sequence) or their index. score counts the shared k-mers.
    """
    index = refs if isinstance(refs, ReferenceIndex) else cluster_references(refs, options)
    # two 64-bit hashes stand for a read's sequence until it is scored
    seq = F.col("sequence")
    keyed = reads.select("query", "sequence", F.xxhash64(seq).alias("r1"), F.xxhash64(seq, F.lit(1)).alias("r2"))
    distinct = written(keyed.groupBy(*READ).agg(F.first("sequence").alias("sequence")), "distinct-reads")
    classes = written(read_classes(distinct, index, options), "read-classes")
    seeds = written(seeded(distinct, classes, index, options), "seeds")
    pairs = written(candidates(classes, seeds, index), "candidates")
    freed(classes)
    best = winners(pairs, distinct, seeds, index, options).join(index.references.select("rep", "refseq"), "rep")
    one = F.min_by(F.struct("refseq", "shared", "identity"), hash_order(F.col("query"), F.col("refseq"))).alias("h")
    hits = keyed.select("query", *READ).join(best, READ).groupBy("query").agg(one)
    return hits.select("query", F.col("h.refseq").alias("hit"), F.col("h.shared").cast("double").alias("score"), F.col("h.identity").alias("identity"))


def usable_hits(hits: DataFrame, min_identity: float | None = None, identity: str = "identity") -> DataFrame:
    """Hits with a target; under a threshold also with a readable identity that is not below it (NaN is not)."""
    out = hits.where(F.coalesce(F.col("hit"), F.lit("")) != "")
    if min_identity is None:
        return out
    value = F.expr(f"try_cast({identity} AS double)")
    return out.where(value.isNotNull() & ~F.coalesce((value < min_identity) & ~F.isnan(value), F.lit(False)))
