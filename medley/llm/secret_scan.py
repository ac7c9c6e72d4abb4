"""Secret scans over an incremental blob ledger (DataFrame functions only).

Every version of every path is content-addressed by SHA-256. The ledger is a folder of Parquet tables: ``versions``
(path, blob) of each scan, ``scanned`` with a row per blob and scan (the rule versions that were run), and ``findings``
with a row per finding. A scan runs only the (blob, rule version) pairs that no earlier scan has in the ledger, each distinct
blob once, and joins the findings back to all paths. compact() folds the history into one folder per table.

Defined results: a null text counts as empty; a null path keeps its row; equal texts share one blob and so get equal
findings; repeated rows stay repeated; an empty table gives an empty result; long texts are scanned whole, in time linear in their length. Offsets count code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import bound, folders, new_dir, removed, spread_join, written


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    #: The group that must have at least so many characters.
    group: int
    least: int

    @property
    def label(self) -> str:
        return f"{self.kind}@{self.version}"


#: Letters in either case are spelled out, so that no engine folds other letters onto them.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: In the order in which kinds sort. A run of hex digits or of key characters of at least the wanted length is
#: what the open pattern finds, less the runs that are too short.
BASE = (
    Rule("assign", 1, ASSIGN, 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)
ADDED = (
    Rule("pem", 1, r"-----BEGIN\x20[A-Z\x20]{0,40}PRIVATE\x20KEY-----", 0, 1),
    # starts where a run of its characters starts, and takes runs whole: long runs stay linear
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 0, 1),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    Rule("forge", 1, r"gh[opsu]_[A-Za-z0-9]{30,}", 0, 1),
)
RULES = BASE + ADDED
SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,version:int>"


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of a rule's leftmost non-overlapping matches, from the lengths of what lies between them."""
    pattern = F.lit(rule.pattern)

    def located(pieces: Column) -> Column:
        whole, part = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group))
        steps = F.zip_with(pieces, F.arrays_zip(whole, part), lambda p, m: F.struct(F.length(p).cast("long").alias("skip"), F.length(m["0"]).cast("long").alias("len"), F.length(m["1"]).alias("got")))

        def add(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["skip"]
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["len"]).alias("end"), F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))
            return F.struct((start + x["len"]).alias("at"), F.when(x["got"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

        # The last piece has no match after it.
        taken = F.slice(steps, 1, F.size(steps) - 1)
        return F.aggregate(taken, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")), add, lambda acc: acc["out"])

    return F.when(text.rlike(rule.pattern), bound(F.split(text, rule.pattern, -1), located)).otherwise(F.array().cast(f"array<{SPAN}>"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


SCANNED = "blob string, rules array<string>"
FINDINGS = f"blob string, f {SPAN}"


def scan(versions: DataFrame, ledger: str, *, path: str = "path", content: str = "content", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Scan versions (path, content) into the ledger folder; one row per version: path, blob, findings.

    Findings hold those of the given rule versions only, in order of start and then of rule.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col(content), F.lit(""))
    name = new_dir(spark, "scan").rpartition("/")[2]
    paths_at = f"{ledger}/versions/{name}"
    versions.select(F.col(path).alias("path"), F.sha2(text, 256).alias("blob")).write.parquet(paths_at)
    paths = spark.read.parquet(paths_at)

    # distinct blobs, less the rule versions that the ledger has for them
    labels = [r.label for r in rules]
    wanted = F.array(*(F.lit(x) for x in labels))
    known = _read(spark, f"{ledger}/scanned/*", SCANNED).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("done"))
    todo = paths.groupBy("blob").agg(F.min(F.xxhash64("path")).alias("at")).join(known, "blob", "left")
    todo = todo.select("blob", "at", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))).alias("need")).where(F.size("need") > 0)

    # The text of one version of each such blob. Rows are dealt by blob and path, so a blob on many paths is not one task's; rows
    # that repeat both lie together and are one then.
    source = versions.select(text.alias("text"), F.xxhash64(path).alias("at")).withColumn("blob", F.sha2("text", 256))
    fetched = source.join(todo.hint("shuffle_hash"), ["blob", "at"]).dropDuplicates(["blob", "at"])
    spans = [F.when(F.array_contains("need", r.label), matches(F.col("text"), r, i)).otherwise(F.array().cast(f"array<{SPAN}>")) for i, r in enumerate(rules)]
    found = written(fetched.select("blob", F.col("need").alias("rules"), F.concat(*spans).alias("findings")), "scan")
    # findings first: a scan that ends between the two writes is done again
    found.select("blob", F.explode("findings").alias("f")).write.parquet(f"{ledger}/findings/{name}")
    found.select("blob", "rules").write.parquet(f"{ledger}/scanned/{name}")

    # the findings of these rules, ranked as the rules are; a scan that was done again left equal rows
    rank = F.create_map(*(x for i, label in enumerate(labels) for x in (F.lit(label), F.lit(i))))
    label = F.concat_ws("@", "f.kind", "f.version")
    hits = _read(spark, f"{ledger}/findings/*", FINDINGS).where(label.isin(labels))
    hits = hits.select("blob", F.struct("f.start", rank[label].alias("rank"), "f.end", "f.kind", "f.version").alias("f"))
    hits = written(hits.groupBy("blob").agg(F.sort_array(F.collect_set("f")).alias("findings")), "hits")
    out = spread_join(paths, hits, "blob", F.col("path"))
    return out.select("path", "blob", F.coalesce("findings", F.array().cast(f"array<{SPAN}>")).alias("findings"))


def compact(spark: SparkSession, ledger: str) -> None:
    """Fold the ledger's history into one folder per table; the old folders go once the new one stands."""
    done = F.array_sort(F.array_distinct(F.flatten(F.collect_list("rules")))).alias("rules")
    folds = {"findings": (FINDINGS, lambda df: df.distinct()), "scanned": (SCANNED, lambda df: df.groupBy("blob").agg(done))}
    for table, (schema, fold) in folds.items():
        old = folders(spark, f"{ledger}/{table}")
        if len(old) > 1:
            fold(spark.read.schema(schema).parquet(*old)).write.parquet(f"{ledger}/{table}/{new_dir(spark, 'scan').rpartition('/')[2]}")
            for path in old:
                removed(spark, path)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per document: counts per base kind, the digest of its base spans and all its spans."""
    found = scan(docs, ledger or new_dir(docs.sparkSession, "ledger"), path="doc_id", content="text")
    base = F.filter("findings", lambda s: s["rank"] < len(BASE))
    n = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("path").alias("doc_id"), n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("findings")).alias("spans"),
    )
