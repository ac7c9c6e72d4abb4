"""Operators 11 to 13 against plain versions, with nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from medley.llm import _shared, fill_in_middle, filter_audit, token_counts
from medley.llm._shared import new_dir

from .test_operators import DOCS, by_id, odd_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def frame(spark, rows, extra=False):
    df = spark.createDataFrame([(i, x, "en", s, 0) for i, x, s in rows], DOCS)
    return df.selectExpr("*", "1 as part", "'x' as form", "2 as n", "3 as step", "4 as n_tokens", "5 as output") if extra else df


# ---- 11 ------------------------------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    """(part, order, step) -> the seven counts, from the definitions."""
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, x in labels if x == 1 and k is not None}
    first = {}
    for k, t, _ in rows:
        if k is not None:
            first[t or ""] = min(k, first.get(t or "", k))
    fails = []
    for k, t, s in rows:
        t, w = t or "", WORD.findall(t or "")
        said = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": k is not None and k > first[t]}
        fails.append((k, s or "", {f for f, x in said.items() if x}))
    out, removed = {}, Counter()
    for part in {s for _, s, _ in fails}:
        mine = [(k, f) for k, s, f in fails if s == part]
        for order in map("".join, permutations("ABCDE")):
            for i, f in enumerate(order):
                before = set(order[:i])
                gone = [(k, x) for k, x in mine if f in x and not x & before]
                out[part, order, i + 1] = [
                    sum(not x & (before | {f}) for _, x in mine), len(gone), sum(f in x and bool(x & before) for _, x in mine), sum(x == {f} for _, x in mine),
                    sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone),
                ]
                removed[part, f] += len(gone)
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(seed):
    r = random.Random(seed)
    words = ["alpha", "beta", "gamma", "ALPHA", "#x", "é", "日本"]
    texts = [" ".join(r.choice([*words, str(r.random())]) for _ in range(r.choice([3, 150, 199, 200, 201, 400]))) for _ in range(25)]
    texts += [None, "", " ", "A" * 2 + "b" * 98, "A" * 3 + "b" * 97, " ".join(map(str, range(5000))) + " \x0b\r"]
    rows = [(i, r.choice(texts), r.choice(["s0", "s1", None, ""])) for i in range(90)]
    return [*rows, rows[3], rows[3], (None, "x y", "s2"), (None, None, None), (None, "x y", "s2")]


def told(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_audit(spark):
    rows = audit_rows(3)
    labels = [(i, i % 3 % 2, i % 5 % 2) for i in range(0, 80, 2)] + [(4, 1, 0), (4, 0, None), (5, None, 1), (None, 1, 1), (9999, 1, 1)]
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("y"))
    got = filter_audit.audit_report(frame(spark, rows, extra=True), said)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert [t for _, t in got.dtypes] == ["string", "string", "int", *["bigint"] * 7]
    want = plain_audit(rows, labels)
    assert len(want) == 4 * 600 and told(got) == want
    assert filter_audit.audit_report(frame(spark, []), said).count() == 0


def test_audit_of_frequent_texts_beyond_a_broadcast(spark, monkeypatch):
    rows = [(i, "same text", "s") for i in range(40)] + [(i, f"pair {i // 2}", "t") for i in range(40, 60)] + [(None, "same text", "s")]
    said = spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    want = plain_audit(rows, [(1, 1, 0), (2, 1, 1)])
    monkeypatch.setattr(_shared, "HOT", 10)
    for most in (1, 0):  # the frequent digests alone can be sent; nothing can
        monkeypatch.setattr(_shared, "sized", lambda df, most=most: F.broadcast(df) if df.count() <= most else df)
        assert told(filter_audit.audit_report(frame(spark, rows), said)) == want


def test_audit_sends_no_more_than_was_counted(spark, monkeypatch):
    masks = spark.createDataFrame([(i, "p", bytes([i % 3]), i % 3) for i in range(30)], "_key long, _part string, _digest binary, _mask int")
    said = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    copies = spark.createDataFrame([(bytes([0]), 0, 10), (bytes([1]), 1, 2000)], "_digest binary, _first long, _n long")
    monkeypatch.setattr(_shared, "sized", lambda df: df)  # too many rows, though Spark finds their files small enough
    joined = filter_audit.cells(masks, said), _shared.counted_join(masks, copies, "_digest", "_n", F.col("_key"))
    assert sorted(map(tuple, joined[0].collect())) == [("p", 0, 10, 7, 3), ("p", 1, 10, 7, 4), ("p", 2, 10, 6, 3)] and joined[1].count() == 30
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in joined]
    assert all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for p in plans)
    monkeypatch.setattr(_shared, "sized", lambda df: F.broadcast(df) if df.count() < 2 else df)  # the frequent digest alone can be sent
    split = _shared.counted_join(masks, copies, "_digest", "_n", F.col("_key"))
    assert split.where("_first is not null").count() == 20 and "SortMergeJoin" in split._jdf.queryExecution().executedPlan().toString()


def test_audit_of_other_filters(spark):
    cells = spark.createDataFrame([("p", 0, 5, 0, 0), ("p", 1, 3, 1, 0), ("p", 3, 2, 0, 2)], "_part string, _mask int, _n long, _good long, _toxic long")
    got = told(filter_audit.evaluated(cells, "xy"))
    assert got == {("p", "xy", 1): (5, 5, 0, 3, 1, 2, 8), ("p", "xy", 2): (5, 0, 2, 0, 0, 0, 2), ("p", "yx", 1): (8, 2, 0, 0, 0, 2, 2), ("p", "yx", 2): (5, 3, 2, 3, 1, 0, 8)}
    assert set(told(filter_audit.evaluated(cells.where("_mask < 2"), "x"))) == {("p", "x", 1)}
    with pytest.raises(ValueError):
        filter_audit.evaluated(cells, "abcdefg")


# ---- 12 ------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    from sentencepiece import SentencePieceProcessor

    public_tokenizers = pytest.importorskip("public_tokenizers")
    return SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_token_counts(spark, model):
    texts = [*odd_texts(7, 80), "<s> </s> <unk> ▁", "a  b", "a b", " a b ", "x\0y", "\U0001f600" * 50, "long word " * 3000]
    rows = [(i, x, "s") for i, x in enumerate(texts)] + [(0, texts[0], "s"), (None, "a b", "s"), (None, None, "s")]
    got = token_counts.count_report(frame(spark, rows, extra=True))
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    want = [(i, len((x or "").encode()), n := len(model.encode(x or "")), n > 4096) for i, x, _ in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert token_counts.count_report(frame(spark, [])).count() == 0


def test_token_cache_encodes_only_what_is_new(spark, model, monkeypatch):
    import public_tokenizers

    cache, tokenizer = new_dir(spark, "cache"), token_counts.Tokenizer.of(public_tokenizers.path("piece_bpe_32k.model"))
    stored = lambda t=tokenizer: spark.read.parquet(f"{cache}/{t.version}/*")
    docs = frame(spark, [(i, f"text {i % 7}", "s") for i in range(60)] + [(60, None, "s"), (61, "", "s")])
    counts = lambda df, t=tokenizer: sorted(map(str, map(tuple, token_counts.counted(df, cache, t).collect())))
    first = counts(docs)
    assert stored().count() == 8  # each distinct text once
    assert counts(docs) == first and stored().count() == 8
    more = docs.unionByName(frame(spark, [(99, "another text", "s"), (98, "another text", "s")]))
    with monkeypatch.context() as m:
        # a stored count is believed; so what is stored was not encoded again
        m.setattr(_shared, "HOT", 3)
        m.setattr(_shared, "sized", lambda df: df)
        m.setattr(token_counts, "sized", lambda df: df)
        assert set(first) < set(counts(more)) and stored().count() == 9
    other = token_counts.Tokenizer.of(public_tokenizers.path("word_bpe_49k.json"))
    assert other.version != tokenizer.version
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in more.collect()]
    assert counts(more, other) == sorted(map(str, want)) and stored().count() == 9 == stored(other).count()
    with pytest.raises(ValueError):
        token_counts.Tokenizer.of("x.tiktoken")


def test_token_cache_joins_equal_contents(spark, monkeypatch):
    """Contents that a normalisation makes equal share one entry."""
    import public_tokenizers

    tokenizer = token_counts.Tokenizer.of(public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(token_counts.Tokenizer, "normalised", lambda self, text: F.trim(F.regexp_replace(text, "\x20+", " ")))
    cache = new_dir(spark, "cache")
    got = token_counts.counted(frame(spark, [(1, "a b", "s"), (2, " a  b ", "s"), (3, "ab", "s")]), cache, tokenizer).collect()
    assert {r._key: r._bytes for r in got} == {1: 3, 2: 6, 3: 2} and spark.read.parquet(f"{cache}/*/*").count() == 2


# ---- 13 ------------------------------------------------------------------------------------------------------------


def plain_middle(key, text, seed=42):
    t = text or ""
    units, digest = UNIT.findall(t), hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h, n = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)], len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    form = "plain" if not t or re.search("<[PSM]>", t) or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm"
    out = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return n, form, None if form == "plain" else len(p), None if form == "plain" else len(m), out


def middle_texts(seed, n):
    r = random.Random(seed)
    parts = ["a", "bc", "é", "日", "\U0001f600", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x85", " ", " ", "<", "P>", "<M", ">", "<S>", "$1", "\\"]
    return ["".join(r.choice(parts[: r.choice([5, 12, len(parts)])]) for _ in range(r.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("chunk", [1, 2, 7, fill_in_middle.CHUNK])
def test_middle(spark, chunk):
    texts = [*middle_texts(chunk, 300), None, "", " ", "x", "x ", "w " * 20_000, " " * 9000 + "x" * 9000, "\U0001f600 " * 6000, *["ab  cd e\n"] * 40]
    rows = [(i, x, "s") for i, x in enumerate(texts)] + [(0, texts[0], "s"), (None, "a b c d", "s"), (2, "another text of 2", "s")]
    docs = frame(spark, rows, extra=True)
    got = fill_in_middle.transformed(docs, chunk=chunk)
    assert got.columns == [*docs.columns, "_fim"]
    found = got.select("doc_id", "text", "_fim.*", fill_in_middle.restored(F.col("_fim.output"), F.col("_fim.form")).alias("back")).collect()
    assert len(found) == len(rows) and len({r.form for r in found}) == 3
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle(r.doc_id, r.text), r
        assert r.back == (r.text or "")


def test_middle_report(spark):
    docs = frame(spark, [(i, x, "s") for i, x in enumerate(middle_texts(9, 60))])
    got = fill_in_middle.middle_report(docs)
    assert got.dtypes == [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), ("output_sha256", "string"), ("restored_sha256", "string")]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for k, r in by_id(got).items():
        want = plain_middle(k, texts[k])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[:4] and r.output_sha256 == hashlib.sha256(want[4].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(texts[k].encode()).hexdigest()
    assert fill_in_middle.middle_report(frame(spark, [])).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
