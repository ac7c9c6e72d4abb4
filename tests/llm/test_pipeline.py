"""The corpus pipeline, each stage against a plain version of it on what the stage before kept."""

import random
import zlib
from collections import Counter
from math import comb, log

import numpy as np
import pytest

import corpus_pipeline
from medley.llm import decontaminate, quality_rules
from medley.llm.queries import ORACLE

from .test_operators import DOCS, edits, plain_components, plain_measures

LABELS, ITEMS = "doc_id long, quality int, toxic int", "item_id long, text string"


def corpus(seed=3):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randrange(3, 9))) for _ in range(800)]
    words = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [" ".join(words(14)) for _ in range(5)]
    texts, labels = [], []
    for _ in range(240):
        w = words(r.randrange(55, 90))
        bad = r.random() < 0.15
        if bad:
            w = [x + "##" if r.random() < 0.8 else x for x in w]
        labels.append((len(texts), int(not bad), 0))
        texts.append(" ".join(w))
    for i in range(0, 60, 3):  # exact and near copies
        w = texts[i].split()
        texts.append(texts[i] if i % 2 else " ".join([*w[:-1], "other"]).upper())
    for i, item in enumerate(items):  # benchmark passages, some with an edit
        texts.append(" ".join([*words(40), item if i % 2 else item[:20] + item[21:], *words(30)]))
    texts += [None, "", "too short", "x y z " * 60, " ".join(words(30_000))]
    rows = [(i, x, None if i % 50 == 7 else ("en", "de")[i % 9 == 0], ("big", "big", "a", "b", None)[i % 5], None if x is None else len(x)) for i, x in enumerate(texts)]
    rows += [rows[4], (None, texts[9] + " more", "en", "a", 1)]
    return rows, labels, items


def folder(spark, path, rows, labels, items):
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as kept", "'x' as code", "2 as n", "3 as id", "array(4) as words", "5 as epoch")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([*enumerate(items), (99, None)], ITEMS).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def plain_quality(rows, labels):
    """Indices of the rows that pass, by the rules' own words."""
    q = quality_rules
    values, failed = [], []
    for _, x, *_ in rows:
        n, chars, symbols, dup, repeats = plain_measures(x or "")
        lines = [s for s in (x or "").split("\n") if s.strip(" \t\n\x0b\x0c\r")]
        upper = sum("A" <= c <= "Z" for c in x or "")
        values.append({"symbol_ratio": symbols / max(n, 1), "dup_line_ratio": dup / max(len(lines), 1), "repeat_ratio": repeats / max(n, 1), "upper_ratio": upper / max(chars, 1), "mean_word": chars / max(n, 1)})
        failed.append(n < 50 or 100 * repeats > 50 * n)
    quality = {i: y for i, y, _ in labels}
    cuts, tested = {}, []
    for s in {r[2] for r in rows}:
        texts = {}
        for r, v, f in zip(rows, values, failed):  # a text is one draw, however many rows have it
            if r[2] == s and not f and r[0] in quality:
                texts[r[1]] = max(quality[r[0]], texts.get(r[1], (0,))[0]), v
        held = list(texts.values())
        good = [v for y, v in held if y]
        rules = {k: c for k, c in q.RULES.items() if any(v[k] > x for y, v in held if not y for x in c)}
        if good and rules and len(good) * log(1 - q.ALPHA / len(rules)) <= log(q.DELTA / len(rules)):
            tested.append(len(rules))
        cuts[s] = held, good, rules
    level, out = q.DELTA / max(1, sum(tested)), {}
    for s, (held, good, rules) in cuts.items():
        for k, steps in rules.items():
            p, n, best = q.ALPHA / len(rules), len(good), (0, None)
            for c in steps:
                wrong = sum(v[k] > c for v in good)
                tail = 1.0 if wrong >= n or wrong > n * p else sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(wrong + 1))
                if tail > level:
                    break
                caught = sum(v[k] > c for y, v in held if not y)
                best = (caught, c) if caught > best[0] else best
            if best[1] is not None:
                out[s, k] = best[1]
    return [i for i, (r, v, f) in enumerate(zip(rows, values, failed)) if not f and not any(s == r[2] and v[k] > c for (s, k), c in out.items())], out


def key(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_two_runs_in_one_session(spark, tmp_path):
    """Stages share nothing: a stage's result stays readable whatever other stages are called meanwhile, and a run frees what it wrote."""
    import os

    at = folder(spark, tmp_path, *corpus(5))
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        a = stage(spark, docs, at)
        n = a.count()
        b = stage(spark, docs.limit(50), at)
        again = stage(spark, docs, at)
        assert a.count() == n == again.count() and b.count() <= 50 * 5
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(shared))
    out = corpus_pipeline.run(spark, at)
    left = sorted({x.rsplit("-", 1)[0] for x in set(os.listdir(shared)) - before})
    assert out.count() > 0 and not {"rare-ends", "shared", "placed", "pairs", "units", "quality-rules", "n-gram-Jaccard-join"} & set(left)


def test_each_stage_against_a_plain_version(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    rows, labels, items = corpus()
    at = folder(spark, tmp_path, rows, labels, items)
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns, done = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, at)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
            out.write.parquet(f"{tmp_path}/stage{i}")
            docs = out = spark.read.parquet(f"{tmp_path}/stage{i}")
        done.append(out.collect())

    passed, cuts = plain_quality(rows, labels)
    assert key(done[0]) == Counter((rows[i][0], rows[i][1]) for i in passed) and cuts and len(done[0]) < len(rows) - 30

    known = sorted((r for r in done[0] if r["doc_id"] is not None), key=lambda r: r["doc_id"])
    ids = [r["doc_id"] for r in known]
    _, comp = plain_components([r["text"] for r in known])
    least = {}
    for i, c in zip(ids, comp):
        least[c] = min(i, least.get(c, i))
    gone = {i for i, c in zip(ids, comp) if least[c] != i}
    assert key(done[1]) == key(r for r in done[0] if r["doc_id"] not in gone) and len(gone) > 10

    norm = decontaminate.normal
    holds = lambda x: any(edits(norm(t), norm(x)[:2000])[0] <= int(len(norm(t)) * decontaminate.RATE) for t in items)
    assert key(done[2]) == key(r for r in done[1] if not holds(r["text"])) and len(done[1]) - len(done[2]) == len(items)

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT doc_id, text, source FROM read_parquet('{tmp_path}/stage2/*.parquet')")
    want = Counter(r[0] for r in c.execute(f"SELECT doc_id FROM ({ORACLE['op2_mixing']})").fetchall())
    assert Counter(r["doc_id"] for r in done[3]) == want and set(key(done[3])) <= set(key(done[2]))

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for r in sorted(done[3], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        raw = np.array([*tok.encode(r["text"], add_special_tokens=False).ids, 1], "<u4")
        want.append((r["doc_id"], start, len(raw), zlib.crc32(raw.tobytes())))
        start += len(raw)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in done[4])


def test_pipeline_of_empty_tables(spark, tmp_path):
    at = folder(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, at).count() == 0
    rows, _, _ = corpus(4)
    at = folder(spark, tmp_path / "more", rows[:60], [], [])
    assert corpus_pipeline.run(spark, at).count() > 30
