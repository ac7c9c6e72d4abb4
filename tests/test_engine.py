"""Sequence functions, sources, sinks and a whole run with planted truth."""

import gzip
import hashlib
import json
import random
import struct
import zlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from medley.functions import sequence as S
from medley.operators import composition as C
from medley.operators import mapper, provenance, sampling, validation
from medley.operators.database import genome_database
from medley.operators.map_fit import MapOptions
from medley.operators.posterior import InferenceOptions
from medley.plans.options import Options
from medley.__main__ import main, options, parser
from medley.plans import experiments
from medley.plans.run import build_matrix, compose, matrix_plan, run_samples
from medley.sources import tables
from medley.sources import sequences
from medley.sources.fetch import fasta_index, fetched
from medley.sources.sequences import register
from medley.streaming.counts import running_counts, windowed_counts

SMALL = Options(fwd_primer="ACGTAC", rev_primer="GGATCC", primer_mismatches=0, sim_n_per_ref=40, mapper=mapper.MapperOptions(k=9), infer=InferenceOptions(mode="mle", presence=False, steps=800))


def plain_primer(seq, primer, budget, start=0):
    for i in range(start, len(seq) - len(primer) + 1):
        if sum(p in S.IUPAC and c not in S.IUPAC[p] for p, c in zip(primer, seq[i : i + len(primer)])) <= budget:
            return i
    return None


def test_primer_search_in_both_forms(spark):
    r = random.Random(4)
    seqs = ["".join(r.choice("ACGTN") for _ in range(r.randrange(0, 60))) for _ in range(200)] + ["", "ACGT"]
    df = spark.createDataFrame([(s,) for s in seqs], "s string")
    for primer, budget in (("ACNR", 0), ("GTGYCA", 1), ("AXA", 0)):
        want = [plain_primer(s, primer, budget) for s in seqs]
        assert [x if x >= 0 else None for x in S.first_hits(seqs, primer, budget)] == want
        assert [x.p for x in df.select(S.primer_at(F.col("s"), primer, budget).alias("p")).collect()] == want


def test_sequence_n_mismatches_primer_n():
    assert S.first_hits(["ANA", "ACA"], "ANA", 0).tolist() == [-1, 0]


def test_amplicons_and_trimming(spark):
    fwd, rev = "ACGTAC", "GGATCC"
    inner = "TTGACCATTG"
    whole = "CC" + fwd + inner + S.reverse_complement_text(rev) + "AA"
    seqs = [whole, S.reverse_complement_text(whole), fwd + S.reverse_complement_text(rev), "TTTT", None]
    df = spark.createDataFrame([(s,) for s in seqs], "s string")
    out = df.select(S.amplicon(F.col("s"), fwd, rev, 0).alias("a"), S.trimmed_read(F.col("s"), fwd, rev, 0).alias("t")).collect()
    assert [r.a for r in out] == [inner, None, None, None, None]
    assert [r.t for r in out] == [inner, inner, fwd + S.reverse_complement_text(rev), "TTTT", None]


def test_translation_and_confusion_golden(spark):
    refs = spark.createDataFrame([("gA|0|x", "gA"), ("gA|1|y", "gA"), ("gB|0|z", "gB")], "refseq string, genome string")
    t = {(r.genome, r.refseq): r.weight for r in C.translation_table(refs).collect()}
    assert t == {("gA", "gA|0|x"): 0.5, ("gA", "gA|1|y"): 0.5, ("gB", "gB|0|z"): 1.0}
    hits = [("gA|0|x", "gA|0|x")] * 7 + [("gA|0|x", "gA|1|y")] * 3 + [("gA|1|y", "gA|1|y")] * 10 + [("gB|0|z", "gB|0|z")] * 10
    rows = [(f"{s}:{i}", d, 1.0, "0.99") for i, (s, d) in enumerate(hits)] + [("q:1", "gA|0|x", 1.0, "0.99"), ("gA|0|x:9", "other", 1.0, "0.99")]
    hits = spark.createDataFrame(rows, "query string, hit string, score double, identity string")
    m = {(r.src, r.dst): r.p for r in C.row_stochastic(C.confusion_counts(hits, refs), refs).collect()}
    assert m["gA|0|x", "gA|0|x"] == pytest.approx(0.7) and m["gA|0|x", "gA|1|y"] == pytest.approx(0.3) and len(m) == 4
    none = C.row_stochastic(C.confusion_counts(mapper.usable_hits(hits, 1.5), refs), refs).collect()
    assert sorted((r.src, r.dst, r.p) for r in none) == sorted((r, r, 1.0) for r in ("gA|0|x", "gA|1|y", "gB|0|z"))


def test_em_recovers_planted_composition(spark):
    t = np.array([[0.5, 0.5, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1.0]])
    m = np.array([[0.7, 0.2, 0.1, 0], [0.1, 0.7, 0.1, 0.1], [0.1, 0.1, 0.7, 0.1], [0, 0, 0.3, 0.7]])
    theta = np.array([0.2, 0.5, 0.3])
    a = t @ m
    matrix = spark.createDataFrame([(f"g{i}", f"r{j}", float(a[i, j])) for i in range(3) for j in range(4)], "genome string, dst string, a double")
    obs = spark.createDataFrame([(s, f"r{j}", int(round(1e6 * (theta @ a)[j]))) for s in "xy" for j in range(4)], "sample string, refseq string, n long")
    got = {(r.sample, r.genome): r.theta for r in C.em(obs, matrix, 400, ["sample"]).collect()}
    assert all(abs(got[s, f"g{i}"] - theta[i]) < 2e-3 for s in "xy" for i in range(3))
    few, same = ({(r.sample, r.genome): r.theta for r in C.em(obs, matrix, 7, ["sample"], packed=n).collect()} for n in (100, 0))
    assert few.keys() == same.keys() and all(abs(few[k] - same[k]) < 1e-12 for k in few)
    one = {r.genome: r.theta for r in C.em(obs.where("sample = 'x'").drop("sample"), matrix, 7, packed=0).collect()}
    assert all(abs(one[g] - few["x", g]) < 1e-12 for g in one)


def test_bootstrap_replicates(spark):
    obs = spark.createDataFrame([("s", "a", 4), ("s", "b", 900), ("s", "c", 0)], "sample string, refseq string, n long")
    rows = C.replicates(obs, 400, 3, ["sample"]).toPandas()
    stats = rows.groupby("refseq")["n"].agg(["mean", "var"])
    assert abs(stats["mean"]["a"] - 4) < 0.5 and 3 < stats["var"]["a"] < 5.2
    assert abs(stats["mean"]["b"] - 900) < 6 and 700 < stats["var"]["b"] < 1150 and stats["mean"]["c"] == 0


def test_simulation_rates(spark):
    seq = "".join(random.Random(0).choice("ACGT") for _ in range(1000))
    refs = spark.createDataFrame([("a", seq)], "refseq string, sequence string")
    ratio = lambda **o: np.mean([len(r.sequence) for r in sampling.simulated_reads(refs, 40, 1, **o).collect()]) / 1000
    assert 0.97 < ratio(sub=0, ins=0, dele=0.02) < 0.99
    assert 1.01 < ratio(sub=0, ins=0.02, dele=0) < 1.03
    reads = [r.sequence for r in sampling.simulated_reads(refs, 40, 1, sub=0.01, ins=0, dele=0).collect()]
    assert 0.005 < np.mean([sum(a != b for a, b in zip(seq, r)) / 1000 for r in reads]) < 0.02
    assert {r.sequence for r in sampling.simulated_reads(refs, 5, 1, sub=0, ins=0, dele=0).collect()} == {seq}
    odd = spark.createDataFrame([("n", "ACGNT"), ("e", "")], "refseq string, sequence string")
    assert sampling.simulated_reads(odd, 3, 1).count() == 0


def test_reservoir_is_uniform_and_stable(spark):
    rows = spark.range(20).withColumnRenamed("id", "k")
    hits = np.zeros(20)
    for seed in range(8):
        for r in sampling.reservoir(rows, 5, seed, ["k"]).collect():
            hits[r.k] += 1
    assert hits.sum() == 40 and (hits > 0).sum() > 14
    a, b = (sorted(r.k for r in sampling.reservoir(rows.repartition(n), 5, 3, ["k"]).collect()) for n in (1, 7))
    assert a == b and sampling.reservoir(rows, 0, 3, ["k"]).count() == 20
    many = spark.range(30_000).selectExpr("id as k", "if(id % 10 = 0, null, 'x') as g")
    want = {g: sorted((hashlib.md5(f"3|{k}".encode()).hexdigest(), k) for k in range(30_000) if (k % 10 == 0) == (g is None))[:5000] for g in (None, "x")}
    got = sampling.reservoir(many, 5000, 3, ["k"], ["g"]).collect()
    assert {g: {r.k for r in got if r.g == g} for g in want} == {g: {k for _, k in v} for g, v in want.items()}
    assert "SinglePartition" not in sampling.reservoir(many, 5000, 3, ["k"], ["g"])._jdf.queryExecution().toString()
    assert sampling.reservoir(rows.limit(0), 5, 3, ["k"]).count() == 0 == sampling.reservoir(many.limit(0), 5, 3, ["k"], ["g"]).count()


def test_running_index(spark, monkeypatch):
    monkeypatch.setattr(sampling, "RUN", 7)
    rows = spark.createDataFrame([(s, f, i) for s in "ab" for f in (0, 1) for i in range(30) if (i + f) % 3], "sample string, file_no int, ordinal long")
    out = sampling.running_index(rows.repartition(5), "sample", "file_no", "ordinal", "at").collect()
    for s in "ab":
        assert [r["at"] for r in sorted(out, key=lambda r: (r.file_no, r.ordinal)) if r["sample"] == s] == list(range(40))


def block_gzip(data, block):
    """data as gzip members that tell their length, and the empty one that ends such files."""
    out = b""
    for raw in [*(data[i : i + block] for i in range(0, len(data), block)), b""]:
        squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = squeeze.compress(raw) + squeeze.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(raw), len(raw))
    return out


def read_parts(batches, path, split, strict=True, names=None):
    columns, out = ["name", "header", "sequence", "quality", "ordinal"], []
    for at, number, size in [(p, i, n) for i, (p, n) in enumerate(sequences.listed(str(path)))]:
        for part in sequences.parts_of(at, number, size, split):
            for found in batches(part, strict, columns, names):
                out += zip(*(found[c].to_pylist() for c in columns if c in found), strict=True)
    return out


@pytest.mark.parametrize("kind", ["txt", "gz", "block.gz"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_the_same_for_any_split(tmp_path, monkeypatch, kind, end):
    r = random.Random(1)
    pack = {"txt": lambda x: x, "gz": gzip.compress, "block.gz": lambda x: block_gzip(x, r.choice([37, 300]))}[kind]
    sizes = [r.randrange(0, 30) for _ in range(30)]
    reads = [(f"r{i}", "".join(r.choice("acgtn") for _ in range(n)), "".join(r.choice("@+I>5") for _ in range(n))) for i, n in enumerate(sizes)]
    text = "".join(f"@{a} note\n{b}\n+{a if len(b) % 3 else ''}\n{c}\n" for a, b, c in reads)
    fasta = "junk\n" + "".join(f">h{i} x>y\n" + "".join(r.choice("acgt") + "\n" * (r.random() < 0.1) for _ in range(9 * i)) + "\n" for i in range(20))
    for tail in ("\n", "\n\n\n", ""):
        (tmp_path / f"a.{kind}").write_bytes(pack((text.rstrip("\n") + tail).replace("\n", end).encode()))
        (tmp_path / f"f.{kind}").write_bytes(pack((fasta.rstrip("\n") + tail).replace("\n", end).encode()))
        for piece in (90 if kind == "txt" else 2000, 1 << 20):
            monkeypatch.setattr(sequences, "PIECE", piece)
            for name, batches, strict in (("a", sequences.fastq_batches, True), ("f", sequences.fasta_batches, False)):
                path = tmp_path / f"{name}.{kind}"
                whole = read_parts(batches, path, 0, strict)
                if name == "a":
                    assert [x[:3] for x in whole] == [(a, b.upper(), c) for a, b, c in reads]
                else:
                    assert [x[0] for x in whole] == [f"h{i}" for i in range(20)]
                assert [x[-1] for x in whole] == sorted({x[-1] for x in whole})
                for split in (path.stat().st_size // 3, path.stat().st_size // 40 + 1):
                    assert read_parts(batches, path, split, strict) == whole
                assert read_parts(batches, path, 200, strict, {"r3", "h3"}) == [x for x in whole if x[0] in ("r3", "h3")]


def test_broken_records(tmp_path):
    def of(batches, text, strict=True, split=0):
        (tmp_path / "x").write_text(text)
        return [x[:-1] for x in read_parts(batches, tmp_path / "x", split, strict)]

    assert of(sequences.fasta_batches, "junk\n>a b\nac\ngt\n\n>c\nnn", False) == [("a", "ACGT"), ("c", "NN")]
    for bad in ("junk\n>a\nc\n", ">a\n>b\nc\n", ">\n", ""):
        with pytest.raises(ValueError):
            of(sequences.fasta_batches, bad)
    assert of(sequences.fastq_batches, "@r x\nacg\n+\nIII\n") == [("r", "ACG", "III")] and of(sequences.fastq_batches, "") == []
    for bad in ("@r\nacg\nx\nIII\n", "@r\nacg\n+\nII\n", "r\nacg\n+\nIII\n", "@r\nacg\n+\n", "@r\na\n+\nI\n\n@s\na\n+\nI\n"):
        with pytest.raises(ValueError):
            of(sequences.fastq_batches, bad)
    assert of(sequences.fastq_batches, "@r\nacg\nx\nII\n@s\nac", False) == [("r", "ACG", "II"), ("s", "AC", "")]
    with pytest.raises(ValueError):
        of(sequences.fastq_batches, "x\n" * 40, False, 10)


def test_sources_push_columns_and_filters(spark, tmp_path):
    register(spark)
    for f in "ab":
        (tmp_path / f"{f}.fq").write_text("".join(f"@{f}{i}\nAC\n+\nII\n" for i in range(50)))
    rows = spark.read.schema("sequence string, name string").format("fastq").option("splitBytes", "100").load(f"{tmp_path}/*.fq")
    assert rows.columns == ["sequence", "name"] and rows.count() == 100 and rows.rdd.getNumPartitions() > 8
    assert rows.where("name = 'a7'").collect() == [("AC", "a7")] and rows.where("name in ('a7', 'b9') and length(name) = 2").count() == 2
    all_of = spark.read.format("fastq").load(f"{tmp_path}/*.fq")
    one = all_of.where("file_no = 1")
    assert one.count() == 50 and one.rdd.getNumPartitions() == 1 and one.where(f"path = '{tmp_path}/a.fq'").count() == 0


def test_fetch_through_an_index(spark, tmp_path):
    r = random.Random(2)
    seqs = {f"h{i}": "".join(r.choice("ACGT") for _ in range(n)) for i, n in enumerate([0, 1, 59, 60, 61, 600, 1234, 90_000])}
    wrap = lambda s, n: "\n".join(s[i : i + n] for i in range(0, len(s), n))
    (tmp_path / "a.fa").write_text("".join(f">{h} note\n{wrap(s, 60).lower()}\n" for h, s in seqs.items()))
    (tmp_path / "b.fa").write_text(f">odd\r\nAC\r\nACGT\r\nA\r\n>crlf\r\nACGT\r\nTTGG\r\nC\r\n>last\nAC")
    index = fasta_index(spark, f"{tmp_path}/*.fa", splitBytes="500").cache()
    assert {x.header: x.length for x in index.collect()} == {**{h: len(s) for h, s in seqs.items()}, "odd": 7, "crlf": 9, "last": 2}
    assert {x.header: x.line_bases for x in index.where("header in ('odd', 'crlf', 'h5')").collect()} == {"odd": None, "crlf": 4, "h5": 60}
    seqs |= {"odd": "ACACGTA", "crlf": "ACGTTTGGC", "last": "AC"}
    wanted = [(h, None, None) for h in seqs] + [(h, a, a + r.randrange(0, 200)) for h, s in seqs.items() for a in (r.randrange(0, len(s) + 5) for _ in range(6))]
    wanted += [("none", 0, 5), ("h5", -3, 5), ("h5", 9, 4), ("h5", 10, 20), ("h5", 10, 20), (None, 0, 1)]
    got = fetched(index, spark.createDataFrame(wanted, "header string, start long, stop long")).collect()
    cut = lambda h, a, b: seqs[h][max(a or 0, 0) : max(len(seqs[h]) if b is None else b, a or 0)]
    assert sorted(map(str, map(tuple, got))) == sorted(str((h, a, b, cut(h, a, b))) for h, a, b in wanted if h in seqs)
    with gzip.open(tmp_path / "c.fa.gz", "wt") as f:
        f.write(">a\nA\n")
    with pytest.raises(Exception, match="plain text"):
        fasta_index(spark, f"{tmp_path}/c.fa.gz").collect()


def test_sources_and_sinks(spark, tmp_path):
    register(spark)
    (tmp_path / "b.fasta").write_text(">x|0|o note\nacgt\nac\n>y\nGG\n")
    with gzip.open(tmp_path / "a.fasta.gz", "wt") as f:
        f.write(">z\nTT\n")
    got = spark.read.format("fasta").load(f"{tmp_path}/*.fasta*").orderBy("file_no", "ordinal").collect()
    assert [(r.file_no, r.ordinal >> 16, r.header, r.sequence) for r in got] == [(0, 0, "z", "TT"), (1, 0, "x|0|o", "ACGTAC"), (1, 20, "y", "GG")]
    fq = spark.createDataFrame([("r1", "ACG", "III"), ("r2", "TT", "II")], "name string, sequence string, quality string")
    tables.write_fastq(fq.coalesce(1), f"{tmp_path}/fq")
    back = spark.read.format("fastq").option("strict", "true").load(f"{tmp_path}/fq/*.gz").collect()
    assert [(r.name, r.sequence, r.quality) for r in back] == [("r1", "ACG", "III"), ("r2", "TT", "II")]
    for path in (tmp_path / "o.fa", tmp_path / "o.fa.gz"):
        for _ in range(2):  # an old file gives way
            tables.write_fasta(fq.repartition(3), f"{path}", name="name", order=["name"])
        assert (gzip.open if path.suffix == ".gz" else open)(path, "rt").read() == ">r1\nACG\n>r2\nTT\n"
    tables.write_fasta(fq.limit(0), f"{tmp_path}/none.fa", name="name")
    assert (tmp_path / "none.fa").read_text() == "" and not list(tmp_path.glob(".*fa*"))
    (tmp_path / "h.tsv").write_text("#c\nq1\tr1\t10\t0.9\nq2\t\t1\t1\nq3\tr2\t5\t<none\n")
    assert [(r.query, r.identity) for r in tables.read_hits(spark, f"{tmp_path}/h.tsv").orderBy("query").collect()] == [("q1", "0.9"), ("q3", "<none")]
    m = spark.createDataFrame([("a|0|x.y", "a|0|x.y", 0.25), ("a|0|x.y", "b", 0.75), ("b", "b", 1.0)], "src string, dst string, p double")
    tables.write_matrix(m, f"{tmp_path}/m")
    back = {(r.src, r.dst): r.p for r in tables.read_matrix(spark, f"{tmp_path}/m").collect()}
    assert back["a|0|x.y", "b"] == 0.75 and back["b", "a|0|x.y"] == 0.0
    (tmp_path / "s.yml").write_text("samples:\n- {id: s1, reads: r.fastq, references: f.fasta}\n- {id: s2, fastq_1: a.fq, fastq_2: b.fq, references: /f.fasta, platform: illumina}\n")
    rows = tables.read_samples(spark, f"{tmp_path}/s.yml").collect()
    assert [len(r.reads) for r in rows] == [1, 2] and rows[1].references == "/f.fasta"
    (tmp_path / "s.yml").write_text("- {id: s1, references: f}\n")
    with pytest.raises(ValueError):
        tables.read_samples(spark, f"{tmp_path}/s.yml")
    (tmp_path / "t.csv").write_text("model_id,inference,aic\nm1,maximum_likelihood,5\nm2,maximum_likelihood,\nm3,maximum_likelihood,4\nm4,vi,1\nm5,maximum_likelihood,4\n")
    assert C.best_model(tables.read_models(spark, f"{tmp_path}/t.csv")).first().model_id == "m3"


def test_folders_are_moved_in_whole(spark, tmp_path):
    for where, text in (("out", "old"), ("new", "new")):
        for name in ("a", "b"):
            (tmp_path / where / name).mkdir(parents=True)
            (tmp_path / where / name / "x").write_text(text)
    (tmp_path / "out/kept").mkdir()
    tables.moved_in(spark, f"{tmp_path}/new", f"{tmp_path}/out")
    assert [(tmp_path / f"out/{n}/x").read_text() for n in "ab"] == ["new", "new"] and sorted(f.name for f in (tmp_path / "out").iterdir()) == ["a", "b", "kept"]
    assert not (tmp_path / "new").exists()


def test_genome_database(spark):
    genomes = spark.createDataFrame([(0, "A", "Bacteria; Genus", "a.fa"), (1, "B", "Bacteria;Genus;Species", "b.fa")], tables.GENOMES)
    records = spark.createDataFrame([("A", 0, "x", "AC"), ("A", 1, "y", "GT"), ("B", 0, "x", "TT")], "id string, ordinal long, header string, sequence string")
    out, header = genome_database(genomes, records)
    got = {r.refseq: r.lineage for r in out.collect()}
    assert got == {"A|0|x": "Bacteria;Genus;unclassified;A", "A|1|y": "Bacteria;Genus;unclassified;A", "B|0|x": "Bacteria;Genus;Species;B"}
    assert header.splitlines()[-1] == "#levels: Taxonomy_1 Taxonomy_2 Taxonomy_3 Subspecies"
    with pytest.raises(validation.Violation):
        genome_database(genomes.withColumn("taxonomy", F.lit("a;;b")), records)


def test_genome_list_and_database_files(spark, tmp_path, monkeypatch):
    (tmp_path / "a.fa").write_text(">x\nAC\n>y\nGT\n")
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(">x\nTT\n")
    (tmp_path / "g.yml").write_text("genomes:\n- {id: B, taxonomy: Bacteria;Genus, fasta: a.fa}\n- {id: A, taxonomy: Bacteria; Genus ;Species, fasta: b.fa.gz}\n".replace("Bacteria; Genus ;Species", '"Bacteria; Genus ;Species"'))
    main(["database", "--genomes", f"{tmp_path}/g.yml", "--prefix", f"{tmp_path}/db/set"], spark)
    assert (tmp_path / "db/set.fasta").read_text() == ">B|0|x\nAC\n>B|1|y\nGT\n>A|0|x\nTT\n"
    assert (tmp_path / "db/set.tax").read_text().splitlines()[2:] == ["#levels: Taxonomy_1 Taxonomy_2 Taxonomy_3 Subspecies", "B|0|x\tBacteria;Genus;unclassified;B", "B|1|y\tBacteria;Genus;unclassified;B", "A|0|x\tBacteria;Genus;Species;A"]
    monkeypatch.setattr(tables, "write_taxonomy", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        main(["database", "--genomes", f"{tmp_path}/g.yml", "--prefix", f"{tmp_path}/db/other"], spark)
    assert sorted(f.name for f in (tmp_path / "db").iterdir()) == ["set.fasta", "set.tax"]
    monkeypatch.undo()
    # the second move fails: both old files are back
    old = [(tmp_path / f"db/set.{x}").read_text() for x in ("fasta", "tax")]
    rows = spark.createDataFrame([("a", "AC", "x;y")], "refseq string, sequence string, lineage string")
    monkeypatch.setattr(tables, "write_taxonomy", lambda *a, **k: None)
    with pytest.raises(FileNotFoundError):
        tables.write_database(rows, "#h", f"{tmp_path}/db/set")
    assert [(tmp_path / f"db/set.{x}").read_text() for x in ("fasta", "tax")] == old and len(list((tmp_path / "db").iterdir())) == 2
    for bad in ("genomes: []", "- x", "genomes:\n- 3"):
        (tmp_path / "g.yml").write_text(bad)
        with pytest.raises(ValueError):
            tables.read_genomes(spark, f"{tmp_path}/g.yml")


def test_matrix_rules(spark):
    refs = spark.createDataFrame([("a",), ("b",)], "refseq string")
    rules = lambda rows: sorted((r.id, r.rule) for r in validation.matrix_violations(spark.createDataFrame(rows, "src string, dst string, p double"), refs).collect())
    assert rules([("a", "a", 1.0), ("b", "b", 1.0)]) == []
    assert rules([("a", "b", 1.0), ("b", "b", 1.0)]) == []  # a is never hit
    assert ("a", "row does not sum to one") in rules([("a", "a", 0.9), ("b", "b", 1.0)])
    assert ("c", "column is unknown") in rules([("a", "a", 0.5), ("a", "c", 0.5), ("b", "b", 1.0)])
    assert ("b", "entry is no probability") in rules([("a", "a", 1.0), ("b", "b", 2.0), ("b", "a", -1.0)])


def test_a_matrix_makes_the_round_trip(spark, tmp_path):
    refs = spark.createDataFrame([("a",), ("b",), ("c",)], "refseq string")
    m = spark.createDataFrame([("a", "b", 1.0), ("b", "b", 1.0), ("c", "a", 1.0)], "src string, dst string, p double")
    tables.write_matrix(m, f"{tmp_path}/m", refs.toDF("dst"))
    back = tables.read_matrix(spark, f"{tmp_path}/m")
    assert validation.matrix_violations(back, refs).isEmpty()
    assert {(r.src, r.dst) for r in back.where("p > 0").collect()} == {("a", "b"), ("b", "b"), ("c", "a")} and back.count() == 9


def fixture(spark, tmp_path, n=400, name="reads", seed=42, present=("g1", "g2")):
    """Two genomes of two copies, 0.7 and 0.3, reads with one percent of errors, primers included; a third one is absent."""
    r = random.Random(42)
    base = "".join(r.choice("ACGT") for _ in range(230))
    rc = S.reverse_complement_text(SMALL.rev_primer)

    def changed(s, n):
        s = list(s)
        for i in r.sample(range(len(s)), n):
            s[i] = r.choice([b for b in "ACGT" if b != s[i]])
        return "".join(s)

    refs = {f"{g}|{c}|x": changed(base, 6) for g in ("g1", "g2", "g3") for c in (0, 1)}
    (tmp_path / "refs.fasta").write_text("".join(f">{k}\n{SMALL.fwd_primer}{v}{rc}\n" for k, v in refs.items()))
    r = random.Random(seed)
    with gzip.open(tmp_path / f"{name}.fastq.gz", "wt") as f:
        for i in range(n):
            ref = refs[f"{present[0] if r.random() < 0.7 else present[1]}|{r.randrange(2)}|x"]
            seq = SMALL.fwd_primer + "".join(r.choice("ACGT") if r.random() < 0.01 else b for b in ref) + rc
            f.write(f"@read{i}\n{seq}\n+\n{'I' * len(seq)}\n")
    return refs


def table(spark, path):
    return spark.read.csv(str(path), header=True, inferSchema=True)


def test_planted_composition_with_the_gate(spark, tmp_path):
    """1,500 reads, the default variational fit with the gate."""
    fixture(spark, tmp_path, 1500)
    o = replace(SMALL, sim_n_per_ref=100, infer=InferenceOptions(steps=1500, num_samples=200))
    samples = spark.createDataFrame([("s1", [f"{tmp_path}/reads.fastq.gz"], "illumina", f"{tmp_path}/refs.fasta", None)], tables.SAMPLES)
    run_samples(spark, samples, f"{tmp_path}/out", o)
    got = {r.genome_id: r for r in table(spark, tmp_path / "out/samples/inferred_composition").collect()}
    truth = {"g1": 0.7, "g2": 0.3, "g3": 0.0}
    assert sum(abs(got[g].inferred_mean - t) for g, t in truth.items()) < 0.08
    assert {g for g in got if got[g].presence_prob >= 0.5} == {"g1", "g2"}
    assert all(got[g].inferred_lo <= got[g].inferred_mean <= got[g].inferred_hi for g in ("g1", "g2"))
    facts = table(spark, tmp_path / "out/samples/inference_diagnostics").first()
    assert facts.n_reads == 1500 and facts.mean_diagonal > 0.9 and "n_present" in facts.extra
    assert table(spark, tmp_path / "out/samples/loss_trace").count() == 1500


def test_samples_of_equal_references_share_a_matrix(spark, tmp_path):
    fixture(spark, tmp_path)
    fixture(spark, tmp_path, name="more", seed=7, present=("g2", "g3"))
    (tmp_path / "copy.fasta").write_text((tmp_path / "refs.fasta").read_text())
    (tmp_path / "other.fasta").write_text("".join((tmp_path / "refs.fasta").read_text().splitlines(True)[:8]))
    rows = [("s2", "more", "copy"), ("s1", "reads", "refs"), ("s3", "reads", "other")]
    (tmp_path / "s.yml").write_text("".join(f"- {{id: {i}, reads: {r}.fastq.gz, references: {f}.fasta, platform: illumina}}\n" for i, r, f in rows))
    args = ["run", "--input", f"{tmp_path}/s.yml", "--outdir", f"{tmp_path}/out", "--mode", "mle", "--no-presence", "--steps", "600", "--sim-n-per-ref", "30", "--fwd-primer", SMALL.fwd_primer, "--rev-primer", SMALL.rev_primer, "--primer-mismatches", "0"]
    main(args, spark)
    groups = spark.read.csv(f"{tmp_path}/out/mismapping/groups.tsv", sep="\t", header=True).collect()
    assert sorted(g.samples for g in groups) == ["s1,s2", "s3"] and {g.source for g in groups} == {"generated"}
    got = {(r.sample, r.genome_id): r.inferred_mean for r in table(spark, tmp_path / "out/samples/inferred_composition").collect()}
    assert abs(got["s1", "g1"] - 0.7) < 0.08 and abs(got["s2", "g2"] - 0.7) < 0.08 and got["s2", "g1"] < 0.05 and abs(got["s3", "g1"] - 0.7) < 0.08
    for g in groups:
        bundle = tmp_path / "out/mismapping" / g.matrix_key
        paper = json.loads((bundle / "provenance.json").read_text())
        assert paper["matrix_key"] == g.matrix_key and [m["id"] for m in paper["members"]] == g.samples.split(",") and paper["settings"]["sim_n_per_ref"] == "30"
        assert sorted(r.sample_id for r in spark.read.csv(f"{bundle}/samples.tsv", sep="\t", header=True).collect()) == g.samples.split(",")
        refs = tables.read_index(spark, f"{bundle}/reference").where("amplifiable")
        assert validation.matrix_violations(tables.read_matrix(spark, f"{bundle}/mismapping_matrix.csv"), refs).isEmpty()
        assert spark.read.format("fasta").load(f"{bundle}/reference/amplicons.fasta").count() == refs.count()
    shared = next(g for g in groups if g.samples == "s1,s2")
    # a matrix that the engine wrote can be given back to it
    (tmp_path / "s.yml").write_text("- {id: s1, reads: reads.fastq.gz, references: refs.fasta}\n")
    again = [*args, "--mismapping-matrix", f"{tmp_path}/out/mismapping/{shared.matrix_key}/mismapping_matrix.csv"]
    again[4] = f"{tmp_path}/again"
    main(again, spark)
    assert spark.read.csv(f"{tmp_path}/again/mismapping/groups.tsv", sep="\t", header=True).first().source == "supplied"
    same = {r.genome_id: r.inferred_mean for r in table(spark, tmp_path / "again/samples/inferred_composition").collect()}
    assert all(abs(same[g] - got["s1", g]) < 1e-6 for g in same)


def test_hit_tables_to_a_composition(spark, tmp_path):
    fixture(spark, tmp_path)
    main(["matrix", "--references", f"{tmp_path}/refs.fasta", "--outdir", f"{tmp_path}/m", "--sim-n-per-ref", "5", "--fwd-primer", SMALL.fwd_primer, "--rev-primer", SMALL.rev_primer], spark)
    refs = [f"g{g}|{c}|x" for g in (1, 2, 3) for c in (0, 1)]
    (tmp_path / "sim.tsv").write_text("#c\n" + "".join(f"{r}:{i}\t{r if i < 8 else refs[0]}\t9\t0.99\n" for r in refs for i in range(10)) + "zz:1\tg1|0|x\t9\t0.99\n")
    (tmp_path / "obs.tsv").write_text("".join(f"q{i}\t{refs[2 if i % 10 < 6 else 0]}\t9\t0.99\n" for i in range(500)) + "q\tg3|0|x\t1\t<bad\n")
    fit = ["--reference-dir", f"{tmp_path}/m/reference", "--mode", "mle", "--no-presence", "--steps", "500", "--min-identity", "0.5"]
    main(["hits", "--simulated", f"{tmp_path}/sim.tsv", "--observed", f"{tmp_path}/obs.tsv", "--outdir", f"{tmp_path}/o", "--sample-id", "s", *fit], spark)
    got = {r.genome_id: r for r in table(spark, tmp_path / "o/inferred_composition").collect()}
    assert got["g2"].inferred_mean > got["g2"].observed_rel_abundance == 0.6 and got["g1"]["sample"] == "s"
    main(["hits", "--simulated", f"{tmp_path}/sim.tsv", "--build-mismapping", "--outdir", f"{tmp_path}/b", *fit], spark)
    m = {(r.src, r.dst): r.p for r in tables.read_matrix(spark, f"{tmp_path}/b/mismapping_matrix.csv").collect()}
    assert m["g2|0|x", "g1|0|x"] == 0.2 and not (tmp_path / "b/inferred_composition").exists()


def test_command_line_rules():
    base = ["hits", "--reference-dir", "r", "--outdir", "o"]
    for bad in (
        [], ["run"], [*base, "--observed", "x"], [*base, "--simulated", "a", "--mismapping-matrix", "b", "--observed", "x"], [*base, "--simulated", "a"],
        [*base, "--mismapping-matrix", "b", "--build-mismapping"], ["run", "--input", "a", "--outdir", "o", "--flat-sub-rate", "1.5"],
        ["run", "--input", "a", "--outdir", "o", "--mode", "nuts"], ["run", "--input", "a", "--outdir", "o", "--sim-n-per-ref", "0"], ["matrix", "--references", "a", "--outdir", "o", "--min-identity", "2"],
    ):
        with pytest.raises(SystemExit):
            main(bad, spark=object())
    assert options(parser().parse_args(["run", "--input", "a", "--outdir", "o"])) == Options()


def test_experiment_grids(spark):
    r = random.Random(1)
    base = [r.choice("ACGT") for _ in range(60)]
    refs = []
    for g in range(4):
        seq = list(base)
        for i in r.sample(range(60), 1):
            seq[i] = "ACGT"["ACGT".index(seq[i]) - 1]
        refs.append((f"g{g}|0|x", f"g{g}", "".join(seq)))
    refs = spark.createDataFrame(refs, "refseq string, genome string, sequence string")
    o = replace(SMALL, sim_n_per_ref=20, infer=InferenceOptions(mode="vi", steps=400, num_samples=50))
    truth = sampling.random_truth(refs.select("genome"), ("g0", "g1"), 3, 0.1, 5)
    rows = experiments.presence_sweep(refs, truth.withColumn("sample", F.lit("0")), ("g0", "g1"), o, priors=(0.1,), temperatures=(1.0,), cutoffs=(0.01,), n_reads=300)
    assert rows.count() == 3 and set(rows.columns) >= {"method", "prior", "temp", "replicate", "jaccard", "l1", "pair_low"}
    summary, best = experiments.sweep_result(rows)
    assert summary.count() == 3 and best.count() == 1 and best.first().l1 < 0.25
    rates = experiments.error_rate_sensitivity(refs, truth, o, generators=(0.01,), candidates=(), n_reads=300).collect()
    got = {x.candidate: x for x in rates}
    assert set(got) == {None, "reseeded"} and 0 < got["reseeded"].m_dist < 1 and got["reseeded"].l1 < 0.4 and got[None].l1 > 0


def test_grids_as_one_relation(spark):
    """Each cell of a grid is what it is alone: the matrix of its rate, and the presence under its prior."""
    r = random.Random(1)
    base = [r.choice("ACGT") for _ in range(60)]
    refs = []
    for g in range(4):
        seq = list(base)
        for i in r.sample(range(60), 1 + g % 2):
            seq[i] = "ACGT"["ACGT".index(seq[i]) - 1]
        refs.append((f"g{g}|0|x", f"g{g}", "".join(seq)))
    refs = spark.createDataFrame(refs, "refseq string, genome string, sequence string")
    o, fit = replace(SMALL, sim_n_per_ref=15), MapOptions(iterations=40, s_grid=(1.0,), kappa_grid=(3.0,))
    both = {(x.cell, x.src, x.dst): x.p for x in experiments.cell_matrices(refs, [("low", 0.005, 42), ("high", 0.08, 42)], o).collect()}
    alone, _ = build_matrix(refs, replace(o, flat_sub_rate=0.08))
    sums = {}
    for (cell, src, _), p in both.items():
        sums[cell, src] = sums.get((cell, src), 0) + p
    assert len(sums) == 8 and all(abs(x - 1) < 1e-9 for x in sums.values())
    # ties are split by the read's name, so entries agree but for those
    assert sum(abs(both.get(("high", x.src, x.dst), 0.0) - x.p) for x in alone.collect()) < 0.8
    truth = sampling.random_truth(refs.select("genome"), ("g0", "g1"), 3, 0.1, 5)
    rows = {(x.generator, x.candidate): x for x in experiments.error_rate_grid(refs, truth, o, generators=(0.005, 0.02), candidates=(0.15,), n_reads=300, fit=fit).collect()}
    assert set(rows) == {(g, c) for g in ("0.005", "0.02") for c in (None, "reseeded", "0.15")}
    assert all(x.l1 < 0.6 for x in rows.values()) and rows["0.005", "0.15"].m_dist > 0 and 0 < rows["0.02", "reseeded"].mean_diag <= 1
    scores = experiments.presence_grid(refs, truth.withColumn("sample", F.lit("0")), ("g0", "g1"), o, priors=(0.5, 0.01), temperatures=(1.0, 2.0), n_reads=300, fit=fit)
    got = {(x.prior, x.temp): x for x in scores.collect()}
    assert len(got) == 4 and all(0 <= x.jaccard <= 1 and x.replicate == "0" for x in got.values()) and got[0.5, 1.0].n_pred >= got[0.01, 1.0].n_pred


def test_mapper_scores_every_reference_that_can_win(spark):
    r = random.Random(8)
    base = [r.choice("ACGT") for _ in range(90)]
    seqs = []
    for _ in range(30):
        s = list(base)
        for i in r.sample(range(90), r.randrange(0, 4)):
            s[i] = r.choice("ACGT")
        seqs.append("".join(s))
    refs = [(f"r{i:02d}", s) for i, s in enumerate([*seqs, *seqs[:5], "ACG"])]
    reads = []
    for i in range(120):
        s = list(r.choice(seqs))
        for j in r.sample(range(len(s)), r.randrange(0, 9)):
            s[j] = r.choice(["", "A", "C", "GT"])
        reads.append((f"q{i}", "".join(s)[r.randrange(3) :]))
    reads += [("same1", seqs[0]), ("same2", seqs[0]), ("short", "ACG"), ("none", "T" * 40)]

    def grams(s, k=7):
        return {s[i : i + k] for i in range(len(s) - k + 1)} if len(s) >= k else {s}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    df = lambda rows, names: spark.createDataFrame(rows, names)
    got = {x.query: x for x in mapper.map_reads(df(reads, "query string, sequence string"), df(refs, "refseq string, sequence string"), mapper.MapperOptions(k=7)).collect()}
    for q, s in reads:
        scored = [(1 - edits(s, t) / max(len(s), len(t)), n) for n, t in refs if grams(s) & grams(t)]
        if not scored:
            assert q not in got
            continue
        best = max(scored)[0]
        tied = [n for v, n in scored if v == best]
        assert got[q].identity == pytest.approx(best) and got[q].hit == min(tied, key=lambda n: hashlib.md5(f"{q}|{n}".encode()).hexdigest())


def test_candidates_do_not_grow_with_near_identical_references(spark):
    """References that differ in one base each: what lies between the joins, and the edit distances, stay few per read."""
    r = random.Random(4)
    base = "".join(r.choice("ACGT") for _ in range(400))
    changed = lambda s, i, b: s[:i] + b + s[i + 1 :]
    every = [changed(base, i, b) for i in range(400) for b in "ACGT" if b != base[i]]
    r.shuffle(every)
    o = mapper.MapperOptions(k=11)
    for n in (150, 1200):
        refs = spark.createDataFrame([(f"r{i:04d}", s) for i, s in enumerate(every[:n])], "refseq string, sequence string")
        index = mapper.cluster_references(refs, o)
        assert index.clusters.where("rep <> center").count() > n / 2
        reads = []
        for i in range(60):
            s = every[i]
            for j in r.sample(range(400), i % 4):
                s = changed(s, j, r.choice("ACGT"))
            reads.append((f"q{i}", s))
        reads = spark.createDataFrame(reads, "query string, sequence string")
        distinct = reads.selectExpr("hash(sequence) as r1", "length(query) as r2", "sequence").distinct()
        classes = mapper.read_classes(distinct, index, o).cache()
        counts = sorted(x["count"] for x in mapper.candidates(classes, mapper.seeded(distinct, classes, index, o), index).groupBy("r1", "r2").count().collect())
        # but for reads in which errors hide the k-mers that decide, a few references are candidates, however many there are
        assert counts[50] <= 6
        # a read is as near to its hit as to what it was made of
        assert all(x.identity >= 1 - int(x.query[1:]) % 4 / 400 - 1e-9 for x in mapper.map_reads(reads, index, o).collect())


def test_supplied_matrix_is_checked(spark, tmp_path):
    fixture(spark, tmp_path)
    register(spark)
    refs = spark.read.format("fasta").load(f"{tmp_path}/refs.fasta")
    reads = spark.read.format("fastq").load(f"{tmp_path}/reads.fastq.gz").withColumn("sample", F.lit("s"))
    bad = spark.createDataFrame([("g1|0|x", "g1|0|x", 1.0)], "src string, dst string, p double")
    with pytest.raises(validation.Violation):
        compose(reads, refs, SMALL, bad)


def test_matrix_is_shared_by_equal_references(spark):
    amps = spark.createDataFrame([(f, i, f"r{i}", s) for f, seqs in (("x", ("AC", "GT")), ("y", ("AC", "GT")), ("z", ("AA",))) for i, s in enumerate(seqs)], "references string, ordinal int, refseq string, sequence string")
    samples = spark.createDataFrame([("s2", ["a"], "illumina", "x", None), ("s1", ["a"], "illumina", "y", None), ("s3", ["a"], "illumina", "z", None)], tables.SAMPLES)
    groups = {r.representative: [m.id for m in r.members] for r in matrix_plan(samples, amps, Options()).collect()}
    assert groups == {"s1": ["s1", "s2"], "s3": ["s3"]}
    facts = provenance.provenance(matrix_plan(samples, amps, Options()), Options().matrix_settings()).collect()
    assert sorted(len(json.loads(r.provenance)["members"]) for r in facts) == [1, 2]
    per = matrix_plan(samples, amps, Options(sim_error_model="trained"))
    assert per.count() == 3
    with pytest.raises(validation.Violation):
        matrix_plan(samples.unionByName(samples), amps, Options())


def test_digest_trees_gather_runs_only(spark):
    """Groups of any size: the digest follows from the records in order, not from how they are dealt or numbered."""
    rows = [(g, 1000 * i, f"n{i}", "ACGT" * i) for g, n in (("a", 1), ("b", 7), ("c", 8), ("d", 50), ("e", 400)) for i in range(n)]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def root(hashes, size):
        level = [sha("\n".join(hashes[i : i + size])) for i in range(0, len(hashes), size)]
        while len(level) > 1:
            level = [level[i] if len(level[i : i + size]) == 1 else sha("\n".join(level[i : i + size])) for i in range(0, len(level), size)]
        return level[0]

    df = spark.createDataFrame(rows, "g string, o long, name string, seq string")
    want = {g: root([sha(f"{n}\n{s}") for h, _, n, s in rows if h == g], 7) for g in "abcde"}
    for frame, o, span in ((df, 1, 5000), (df.repartition(9), 1, 1 << 40), (df.withColumn("o", F.col("o") * 3 + 1), 3, 700)):
        assert {r.g: r.reference_sha256 for r in provenance.content_hash(frame, ["g"], "o", "name", "seq", gathered=7, span=span).collect()} == want
    assert provenance.content_hash(df.limit(0), ["g"], "o", "name").count() == 0


def test_draws_from_any_number_of_classes(spark):
    r = random.Random(3)
    weights = [0.0 if i % 7 == 0 else 1e-9 if i % 5 else r.random() * (1000 if i == 11 else 1) for i in range(3000)]
    items = sorted(f"c{i}" for i in range(3000))
    classes = spark.createDataFrame(list(zip(items, weights)), "item string, p double").repartition(8)
    sums, total = np.cumsum(weights), sum(weights)
    draws = spark.range(4000).withColumn("u", (F.col("id") * 0.61803398875) % 1).withColumn("item", F.lit("x"))
    got = sampling.categorical(draws, classes).collect()
    assert len(got) == 4000 and set(got[0].asDict()) == {"id", "u", "item"}
    for x in got:
        i = items.index(x.item)
        assert sums[i] - weights[i] - 1e-9 <= x.u * total < sums[i] + 1e-9
    assert {x.item for x in sampling.categorical(draws.limit(3), classes.limit(0)).collect()} == {None}
    assert {x.item for x in sampling.categorical(draws.limit(3), classes.where("item = 'c1'")).collect()} == {"c1"}


def test_streaming_counts(spark, tmp_path):
    refs = spark.createDataFrame([("r1",), ("r2",)], "refseq string")
    spark.createDataFrame([("s", "r1"), ("s", "r1"), ("s", "zz"), ("t", "r2")], "sample string, hit string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("sample string, hit string").parquet(f"{tmp_path}/in")
    q = running_counts(stream, refs).writeStream.outputMode("complete").format("memory").queryName("running").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    timed = spark.createDataFrame([("r1", "2024-01-01 00:00:10"), ("r1", "2024-01-01 00:00:50"), ("r1", "2024-01-01 00:01:10"), ("zz", "2024-01-01 00:01:10")], "hit string, at string")
    timed.selectExpr("hit", "cast(at as timestamp) as at").write.parquet(f"{tmp_path}/timed")
    timed = spark.readStream.schema("hit string, at timestamp").parquet(f"{tmp_path}/timed")
    q = windowed_counts(timed, refs, "at", "1 minute", "10 seconds").writeStream.outputMode("complete").format("memory").queryName("windowed").option("checkpointLocation", f"{tmp_path}/w").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.window.start.minute, r.n) for r in spark.table("windowed").collect()) == [(0, 2), (1, 1)]
    assert sorted((r.sample, r.hit, r.n) for r in spark.table("running").collect()) == [("s", "r1", 2), ("t", "r2", 1)]
