"""Error models: alignment, counts, choice by AIC, simulation and runs under each scope."""

import gzip
import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from medley.operators import error_model as E
from medley.plans.run import run_samples
from medley.sources import tables

from .test_engine import SMALL, fixture, table


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_scripts_are_shortest_and_whole():
    r = random.Random(3)
    for _ in range(400):
        ref = "".join(r.choice("ACGT"[: r.choice([2, 4])]) for _ in range(r.randrange(1, 40)))
        read = "".join(r.choice(["", x, x, x, x, x, r.choice("ACGT"), x + r.choice("ACGT")]) for x in ref) if r.random() < 0.8 else "".join(r.choice("ACGT") for _ in range(r.randrange(1, 60)))
        if not read:
            continue
        script = E.edit_script(read, ref)
        assert [i for i, _, _ in script] == list(range(len(ref)))
        kept = [at for _, at, _ in script if at >= 0]
        cost = sum(at < 0 or read[at] != ref[i] for i, at, _ in script) + len(read) - len(kept)
        lead = kept[0] if kept else len(read)
        assert kept == sorted(set(kept)) and cost == edits(read, ref)
        assert sum(n for _, _, n in script) in (len(read) - len(kept) - lead, len(read) - len(kept))
    assert len(E.edit_script("ACGT" * 2000, "ACGT" * 1500 + "TTTT" + "ACGT" * 480)) == 7924


def test_a_gap_costs_what_is_asked():
    r = random.Random(4)

    def cheapest(a, b, gap):
        row = [j * gap for j in range(len(b) + 1)]
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i * gap
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + gap, row[j - 1] + gap, last + (x != y))
        return row[-1]

    for n in range(600):
        ref = "".join(r.choice("ACGT"[: r.choice([2, 4])]) for _ in range(r.randrange(1, 60)))
        read = "".join(r.choice(["", x, x, x, x, r.choice("ACGT"), x + r.choice("ACGT")]) for x in ref) if n % 2 else "".join(r.choice("ACGT") for _ in ref)
        gap = r.choice([1, 2, 3, 7, E.UNGAPPED])
        script = E.edit_script(read, ref, gap)
        kept = [at for _, at, _ in script if at >= 0]
        assert kept == sorted(set(kept)) and [i for i, _, _ in script] == list(range(len(ref)))
        assert sum(gap if at < 0 else read[at] != ref[i] for i, at, _ in script) + gap * (len(read) - len(kept)) == cheapest(read, ref, gap)
        if gap == E.UNGAPPED and len(read) == len(ref):
            assert script == [(i, i, 0) for i in range(len(ref))]
    shifted = ("CACACACA", "ACACACAC")
    assert len(set(E.outcomes(*shifted, 0))) > 2 and set(E.outcomes(*shifted, 0, E.UNGAPPED)) == {("", "A", "C"), ("", "C", "A")}


def counted(pairs, k):
    """Counts by the edit scripts themselves, without Spark."""
    return Counter(x for read, ref in pairs if read and ref for x in E.outcomes(read, ref, k))


def test_counts_and_tables(spark):
    pairs = [("ACGT", "ACGT"), ("AGT", "ACGT"), ("ACCGT", "ACGT"), ("ATGT", "ACGT"), ("ANGT", "ACGT"), ("", "ACGT"), (None, "A"), ("A", None), ("A", ""), ("ACGT", "ACGT"), ("TTTTACGTACGT", "ACGTACGT")]
    df = spark.createDataFrame(pairs, "read string, reference string").withColumn("base", F.lit(1)).withColumn("n", F.lit(2))
    got = {(x.context, x.base, x.outcome): x.n for x in E.context_counts(df, 2).collect()}
    assert got == counted(pairs, 2) and got["A", "C", "-"] == 1 and got["A", "C", "T"] == 1
    model = {(x.context, x.base, x.outcome): x for x in E.model_table(E.context_counts(df, 2), 0).collect()}
    n = Counter()
    for (_, b, o), c in counted(pairs, 2).items():
        n["", b, o] += c
    assert {k: x.n for k, x in model.items()} == n
    c = sum(n["", "C", o] for o in "ACGT-")
    assert model["", "C", "-"].p == pytest.approx(n["", "C", "-"] / c) and model["", "A", "+C"].p == pytest.approx(1 / (1 + sum(n["", "A", o] for o in "ACGT")))
    none = E.context_counts(df.limit(0), 2)
    assert none.count() == 0
    refs = spark.createDataFrame([("a", "ACGTACGT"), ("n", "ACN"), ("e", "")], "refseq string, sequence string")
    assert {x.sequence for x in E.model_reads(refs, E.model_table(none, 1), 3, 1).collect()} == {"ACGTACGT"}


def rates(reads, k=1):
    found = counted(reads, k)
    return lambda c, b, o: found[c, b, o] / max(1, sum(found[c, b, x] for x in "ACGT-"))


def test_a_context_is_found_and_simulated(spark):
    """Reads in which C after A is lost or doubled more often: the model with context is chosen and gives such reads."""
    r = random.Random(5)
    refs = ["".join(r.choice("ACGT") for _ in range(150)) for _ in range(40)]

    def read(ref):
        out = ""
        for i, b in enumerate(ref):
            u, after = r.random(), i > 0 and ref[i - 1] == "A" and b == "C"
            out += "" if after and u < 0.1 else r.choice("ACGT") if u > 0.99 else b + "G" if after and u > 0.9 else b
        return out

    pairs = spark.createDataFrame([(read(s), s) for s in refs for _ in range(10)], "read string, reference string")
    model = E.trained_model(pairs).cache()
    assert {len(x.context) for x in model.collect()} == {0, 1}  # one base of context, none at the start
    source = spark.createDataFrame([(f"r{i}", s) for i, s in enumerate(refs)], "refseq string, sequence string")
    made = E.model_reads(source, model, 10, 7).collect()
    assert len(made) == 400 and made[0].name.rpartition(":")[0] == made[0].refseq
    want, got = rates([(x.read, x.reference) for x in pairs.collect()]), rates([(x.sequence, refs[int(x.refseq[1:])]) for x in made])
    for key in (("A", "C", "-"), ("A", "C", "C"), ("G", "C", "C"), ("A", "C", "+G")):
        assert got(*key) == pytest.approx(want(*key), abs=0.025)
    assert E.model_reads(source.repartition(7), model, 10, 7).collect() != [] and sorted(x.sequence for x in E.model_reads(source.repartition(7), model, 10, 7).collect()) == sorted(x.sequence for x in made)


def test_qualities(spark, tmp_path):
    r = random.Random(6)
    refs = ["".join(r.choice("ACGT") for _ in range(60)) for _ in range(20)]
    rows = []
    for s in refs * 20:
        read = "".join(r.choice("ACGT") if r.random() < 0.05 else b for b in s)
        rows.append((read, s, "".join(("#" if a != b else "I" if i < 30 else "5") for i, (a, b) in enumerate(zip(read, s)))))
    pairs = spark.createDataFrame(rows, "read string, reference string, quality string")
    counts = E.quality_counts(pairs).cache()
    got = {(x.kind, x.bin, x.quality): x.n for x in counts.collect()}
    assert {(k, q) for k, b, q in got} == {("match", "I"), ("match", "5"), ("substitution", "#")} and sum(got.values()) == 60 * 400
    source = spark.createDataFrame([(f"r{i}", s) for i, s in enumerate(refs)], "refseq string, sequence string")
    made = E.model_reads(source, E.trained_model(pairs), 5, 2, qualities=counts)
    tables.write_fastq(made.select("name", "sequence", "quality"), f"{tmp_path}/fq")
    for x in made.collect():
        assert len(x.quality) == len(x.sequence)
        if len(x.sequence) == 60:
            assert [q == "#" for q in x.quality] == [a != b for a, b in zip(x.sequence, refs[int(x.refseq[1:])])] and x.quality[:30].strip("#I") == "" == x.quality[30:].strip("#5")
    # read bases without counts
    assert {q for x in E.model_reads(source, E.trained_model(pairs), 1, 2, qualities=counts.limit(0)).collect() for q in x.quality} == {"I"}


def test_runs_under_each_scope(spark, tmp_path):
    """Samples with their own, a pooled and a supplied model; the matrix of each is bundled with its model."""
    fixture(spark, tmp_path, n=150)
    o = replace(SMALL, sim_error_model="trained", sim_n_per_ref=10, infer=replace(SMALL.infer, steps=100))
    model = E.model_table(E.context_counts(spark.createDataFrame([("ACGT", "ACGT")] * 3, "read string, reference string")), 1)
    E.write_model(model, f"{tmp_path}/own.csv")
    sheet = lambda *ids: "".join(f"- {{id: {i}, reads: reads.fastq.gz, references: refs.fasta, platform: illumina{f', error_model: {tmp_path}/own.csv' if i == 'c' else ''}}}\n" for i in ids)
    for scope, ids, groups in (("per-sample", "a", [["a"]]), ("pooled", "abc", [["a", "b"], ["c"]])):
        out = f"{tmp_path}/{scope}"
        (tmp_path / "s.yml").write_text(sheet(*ids))
        run_samples(spark, tables.read_samples(spark, f"{tmp_path}/s.yml"), out, replace(o, error_model_scope=scope))
        rows = spark.read.csv(f"{out}/mismapping/groups.tsv", sep="\t", header=True).collect()
        assert sorted(x.samples.split(",") for x in rows) == groups and {x.model_scope for x in rows} == ({scope, "supplied"} if "c" in ids else {scope})
        for x in rows:
            used = E.read_model(spark, f"{out}/mismapping/{x.matrix_key}/error_model.csv").collect()
            assert used and (sum(m.n for m in used) == 12) == (x.samples == "c")
        got = {(x.sample, x.genome_id): x.inferred_mean for x in table(spark, f"{out}/samples/inferred_composition").collect()}
        assert all(abs(got[s, "g1"] - 0.7) < 0.15 for s in ids)
