"""Error models learned from mapped reads: what becomes of a base, given the bases before it; and reads simulated by them.

Reads are aligned with what they were mapped to (edit scripts by a banded alignment with traceback). What a gap costs is a
parameter: 1 gives shortest edit scripts, more suits reads in which gaps are rare. Each reference base has an
outcome: a letter, or a deletion ('-'); letters that are put in after a base that stays are outcomes of their own ('+A'). Outcomes are counted by
the base and the K bases before it, within tasks first, so what is shuffled is a table of some thousand rows a task at most. Counts of
shorter contexts are sums of those, and the length of the context is chosen by AIC.

A model is a table (context, base, outcome, n, p): p is the probability of a letter or deletion, and of an inserted letter the
chance that one more comes. Simulation packs it into one row, an array indexed by the code of context and base, which goes to every task;
each base of a read is one lookup and hashed draws inside one expression. Contexts that were never seen take the table of shorter ones.

Qualities: the distribution of quality letters by what a read base is (a match, a substitution, an insertion) and by its place in the read.

Defined results: pairs with a null or empty side and letters other than ACGT count nowhere; insertions before the first base are left
out; of equally cheap edit scripts the one with substitutions is preferred; no reads give an empty table, which simulates reads without errors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import BASES, fragment, is_acgt
from ..functions.uniform import uniform
from .composition import best_model

STAYS, GONE = list(BASES), "-"
INSERTED = [f"+{b}" for b in BASES]
COUNTS = "context string, base string, outcome string, n long"
MODEL = f"{COUNTS}, p double"
QUALITIES = "kind string, bin int, quality string, n long"
#: Bases of context that are counted, and read bases of one bin of qualities.
K, BIN = 3, 10
#: Free parameters of a context and base: outcomes less one, the chance of an insertion, inserted letters less one.
PARAMETERS = 8
#: A cost of a gap at which sequences of equal length are aligned without any.
UNGAPPED = 1 << 30


# ---- alignment -----------------------------------------------------------------------------------------------------


def edit_script(read: str, ref: str, gap: int = 1) -> list[tuple[int, int, int]]:
    """(place in ref, place in read, inserted letters after it) per reference base, of a cheapest edit script; a deleted base has read place -1.

    A substitution costs 1 and an inserted or deleted letter gap. Gaps of sequences of equal length come in pairs, so those with up to
    2 * gap different letters need no search. Else the band around the diagonal is doubled until no way out of it is as cheap, so time and
    memory are the length times the distance.
    """
    n, m = len(ref), len(read)
    a, b = np.frombuffer(ref.encode("latin1", "replace"), np.uint8), np.frombuffer(read.encode("latin1", "replace"), np.uint8)
    if n == m and int((a != b).sum()) <= 2 * gap:
        return [(i, i, 0) for i in range(n)]
    kind = np.int32 if (n + m + 1) * gap < 1 << 28 else np.int64
    band, far = abs(n - m) + 8, kind((n + m + 1) * gap)
    while True:
        width = 2 * band + 1
        t = np.arange(width, dtype=kind)
        table = np.empty((n + 1, width), kind)
        j = t - band  # of row 0
        table[0] = np.where((j >= 0) & (j <= m), j * gap, far)
        for i in range(1, n + 1):
            j = t + (i - band)
            inside = (j >= 0) & (j <= m)
            same = np.zeros(width, bool)
            read_at = (j >= 1) & (j <= m)
            same[read_at] = b[j[read_at] - 1] == a[i - 1]
            step = np.where(read_at, table[i - 1] + ~same, far)
            step[:-1] = np.minimum(step[:-1], table[i - 1, 1:] + gap)
            step = np.where(inside, step, far)
            table[i] = np.where(inside, np.minimum.accumulate(step - t * gap) + t * gap, far)
        distance = int(table[n, m - n + band])
        if distance <= band * gap or band > n + m:
            break
        band *= 2
    out, i, at, more = [], n, m, 0
    while i:
        here, k = table[i, at - i + band], at - i + band
        if at and table[i - 1, k] + (a[i - 1] != b[at - 1]) == here:
            out.append((i - 1, at - 1, more))
            i, at, more = i - 1, at - 1, 0
        elif k + 1 < width and table[i - 1, k + 1] + gap == here:
            out.append((i - 1, -1, more))
            i, more = i - 1, 0
        else:
            at, more = at - 1, more + 1
    return out[::-1]


def outcomes(read: str, ref: str, k: int, gap: int = 1) -> Iterator[tuple[str, str, str]]:
    """(context, base, outcome) of each reference base, and of each letter put in after it."""
    last = -1
    for i, at, more in edit_script(read, ref, gap):
        context, base = ref[max(0, i - k) : i], ref[i]
        last = at if at >= 0 else last
        if base not in BASES or context.strip(BASES):
            continue
        got = read[at] if at >= 0 else GONE
        if got in BASES or got == GONE:
            yield context, base, got
        for x in read[last + 1 : last + 1 + more] if at >= 0 else "":
            if x in BASES:
                yield context, base, f"+{x}"


def context_counts(pairs: DataFrame, k: int = K, gap: int = 1) -> DataFrame:
    """context, base, outcome, n of pairs (read, reference), aligned with this cost of a gap; UNGAPPED where reads have substitutions only."""

    def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for pdf in frames:
            for read, ref in zip(pdf["read"], pdf["reference"], strict=True):
                found.update(outcomes(read, ref, k, gap))
        yield pd.DataFrame([(*key, n) for key, n in found.items()], columns=["context", "base", "outcome", "n"])

    usable = pairs.where((F.length("read") > 0) & (F.length("reference") > 0)).select("read", "reference")
    return usable.mapInPandas(count, COUNTS).groupBy("context", "base", "outcome").agg(F.sum("n").alias("n"))


def quality_counts(pairs: DataFrame) -> DataFrame:
    """kind (match, substitution, insertion), bin, quality, n of pairs (read, reference, quality)."""

    def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for pdf in frames:
            for read, ref, quality in zip(pdf["read"], pdf["reference"], pdf["quality"], strict=True):
                kinds = ["insertion"] * len(read)
                for i, at, _ in edit_script(read, ref):
                    if at >= 0:
                        kinds[at] = "match" if read[at] == ref[i] else "substitution"
                found.update((kind, i // BIN, q) for i, (kind, q) in enumerate(zip(kinds, quality, strict=False)))
        yield pd.DataFrame([(*key, n) for key, n in found.items()], columns=["kind", "bin", "quality", "n"])

    usable = pairs.where((F.length("read") > 0) & (F.length("reference") > 0)).select("read", "reference", "quality")
    return usable.mapInPandas(count, QUALITIES).groupBy("kind", "bin", "quality").agg(F.sum("n").alias("n"))


# ---- models --------------------------------------------------------------------------------------------------------


def model_table(counts: DataFrame, k: int) -> DataFrame:
    """The model of contexts of k bases: context, base, outcome, n, p."""
    rows = counts.groupBy(F.expr(f"right(context, {k})").alias("context"), "base", "outcome").agg(F.sum("n").alias("n"))
    of = Window.partitionBy("context", "base")  # nine outcomes at most
    stays, gone, more = (F.sum(F.when(F.col("outcome").isin(x), F.col("n")).otherwise(0)).over(of) for x in (STAYS, [GONE], INSERTED))
    p = F.when(F.col("outcome").isin(INSERTED), F.col("n") / (more + stays)).otherwise(F.col("n") / (stays + gone))
    return rows.select("context", "base", "outcome", "n", p.alias("p"))


def model_scores(counts: DataFrame, ks: Sequence[int] = range(K + 1)) -> DataFrame:
    """model_id, inference, aic, ordinal of the models with contexts of each length, as best_model reads them."""
    rows = counts.withColumn("ordinal", F.explode(F.array(*(F.lit(k) for k in ks)))).withColumn("context", F.expr("right(context, ordinal)"))
    n = lambda which: F.sum(F.when(F.col("outcome").isin(which), F.col("n")).otherwise(0)).cast("double")
    each = rows.groupBy("ordinal", "context", "base").agg(*(n([x]).alias(x) for x in (*STAYS, GONE, *INSERTED)))
    total = lambda names: sum((F.col(x) for x in names), F.lit(0.0))
    part = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(0.0)
    stays, more = total(STAYS), total(INSERTED)
    fits = sum((part(F.col(x), stays + F.col(GONE)) for x in (*STAYS, GONE)), F.lit(0.0)) + part(more, more + stays) + part(stays, more + stays)
    fits = fits + sum((part(F.col(x), more) for x in INSERTED), F.lit(0.0))
    scores = each.groupBy("ordinal").agg((2.0 * PARAMETERS * F.count(F.lit(1)) - 2.0 * F.sum(fits)).alias("aic"))
    return scores.select(F.concat(F.lit("k"), "ordinal").alias("model_id"), F.lit("maximum_likelihood").alias("inference"), "aic", "ordinal")


def trained_model(pairs: DataFrame) -> DataFrame:
    """The model with least AIC of pairs (read, reference)."""
    from ..functions.scratch import written

    counts = written(context_counts(pairs), "error-counts")
    best = best_model(model_scores(counts)).first()["model_id"]
    return model_table(counts, int(best[1:]) if best else 0)


def packed(model: DataFrame) -> DataFrame:
    """The model as one row: k and cells, by the code of context and base; what was never seen has the cell of the next shorter context.

    There are 4 * 5^k cells, as a place before the first base is a fifth letter.
    """
    k = model.agg(F.coalesce(F.max(F.length("context")), F.lit(0))).first()[0]
    letters = "^" + BASES
    contexts = [""] if not k else [c for c in _words(letters, k) if "^" not in c.lstrip("^")]
    rows = model.collect()  # a model has 9 * 4 * 5^k rows at most
    found: dict[tuple[str, str], Counter] = {}
    for r in rows:
        for j in range(len(r.context) + 1):
            found.setdefault((r.context[len(r.context) - j :], r.base), Counter())[r.outcome] += r.n
    cells: list = [None] * (4 * 5**k)
    for context in contexts:
        for b in BASES:
            seen = next((found[c, b] for c in (context.lstrip("^")[i:] for i in range(k + 1)) if (c, b) in found), Counter({b: 1}))
            stays, more = sum(seen[x] for x in STAYS), sum(seen[x] for x in INSERTED)
            cums = np.cumsum([seen[x] / (stays + seen[GONE]) for x in (*STAYS, GONE)]).tolist() if stays + seen[GONE] else [float(BASES.index(b) <= i) for i in range(5)]
            inserted = np.cumsum([seen[x] / more for x in INSERTED]).tolist() if more else [1.0] * 4
            code = BASES.index(b) + 4 * sum(letters.index(x) * 5**j for j, x in enumerate(reversed(context)))
            cells[code] = (cums, more / (more + stays) if more else 0.0, inserted)
    return model.sparkSession.createDataFrame([(k, cells)], "k int, cells array<struct<cum:array<double>,more:double,letters:array<double>>>")


def _words(letters: str, k: int) -> list[str]:
    return [w + x for w in (_words(letters, k - 1) if k > 1 else [""]) for x in letters]


def drawn_base(cum: Column, u: Column, letters: Sequence[str]) -> Column:
    """The letter whose cumulative probability is the first over u; the last one if none is."""
    out = F.lit(letters[-1])
    for i in reversed(range(len(letters) - 1)):
        out = F.when(u < cum[i], F.lit(letters[i])).otherwise(out)
    return out


def drawn_read(seq: Column, key: Sequence[Column], seed: int) -> Column:
    """What becomes of each base of a sequence, under the model in columns k and cells: an array of structs (kept, more, kind)."""
    digit = lambda i: F.coalesce(F.instr(F.lit(BASES), F.substring(seq, i + 1, F.lit(1))), F.lit(0))

    def code(i: Column) -> Column:
        back = F.transform(F.sequence(F.lit(0), F.greatest(F.col("k") - 1, F.lit(0))), lambda j: F.when((j < F.col("k")) & (i - j >= 1), digit(i - j - 1) * F.pow(F.lit(5.0), j).cast("int")).otherwise(0))
        return digit(i) - 1 + 4 * F.aggregate(back, F.lit(0), lambda acc, x: acc + x)

    def base(i: Column) -> Column:
        def of(cell: Column) -> Column:
            u, v = uniform(seed, *key, i, "m"), F.greatest(uniform(seed, *key, i, "i"), F.lit(2.0**-33))
            kept = drawn_base(cell["cum"], u, [*STAYS, ""])
            n = F.when((cell["more"] > 0) & (kept != ""), F.floor(F.log(v) / F.log(cell["more"]))).otherwise(0).cast("int")
            more = F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), n), lambda j: drawn_base(cell["letters"], uniform(seed, *key, i, "b", j), STAYS)), "")).otherwise("")
            kind = F.when(kept == F.substring(seq, i + 1, F.lit(1)), "match").otherwise("substitution")
            return F.struct(kept.alias("kept"), more.alias("more"), kind.alias("kind"))

        return F.transform(F.array(F.col("cells")[code(i)]), of)[0]

    return F.transform(F.sequence(F.lit(0), F.length(seq) - 1), base)


def model_reads(refs: DataFrame, model: DataFrame, n_per_ref: int, seed: int, *, read_len: int | None = None, qualities: DataFrame | None = None) -> DataFrame:
    """refseq, name, sequence of n reads per reference (refseq, sequence) under a model; unusable and empty ones are left out.

    With qualities (quality_counts) there is a column quality: a letter per base, drawn for its kind and place; kinds and places without
    counts have the letter 'I'.
    """
    reads = refs.select("refseq", "sequence").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_per_ref - 1))))
    reads = reads.withColumn("_f", fragment(F.col("sequence"), read_len, uniform(seed, F.col("refseq"), F.col("i"), "f"))).where(is_acgt(F.col("_f")))
    rows = reads.join(F.broadcast(packed(model)))  # one row
    rows = rows.withColumn("_b", drawn_read(F.col("_f"), [F.col("refseq"), F.col("i")], seed))
    whole = F.array_join(F.transform("_b", lambda x: F.concat(x["kept"], x["more"])), "")
    out = rows.select("refseq", "i", F.concat_ws(":", "refseq", F.col("i").cast("string")).alias("name"), whole.alias("sequence"), *([] if qualities is None else ["_b"])).where(F.length("sequence") > 0)
    if qualities is None:
        return out.drop("i")
    kinds = F.flatten(F.transform("_b", lambda x: F.concat(F.when(x["kept"] == "", F.array().cast("array<string>")).otherwise(F.array(x["kind"])), F.array_repeat(F.lit("insertion"), F.length(x["more"])))))
    out = out.join(F.broadcast(packed_qualities(qualities)))  # one row

    def letter(kind: Column, i: Column) -> Column:
        u = uniform(seed, F.col("refseq"), F.col("i"), i, "q")
        cell = F.get(F.element_at("quality_cells", kind), F.floor(i / BIN).cast("int"))
        at = F.filter(cell, lambda x: u < x["cum"])
        return F.coalesce(F.get(at, F.lit(0))["quality"], F.element_at(cell, -1)["quality"], F.lit("I"))

    return out.select("refseq", "name", "sequence", F.array_join(F.transform(kinds, letter), "").alias("quality"))


def packed_qualities(counts: DataFrame) -> DataFrame:
    """One row: by kind an array over bins of quality letters with their cumulative probability; empty bins have the last one before them.

    As many cells as the longest read has bins, times three kinds and some forty letters.
    """
    found: dict[str, dict[int, list]] = {kind: {} for kind in ("match", "substitution", "insertion")}
    for r in counts.orderBy("kind", "bin", "quality").collect():
        found[r.kind].setdefault(r.bin, []).append((r.quality, r.n))
    cells = {}
    for kind, bins in found.items():
        filled, last = [], None
        for b in range(max(bins, default=-1) + 1):
            if b in bins:
                cums = np.cumsum([n for _, n in bins[b]]) / sum(n for _, n in bins[b])
                last = [(q, float(c)) for (q, _), c in zip(bins[b], cums, strict=True)]
            filled.append(last)
        cells[kind] = filled
    return counts.sparkSession.createDataFrame([(cells,)], "quality_cells map<string,array<array<struct<quality:string,cum:double>>>>")


def read_model(spark, path: str) -> DataFrame:
    """A model that write_model wrote."""
    return spark.read.csv(path, header=True, schema=MODEL).na.fill({"context": ""})


def write_model(model: DataFrame, path: str) -> None:
    model.orderBy("context", "base", "outcome").coalesce(1).write.csv(path, header=True, mode="overwrite")
