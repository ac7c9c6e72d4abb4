"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Text measures come from one expression per row. A labelled holdout then chooses, per stratum and rule, a
cutoff whose false rejection rate is certified: with n good holdout texts of which k exceed the cutoff, the exact
binomial tail P(Bin(n, a) <= k) must be at most delta over the number of (stratum, rule) pairs. Only rules that reject a bad
text of the stratum are tested, and share alpha there; the bounds look at good texts only, so that choice does not bias
them. A text counts once in its stratum however many rows hold it, as copies are no further draws. Cutoffs of a rule are tested from the loosest to the strictest and the testing stops at the first failure (fixed
sequence), so the correction needs to count pairs only. Among certified cutoffs the one that rejects most bad texts wins, ties
go to the loosest.

Defined results: a null text counts as empty and fails the base rule (under 50 words); a null stratum is a stratum
of its own; a stratum without enough labels keeps all that pass the base rule; labels that are null are dropped and
of several labels of one id, and of equal texts of a stratum, the best counts; repeated rows are judged each for itself, and are one row
of the holdout; an empty table gives an
empty result; without labels no cutoff is certified. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import BLANKS, bound, sized, words_of, written

SYMBOLS = "#*$%&|<>"
#: The share of good texts that may be rejected in a stratum, and the chance that this fails anywhere.
ALPHA, DELTA = 0.02, 0.1
#: Rule -> cutoffs from the loosest to the strictest; a text is rejected when the measure exceeds the cutoff.
RULES: dict[str, Sequence[float]] = {
    "symbol_ratio": (4.0, 2.0, 1.0, 0.5, 0.25, 0.1),
    "dup_line_ratio": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "repeat_ratio": (0.45, 0.4, 0.3, 0.2, 0.1, 0.05),
    "upper_ratio": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "mean_word": (40.0, 25.0, 15.0, 12.0, 10.0),
}


def kept_only(text: Column, wanted: str) -> Column:
    """How many characters of a text are in the class wanted."""
    return F.length(F.regexp_replace(text, f"[^{wanted}]+", "")).cast("long")


def with_measures(docs: DataFrame, text: str = "text", into: str = "_m") -> DataFrame:
    """docs with a struct of the counts of each text.

    A word counts as repeated when it stands in a 3-word window found at least twice: windows are sorted with
    their positions, equal neighbours give the positions, and gaps of under three words overlap. Each step is a
    column of its own, so that it is evaluated once and by generated code. (Sorting the windows' hashes takes longer: a hash
    for each window costs more than comparing words, which mostly differ in their first letters.)
    """
    columns = docs.columns
    t, w, s, p = (F.col(c) for c in ("_t", "_w", "_s", "_p"))
    m = F.size(w) - 2
    windows = F.arrays_zip(F.slice(w, 1, m).alias("a"), F.slice(w, 2, m).alias("b"), F.slice(w, 3, m).alias("c"), F.sequence(F.lit(0), m - 1).alias("p"))
    no_windows = F.array().cast("array<struct<a:string,b:string,c:string,p:int>>")
    same = lambda x, y: F.when((x["c"] == y["c"]) & (x["b"] == y["b"]) & (x["a"] == y["a"]), F.array(x["p"], y["p"]))
    k = F.size(s) - 1
    twice = F.filter(F.zip_with(F.slice(s, 1, k), F.slice(s, 2, k), same), lambda x: x.isNotNull())
    none = F.array().cast("array<int>")
    gaps = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.when(F.size(p) == 0, F.lit(0).cast("long")).otherwise(F.aggregate(gaps, F.lit(3).cast("long"), lambda acc, g: acc + g))
    lines = bound(
        F.filter(F.split(t, "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != ""),
        lambda ls: F.struct(F.size(ls).cast("long").alias("n_lines"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines")),
    )
    counts = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        kept_only(t, SYMBOLS).alias("n_symbols"),
        lines.alias("lines"),
        covered.alias("n_repeat_words"),
        kept_only(t, "A-Z").alias("n_upper"),
    )
    out = docs.withColumn("_t", F.coalesce(docs[text], F.lit(""))).withColumn("_w", words_of(t))
    out = out.withColumn("_s", F.when(m >= 2, F.sort_array(windows)).otherwise(no_windows))
    out = out.withColumn("_p", F.when(F.size(s) >= 2, F.sort_array(F.array_distinct(F.flatten(twice)))).otherwise(none))
    return out.select(*columns, counts.alias(into))


def rule_values(m: Column) -> dict[str, Column]:
    words = F.greatest(m["n_words"], F.lit(1))
    return {
        "symbol_ratio": m["n_symbols"] / words,
        "dup_line_ratio": m["lines"]["n_dup_lines"] / F.greatest(m["lines"]["n_lines"], F.lit(1)),
        "repeat_ratio": m["n_repeat_words"] / words,
        "upper_ratio": m["n_upper"] / F.greatest(m["word_chars"], F.lit(1)),
        "mean_word": m["word_chars"] / words,
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def log_binomial_cdf(k: Column, n: Column, p: Column) -> Column:
    """log P(Bin(n, p) <= k), summed exactly from term to term in log space; 0 where k is over the mean."""
    odds = p / (1 - p)
    first = n * F.log(1 - p)

    def step(acc: Column, i: Column) -> Column:
        t = acc["t"] + F.log((n - i + 1) / i * odds)
        hi, lo = F.greatest(acc["s"], t), F.least(acc["s"], t)
        return F.struct(t.alias("t"), (hi + F.log1p(F.exp(lo - hi))).alias("s"))

    more = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.struct(first.alias("t"), first.alias("s")), step, lambda acc: acc["s"])
    return F.when(k >= n, F.lit(0.0)).when(k > n * p, F.lit(0.0)).when(k == 0, first).otherwise(more)


def certified_cutoffs(labelled: DataFrame, stratum: str, good: str, alpha: float, delta: float, rules: dict[str, Sequence[float]] = RULES) -> DataFrame:
    """(stratum, one column per rule with its cutoff or null), a row per stratum with good labels.

    labelled has the stratum, the label (1 good, 0 bad) and a column per rule. alpha bounds the rate of good
    texts rejected per stratum and is shared out evenly over the rules that reject a bad one there; delta is the chance that
    any bound fails.
    """
    tests = [(r, i, c) for r, cuts in rules.items() for i, c in enumerate(cuts)]
    is_good, is_bad = F.col(good) == 1, F.col(good) == 0
    counts = labelled.groupBy(F.col(stratum).alias("_stratum")).agg(
        F.count_if(is_good).alias("_n"),
        *(F.count_if(is_good & (F.col(r) > c)).alias(f"_k_{r}_{i}") for r, i, c in tests),
        *(F.count_if(is_bad & (F.col(r) > c)).alias(f"_b_{r}_{i}") for r, i, c in tests),
    )
    useful = sum((F.greatest(F.lit(0), *(F.col(f"_b_{r}_{i}") for i in range(len(cuts)))) > 0).cast("int") for r, cuts in rules.items())
    counts = counts.where(F.col("_n") > 0).withColumn("_m", useful).withColumn("_each", F.lit(float(alpha)) / F.greatest(F.col("_m"), F.lit(1)))
    counts = written(counts, "strata")
    # Only strata that could be certified with no false rejection at all, were they the only one, are tested and counted.
    able = counts.where((F.col("_m") > 0) & (F.col("_n") * F.log(1 - F.col("_each")) <= F.log(F.lit(float(delta)) / F.col("_m"))))
    pairs = able.agg(F.sum("_m")).first()[0] or 1
    counts = counts.withColumn("_level", F.log(F.lit(delta / pairs)))

    def chosen(rule: str, cuts: Sequence[float]) -> Column:
        """Of the certified run of cutoffs from the loosest on, the first that rejects most bad texts."""
        steps = F.array(*(F.struct(F.lit(float(c)).alias("c"), F.col(f"_k_{rule}_{i}").alias("k"), F.col(f"_b_{rule}_{i}").alias("b")) for i, c in enumerate(cuts)))

        def step(acc: Column, x: Column) -> Column:
            alive = acc["alive"] & (log_binomial_cdf(x["k"], F.col("_n"), F.col("_each")) <= F.col("_level"))
            better = alive & (x["b"] > acc["b"])
            return F.struct(alive.alias("alive"), F.when(better, x["b"]).otherwise(acc["b"]).alias("b"), F.when(better, x["c"]).otherwise(acc["c"]).alias("c"))

        start = F.struct(F.lit(True).alias("alive"), F.lit(0).cast("long").alias("b"), F.lit(None).cast("double").alias("c"))
        return F.aggregate(steps, start, step, lambda acc: acc["c"])

    return counts.select("_stratum", *(chosen(r, cuts).alias(f"_cut_{r}") for r, cuts in rules.items()))


def holdout(docs: DataFrame, labels: DataFrame, *, key: str, text: str, stratum: str) -> DataFrame:
    """_s, _q and the rules' values of the labelled texts that pass the base rules: one row per distinct text and stratum."""
    best = labels.select(F.col(key).alias("_key"), F.col("quality").alias("_q")).where("_q in (0, 1) and _key is not null").groupBy("_key").agg(F.max("_q").alias("_q"))
    rows = docs.select(F.col(key).alias("_key"), F.col(stratum).alias("_s0"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    held = with_measures(rows.join(sized(written(best, "labels")), "_key"), "_text").select("_s0", "_q", F.sha2("_text", 256).alias("_digest"), "_m")
    # written, so that no filter on the counts is moved to where they would be made again and again
    held = written(held, "measured").where(~base_failed(F.col("_m")))
    held = held.select(F.col("_s0").alias("_s"), "_q", "_digest", *(v.alias(r) for r, v in rule_values(F.col("_m")).items()))
    return held.groupBy("_s", "_digest").agg(F.max("_q").alias("_q"), *(F.any_value(r).alias(r) for r in RULES)).drop("_digest")


def judged(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA, carry: Sequence[str] | None = None) -> DataFrame:
    """The rows of docs (columns carry, all by default) with _m (counts), _base_failed and _kept.

    Cutoffs come from the labelled rows; the verdicts are then a map over all rows, joined with the table of cutoffs, which is
    sent to every task. Nothing of the texts is written.
    """
    carry = list(docs.columns if carry is None else carry)
    held = written(holdout(docs, labels, key=key, text=text, stratum=stratum), "holdout")
    cuts = certified_cutoffs(held, "_s", "_q", alpha, delta)
    cuts = sized(written(cuts.where(reduce(lambda a, b: a | b, (F.col(f"_cut_{r}").isNotNull() for r in RULES))), "cutoffs"))
    rows = docs.select(*carry, F.col(stratum).alias("_s0"), F.col(text).alias("_text"))
    measured = with_measures(rows, "_text").drop("_text")
    out = measured.join(cuts, measured["_s0"].eqNullSafe(cuts["_stratum"]), "left")
    values = rule_values(F.col("_m"))
    fails = reduce(lambda a, b: a | b, (F.coalesce(v > F.col(f"_cut_{r}"), F.lit(False)) for r, v in values.items()))
    # one condition that also reads the cutoffs: no part of it is moved below the join, where the counts would be made again
    kept = F.when(F.col("_stratum").isNull(), ~base_failed(F.col("_m"))).otherwise(~base_failed(F.col("_m")) & ~fails)
    return out.select(*carry, "_m", base_failed(F.col("_m")).alias("_base_failed"), kept.alias("_kept"))


def quality_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: its counts, the base verdict and the final verdict."""
    out = judged(docs, labels, carry=["doc_id"], **options)
    m = F.col("_m")
    return out.select(
        "doc_id", m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["lines"]["n_dup_lines"].alias("n_dup_lines"), m["n_repeat_words"].alias("n_repeat_words"), F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
    )


def passing(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that are kept, with the columns of docs."""
    return judged(docs, labels, **options).where("_kept").select(*docs.columns)
