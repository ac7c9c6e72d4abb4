"""Nucleotide functions: Column expressions, and Arrow-batched primer search where expressions would crawl."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The IUPAC nucleotide codes and their complements.
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "GC", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}
CODES, COMPLEMENTS = "ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"
BASES = "ACGT"


def genome_of(header: Column) -> Column:
    """What stands before the first '|' of a reference id."""
    return F.split_part(header, F.lit("|"), F.lit(1))


def reverse_complement(seq: Column) -> Column:
    """Reverse complement over the IUPAC codes; other characters stay."""
    return F.reverse(F.translate(seq, CODES, COMPLEMENTS))


def reverse_complement_text(seq: str) -> str:
    return seq.translate(str.maketrans(CODES, COMPLEMENTS))[::-1]


def header_token(header: Column) -> Column:
    """The first word of a header line."""
    return F.regexp_extract(F.trim(header), r"^(\S+)", 1)


def read_source(query: Column) -> Column:
    """A simulated read's reference: its name up to the last ':'."""
    return F.regexp_replace(query, ":[^:]*$", "")


def is_acgt(seq: Column) -> Column:
    return seq.rlike("^[ACGT]+$")


def lineage(header: Column) -> Column:
    """Synthetic lineage of a reference: a root, its genome, itself."""
    return F.concat_ws(";", F.lit("Bacteria"), genome_of(header), header)


def taxonomy_levels(taxonomy: Column) -> Column:
    """A ';'-separated taxonomy as trimmed levels."""
    return F.transform(F.split(taxonomy, ";"), lambda level: F.trim(level))


def taxonomy_is_valid(levels: Column) -> Column:
    return (F.size(levels) > 0) & ~F.exists(levels, lambda x: (x == "") | x.rlike("[\t\n]"))


def padded_lineage(levels: Column, genome: Column, depth: Column) -> Column:
    """Levels filled up with 'unclassified' to a depth, then the genome."""
    return F.concat(levels, F.array_repeat(F.lit("unclassified"), (depth - F.size(levels)).cast("int")), F.array(genome))


def level_names(depth: int) -> list[str]:
    return [*(f"Taxonomy_{i}" for i in range(1, depth + 1)), "Subspecies"]


def fragment(seq: Column, length: int | None, u: Column) -> Column:
    """A substring of a length at a uniform place; the whole sequence if it is no longer than that."""
    if not length:
        return seq
    start = F.floor(u * (F.length(seq) - F.lit(length) + 1)).cast("int") + 1
    return F.when(F.length(seq) <= length, seq).otherwise(F.substring(seq, start, F.lit(length)))


def primer_at(seq: Column, primer: str, mismatches: int, start: Column | int = 0) -> Column:
    """Earliest 0-based place from start on where a degenerate primer matches within a mismatch budget, else null.

    The plain expression form, for short sequences and as a check of the batched form.
    """
    start = F.lit(start) if isinstance(start, int) else start
    last = F.length(seq) - len(primer)

    def misses(p: Column) -> Column:
        out = F.lit(0)
        for j, c in enumerate(primer):
            if c in IUPAC:
                out = out + F.when(F.instr(F.lit(IUPAC[c]), F.substring(seq, p + j + 1, F.lit(1))) > 0, 0).otherwise(1)
        return out

    places = F.filter(F.sequence(start, last), lambda p: misses(p) <= mismatches)
    return F.when(last >= start, F.try_element_at(places, F.lit(1)))


def _fits(primer: str) -> list[np.ndarray | None]:
    """Per place of a primer, a table of the bytes that fit it; None where all do."""
    out: list[np.ndarray | None] = []
    for c in primer:
        table = np.zeros(256, bool)
        table[list(IUPAC.get(c, "").encode())] = True
        out.append(table if c in IUPAC else None)
    return out


def first_hits(seqs: list[str], primer: str, mismatches: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Earliest hits of a primer in many sequences at once; -1 where there is none."""
    size, out = len(primer), np.full(len(seqs), -1)
    lens = np.array([len(s) for s in seqs])
    if not lens.sum() or lens.max() < size:
        return out
    raw = np.frombuffer("".join(seqs).encode("ascii", "replace"), np.uint8)
    if len(raw) < size:
        return out
    n = len(raw) - size + 1
    misses = np.zeros(n, np.uint16)
    for j, table in enumerate(_fits(primer)):
        if table is not None:
            misses += ~table[raw[j : j + n]]
    offsets = np.concatenate([[0], np.cumsum(lens)])
    hits = np.flatnonzero(misses <= mismatches)
    owner = np.searchsorted(offsets, hits, "right") - 1
    at = hits - offsets[owner]
    ok = at <= lens[owner] - size
    if starts is not None:
        ok &= at >= starts[owner]
    owner, at = owner[ok], at[ok]
    where, first = np.unique(owner, return_index=True)
    out[where] = at[first]
    return out


def amplicons(seqs: list[str], forward: str, reverse: str, mismatches: int) -> list[str | None]:
    """What lies between the first forward hit and the first hit of the reverse primer's complement after it."""
    f = first_hits(seqs, forward, mismatches)
    begin = np.where(f >= 0, f + len(forward), 1 << 40)
    r = first_hits(seqs, reverse_complement_text(reverse), mismatches, begin)
    return [s[a:b] or None if b >= 0 else None for s, a, b in zip(seqs, begin.tolist(), r.tolist(), strict=True)]


def amplicon(seq: Column, forward: str, reverse: str, mismatches: int) -> Column:
    """In-silico PCR; null if a primer has no site or nothing lies between them."""

    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(amplicons([x or "" for x in s], forward, reverse, mismatches), dtype="object")

    return F.pandas_udf(cut, "string")(seq)


def trimmed_read(seq: Column, forward: str, reverse: str, mismatches: int) -> Column:
    """A read cut to its amplicon in either orientation; unchanged if no primer pair is found."""

    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            seqs = [x or "" for x in s]
            out = amplicons(seqs, forward, reverse, mismatches)
            left = [i for i, x in enumerate(out) if x is None]
            for i, x in zip(left, amplicons([reverse_complement_text(seqs[i]) for i in left], forward, reverse, mismatches), strict=True):
                out[i] = x
            yield pd.Series([x or y for x, y in zip(out, s, strict=True)], dtype="object")

    return F.pandas_udf(cut, "string")(seq)
