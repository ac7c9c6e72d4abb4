"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a span classifier decides.

Candidates come from the base patterns and from looser ones. Five labelers vote yes, no or abstain on each, and look at
different things: the span's form, a checksum or range, a gazetteer (top domains, issuers, dialling codes, reserved networks, first
names), cue words around it in four languages, matched as whole words, and its boundaries. EM over the counts of all vote patterns of the
whole corpus estimates each labeler's reliability (a Dawid-Skene model per kind) and with it how likely each pattern is personal
data. On these likelihoods a logistic regression is trained, which sees the span's shape, the words around it and the
votes; it decides. It is fitted on about SAMPLE candidates (a hash of their features chooses them); all are scored.

Spans that pass the base rule always stay; of other candidates those are added to which the classifier gives at least
THRESHOLD, the likeliest first, unless they overlap a span that is there.

Defined results: a null text counts as empty; null ids and repeated rows keep a row each; a candidate without votes for or against
it is as likely as its kind; an empty table gives an empty result; texts are read whole, in time linear in their length;
other columns are not read. Offsets count code points, end exclusive.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import written

KINDS = ("email", "ip", "card", "phone", "name", "idnum")
N_BASE = 4
LABELERS = 5
YES, NO, ABSTAIN = 2, 0, 1
N_VOTES = 3**LABELERS
N_PATTERNS = len(KINDS) * N_VOTES
THRESHOLD = 0.8
#: Characters around a span that are read for cues, hashed features, and candidates that the classifier is fitted on.
CONTEXT_CHARS, BITS, SAMPLE = 48, 16, 20_000

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is taken whole, so matches start where a run of digits starts.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TITLES = r"Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Herrn|Frau|Mme|Mlle|Monsieur|Madame|Sr|Sra|Srta|Señor|Señora"
LOOSE = {
    "name": re.compile(rf"\b(?:{TITLES})\.?\x20[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{{1,20}}(?:[\x20-][A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{{1,20}}){{1,2}}\b"),
    "phone": re.compile(r"(?<![\w+.-])\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\w-])"),
    "idnum": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
}
def cues(words: str) -> frozenset[str]:
    return frozenset(words.split())


@dataclass(frozen=True)
class Gazetteers:
    """What labelers look up; larger lists may be given."""

    top_domains: frozenset[str] = cues("com org net edu gov mil int info biz io co ai app dev me tv eu de at ch fr be lu es mx ar cl pe it pt br nl uk ie us ca au nz se no dk fi pl cz gr ru ua tr in cn jp kr za test example")
    first_names: frozenset[str] = cues(
        "Anna Maria Peter Paul John Mary James Robert Linda David Susan Thomas Karl Hans Luis Jose José Carlos Jean Marie Pierre Michael William Richard Joseph Charles Daniel Matthew Mark George Sarah Karen Nancy Lisa "
        "Emma Olivia Sophia Jennifer Elizabeth Patricia Wolfgang Jürgen Klaus Stefan Andreas Christian Martin Sabine Petra Monika Ursula Claudia Heike Katrin Julia Jacques Michel Philippe Alain Nicolas François Louis "
        "Isabelle Nathalie Sophie Catherine Claire Camille Juan Antonio Manuel Francisco Javier Miguel Pedro Carmen Isabel Laura Lucía Elena Ana Rosa Pilar Dolores"
    )
    #: Words that speak for a kind, in English, German, French and Spanish, and words that speak against any.
    positive: dict[str, frozenset[str]] = field(default_factory=lambda: {
        "email": cues("mail email e-mail contact write kontakt schreiben adresse courriel contacter écrire correo contacto escribir"),
        "ip": cues("ip ips host server address login gateway router serveur adresse hôte servidor dirección rechner"),
        "card": cues("card visa mastercard amex credit debit payment paid karte kreditkarte zahlung carte bancaire paiement tarjeta crédito pago"),
        "phone": cues("phone telephone tel call mobile cell fax telefon anrufen handy rufnummer téléphone appeler portable teléfono llamar móvil"),
        "name": cues("name named signed by from dear names unterzeichnet von liebe nom signé par cher chère nombre firmado por querido"),
        "idnum": cues("ssn social security insurance versicherungsnummer sozialversicherung sécurité sociale seguro seguridad"),
    })
    negative: frozenset[str] = cues("version release isbn issn order sku invoice section chapter build serial bestellung rechnung kapitel abschnitt commande facture chapitre pedido factura capítulo sección")

    def dialled(self, digits: str) -> bool:
        """Whether digits begin with a calling code: zones 1 and 7, codes of two digits, and the zones whose codes have three."""
        two = digits[:2]
        return digits[:1] in "17" or two in self.two_digit_codes or two in self.three_digit_zones

    # The numbering plan's codes of two digits, and the beginnings of its codes of three.
    two_digit_codes: frozenset[str] = cues("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98")
    three_digit_zones: frozenset[str] = cues("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: from each @ the local part reaches left over its run of characters."""
    done, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in LOCAL:
            lo -= 1
        if lo < at and (m := DOMAIN.match(text, at + 1)):
            yield lo, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_ok(kind: str, span: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in span.split("."))
    digits = re.sub("[^0-9]", "", span)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return kind == "email"


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, base) of all candidates, base ones first."""
    found = [(a, 0, b, True) for a, b in emails(text)] if "@" in text else []
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        found += [(m.start(), kind, m.end(), base_ok(KINDS[kind], m[0])) for m in pattern.finditer(text)]
    # Runs of a few digits are no cards; only those of card length that fail the checksum are worth a vote.
    found = [f for f in found if f[3] or f[1] != 2 or 13 <= sum(c.isdigit() for c in text[f[0] : f[2]]) <= 19]
    for kind in ("phone", "name", "idnum"):
        found += [(m.start(), KINDS.index(kind), m.end(), False) for m in LOOSE[kind].finditer(text)]
    return found


WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")


def around(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """The whole words near a span, in lower case: before it and after it."""
    lo = max(0, start - CONTEXT_CHARS)
    before = WORD.findall(text[lo:start].lower())
    if lo and before and text[lo - 1].isalnum() and text[lo].isalnum():
        before = before[1:]  # a word that the window cuts
    after = WORD.findall(text[end : end + CONTEXT_CHARS].lower())
    if after and text[end + CONTEXT_CHARS - 1 : end + CONTEXT_CHARS].isalnum() and text[end + CONTEXT_CHARS : end + CONTEXT_CHARS + 1].isalnum():
        after = after[:-1]
    return before, after


def votes(text: str, start: int, kind: int, end: int, known: Gazetteers) -> tuple[int, ...]:
    """One vote per labeler: form, test, gazetteer, cues, boundaries. What a kind's pattern demands already is no vote."""
    name, span = KINDS[kind], text[start:end]
    digits = re.sub("[^0-9]", "", span)
    of = lambda yes: YES if yes else NO
    form = test = gaz = ABSTAIN
    if name == "email":
        local, _, domain = span.partition("@")
        form = of(len(local) <= 64 and ".." not in local and local[0] != "." and local[-1] != "." and not any(p.startswith("-") or p.endswith("-") for p in domain.split(".")))
        gaz = of(domain.rpartition(".")[2].lower() in known.top_domains)
    elif name == "ip":
        parts = span.split(".")
        form = of(all(len(p) == 1 or p[0] != "0" for p in parts))
        test = of(base_ok("ip", span))
        if test == YES:
            a, b = int(parts[0]), int(parts[1])
            gaz = NO if a in (0, 127) or a >= 224 or (a, b) == (169, 254) else ABSTAIN if a == 10 or (a, b) == (192, 168) or (a == 172 and 16 <= b < 32) else YES
    elif name == "card":
        groups = [len(g) for g in re.split(r"[\x20-]", span)]
        form = of(len(groups) == 1 or groups in ([4, 4, 4, 4], [4, 6, 5], [4, 4, 4, 4, 3]))
        test = of(luhn(digits))
        lengths = {"3": (14, 15, 16), "4": (13, 16, 19), "5": (16,), "6": (16, 17, 18, 19), "2": (16,)}
        gaz = of(len(digits) in lengths.get(digits[:1], ()))
    elif name == "phone" and span[0] == "+":
        form = of(span.count("(") == span.count(")") and not re.search(r"[().-]{2,}(?<![)][\x20.-])|\x20{2,}", span))
        test = of(10 <= len(digits) <= 15)
        gaz = of(known.dialled(digits))
    elif name == "name":
        gaz = YES if known.first_names & set(re.split(r"[\x20-]", span)) else ABSTAIN
    elif name == "idnum":
        test = NO if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else YES
    before, after = around(text, start, end)
    near = {*before[-6:], *after[:3]}
    context = NO if known.negative & near else YES if known.positive[name] & near else ABSTAIN
    edge = (text[start - 1 : start] + text[end : end + 1]).strip()
    loose = kind >= N_BASE or (name == "phone" and span[0] != "+")
    boundary = ABSTAIN if loose else NO if any(c.isalnum() or c in "_@/\\" for c in edge) else YES
    return form, test, gaz, context, boundary


def pattern_code(kind: int, cast: tuple[int, ...]) -> int:
    for v in cast:
        kind = kind * 3 + v
    return kind


def span_features(text: str, start: int, kind: int, end: int, cast: tuple[int, ...]) -> list[int]:
    """Hashed features of a span: its votes, its shape and the words around it, each for its kind."""
    span = text[start:end]
    shape = re.sub(r"([0Aa])\1+", r"\1+", re.sub("[A-ZÀ-Þ]", "A", re.sub("[a-zß-ÿ]", "a", re.sub("[0-9]", "0", span))))
    before, after = around(text, start, end)
    keys = [f"k{kind}", f"k{kind}s{shape[:40]}", f"k{kind}n{min(len(span), 40) // 4}", *(f"k{kind}v{i}{v}" for i, v in enumerate(cast))]
    keys += [f"k{kind}b{i}{w}" for i, w in enumerate(reversed(before[-2:]))] + [f"k{kind}B{w}" for w in before[-6:]] + [f"k{kind}a{w}" for w in after[:2]]
    return sorted({zlib.crc32(k.encode()) % (1 << BITS) for k in keys})


def unpacked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kind and votes (a column per labeler) of pattern codes."""
    out = np.empty((len(codes), LABELERS), int)
    for i in reversed(range(LABELERS)):
        out[:, i], codes = codes % 3, codes // 3
    return codes, out


def em_posteriors(codes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """P(true) per pattern, and reliabilities[kind, labeler, class, vote], by EM from the majority vote."""
    kind, vote = unpacked(codes)
    score = (vote - 1).sum(1)
    p = np.where(score > 0, 0.9, np.where(score < 0, 0.1, 0.5))
    table = np.zeros((len(KINDS), LABELERS, 2, 3))
    for _ in range(rounds):
        for k in range(len(KINDS)):
            mine = kind == k
            if not mine.any():
                continue
            w1, w0 = counts[mine] * p[mine], counts[mine] * (1 - p[mine])
            prior = (w1.sum() + 1) / (counts[mine].sum() + 2)
            logit = np.full(mine.sum(), np.log(prior / (1 - prior)))
            for lab in range(LABELERS):
                v = vote[mine, lab]
                # a weak prior that labelers are better than chance keeps the classes from changing places
                yes = np.bincount(v, w1, 3) + (1, 2, 4)
                no = np.bincount(v, w0, 3) + (4, 2, 1)
                table[k, lab, 1], table[k, lab, 0] = yes / yes.sum(), no / no.sum()
                logit += np.where(v == ABSTAIN, 0, np.log(table[k, lab, 1][v] / table[k, lab, 0][v]))
            p[mine] = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return p, table


def trained(rows: list[list[int]], target: np.ndarray, weight: np.ndarray, steps: int = 150, rate: float = 0.1, ridge: float = 1e-4) -> np.ndarray:
    """Weights (the last one the constant) of a logistic regression on soft labels, by Adam over all rows."""
    out = np.zeros((1 << BITS) + 1, np.float32)
    if not rows:
        return out
    sizes = [len(r) for r in rows]
    used, cols = np.unique(np.concatenate([np.asarray(r) for r in rows]), return_inverse=True)
    row_of, weight = np.repeat(np.arange(len(rows)), sizes), weight / weight.sum()
    w, m, v = (np.zeros(len(used) + 1) for _ in range(3))
    for t in range(1, steps + 1):
        z = np.bincount(row_of, w[cols], len(rows)) + w[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight
        grad = np.append(np.bincount(cols, g[row_of], len(used)) + ridge * w[:-1], g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    out[used], out[-1] = w[:-1], w[-1]
    return out


def chosen(cands: list[dict], weights: np.ndarray, threshold: float) -> list[dict]:
    """The base spans and the likely ones that overlap no span that is taken, in order."""
    kept = [c for c in cands if c["base"]]
    rest = []
    for c in cands:
        if not c["base"]:
            z = float(weights[c["feats"]].sum() + weights[-1])
            if z >= np.log(threshold / (1 - threshold)):
                rest.append((-z, c["start"], c["rank"], c["end"], c))
    if rest:
        # taken spans of different kinds may overlap each other, so their union is what must stay free
        free = Taken(kept)
        kept += [c for *_, c in sorted(rest, key=lambda x: x[:4]) if free.add(c["start"], c["end"])]
    return sorted(kept, key=lambda c: (c["start"], c["rank"], c["end"]))


class Taken:
    """The union of spans, as disjoint ones in order."""

    def __init__(self, spans: list[dict]):
        self.lo, self.hi = [], []
        for c in sorted(spans, key=lambda c: c["start"]):
            if self.hi and c["start"] < self.hi[-1]:
                self.hi[-1] = max(self.hi[-1], c["end"])
            else:
                self.lo.append(c["start"])
                self.hi.append(c["end"])

    def add(self, start: int, end: int) -> bool:
        """Whether a span overlaps none; then it is taken too."""
        i = bisect_right(self.hi, start)
        if i < len(self.lo) and self.lo[i] < end:
            return False
        self.lo.insert(i, start)
        self.hi.insert(i, end)
        return True


SPAN = "struct<start:bigint,rank:int,end:bigint,base:boolean,code:int,feats:array<int>>"
SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("base", pa.bool_()), ("code", pa.int32()), ("feats", pa.list_(pa.int32()))]))
ANY = re.compile(rf"[0-9@]|\b(?:{TITLES})\b")


def find(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE, known: Gazetteers = Gazetteers()) -> DataFrame:
    """One row per document: its id and its spans (start, rank of the kind, end, base), in order."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1):
                t, rows = t.as_py() or "", []
                for a, k, b, ok in sorted(candidates(t)) if ANY.search(t) else ():
                    cast = votes(t, a, k, b, known)
                    rows.append({"start": a, "rank": k, "end": b, "base": ok, "code": pattern_code(k, cast), "feats": span_features(t, a, k, b, cast)})
                out.append(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, SPAN_ARROW)], names=["doc_id", "cands"])

    cands = written(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, f"doc_id long, cands array<{SPAN}>"), "spans")
    # candidates of equal features are one row with their number
    each = cands.select(F.explode("cands").alias("c")).groupBy("c.code", "c.feats").agg(F.count(F.lit(1)).alias("n"))
    each = written(each, "span-kinds")
    counts = {r["code"]: r["n"] for r in each.groupBy("code").agg(F.sum("n").alias("n")).collect()}  # at most N_PATTERNS rows
    codes = np.array(sorted(counts), int)
    likely = dict(zip(codes.tolist(), em_posteriors(codes, np.array([counts[c] for c in codes], float))[0], strict=True)) if counts else {}
    n = each.count()
    part = each if n <= sample else each.where(F.pmod(F.xxhash64("code", "feats"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    rows = sorted((r["feats"], r["code"], r["n"]) for r in part.collect())  # about sample rows
    weights = trained([r[0] for r in rows], np.array([likely[r[1]] for r in rows]), np.sqrt([r[2] for r in rows]))

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[{k: c[k] for k in ("start", "rank", "end", "base")} for c in chosen(cs, weights, threshold)] for cs in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, FOUND_ARROW)], names=["doc_id", "spans"])

    return cands.mapInArrow(decide, f"doc_id long, spans array<{FOUND}>")


FOUND = "struct<start:bigint,rank:int,end:bigint,base:boolean>"
FOUND_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("base", pa.bool_())]))


def personal_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: counts per base kind, the digest of its base spans, all its spans, their number, and whether there are any."""
    kinds = F.array(*(F.lit(k) for k in KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])
    n = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["rank"] == k))).cast("long")
    found = find(docs, **options)
    return found.select(
        "doc_id", *(n(k).alias(f"n_{KINDS[k]}") for k in range(N_BASE)), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"), (F.size("spans") > 0).alias("has_personal"),
    )
