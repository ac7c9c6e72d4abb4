"""Quotation linking in conversations (DataFrame functions; the alignment of partly quoted passages in pandas).

Quote levels are the '>' marks before a line, nested ones included ('> > text' is level 2); blanks may stand before, between and
after them. A quoted passage is a run of lines of one message at one level; passages and the unquoted paragraphs and
lines of messages are normalised (case, blanks and outer punctuation dropped) and hashed. A passage is joined to the first
earlier message of its conversation that holds it as a whole; if none does, it is cut into paragraphs and lines too, and joined to
the earlier message that holds most of its lines in order (by line or by paragraph; ties go to the first). A message answers
the message that holds its outermost first linked passage. Threads are the trees that these links make.

Threads are read depth-first: a message, then each answer to it in order of turns with all that answers it. place is the
position in that order. conversations() gives the messages of each thread in that order, without their quotes, in rows
of PART places each, so no row holds an unbounded thread.

Only one row per conversation and hash enters the join of whole passages, so a text that many messages share does not
multiply. For the other passages each message with another body that shares a part is weighed once, by an alignment row by row: lines
of the passage times lines of the message in time, lines of the message in memory, however often a line is repeated. Roots of threads are found by
pointer doubling over the linked messages alone, and places by ranking the list of their entries and exits in the same
way; both end after log2(longest thread) rounds, and no task orders a whole thread.

Defined results: a null text counts as empty; rows with a null conversation or turn stay and link to nothing; of rows
that repeat a turn each is kept, each may be answered, and they share a place; quotes that no earlier message holds are removed
from the body but not linked; marks and punctuation may be of any length; an empty table gives an empty result; other
columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import bound, sized, written

ATTRIBUTION = r"(?i)^(on\b.{0,200}\bwrote|.{0,100}\bschrieb|le\b.{0,200}\ba\x20écrit|el\b.{0,200}\bescribió)\x20?:\s*$"
#: What stands before a quoted line, and what normalised texts do not begin or end with.
MARKS = "> \t"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~ "
#: Places of a thread that one row of conversations() holds, and turns in which next answers are looked for together.
PART, TURNS = 1000, 1024


PASSAGES = "array<struct<level:int,hash:string,parts:array<struct<first:int,last:int,hash:string>>>>"


def without_marks(line: Column) -> Column:
    return F.ltrim(line, F.lit(MARKS))


def level(line: Column) -> Column:
    """The number of '>' among the marks and blanks that a line begins with."""
    marks = F.substring(line, F.lit(1), F.length(line) - F.length(without_marks(line)))
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def normalised(text: Column) -> Column:
    """Lower case, blanks as one space, no punctuation at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "), F.lit(PUNCTUATION))


def parts(text: Column) -> Column:
    """The lines of a text and its paragraphs of several lines: their first and last line (blank ones not counted) and hash."""
    lines = lambda p: F.filter(F.transform(F.split(p, "\n"), normalised), lambda t: t != "")
    found = F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda p: F.struct(normalised(p).alias("t"), lines(p).alias("lines"))), lambda p: F.size(p["lines"]) > 0)

    def numbered(ps: Column) -> Column:
        # the number of lines before each paragraph
        add = lambda acc, p: F.struct((acc["n"] + F.size(p["lines"])).alias("n"), F.concat(acc["at"], F.array(acc["n"])).alias("at"))
        before = F.aggregate(ps, F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("at")), add, lambda acc: acc["at"])
        part = lambda first, last, t: F.struct(first.alias("first"), last.alias("last"), F.sha2(t, 256).alias("hash"))

        def of(p: Column, at: Column) -> Column:
            own = F.transform(p["lines"], lambda t, i: part(at + i, at + i, t))
            return F.array_distinct(F.concat(F.array(part(at, at + F.size(p["lines"]) - 1, p["t"])), own))

        return F.flatten(F.zip_with(ps, before, of))

    return bound(found, numbered)


def most_in_order(parts: Iterable[dict], held: Iterable[dict]) -> int:
    """The most lines of a passage that parts which a message holds too cover, in the order of both.

    parts and held: first, last and hash of lines and paragraphs. One row is kept: the most lines up to here of the passage for
    each number of lines of the message; and the row where a paragraph began, until it ends.
    """
    where: dict[str, tuple[list[int], list[int]]] = {}
    for p in held:
        firsts, ends = where.setdefault(p["hash"], ([], []))
        firsts.append(p["first"])
        ends.append(p["last"] + 1)
    found = sorted(((p["last"], p["first"], p["hash"]) for p in parts if p["hash"] in where))
    at = {h: (np.array(f), np.array(e)) for h, (f, e) in where.items()}
    row = np.zeros(1 + max((e for _, ends in where.values() for e in ends), default=0), np.int64)
    opens, begun = sorted({first for last, first, _ in found if first < last}, reverse=True), {}
    for last, group in groupby(found, key=lambda x: x[0]):
        while opens and opens[-1] <= last:  # nothing ends between a paragraph's first line and here that this row lacks
            begun[opens.pop()] = row
        new = row.copy()
        for _, first, h in group:
            firsts, ends = at[h]
            np.maximum.at(new, ends, (row if first == last else begun[first])[firsts] + last - first + 1)
        row = np.maximum.accumulate(new)
    return int(row[-1])


def parsed(messages: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages with their lines by quote level: body, passages (level, hash, n lines) and what they hold themselves.

    What several steps read is bound to a name first, so each text is cut and each line judged once.
    """
    texts = F.split(F.coalesce(F.col(text), F.lit("")), r"\r?\n")
    judged = F.transform(texts, lambda x: bound(level(x), lambda n: F.struct(n.alias("level"), F.when(n > 0, without_marks(x)).otherwise(x).alias("line"))))

    def starts(lines: Column) -> Column:
        """The places where the level changes."""
        levels = F.transform(lines, lambda x: x["level"])
        before = F.concat(F.array(F.lit(-1)), F.slice(levels, F.lit(1), F.size(lines) - 1))
        changed = F.transform(F.zip_with(levels, before, lambda a, b: a != b), lambda c, i: F.when(c, i))
        return F.filter(changed, lambda i: i.isNotNull())

    def passages(lines: Column) -> Column:
        def run(at: Column, start: Column, j: Column) -> Column:
            end = F.coalesce(F.try_element_at(at, j + 2), F.size(lines))
            mine = F.transform(F.slice(lines, start + 1, end - start), lambda x: x["line"])
            return F.struct(lines[start]["level"].alias("level"), F.array_join(mine, "\n").alias("text"))

        runs = bound(starts(lines), lambda at: F.transform(at, lambda start, j: run(at, start, j)))
        quoted = F.transform(F.filter(runs, lambda r: r["level"] > 0), lambda r: F.struct(r["level"].alias("level"), r["text"].alias("text"), normalised(r["text"]).alias("t")))
        return F.transform(F.filter(quoted, lambda p: p["t"] != ""), lambda p: F.struct(p["level"].alias("level"), F.sha2(p["t"], 256).alias("hash"), parts(p["text"]).alias("parts")))

    def told(lines: Column) -> Column:
        top = F.array_max(F.transform(lines, lambda x: x["level"]))
        own = F.filter(lines, lambda x: x["level"] == 0)
        return bound(top, lambda n: F.struct(
            F.trim(F.array_join(F.transform(F.when(n > 0, F.filter(own, lambda x: ~x["line"].rlike(ATTRIBUTION))).otherwise(own), lambda x: x["line"]), "\n"), F.lit(" \t\r\n")).alias("body"),
            n.alias("quote_levels"), F.when(n > 0, passages(lines)).otherwise(F.array().cast(PASSAGES)).alias("passages"),
        ))

    rows = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), bound(judged, told).alias("x"))
    return rows.select("conv_id", "turn", "role", "x.body", "x.quote_levels", "x.passages")


def partly(rest: DataFrame, rows: DataFrame) -> DataFrame:
    """(passage, holder) of passages that no message holds as a whole: the first of the messages that hold most of their lines in order."""
    passage = ["conv_id", "turn", "pos", "level", "hash"]
    own = rows.where(F.col("turn").isNotNull()).join(sized(written(rest.select("conv_id").distinct(), "partly-quoted")), "conv_id", "left_semi")
    # of messages with the same body the first holds as much as the others
    own = own.groupBy("conv_id", "body").agg(F.min("turn").alias("holder")).select("conv_id", "holder", F.sha2("body", 256).alias("own"), parts(F.col("body")).alias("held"))
    own = written(own, "bodies")
    each = lambda ps: F.explode(F.array_distinct(F.transform(ps, lambda p: p["hash"]))).alias("part")
    pairs = rest.select(*passage, each("parts")).join(own.select("conv_id", "holder", "own", each("held")), ["conv_id", "part"])
    pairs = pairs.where("holder < turn").select(*passage, "holder", "own").distinct()
    both = pairs.join(rest.select(*passage, "parts"), passage).join(own, ["conv_id", "holder", "own"])

    def weighed(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf["n"] = [most_in_order(p, h) for p, h in zip(pdf["parts"], pdf["held"], strict=True)]
            yield pdf[[*passage, "holder", "n"]]

    kinds = dict(pairs.dtypes)
    found = both.mapInPandas(weighed, ", ".join(f"{c} {kinds[c]}" for c in [*passage, "holder"]) + ", n long")
    return found.groupBy(*passage).agg(F.min_by("holder", F.struct(F.negative("n"), "holder")).alias("holder"))


def linked(messages: DataFrame, **columns) -> DataFrame:
    """One row per message: conv_id, turn, role, body, quote_levels, n_quotes, n_linked, reply_to, thread, place."""
    rows = written(parsed(messages, **columns), "messages")
    quotes = rows.where((F.size("passages") > 0) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    quotes = quotes.select("conv_id", "turn", F.posexplode("passages").alias("pos", "p")).select("conv_id", "turn", "pos", "p.level", "p.hash", "p.parts").distinct()
    quotes = written(quotes, "quotes")
    wanted = sized(quotes.select("conv_id").distinct()) if quotes.count() else quotes.select("conv_id")
    # the first message of a conversation that holds a text as its whole body, a paragraph or a line
    texts = F.array_distinct(F.concat(F.array("body"), F.split("body", r"\n\s*\n"), F.split("body", "\n")))
    holders = rows.where(F.col("turn").isNotNull()).join(wanted, "conv_id", "left_semi")
    holders = holders.select("conv_id", "turn", F.explode(F.filter(F.transform(texts, normalised), lambda t: t != "")).alias("t"))
    holders = holders.groupBy("conv_id", F.sha2("t", 256).alias("hash")).agg(F.min("turn").alias("holder"))
    whole = written(quotes.drop("parts").join(holders, ["conv_id", "hash"]).where("holder < turn"), "whole")
    passage = ["conv_id", "turn", "pos", "level", "hash"]
    rest = written(quotes.join(whole, passage, "left_anti"), "rest")
    links = whole.select(*passage, "holder")
    if not rest.isEmpty():
        links = links.unionByName(partly(rest, rows).select(*passage, "holder"))
    links = links.groupBy("conv_id", "turn").agg(F.min_by("holder", F.struct("level", "pos")).alias("reply_to"), F.count_distinct("pos").alias("n_linked"))
    links = written(links, "links")

    roots = thread_roots(links)
    placed = written(links.join(roots, ["conv_id", "turn"]).join(places(links, roots), ["conv_id", "turn"]), "threads")
    out = rows.join(sized(placed), ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "body", "quote_levels", F.size("passages").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "reply_to", F.coalesce("root", "turn").alias("thread"), F.when(F.col("turn").isNotNull(), F.coalesce("place", F.lit(0))).alias("place"),
    )


def thread_roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root) of the messages of links: a root that itself answers something gives way to its own, until none does."""
    roots = links.select("conv_id", "turn", F.col("reply_to").alias("root"))
    while True:
        up = roots.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("_up"))
        nearer = roots.join(up, ["conv_id", "root"], "left").select("conv_id", "turn", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("_moved"))
        nearer = written(nearer, "roots")
        roots = nearer.drop("_moved")
        if nearer.where("_moved").isEmpty():
            return roots


def places(links: DataFrame, roots: DataFrame) -> DataFrame:
    """(conv_id, turn, place) of the messages of links (conv_id, turn, reply_to): their position in the depth-first order of their thread.

    Each message is entered and left. What comes after entering it is its first answer, or its exit; after its exit
    the next answer to the same message, or that message's exit. Following pointers to the end of that list, twice as far in
    each round, counts the entries from each on.
    """
    edges = links.select("conv_id", "turn", F.col("reply_to").alias("up"))
    # the next answer to the same message: within so many turns, or else the first one of the next such stretch
    stretch = edges.withColumn("at", F.floor(F.col("turn") / TURNS))
    firsts = stretch.groupBy("conv_id", "up", "at").agg(F.min("turn").alias("first"))
    firsts = firsts.select("conv_id", "up", "at", F.lead("first").over(Window.partitionBy("conv_id", "up").orderBy("at")).alias("beyond"))
    following = F.lead("turn").over(Window.partitionBy("conv_id", "up", "at").orderBy("turn"))
    edges = stretch.withColumn("next", following).join(firsts, ["conv_id", "up", "at"]).select("conv_id", "turn", "up", F.coalesce("next", "beyond").alias("sibling"))
    children = edges.groupBy("conv_id", F.col("up").alias("turn")).agg(F.min("turn").alias("child"))
    nodes = edges.join(children, ["conv_id", "turn"], "full")

    to = lambda turn, entry: F.struct(turn.alias("turn"), F.lit(entry).alias("entry"))
    entry = F.when(F.col("child").isNotNull(), to(F.col("child"), True)).otherwise(to(F.col("turn"), False))
    leave = F.when(F.col("sibling").isNotNull(), to(F.col("sibling"), True)).when(F.col("up").isNotNull(), to(F.col("up"), False))
    steps = nodes.select("conv_id", F.explode(F.array(F.struct(to(F.col("turn"), True).alias("at"), entry.alias("next")), F.struct(to(F.col("turn"), False).alias("at"), leave.alias("next")))).alias("s"))
    steps = written(steps.select("conv_id", "s.at", "s.next", F.col("s.at.entry").cast("long").alias("n")), "steps")
    while True:
        ahead = steps.select("conv_id", F.col("at").alias("next"), F.col("next").alias("_next"), F.col("n").alias("_n"))
        steps = steps.join(ahead, ["conv_id", "next"], "left").select("conv_id", "at", F.col("_next").alias("next"), (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"))
        steps = written(steps, "steps")
        if steps.where("next is not null").isEmpty():
            break
    # a root counts its whole thread; all others of a thread are counted from its root
    counted = steps.where("at.entry").select("conv_id", F.col("at.turn").alias("turn"), "n")
    size = counted.join(roots.select("conv_id", F.col("root").alias("turn")).distinct(), ["conv_id", "turn"], "left_semi").select("conv_id", F.col("turn").alias("root"), F.col("n").alias("size"))
    out = counted.join(roots, ["conv_id", "turn"]).join(size, ["conv_id", "root"])
    return out.select("conv_id", "turn", (F.col("size") - F.col("n")).alias("place"))


def conversations(messages: DataFrame) -> DataFrame:
    """conv_id, thread, part, messages: the threads of linked messages, each message (place, turn, role, body, reply_to, n) once.

    Messages that repeat all of this count as one, n times. Those with a null conversation or turn are in no conversation.
    """
    known = messages.where("conv_id is not null and turn is not null")
    each = known.groupBy("conv_id", "thread", "place", "turn", "role", "body", "reply_to").agg(F.count(F.lit(1)).alias("n"))
    rows = each.groupBy("conv_id", "thread", F.floor(F.col("place") / PART).alias("part"))
    return rows.agg(F.sort_array(F.collect_list(F.struct("place", "turn", "role", "body", "reply_to", "n"))).alias("messages"))
