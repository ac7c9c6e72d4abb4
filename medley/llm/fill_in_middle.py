"""Fill-in-the-middle transformation (DataFrame functions).

A text's units are runs of blanks with the word after them, and blanks at the end. A unit ends where a blank follows a
character that is none, and at the end of the text. Texts are cut into chunks of CHUNK characters, each with one character of the next
one, so that the predicate on adjacent characters sees every boundary exactly once. Boundaries are counted per chunk; running sums of
the counts tell which chunk owns each of the two cut ranks, and only those chunks are scanned again for the cuts' places.

All of it is a map over rows: no shuffle, and each step of a text takes time linear in its length. Chunks bound what a
step looks at, not what a row holds, since a row's result is the whole text in another order.

Which texts are changed, how and where they are cut follows from SHA-256 of seed and id. The result can be turned back:
restored() rebuilds the text from output and form alone.

Defined results: a null text counts as empty; empty texts, those that hold a mark, and a share of all others stay plain; a null id
hashes like an empty one; rows that repeat an id are cut by the same hashes, each by its own units; an empty table gives an empty
result; other columns pass through, and may have any name that does not begin with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK, OTHER = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
CHUNK = 4096
#: Percent of texts that are transformed, and percent of those in suffix-prefix-middle order.
RATE, SUFFIX_FIRST = 50, 80
OWNER = "struct<sum:bigint,chunk:int,lo:int,lo_rank:bigint,hi:int,hi_rank:bigint>"


def boundaries(piece: Column) -> Column:
    """How many units end before the last character of a piece: a pair of word end and blank becomes one character."""
    return (F.length(piece) - F.length(F.regexp_replace(piece, OTHER + BLANK, "."))).cast("long")


def owners(counts: Column, lo: Column, hi: Column) -> Column:
    """The chunks that hold the boundaries of rank lo and hi, with the ranks within them (null: no chunk does)."""

    def step(acc: Column, c: Column) -> Column:
        upto = acc["sum"] + c
        here = lambda rank, name: F.when((acc["sum"] < rank) & (rank <= upto), acc["chunk"]).otherwise(acc[name])
        within = lambda rank, name: F.when((acc["sum"] < rank) & (rank <= upto), rank - acc["sum"]).otherwise(acc[name])
        fields = (upto.alias("sum"), (acc["chunk"] + 1).alias("chunk"), here(lo, "lo").alias("lo"), within(lo, "lo_rank").alias("lo_rank"), here(hi, "hi").alias("hi"), within(hi, "hi_rank").alias("hi_rank"))
        return F.struct(*fields).cast(OWNER)

    nothing = F.lit(None)
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("chunk"), nothing.alias("lo"), nothing.alias("lo_rank"), nothing.alias("hi"), nothing.alias("hi_rank")).cast(OWNER)
    return F.aggregate(counts, start, step)


def place(pieces: Column, chunk: Column, rank: Column, size: int) -> Column:
    """The place of the boundary of a rank within a chunk: the length of what ends there, from the chunk's start."""
    ending = F.regexp_extract_all(F.get(pieces, chunk), F.lit(f"{BLANK}*{OTHER}+(?={BLANK})"), F.lit(0))
    return chunk * size + F.aggregate(F.slice(ending, F.lit(1), rank.cast("int")), F.lit(0), lambda acc, x: acc + F.length(x))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of."""
    parts = F.split(output, MARKS, -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)


def transformed(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, chunk: int = CHUNK) -> DataFrame:
    """docs with _fim: output, form (plain, psm or spm), n (units), prefix_chars and middle_chars (null if plain).

    Each step is a column of its own, so that it is evaluated once.
    """
    t, pieces, n, lo, hi, at = (F.col(f"_{c}") for c in ("t", "pieces", "n", "lo", "hi", "at"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    drawn = lambda i: F.conv(F.substring("_digest", 8 * i - 7, 8), 16, 10).cast("long")
    out = docs.withColumn("_t", F.coalesce(docs[text], F.lit(""))).withColumn("_digest", digest)
    out = out.withColumn("_chunks", F.regexp_extract_all("_t", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)))
    chunks = F.col("_chunks")
    out = out.withColumn("_pieces", F.transform(chunks, lambda c, i: F.concat(c, F.left(F.coalesce(F.get(chunks, i + 1), F.lit("")), F.lit(1)))))
    out = out.withColumn("_counts", F.transform(pieces, boundaries))
    out = out.withColumn("_n", F.when(t == "", F.lit(0).cast("long")).otherwise(F.aggregate("_counts", F.lit(1).cast("long"), lambda acc, c: acc + c)))
    out = out.withColumns({"_a": drawn(1) % (n + 1), "_b": drawn(2) % (n + 1)})
    out = out.withColumns({"_lo": F.least("_a", "_b"), "_hi": F.greatest("_a", "_b")})
    plain = (t == "") | t.rlike(MARKS) | (drawn(3) % 100 >= rate)
    out = out.withColumn("_form", F.when(plain, "plain").when(drawn(4) % 100 < suffix_first, "spm").otherwise("psm"))
    changed = F.col("_form") != "plain"
    out = out.withColumn("_at", F.when(changed, owners(F.col("_counts"), lo, hi)))
    # the ranks 0 and n are the ends of the text, whatever the chunks say
    cut = lambda rank, name: F.when(rank == 0, F.lit(0)).when(rank == n, F.length(t)).otherwise(place(pieces, at[name], at[f"{name}_rank"], chunk))
    out = out.withColumns({"_first": F.when(changed, cut(lo, "lo")), "_second": F.when(changed, cut(hi, "hi"))})
    first, second = F.col("_first"), F.col("_second")
    prefix, middle, suffix = F.substring(t, F.lit(1), first), F.substring(t, first + 1, second - first), F.substring(t, second + 1, F.length(t))
    p, s, m = F.concat(F.lit(PREFIX), prefix), F.concat(F.lit(SUFFIX), suffix), F.concat(F.lit(MIDDLE), middle)
    output = F.when(F.col("_form") == "psm", F.concat(p, s, m)).when(F.col("_form") == "spm", F.concat(s, p, m)).otherwise(t)
    fields = (output.alias("output"), F.col("_form").alias("form"), n.alias("n"), first.cast("long").alias("prefix_chars"), (second - first).cast("long").alias("middle_chars"))
    return out.select(*docs.columns, F.struct(*fields).alias("_fim"))


def middle_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: units, form, lengths, and the digests of the output and of the text that it gives back."""
    out = transformed(docs.select("doc_id", "text"), **options)
    x = F.col("_fim")
    return out.select(
        "doc_id", x["n"].alias("n"), x["form"].alias("form"), x["prefix_chars"].alias("prefix_chars"), x["middle_chars"].alias("middle_chars"),
        F.sha2(x["output"], 256).alias("output_sha256"), F.sha2(restored(x["output"], x["form"]), 256).alias("restored_sha256"),
    )
