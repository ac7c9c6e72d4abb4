"""Tables at the edge: hit tables, matrices, model tables, YAML lists, and the text and table sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import lineage
from ..operators.composition import long, wide
from .onefile import removed, replaced, write_one_file
from .sequences import file_system

HITS = "query string, hit string, score string, identity string"
SAMPLES = "id string, reads array<string>, platform string, references string, error_model string"
# The comment lines of an amplicon taxonomy.
AMPLICON_HEADER = "#cutoff: 0.00:0.08 0.80:0.35 0.95:0.05\n#name: refdb\n#levels: Kingdom Genome Copy"
GENOMES = "entry int, id string, taxonomy string, fasta string"


def read_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A hit table: tab-separated, '#' comments; identity stays text, so that unreadable ones can be judged."""
    raw = spark.read.csv(path, sep="\t", comment="#", quote="", schema=HITS)
    return raw.where("hit is not null and hit <> ''").select("query", "hit", F.expr("try_cast(score AS double)").alias("score"), "identity")


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A square CSV with an index column, as src, dst, p."""
    raw = spark.read.csv(path, header=True)
    raw = raw.withColumnRenamed(raw.columns[0], "src")
    return long(raw, "src", "dst", "p").withColumn("p", F.expr("try_cast(p AS double)"))


def write_matrix(matrix: DataFrame, path: str, ids: DataFrame | None = None, row: str = "src", column: str = "dst", value: str = "p") -> None:
    """A long matrix as CSV with an index column; columns and rows in order.

    ids (the column's name) has a column for each of its values, in order, also for those without an entry. A wide file has
    a column per reference, so this is for matrices of a few thousand.
    """
    names = matrix.select(column) if ids is None else ids.select(column).unionByName(matrix.select(column))
    columns = sorted(r[0] for r in names.distinct().collect())
    wide(matrix, row, column, value, columns).orderBy(row).coalesce(1).write.csv(path, header=True, mode="overwrite")


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """model_id, inference, aic (null where blank) and the row's place: its file, split and record."""
    raw = spark.read.csv(path, header=True)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("record"))
    return raw.select("model_id", "inference", F.expr("try_cast(aic AS double)").alias("aic"), place.alias("ordinal"))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as one file: written under another name, then moved over the old one."""
    fs, part, final = _file_system(spark, path)
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    _moved(fs, [(part, final)])


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path
    final = place(path)
    return final.getFileSystem(spark._jsc.hadoopConfiguration()), place(final.getParent(), f".{uuid.uuid4().hex}.part"), final


def _moved(fs, pairs) -> None:
    for part, final in pairs:
        fs.delete(final, True)
        if not fs.rename(part, final):
            raise OSError(f"{part} could not be moved to {final}")


def moved_in(spark: SparkSession, staged: str, out_dir: str) -> None:
    """Move what a folder holds into another one, over what has the same name there, all or none; the first folder goes."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    source, target = place(staged), place(out_dir)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    done = []
    try:
        for name in sorted(f.getPath().getName() for f in fs.listStatus(source)):
            final, aside = place(target, name), place(target, f".{name}.{uuid.uuid4().hex}.old")
            if old := fs.exists(final):
                fs.rename(final, aside)
            done.append((final, aside if old else None))
            if not fs.rename(place(source, name), final):
                raise OSError(f"{name} could not be moved to {out_dir}")
    except BaseException:
        for final, aside in reversed(done):
            fs.delete(final, True)
            if aside is not None:
                fs.rename(aside, final)
        raise
    for _, aside in done:
        if aside is not None:
            fs.delete(aside, True)
    fs.delete(source, True)


def write_database(rows: DataFrame, header: str, prefix: str) -> tuple[str, str]:
    """A reference set (refseq, sequence, lineage) as the files prefix.fasta and prefix.tax, both or none.

    Rows are in order of entry and ordinal if there are such columns, else of refseq. Both are written under other names first and then
    take the place of older ones together: if anything fails, the older files are there as they were.
    """
    order = [c for c in ("entry", "ordinal") if c in rows.columns] or ["refseq"]
    fasta, tax = f"{prefix}.fasta", f"{prefix}.tax"
    new = [f"{prefix}.{uuid.uuid4().hex}.{kind}" for kind in ("fasta", "tax")]
    try:
        write_fasta(rows, new[0], order=order)
        write_taxonomy(rows, new[1], header, order=order)
        replaced([(new[0], fasta), (new[1], tax)])
    finally:
        for path in new:
            removed(path, file_system(path)[1])
    return fasta, tax


def write_reference(index: DataFrame, translation: DataFrame, folder: str) -> None:
    """The reference tables of an index: amplicons.fasta, amplicons.tax, translation_table.csv, refseq_index.csv."""
    cut = index.where("amplifiable").select("ordinal", "refseq", F.col("amplicon").alias("sequence"), lineage(F.col("refseq")).alias("lineage"))
    write_fasta(cut, f"{folder}/amplicons.fasta", order=["ordinal"])
    write_taxonomy(cut, f"{folder}/amplicons.tax", AMPLICON_HEADER, order=["ordinal"])
    write_matrix(translation, f"{folder}/translation_table.csv", cut.select("refseq"), "genome", "refseq", "weight")
    rows = index.select("refseq", "genome", "amplicon_len", "amplifiable").orderBy("refseq").coalesce(1)
    rows.write.csv(f"{folder}/refseq_index.csv", header=True, mode="overwrite")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """refseq, genome, amplicon_len, amplifiable of a folder that write_reference made."""
    return spark.read.csv(f"{folder}/refseq_index.csv", header=True, schema="refseq string, genome string, amplicon_len int, amplifiable boolean")


def read_samples(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """A sample sheet: a YAML list, or a map with samples; reads or fastq_1 and fastq_2."""
    import yaml

    found = yaml.safe_load(Path(path).read_text())
    found = found.get("samples") if isinstance(found, dict) else found
    if not isinstance(found, list):
        raise ValueError("a sample sheet is a list, or a map with samples")
    at = lambda p: p if p is None or "://" in p or p.startswith("/") else str(Path(base or Path(path).parent) / p)
    rows = []
    for s in found:
        reads = s.get("reads") or [x for x in (s.get("fastq_1"), s.get("fastq_2")) if x]
        reads = [reads] if isinstance(reads, str) else reads
        if not s.get("id") or not reads or not s.get("references"):
            raise ValueError(f"a sample needs id, reads and references: {s}")
        rows.append((str(s["id"]), [at(r) for r in reads], s.get("platform"), at(s["references"]), at(s.get("error_model"))))
    if len({r[0] for r in rows}) < len(rows):
        raise ValueError("sample ids repeat")
    return spark.createDataFrame(rows, SAMPLES)


def read_genomes(spark: SparkSession, path: str) -> DataFrame:
    """A genome list: a YAML map with genomes, each with id, taxonomy and fasta."""
    import yaml

    found = yaml.safe_load(Path(path).read_text())
    if not isinstance(found, dict) or not isinstance(found.get("genomes"), list) or not found["genomes"]:
        raise ValueError("a genome list is a map with genomes")
    rows = []
    for i, g in enumerate(found["genomes"]):
        if not isinstance(g, dict):
            raise ValueError(f"genome {i} is no map")
        fasta = g.get("fasta")
        rows.append((i, g.get("id"), g.get("taxonomy"), None if fasta is None else str(Path(path).parent / fasta)))
    return spark.createDataFrame(rows, GENOMES)


def write_fasta(rows: DataFrame, path: str, name: str = "refseq", sequence: str = "sequence", order: Sequence[str] | None = None) -> None:
    """One file of records of two lines each, in order if one is given; gzipped if path says so."""
    rows = rows.orderBy(*order) if order else rows
    write_one_file(rows.select(F.format_string(">%s\n%s", name, sequence)), path)


def write_fastq(rows: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records of name, sequence, quality; gzipped unless another compression, or none, is asked for."""
    rows.select(F.format_string("@%s\n%s\n+\n%s", "name", "sequence", "quality")).write.option("compression", compression).text(path)


def write_taxonomy(rows: DataFrame, path: str, header: str, order: Sequence[str] = ("refseq",)) -> None:
    """One file: comment lines, then id and lineage in order."""
    write_one_file(rows.orderBy(*order).select(F.concat_ws("\t", "refseq", "lineage")), path, header)


def write_tsv(rows: DataFrame, path: str, order: str) -> None:
    """One tab-separated file with a header."""
    rows.orderBy(order).coalesce(1).write.csv(path, sep="\t", header=True, mode="overwrite")


def model_config(names: DataFrame, column: str = "components") -> DataFrame:
    """Comma lists as {"models": [{"id", "components"}]}: ids are m<place>_<slug>, blank items do not count."""
    items = F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    slug = lambda x: F.lower(F.regexp_replace(x, "[^A-Za-z0-9]", ""))
    models = F.transform(items, lambda x, i: F.struct(F.concat(F.lit("m"), i.cast("string"), F.lit("_"), slug(x)).alias("id"), x.alias("components")))
    return names.withColumn("config", F.when(F.size(items) > 0, F.to_json(F.struct(models.alias("models")))))
