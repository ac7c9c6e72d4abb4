"""A whole run: amplicons, simulation, mapping, confusion matrix, observed counts, composition.

Samples that share a matrix key share one matrix: groups are formed from the content of their references and the
settings before anything is simulated, and each group is simulated and mapped once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import sized, written
from ..functions.sequence import trimmed_read
from ..operators import composition as C
from ..operators import provenance as V
from ..operators.database import amplified, reference_index
from ..operators.error_model import model_reads, read_model, trained_model, write_model
from ..operators.mapper import ReferenceIndex, cluster_references, map_reads, usable_hits
from ..operators.posterior import diagnostics, infer
from ..operators.sampling import reservoir, running_index, simulated_reads
from ..operators.validation import matrix_violations, require, sample_violations
from ..sources import tables
from ..sources.sequences import register
from .options import Options


#: The columns of reads that a run uses.
READS = "file_no int, ordinal long, name string, sequence string"


@dataclass
class Result:
    composition: DataFrame
    loss: DataFrame
    diagnostics: DataFrame
    matrix: DataFrame
    #: src, dst, n of simulated reads that are left out of the matrix, as their source or hit is no reference.
    unknown: DataFrame
    translation: DataFrame
    index: DataFrame
    #: The error model that reads were simulated by; None if it was flat or a matrix was supplied.
    model: DataFrame | None = None


def prepared_reads(reads: DataFrame, o: Options, most: int | None = None, by: Sequence[str] = ("sample",)) -> DataFrame:
    """sample, query, sequence: at most so many reads per sample (or of all, if by is empty), trimmed to the amplicon, empty ones left out.

    The names get the running index of the reads that are left, in order of file and record.
    """
    reads = reservoir(reads, o.obs_max_reads if most is None else most, o.seed, ["sample", "file_no", "ordinal"], by)
    if o.trim_primers:
        reads = reads.withColumn("sequence", trimmed_read(F.col("sequence"), o.fwd_primer, o.rev_primer, o.primer_mismatches))
    reads = written(reads.where(F.length("sequence") > 0).select("sample", "file_no", "ordinal", "name", "sequence"), "reads")
    numbered = running_index(reads, "sample", "file_no", "ordinal", into="at")
    return numbered.select("sample", F.concat_ws("_", "name", "at").alias("read"), F.concat_ws("\t", "sample", F.concat_ws("_", "name", "at")).alias("query"), "sequence")


def simulated_hits(refs: DataFrame, index: ReferenceIndex, o: Options, model: DataFrame | None = None) -> DataFrame:
    """Usable hits of reads that are simulated of every reference (refseq, sequence), by a model or the flat rates."""
    if model is not None:
        reads = model_reads(refs, model, o.sim_n_per_ref, o.seed, read_len=o.sim_read_len)
    elif o.sim_error_model == "flat":
        reads = simulated_reads(refs, o.sim_n_per_ref, o.seed, read_len=o.sim_read_len, sub=o.flat_sub_rate, ins=o.flat_ins_rate, dele=o.flat_del_rate)
    else:
        raise ValueError("a trained error model needs reads to be trained on")
    return usable_hits(map_reads(reads.select(F.col("name").alias("query"), "sequence"), index, o.mapper), o.min_identity)


def build_matrix(refs: DataFrame, o: Options, index: ReferenceIndex | None = None, model: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The confusion matrix (src, dst, p) of references (refseq, sequence), and the counts of what it leaves out."""
    hits = written(simulated_hits(refs, index or cluster_references(refs, o.mapper), o, model).select("query", "hit"), "simulated-hits")
    return written(C.row_stochastic(C.confusion_counts(hits, refs), refs), "matrix"), C.unknown_counts(hits, refs)


def mapped(seqs: DataFrame, clustered: ReferenceIndex, o: Options) -> DataFrame:
    return written(usable_hits(map_reads(seqs.select("query", "sequence"), clustered, o.mapper), o.min_identity), "hits")


def learned(seqs: DataFrame, hits: DataFrame, refs: DataFrame) -> DataFrame:
    """The error model of reads (query, sequence) with their hits."""
    pairs = hits.select("query", F.col("hit").alias("refseq")).join(seqs.select("query", F.col("sequence").alias("read")), "query")
    return written(trained_model(pairs.join(sized(refs.select("refseq", F.col("sequence").alias("reference"))), "refseq")), "error-model")


def compose(reads: DataFrame, references: DataFrame, o: Options = Options(), matrix: DataFrame | None = None, group_id: str | None = None, matrix_path: str | None = None, model: DataFrame | None = None, training: DataFrame | None = None) -> Result:
    """Compositions of all samples of one reference set.

    reads: sample, file_no, ordinal, name, sequence; references: ordinal, header, sequence; matrix: a supplied src, dst, p; model: a
    supplied error model. A trained model is learned from training (columns of reads), by default from the reads themselves.
    """
    index = written(reference_index(references, o.fwd_primer, o.rev_primer, o.primer_mismatches), "index")
    refs = written(amplified(index), "amplicons")
    clustered = cluster_references(refs, o.mapper)
    translation = C.translation_table(refs.select("refseq", "genome"))
    seqs = prepared_reads(reads, o)
    hits = mapped(seqs, clustered, o)
    if matrix is None:
        if o.sim_error_model == "trained" and model is None:
            if training is None:
                model = learned(seqs, hits, refs)
            else:
                pooled = prepared_reads(training, o, o.error_model_max_reads, ())
                model = learned(pooled, mapped(pooled, clustered, o), refs)
        matrix, unknown = build_matrix(refs, o, clustered, model)
    else:
        require(matrix_violations(matrix, refs), "supplied matrix")
        unknown, model = refs.sparkSession.createDataFrame([], "src string, dst string, n long"), None
    named = hits.withColumn("sample", F.split_part("query", F.lit("\t"), F.lit(1)))
    observed = written(C.observed_counts(named, refs, ["sample"]), "observed")
    fits = infer(observed, translation, matrix, o.infer)
    facts = diagnostics(observed, C.mean_diagonal(matrix, refs), o.infer, fits, o.min_identity, group_id, matrix_path or o.mismapping_matrix)
    return Result(fits.composition, fits.loss, facts, matrix, unknown, translation, index, model)


def matrix_plan(samples: DataFrame, amplicons: DataFrame, o: Options) -> DataFrame:
    """Matrix groups of samples (id, platform, references, error_model); amplicons: references, ordinal, refseq, sequence."""
    require(sample_violations(samples), "samples")
    refs = V.content_hash(amplicons, ["references"], "ordinal", "refseq", "sequence")
    named = V.model_identity(samples, o.sim_error_model, o.error_model_scope, o.mismapping_matrix).join(refs, "references")
    # samples share a supplied model only if it is the same one
    own = (F.col("identity") == "supplied") & F.lit(o.mismapping_matrix is None)
    named = named.withColumn("identity", F.when(own, F.concat_ws(":", "identity", "error_model")).otherwise(F.col("identity")))
    keyed = named.withColumn("matrix_key", V.matrix_key(F.col("reference_sha256"), V.settings_text(o.matrix_settings()), F.col("identity")))
    return V.matrix_groups(keyed)


def read_references(spark: SparkSession, paths: list[str]) -> DataFrame:
    """FASTA files as references (the path), ordinal, header, sequence."""
    each = [spark.read.format("fasta").option("strict", "true").load(p).withColumn("references", F.lit(p)) for p in paths]
    return reduce(DataFrame.unionByName, each)


def run_samples(spark: SparkSession, samples: DataFrame, out_dir: str, o: Options = Options()) -> None:
    """Samples of a sheet to out_dir, one matrix per group of samples that share references and settings.

    Each group has a bundle in mismapping/<matrix key>, and groups.tsv lists them. Each sample has its CSV tables in
    samples/sample=<id>. Under a trained error model each sample has its own, or its platform's (from the reads of all its samples), or the
    one that the sheet names for it. Results are written beside out_dir's and take their place at the end: a run that fails leaves the old ones.
    """
    staged = f"{out_dir}/.run-{uuid.uuid4().hex}"
    register(spark)
    sheet = {s["id"]: s for s in samples.collect()}  # a sample sheet, a few hundred rows
    references = read_references(spark, sorted({s["references"] for s in sheet.values()}))
    cut = reference_index(references, o.fwd_primer, o.rev_primer, o.primer_mismatches, keep=["references"])
    amplicons = cut.where("amplifiable").withColumnRenamed("amplicon", "sequence")
    groups = written(matrix_plan(samples, amplicons, o), "groups")
    found = groups.collect()
    if lost := set(sheet) - {m["id"] for g in found for m in g["members"]}:
        raise ValueError(f"no reference amplifies for samples {sorted(lost)}")
    supplied = tables.read_matrix(spark, o.mismapping_matrix) if o.mismapping_matrix else None
    papers = {r["matrix_key"]: r["provenance"] for r in V.provenance(groups, o.matrix_settings()).collect()}
    for g in found:
        reads_of = lambda ids: reduce(DataFrame.unionByName, [spark.read.schema(READS).format("fastq").load(",".join(sheet[i]["reads"])).withColumn("sample", F.lit(i)) for i in ids])
        refs = references.where(F.col("references") == sheet[g["representative"]]["references"]).drop("references")
        key, at = g["matrix_key"], f"mismapping/{g['matrix_key']}/mismapping_matrix.csv"
        lead, model, training = sheet[g["representative"]], None, None
        if o.sim_error_model == "trained" and supplied is None:
            if lead["error_model"]:
                model = read_model(spark, lead["error_model"])
            elif o.error_model_scope == "pooled":
                training = reads_of([i for i, s in sheet.items() if s["platform"] == lead["platform"] and not s["error_model"]])
        result = compose(reads_of([m["id"] for m in g["members"]]), refs, o, supplied, key, at, model, training)
        write_bundle(result, f"{staged}/mismapping/{key}", papers[key], V.group_members(groups.where(F.col("matrix_key") == key)))
        for name, df in (("inferred_composition", result.composition), ("inference_diagnostics", flat(result.diagnostics)), ("loss_trace", result.loss)):
            df.write.mode("append").partitionBy("sample").csv(f"{staged}/samples/{name}", header=True)
    tables.write_tsv(V.group_records(groups), f"{staged}/mismapping/groups.tsv", "matrix_key")
    tables.moved_in(spark, staged, out_dir)


def flat(facts: DataFrame) -> DataFrame:
    """Diagnostics with the fit's own figures as one JSON column, for text tables."""
    return facts.withColumn("extra", F.to_json("extra"))


def write_bundle(result: Result, folder: str, paper: str, members: DataFrame) -> None:
    """A matrix with its provenance, its samples and the reference tables that it was made from."""
    spark, refs = members.sparkSession, result.index.where("amplifiable")
    tables.write_matrix(result.matrix, f"{folder}/mismapping_matrix.csv", refs.select(F.col("refseq").alias("dst")))
    tables.write_tsv(members.select("sample_id", "platform"), f"{folder}/samples.tsv", "sample_id")
    tables.write_text(spark, f"{folder}/provenance.json", paper + "\n")
    tables.write_tsv(result.unknown, f"{folder}/unknown_hits.tsv", "src")
    if result.model is not None:
        write_model(result.model, f"{folder}/error_model.csv")
    tables.write_reference(result.index, result.translation, f"{folder}/reference")


def run_matrix(spark: SparkSession, references: str, out_dir: str, o: Options = Options()) -> None:
    """The confusion matrix of a reference file alone, as CSV, with the reference tables."""
    register(spark)
    index = written(reference_index(read_references(spark, [references]), o.fwd_primer, o.rev_primer, o.primer_mismatches), "index")
    refs = written(amplified(index), "amplicons")
    matrix, unknown = build_matrix(refs, o)
    tables.write_matrix(matrix, f"{out_dir}/mismapping_matrix.csv", refs.select(F.col("refseq").alias("dst")))
    tables.write_tsv(unknown, f"{out_dir}/unknown_hits.tsv", "src")
    tables.write_reference(index, C.translation_table(refs.select("refseq", "genome")), f"{out_dir}/reference")


def run_hits(spark: SparkSession, reference: str, out_dir: str, *, observed: list[str], simulated: list[str] | None = None, o: Options = Options(), sample: str = "sample") -> None:
    """The composition of one sample from hit tables that another mapper made; reference: a folder of write_reference."""
    refs = written(tables.read_index(spark, reference).where("amplifiable"), "references")
    if simulated:
        hits = usable_hits(tables.read_hits(spark, simulated), o.min_identity)
        matrix = written(C.row_stochastic(C.confusion_counts(hits, refs), refs), "matrix")
    else:
        matrix = written(tables.read_matrix(spark, o.mismapping_matrix), "matrix")
        require(matrix_violations(matrix, refs), "supplied matrix")
    tables.write_matrix(matrix, f"{out_dir}/mismapping_matrix.csv", refs.select(F.col("refseq").alias("dst")))
    if not observed:
        return
    hits = usable_hits(tables.read_hits(spark, observed), o.min_identity).withColumn("sample", F.lit(sample))
    counts = written(C.observed_counts(hits, refs, ["sample"]), "observed")
    fits = infer(counts, C.translation_table(refs.select("refseq", "genome")), matrix, o.infer)
    facts = diagnostics(counts, C.mean_diagonal(matrix, refs), o.infer, fits, o.min_identity, None, o.mismapping_matrix)
    for name, df, order in (("inferred_composition", fits.composition, "genome_id"), ("inference_diagnostics", flat(facts), "sample"), ("loss_trace", fits.loss, "step")):
        df.orderBy(order).coalesce(1).write.mode("overwrite").csv(f"{out_dir}/{name}", header=True)


def with_inference(o: Options, **changes) -> Options:
    return replace(o, infer=replace(o.infer, **changes))
