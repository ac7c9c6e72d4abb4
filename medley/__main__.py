"""Command line: run, matrix, hits and database."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from .operators.mapper import MapperOptions
from .operators.posterior import InferenceOptions
from .plans.options import Options


def _add_shared(p: argparse.ArgumentParser) -> None:
    p.add_argument("--outdir", required=True)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--min-identity", type=float)


def _add_simulation(p: argparse.ArgumentParser) -> None:
    p.add_argument("--fwd-primer", default=Options.fwd_primer)
    p.add_argument("--rev-primer", default=Options.rev_primer)
    p.add_argument("--primer-mismatches", type=int, default=3)
    p.add_argument("--sim-error-model", choices=["flat", "trained"], default="flat")
    p.add_argument("--flat-sub-rate", type=float, default=0.005)
    p.add_argument("--flat-ins-rate", type=float, default=0.0005)
    p.add_argument("--flat-del-rate", type=float, default=0.0005)
    p.add_argument("--sim-n-per-ref", type=int, default=500)
    p.add_argument("--sim-read-len", type=int)
    p.add_argument("--kmer", type=int, default=11)


def _add_inference(p: argparse.ArgumentParser) -> None:
    p.add_argument("--mode", choices=["vi", "mle", "nuts"], default="vi")
    p.add_argument("--alpha", type=float, default=0.5)
    p.add_argument("--steps", type=int, default=3000)
    p.add_argument("--lr", type=float, default=0.02)
    p.add_argument("--num-samples", type=int, default=500)
    p.add_argument("--warmup", type=int, default=500)
    p.add_argument("--no-mismapping", action="store_true")
    p.add_argument("--no-presence", action="store_true")
    p.add_argument("--presence-prior", type=float, default=0.01)
    p.add_argument("--presence-temp", type=float, default=1.0)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="medley", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="a sample sheet to compositions")
    run.add_argument("--input", required=True)
    run.add_argument("--no-trim-primers", action="store_true")
    run.add_argument("--obs-max-reads", type=int, default=100_000)
    run.add_argument("--mismapping-matrix")
    run.add_argument("--error-model-scope", choices=["per-sample", "pooled"], default=Options.error_model_scope)
    run.add_argument("--error-model-max-reads", type=int, default=Options.error_model_max_reads)
    matrix = commands.add_parser("matrix", help="the confusion matrix of a reference file")
    matrix.add_argument("--references", required=True)
    hits = commands.add_parser("hits", help="hit tables of one sample to its composition")
    hits.add_argument("--reference-dir", required=True, help="a folder with the reference tables of a bundle")
    source = hits.add_mutually_exclusive_group(required=True)
    source.add_argument("--simulated", nargs="+", help="hit tables of simulated reads")
    source.add_argument("--mismapping-matrix")
    hits.add_argument("--observed", nargs="+", help="hit tables of the sample's reads")
    hits.add_argument("--build-mismapping", action="store_true", help="write the matrix and stop")
    hits.add_argument("--sample-id", default="sample")
    database = commands.add_parser("database", help="a genome list to a reference set")
    database.add_argument("--genomes", required=True)
    database.add_argument("--prefix", required=True)
    for p in (run, matrix, hits):
        _add_shared(p)
    for p in (run, matrix):
        _add_simulation(p)
    for p in (run, hits):
        _add_inference(p)
    return top


def options(a: argparse.Namespace) -> Options:
    """The options that a command names; ranges are checked where they are held."""
    given = vars(a)
    pick = lambda *names: {n: given[n] for n in names if n in given}
    more: dict = pick("seed", "fwd_primer", "rev_primer", "primer_mismatches", "sim_error_model", "flat_sub_rate", "flat_ins_rate", "flat_del_rate", "sim_n_per_ref", "sim_read_len", "obs_max_reads", "mismapping_matrix", "min_identity", "error_model_scope", "error_model_max_reads")
    if "no_trim_primers" in given:
        more["trim_primers"] = not a.no_trim_primers
    if "kmer" in given:
        more["mapper"] = MapperOptions(k=a.kmer)
    if "mode" in given:
        fit = pick("mode", "alpha", "steps", "lr", "num_samples", "warmup", "presence_prior", "presence_temp", "seed")
        more["infer"] = InferenceOptions(**fit, presence=not a.no_presence, use_mismapping=not a.no_mismapping)
    return Options(**more)


def main(argv: Sequence[str] | None = None, spark=None) -> None:
    top = parser()
    a = top.parse_args(argv)
    if a.command == "hits":
        if a.build_mismapping and not a.simulated:
            top.error("--build-mismapping needs --simulated")
        if not a.build_mismapping and not a.observed:
            top.error("--observed is required, unless --build-mismapping is given")
    o = None
    if a.command != "database":
        try:
            o = options(a)
        except ValueError as e:
            top.error(str(e))
    from pyspark.sql import SparkSession

    from .operators.database import genome_records
    from .plans import run
    from .sources import tables

    spark = spark or SparkSession.builder.appName("medley").getOrCreate()
    if a.command == "run":
        run.run_samples(spark, tables.read_samples(spark, a.input), a.outdir, o)
    elif a.command == "matrix":
        run.run_matrix(spark, a.references, a.outdir, o)
    elif a.command == "hits":
        run.run_hits(spark, a.reference_dir, a.outdir, observed=[] if a.build_mismapping else a.observed, simulated=a.simulated, o=o, sample=a.sample_id)
    else:
        rows, header = genome_records(spark, tables.read_genomes(spark, a.genomes))
        tables.write_database(rows, header, a.prefix)


if __name__ == "__main__":
    main()
