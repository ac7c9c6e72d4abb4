"""All parameters of a run with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..operators.mapper import MapperOptions
from ..operators.posterior import InferenceOptions


@dataclass(frozen=True)
class Options:
    seed: int = 42
    # The primers of the region.
    fwd_primer: str = "GTGYCAGCMGCCGCGGTAA"
    rev_primer: str = "GGACTACNVGGGTWTCTAAT"
    primer_mismatches: int = 3
    trim_primers: bool = True
    sim_error_model: str = "flat"
    flat_sub_rate: float = 0.005
    flat_ins_rate: float = 0.0005
    flat_del_rate: float = 0.0005
    sim_n_per_ref: int = 500
    sim_read_len: int | None = None
    mismapping_matrix: str | None = None
    min_identity: float | None = None
    obs_max_reads: int = 100_000
    error_model_scope: str = "per-sample"
    error_model_max_reads: int = 1_000_000
    mapper: MapperOptions = field(default_factory=MapperOptions)
    infer: InferenceOptions = field(default_factory=InferenceOptions)

    def __post_init__(self):
        if self.sim_error_model not in ("flat", "trained"):
            raise ValueError(f"unknown error model {self.sim_error_model}")
        if self.error_model_scope not in ("per-sample", "pooled"):
            raise ValueError(f"unknown scope {self.error_model_scope}")
        rates = ("flat_sub_rate", "flat_ins_rate", "flat_del_rate")
        if bad := [n for n in rates if not 0 <= getattr(self, n) < 1]:
            raise ValueError(f"{', '.join(bad)}: between zero and one")
        if self.flat_sub_rate + self.flat_del_rate >= 1:
            raise ValueError("substitutions and deletions together stay under one")
        counts = ("primer_mismatches", "obs_max_reads", "error_model_max_reads")
        if bad := [n for n in counts if getattr(self, n) < 0]:
            raise ValueError(f"{', '.join(bad)}: not negative")
        if self.sim_n_per_ref < 1 or (self.sim_read_len is not None and self.sim_read_len < 1):
            raise ValueError("sim_n_per_ref and sim_read_len are at least 1")
        if self.min_identity is not None and not 0 <= self.min_identity <= 1:
            raise ValueError("min_identity lies between zero and one")

    def matrix_settings(self) -> dict[str, object]:
        """What a confusion matrix depends on besides its references and error model."""
        names = ("sim_error_model", "sim_n_per_ref", "sim_read_len", "flat_sub_rate", "flat_ins_rate", "flat_del_rate", "min_identity", "seed")
        return {n: getattr(self, n) for n in names} | {"mapper": str(self.mapper)}
