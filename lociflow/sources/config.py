"""Configuration files and checked settings."""

from __future__ import annotations

import argparse
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from pathlib import Path


#: Settings of several values, and of keys with values.
LISTS, MAPPINGS = ("gff3_feature", "selected_classes", "traits"), ("embedder_options",)


def scalar(text: str):
    """A value written in a flat configuration: number, boolean, null, or text with or without quotes."""
    t = text.strip()
    if len(t) > 1 and t[0] == t[-1] and t[0] in "'\"":
        return t[1:-1]
    low = t.lower()
    if low in ("", "null", "none", "~"):
        return None
    if low in ("true", "false"):
        return low == "true"
    if re.fullmatch(r"[+-]?[0-9]+", t):
        return int(t)
    try:
        return float(t)
    except ValueError:
        return t


def load_yaml(path: str) -> dict:
    """A mapping from a YAML file; without a YAML library, from lines of ``key: value``."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        out = {}
        for line in text.splitlines():
            line = re.sub(r"(^|\s)#.*$", "", line)
            if line.strip():
                key, colon, value = line.partition(":")
                if not colon:
                    raise ValueError(f"not a line of key: value: {line!r}") from None
                out[key.strip()] = scalar(value)
        return out
    loaded = yaml.safe_load(text) or {}
    if not isinstance(loaded, dict):
        raise ValueError(f"{path} holds no mapping")
    return loaded


def require(config: Mapping, key: str):
    if config.get(key) in (None, ""):
        raise ValueError(f"the configuration lacks {key}")
    return config[key]


def merge(config: Mapping, args: argparse.Namespace, parser: argparse.ArgumentParser) -> argparse.Namespace:
    """Command line over file over defaults: an argument counts where it differs from its default."""
    known = {a.dest for a in parser._actions}
    if unknown := sorted(set(config) - known):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    given = {k: v for k, v in vars(args).items() if v != parser.get_default(k)}
    return argparse.Namespace(**{**vars(args), **config, **given})


def of(cls, config: Mapping):
    """A settings object from a mapping; keys that it does not know are an error."""
    names = {f.name for f in fields(cls)}
    if unknown := sorted(set(config) - names):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return cls(**config)


@dataclass(frozen=True)
class BuilderConfig:
    vcf_path: str
    fasta_path: str
    gff3_path: str
    gwas_path: str
    qtl_path: str
    outdir: str
    type: str = "union"
    gff3_feature: str | Sequence[str] = "gene"
    use_gffutils: bool = False
    ext_len: int = 0
    k: int = 100
    max_pvalue: float = 1e6
    min_lod: float = 0.0
    min_pve: float = 0.0
    gene_list_path: str | None = None
    isolated_samples_path: str | None = None
    split: bool = False
    test_ratio: float = 0.2
    seed: int = 42
    embedder: str = "kmer"
    embedder_options: Mapping | None = None
    wide: bool = True
    resume: bool = True

    def __post_init__(self) -> None:
        if self.type not in ("union", "intersect"):
            raise ValueError("type must be union or intersect")
        if self.ext_len < 0 or self.k < 0:
            raise ValueError("ext_len and k must not be negative")
        if not 0 < self.test_ratio < 1:
            raise ValueError("test_ratio must lie between 0 and 1")


@dataclass(frozen=True)
class ScorerConfig:
    vcf_path: str
    fasta_path: str
    outdir: str
    k: int = 100
    embedder: str = "kmer"
    embedder_options: Mapping | None = None


@dataclass(frozen=True)
class PhenotypeConfig:
    sheet_file: str
    outdir: str
    sheet: str = "triple_data"
    traits: Sequence[str] | None = None
    stamp: str | None = None


@dataclass(frozen=True)
class SimulatorConfig:
    genotype_file: str
    phenotype_file: str
    feature_importance_file: str
    variant_effect_file: str
    sample_id: str
    outdir: str
    model_file: str | None = None
    top_n: int = 10
    rank_order: str = "desc"
    allow_pickle: bool = False
    most_points: int | None = None
    log_level: str = "INFO"

    def __post_init__(self) -> None:
        if self.rank_order not in ("desc", "asc"):
            raise ValueError("rank_order must be desc or asc")
        if self.top_n <= 0:
            raise ValueError("top_n must be positive")
