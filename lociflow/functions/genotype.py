"""Genotype calls and variant types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_gt(gt: Column) -> Column:
    """Alternative alleles of a call (``0/1``, ``1|1``, ``1``), two at most; 0 if any allele is missing."""
    alleles = F.split(gt, r"[/|]")
    missing = gt.isNull() | F.exists(alleles, lambda a: (a == ".") | (a == ""))
    count = F.size(F.filter(alleles, lambda a: a != "0"))
    return F.when(missing, 0).otherwise(F.least(count, F.lit(2))).cast("tinyint")


def variant_type(ref: Column, alt: Column) -> Column:
    r, a = F.length(ref), F.length(alt)
    return F.when((r == 1) & (a == 1), "SNV").when(r == a, "MNV").when(r < a, "Insertion").when(r > a, "Deletion")


def weighted(dosage: Column, effect: Column) -> Column:
    """Dosage times effect in single precision; a missing effect is 0."""
    return (dosage.cast("float") * F.coalesce(effect, F.lit(0.0)).cast("float")).cast("float")
