"""Chromosome, sample and site names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Chromosomes without a number sort last.
NO_NUMBER = 1_000_000_000


def strip(c: Column) -> Column:
    """Without white space at both ends, as Python's ``str.strip`` does for ASCII (SQL's trim takes spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def first_number(c: Column) -> Column:
    """First run of digits without leading zeros, as text of any length; null if there is none."""
    digits = F.regexp_extract(c, r"([0-9]+)", 1)
    return F.regexp_replace(F.when(digits != "", digits), r"^0+(?=[0-9])", "")


def standard_chrom(c: Column) -> Column:
    """``1``, ``chr1``, ``chr_01`` become ``Chr1``; names without a digit become null."""
    return F.concat(F.lit("Chr"), first_number(c))


def standard_sample(c: Column) -> Column:
    """``1``, ``Sample_01`` become ``sample_1``; names without a digit become null."""
    return F.concat(F.lit("sample_"), first_number(c))


def site_id(chrom: Column, pos: Column) -> Column:
    return F.concat_ws(":", chrom, pos.cast("string"))


def allele_site_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat(chrom, F.lit(":"), pos.cast("string"), F.lit(":"), ref, F.lit(">"), alt)


def chrom_order(chrom: Column) -> Column:
    """Sort key of a standard name: its number."""
    return F.coalesce(F.regexp_extract(chrom, r"^Chr([0-9]+)$", 1).try_cast("long"), F.lit(NO_NUMBER))


def empty_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", strip(c))


def first_of(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[empty_to_null(c) for c in columns])
