"""Phenotypes: wide sheets to one value for each sample and location."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(c, digits: int = 3):
    """Halves go to the even neighbour of the scaled value."""
    return F.rint(c * 10**digits) / 10**digits


def melt(sheet: DataFrame, trait: str, sample: str = "sample") -> DataFrame:
    """sample, trait, year, location, value of the columns TRAIT_year_location; nulls are dropped."""
    columns = [c for c in sheet.columns if c != sample and trait in c]
    if bad := [c for c in columns if len(c.split("_")) != 3]:
        raise ValueError(f"columns are not TRAIT_year_location: {bad[:20]}")
    if not columns:
        raise ValueError(f"no column of trait {trait}")
    long = sheet.select(
        sample, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns]
    ).unpivot(sample, [F.col(f"`{c}`") for c in columns], "__name", "value")
    part = F.split("__name", "_")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value")).select(
        F.col(sample).alias("sample"), F.get(part, F.lit(0)).alias("trait"), F.get(part, F.lit(1)).alias("year"),
        F.get(part, F.lit(2)).alias("location"), "value"
    )


def location_means(rows: DataFrame) -> DataFrame:
    """sample, location, value: means over the years, to three digits."""
    return rows.groupBy("sample", "location").agg(rounded(F.avg("value")).alias("value"))


def one_hot(rows: DataFrame, column: str, values: Sequence[str] | None = None, prefix: str = "loc") -> DataFrame:
    """rows with a 0/1 column for each value in place of the column; by default the sorted values it has, which
    are few, such as locations."""
    values = sorted(r[0] for r in rows.select(column).distinct().collect() if r[0] is not None) if values is None else values
    return rows.select(
        "*", *[F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{prefix}_{v}") for v in values]
    ).drop(column)


def process_trait(sheet: DataFrame, trait: str, sample: str = "sample") -> DataFrame:
    """sample, value, loc_*: one trait of a sheet."""
    return one_hot(location_means(melt(sheet, trait, sample)), "location")


def location_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if re.match("loc", c)]
