"""Genotypes in long form: one row for each site and sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociflow.functions.genotype import encode_gt, weighted
from lociflow.functions.names import site_id, standard_sample


def first_by(rows: DataFrame, keys: Sequence[str], *order) -> DataFrame:
    """The first row of each key by the columns of ``order``: combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    least = F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return rows.groupBy(*keys).agg(least).select(*keys, "__row.*").select(*rows.columns)


def last_values(rows: DataFrame, keys: Sequence[str], order: str, *values: str) -> DataFrame:
    """Of each key the values of the row that comes last: combined before the shuffle."""
    return rows.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])


def standard_samples(samples: DataFrame) -> DataFrame:
    """raw_sample, sample from (idx, raw_sample), idx counting from 0: names without a number are numbered by
    their place, and a name that came before gets its place appended."""
    named = samples.withColumn(
        "__base", F.coalesce(standard_sample(F.col("raw_sample")), F.format_string("sample_%d", F.col("idx") + 1))
    )
    again = F.row_number().over(Window.partitionBy("__base").orderBy("idx")) > 1
    return named.select(
        "idx", "raw_sample",
        F.when(
            again, F.concat("__base", F.lit("_"), (F.col("idx") + 1).cast("string"))
        ).otherwise(F.col("__base")).alias("sample")
    )


def long_genotypes(calls: DataFrame, sites: DataFrame) -> DataFrame:
    """site_id, chrom, pos, sample, dosage of the sites wanted, from calls (chrom, pos, ord, sample, gt). Of
    records at one position the last counts."""
    wanted = calls.join(sites.select("chrom", "pos").distinct(), ["chrom", "pos"], "left_semi")
    last = last_values(wanted, ["chrom", "pos", "sample"], "ord", "gt")
    return last.select(
        site_id(F.col("chrom"), F.col("pos")).alias("site_id"), "chrom", "pos", "sample",
        encode_gt(F.col("gt")).alias("dosage")
    )


def wide(rows: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str], fill=None) -> DataFrame:
    """One column for each name, in the order given; the names are data of known size, such as a sample list."""
    out = rows.groupBy(*keys).pivot(name, list(names)).agg(F.first(value))
    return out if fill is None else out.fillna(fill, list(names))


def effect_matrix(genotypes: DataFrame, effects: DataFrame) -> DataFrame:
    """site_id, sample, value: dosage times the site's effect, 0 where there is none."""
    return genotypes.join(effects.select("site_id", "var_effect"), "site_id", "left").select(
        "site_id", "sample", weighted(F.col("dosage"), F.col("var_effect")).alias("value")
    )
