"""All combinations of genotypes at a few sites, and the ranking of what a model predicts for them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociflow.operators.places import numbered, placed

#: Fixed value: the genotypes of a site.
GENOTYPES = (0, 1, 2)
#: Combinations of more sites are refused: 3 ** 16 rows are 43 million.
MOST_SITES = 16
META = (
    "sample", "combination_id", "is_target", "source_sample", "source_type", "mutated_feature_count",
    "mutated_features", "mutated_feature_genotypes"
)


def top_features(
    importance: DataFrame, genotype_features: Sequence[str] | DataFrame, n: int, ordinal: str = "ord"
) -> list[str]:
    """The n features of most gain, then most splits, then first in the file, among the genotype features: names, or a
    table of them (feature)."""
    if n <= 0:
        raise ValueError("top_n must be positive")
    known = genotype_features
    if not isinstance(known, DataFrame):
        known = importance.sparkSession.createDataFrame([(f,) for f in genotype_features], "feature string")
    rows = importance.where(~F.col("feature").startswith("loc")).join(known, "feature", "left_semi").orderBy(
        F.desc("importance_gain"), F.desc("importance_split"), ordinal
    ).limit(n)
    out = [r["feature"] for r in rows.select("feature").collect()]
    if not out:
        raise ValueError("no genotype feature among the importances")
    return out


def digit(i: int, n: int, index: Column | None = None) -> Column:
    """Genotype of the i-th of n sites in a combination's number; the first site changes slowest."""
    return (F.floor((F.col("id") if index is None else index) / F.lit(3 ** (n - 1 - i))) % 3).cast("int")


def combination_number(genotypes: Sequence[int]) -> int:
    n = 0
    for g in genotypes:
        if g not in GENOTYPES:
            raise ValueError(f"genotype {g} is none of {GENOTYPES}")
        n = n * 3 + g
    return n


def combinations(
    spark: SparkSession, base: Mapping[str, int], sample: str, features: Sequence[str], mutable: Sequence[str],
    effects: Mapping[str, float]
) -> DataFrame:
    """Every combination of genotypes at the mutable sites: META and ``features``, an array of weighted genotypes
    in the order of the features. The sample's own combination is the target."""
    n = len(mutable)
    if n > MOST_SITES:
        raise ValueError(f"at most {MOST_SITES} mutable sites")
    own = [int(base[f]) for f in mutable]
    rows = spark.range(3**n)
    target = F.col("id") == combination_number(own)
    digits = [digit(i, n) for i in range(n)]
    changed = F.filter(
        F.array(
            *[
                F.when(d != o, F.struct(F.lit(f).alias("f"), d.alias("g"))) for f, d,
                o in zip(mutable, digits, own, strict=True)
            ]
        ),
        lambda x: x.isNotNull()
    ) if n else F.expr("cast(array() as array<struct<f:string,g:int>>)")
    place = {f: i for i, f in enumerate(mutable)}
    vector = F.array(
        *[
            (
                (digits[place[f]] if f in place else F.lit(int(base[f]))).cast("float") * F.lit(float(effects[f])).cast("float")
            ).cast("float") for f in features
        ]
    )
    number = F.format_string("sim_%06d", F.col("id"))
    rows = rows.withColumn("__changed", changed)
    return rows.select(
        F.when(target, sample).otherwise(F.concat(F.lit(f"{sample}_"), number)).alias("sample"),
        F.when(target, "original").otherwise(number).alias("combination_id"),
        target.alias("is_target"),
        F.lit(sample).alias("source_sample"),
        F.when(target, "original").otherwise("simulated").alias("source_type"),
        F.size("__changed").alias("mutated_feature_count"),
        F.array_join(F.transform("__changed", lambda x: x["f"]), ";").alias("mutated_features"),
        F.array_join(
            F.transform("__changed", lambda x: F.concat(x["f"], F.lit(":"), x["g"].cast("string"))), ";"
        ).alias("mutated_feature_genotypes"),
        vector.alias("features"),
    )


def observed(
    genotypes: DataFrame, features: Sequence[str], effects: Mapping[str, float], exclude: str | None = None,
    ordinal: str = "ord"
) -> DataFrame:
    """The observed samples in the same form, numbered in file order."""
    rows = genotypes.where(F.col("sample") != exclude) if exclude else genotypes
    vector = F.array(
        *[(F.col(f"`{f}`").cast("float") * F.lit(float(effects[f])).cast("float")).cast("float") for f in features]
    )
    rows = numbered(rows, "__place", [F.shiftright(F.col(ordinal).cast("long"), 16)], [ordinal])
    number = F.col("__place") - 1
    return rows.select(
        F.col("sample").cast("string").alias("sample"),
        F.format_string("observed_%06d", number).alias("combination_id"), F.lit(False).alias("is_target"),
        F.col("sample").cast("string").alias("source_sample"), F.lit("observed").alias("source_type"),
        F.lit(0).alias("mutated_feature_count"), F.lit("").alias("mutated_features"),
        F.lit("").alias("mutated_feature_genotypes"), vector.alias("features")
    )


def location_groups(rows: DataFrame, locations: Sequence[str], ordinal: str = "ord") -> DataFrame:
    """group_id, location_label, row_count, actual_value_mean and the locations, in order of first appearance."""
    if not locations:
        raise ValueError("no location columns")
    flags = [F.col(c).cast("int").alias(c) for c in locations]
    groups = rows.select(*flags, "value", ordinal).groupBy(*locations).agg(
        F.count("*").alias("row_count"), F.avg("value").alias("actual_value_mean"), F.min(ordinal).alias("__first")
    )
    number = F.row_number().over(Window.orderBy("__first"))
    active = F.array_join(
        F.filter(F.array(*[F.when(F.col(c) == 1, F.lit(c)) for c in locations]), lambda x: x.isNotNull()), "__"
    )
    return groups.withColumn("__n", number).select(
        F.format_string("group_%03d", F.col("__n")).alias("group_id"),
        F.when(active != "", active).otherwise(
            F.format_string("location_group_%03d", F.col("__n"))
        ).alias("location_label"),
        "row_count", "actual_value_mean", *locations
    )


def rank_predictions(predicted: DataFrame, descending: bool = True, group: str | None = "group_id") -> DataFrame:
    """predicted with ``rank`` from 1 within each group; ties go by combination. A group is ranked by as many tasks as it
    fills."""
    by = F.desc("predicted_phenotype") if descending else F.asc("predicted_phenotype")
    return placed(predicted, "rank", [by, F.col("combination_id"), F.col("sample")], [group] if group else [])


def scale(value: Column, low: Column, high: Column, to_low: float, to_high: float) -> Column:
    """Linear map of [low, high] to [to_low, to_high]; the middle if the source range has no width."""
    flat = F.abs(high - low) <= 1e-9 * F.greatest(F.abs(high), F.abs(low))
    return F.when(
        flat, F.lit((to_low + to_high) / 2)
    ).otherwise(F.lit(float(to_low)) + (value - low) / (high - low) * F.lit(float(to_high - to_low)))
