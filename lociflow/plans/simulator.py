"""Combinations of genotypes for one sample, scored under every location and ranked."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.ml import models
from lociflow.operators import simulate
from lociflow.sources import config, sinks, tables
from lociflow.sources.config import SimulatorConfig

Predict = Callable[[DataFrame, list[str]], DataFrame]


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else tables.text_table(spark, path)


def linear_model(weights: dict[str, float]) -> Predict:
    """predicted_phenotype as a weighted sum of the array ``features`` and the location columns."""

    def predict(rows: DataFrame, features: list[str]) -> DataFrame:
        w = F.array(*[F.lit(float(weights.get(f, 0.0))) for f in features])
        total = F.aggregate(
            F.zip_with("features", w, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda a, b: a + b
        )
        for c in rows.columns:
            if c in weights and c not in features:
                total = total + F.col(c).cast("double") * F.lit(float(weights[c]))
        return rows.withColumn("predicted_phenotype", total)

    return predict


def _pickled(path: str, allow: bool) -> Predict:
    model = models.load_pickle(path, allow)

    def predict(rows: DataFrame, features: list[str]) -> DataFrame:
        locations = [c for c in rows.columns if c.startswith("loc") and c != "location_label"]
        flat = rows.select("*", *[F.col("features")[i].alias(f) for i, f in enumerate(features)])
        return models.predict_frame(model, flat.drop("features"), [*features, *locations]).drop(*features)

    return predict


def _pipeline(path: str) -> Predict:
    """A fitted pipeline of pyspark.ml, saved in a folder, over one vector ``x`` of features and locations."""
    model = models.load_model(path)

    def predict(rows: DataFrame, features: list[str]) -> DataFrame:
        locations = [c for c in rows.columns if c.startswith("loc") and c != "location_label"]
        x = F.concat(F.col("features").cast("array<double>"), F.array(*[F.col(c).cast("double") for c in locations]))
        out = model.transform(models.with_vector(rows.withColumn("__all", x), "__all"))
        return out.select(*rows.columns, F.col("prediction").alias("predicted_phenotype"))

    return predict


def model_of(spark: SparkSession, path: str, allow_pickle: bool) -> Predict:
    """A folder holds a saved pipeline; a file a pickled or joblib model."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return _pipeline(path) if fs.exists(p) and fs.getFileStatus(p).isDirectory() else _pickled(path, allow_pickle)


def run(spark: SparkSession, c: SimulatorConfig, predict: Predict | None = None) -> DataFrame:
    """The ranking of all combinations and observed samples in every location group, also written to outdir."""
    genotype = tables.genotypes(_read(spark, c.genotype_file))
    features = tables.genotype_features([x for x in genotype.columns if x != "ord"])
    phenotype = tables.phenotypes(_read(spark, c.phenotype_file))
    locations = [x for x in phenotype.columns if x.startswith("loc")]
    merged = tables.phenotype_genotype(phenotype, genotype)
    own = tables.sample_rows(merged, c.sample_id)
    mutable = simulate.top_features(tables.importance(_read(spark, c.feature_importance_file)), features, c.top_n)
    effects = tables.variant_effects(_read(spark, c.variant_effect_file), features)
    groups = simulate.location_groups(own, locations)
    if predict is None:
        predict = model_of(spark, config.require(asdict(c), "model_file"), c.allow_pickle)
    base = own.orderBy("ord").limit(1).collect()[0].asDict()
    rows = simulate.combinations(spark, base, c.sample_id, features, mutable, effects).unionByName(
        simulate.observed(genotype, features, effects, c.sample_id)
    )
    # A group for each place the sample was grown at: a handful of rows.
    scored = predict(rows.crossJoin(F.broadcast(groups)), features)
    seen = own.join(F.broadcast(groups.select("group_id", "location_label", *locations)), locations)
    seen.write.mode("overwrite").partitionBy("group_id").parquet(f"{c.outdir}/observed_rows.parquet")
    sinks.save_csv(seen.orderBy("group_id", "ord").drop("ord"), f"{c.outdir}/observed_rows.csv")
    flat = rows.select(*simulate.META, *[F.col("features")[i].alias(f) for i, f in enumerate(features)])
    if sinks.try_parquet(flat, f"{c.outdir}/prediction_features.parquet"):
        flat = spark.read.parquet(f"{c.outdir}/prediction_features.parquet")
    sinks.save_csv(flat, f"{c.outdir}/prediction_features.csv")
    ranked = simulate.rank_predictions(scored.drop("features"), c.rank_order == "desc").select(
        "group_id", "location_label", "row_count", "actual_value_mean", *simulate.META, "predicted_phenotype", "rank"
    )
    ranked.write.mode("overwrite").partitionBy("group_id").parquet(f"{c.outdir}/ranking.parquet")
    ranked = spark.read.parquet(f"{c.outdir}/ranking.parquet")
    sinks.save_csv(ranked.orderBy("group_id", "rank"), f"{c.outdir}/ranking.csv")
    summary = []
    for g in groups.collect():
        one = ranked.where(F.col("group_id") == g["group_id"])
        target = one.where("is_target").select("rank", "predicted_phenotype").first()
        sinks.scatter_svg(one, g["location_label"], f"{c.outdir}/{g['group_id']}.svg", most=c.most_points)
        summary.append(
            {
                "group_id": g["group_id"], "location_label": g["location_label"], "row_count": g["row_count"],
                "actual_value_mean": g["actual_value_mean"], "target_rank": target["rank"],
                "target_prediction": target["predicted_phenotype"]
            }
        )
    sinks.save_json(
        {"sample_id": c.sample_id, "mutable_features": mutable, "combinations": 3 ** len(mutable), "groups": summary},
        f"{c.outdir}/summary.json"
    )
    return ranked
