"""Variant types from the embeddings of both alleles' windows."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.embed.cache import CachedEmbedder
from lociflow.functions import vectors
from lociflow.ml import labels, metrics, models
from lociflow.operators import effects, splits
from lociflow.operators.places import numbered
from lociflow.sources import fasta, sinks, tables, vcf


@dataclass(frozen=True)
class ClassifierConfig:
    tsv_path: str
    vcf_path: str
    fasta_path: str
    outdir: str
    k: int = 100
    embedder: str = "kmer"
    embedder_options: dict | None = None
    task_type: str = "auto"
    feature_type: str = "all"
    model_type: str = "logistic_regression"
    eval_mode: str = "auto"
    positive_class: str | None = None
    selected_classes: list[str] | None = None
    min_class_size: int = 1
    class_weight: str | None = "balanced"
    standardize: bool = True
    test_ratio: float = 0.2
    folds: int = 5
    seed: int = 42
    label_by_position: bool = False
    matrices: bool = False


def sequences(spark: SparkSession, c: ClassifierConfig) -> DataFrame:
    """site_id, variant_type, alleles and windows of the variants that the site table asks for."""
    wanted = tables.site_table(tables.text_table(spark, c.tsv_path, "\t"))
    found = vcf.labelled(vcf.all_alts(vcf.lines(spark, c.vcf_path)), wanted, c.label_by_position)
    genome = fasta.read_pieces(spark, c.fasta_path, overlap=max(fasta.OVERLAP, 4 * c.k + 1_000))
    return effects.allele_windows(found, genome, c.k)


def feature_rows(seqs: DataFrame, embed, kind: str) -> DataFrame:
    """site_id, variant_type, features."""
    known = embed(seqs.select(F.explode(F.array("ref_seq", "alt_seq")).alias("seq")).distinct())
    both = seqs.join(
        known.select(F.col("seq").alias("ref_seq"), F.col("embedding").alias("__r")), "ref_seq"
    ).join(known.select(F.col("seq").alias("alt_seq"), F.col("embedding").alias("__a")), "alt_seq")
    made = vectors.features(F.col("__r"), F.col("__a"), kind, F.length("ref"), F.length("alt"))
    return both.select(
        "site_id", "variant_type", F.col("__r").alias("ref_embedding"), F.col("__a").alias("alt_embedding"),
        made.alias("features")
    )


def save_matrices(data: DataFrame, kind: str, outdir: str) -> None:
    """The embeddings of both alleles, their difference and the features as .npy files, rows by site_id, and what the
    features are made of; for tables that the driver holds."""
    made = data.withColumn("diff", vectors.difference(F.col("alt_embedding"), F.col("ref_embedding")))
    for column, name in (
        ("ref_embedding", "ref_embeddings"), ("alt_embedding", "alt_embeddings"), ("diff", "alt_minus_ref_embeddings"),
        ("features", "features")
    ):
        sinks.save_vectors(made, column, "site_id", f"{outdir}/{name}.npy")
    size = data.select(F.size("alt_embedding"), F.size("features")).first()
    sinks.save_json(
        {"feature_type": kind, "embedding_dim": size[0], "feature_dim": size[1]}, f"{outdir}/feature_meta.json"
    )


def prepare(spark: SparkSession, c: ClassifierConfig) -> tuple[DataFrame, str, list[str], list[dict]]:
    """Writes the sequences, labels and features; returns the features with their labels, the task, the class names and
    how many rows each label has."""
    seqs = sequences(spark, c)
    if seqs.isEmpty():
        raise ValueError("no variant matches the site table")
    kept = labels.filter_classes(seqs, "variant_type", c.min_class_size, c.selected_classes)
    if kept.isEmpty():
        raise ValueError("no class is left")
    kept.write.mode("overwrite").parquet(f"{c.outdir}/variant_sequences.parquet")
    kept = spark.read.parquet(f"{c.outdir}/variant_sequences.parquet")
    sinks.save_csv(
        labels.class_counts(kept, "variant_type").orderBy("variant_type"), f"{c.outdir}/label_distribution.tsv", "\t"
    )
    rows, task, names = labels.prepare_labels(kept, "variant_type", c.task_type, c.positive_class)
    sinks.save_csv(kept, f"{c.outdir}/variant_sequences.tsv", "\t")
    sinks.save_csv(rows.select("site_id", "variant_type", F.col("y").alias("label_id")), f"{c.outdir}/labels.tsv", "\t")
    table = feature_rows(
        kept, CachedEmbedder(c.embedder, f"{c.outdir}/embeddings", **(c.embedder_options or {})), c.feature_type
    )
    table.join(rows.select("site_id", "y"), "site_id").write.mode("overwrite").parquet(f"{c.outdir}/features.parquet")
    data = spark.read.parquet(f"{c.outdir}/features.parquet")
    if c.matrices:
        save_matrices(data, c.feature_type, c.outdir)
    counts = [r.asDict() for r in labels.class_counts(data, "y").orderBy("y").collect()]  # as many as classes
    return data.drop("ref_embedding", "alt_embedding"), task, names, counts


def run(spark: SparkSession, c: ClassifierConfig) -> dict:
    """Trains, evaluates and writes everything; returns the summary."""
    data, task, names, counts = prepare(spark, c)
    n = data.count()
    mode = splits.eval_mode(n, c.eval_mode)
    options = {"class_weight": c.class_weight, "standardize": c.standardize}
    summary = {
        "config": asdict(c), "task_type": task, "classes": names,
        "label_counts": {names[r["y"]]: r["count"] for r in counts}, "rows": n, "eval_mode": mode
    }
    if mode == "holdout":
        model, predicted, scores = models.holdout(
            data, "site_id", c.model_type, task, len(names), c.test_ratio, c.seed, **options
        )
        model.write().overwrite().save(f"{c.outdir}/model")
        summary["metrics"] = scores.first().asDict()
        tested = predicted.select("site_id").withColumn("part", F.lit("test"))
        # In the order of the matrices: by the site's name, in stretches of its first letters.
        places = numbered(
            data.select("site_id"), "place", [F.substring("site_id", 1, 6)], ["site_id"]
        ).join(tested, "site_id", "left")
        for name, part in (("train_indices", "part IS NULL"), ("test_indices", "part IS NOT NULL")):
            if c.matrices:
                sinks.save_numbers(
                    places.where(part).select((F.col("place") - 1).alias("i")), "i", f"{c.outdir}/{name}.npy"
                )
    else:
        predicted, folds = models.cross_validate(
            data, "site_id", c.model_type, task, len(names), c.folds, c.seed, **options
        )
        folds.write.mode("overwrite").parquet(f"{c.outdir}/fold_metrics.parquet")
        folds = spark.read.parquet(f"{c.outdir}/fold_metrics.parquet")
        sinks.save_csv(folds.orderBy("fold"), f"{c.outdir}/fold_metrics.tsv", "\t")
        summary["metrics"] = {
            r["metric"]: {"mean": r["mean"], "std": r["std"]} for r in metrics.fold_summary(
                folds, [x for x in folds.columns if x != "fold"]
            ).collect()
        }
    predicted.write.mode("overwrite").parquet(f"{c.outdir}/predictions.parquet")
    predicted = spark.read.parquet(f"{c.outdir}/predictions.parquet")
    sinks.save_csv(
        models.prediction_table(predicted, names, "test" if mode == "holdout" else "cv"), f"{c.outdir}/predictions.tsv",
        "\t"
    )
    ids = spark.createDataFrame([(i,) for i in range(len(names))], "label int")
    sinks.save_csv(
        metrics.confusion_matrix(predicted, ids).orderBy("label_true", "label_pred"),
        f"{c.outdir}/confusion_matrix.tsv", "\t"
    )
    report = [r.asDict() for r in metrics.class_report(predicted).collect()]
    sinks.save_text(sinks.report_text(report, names), f"{c.outdir}/classification_report.txt")
    if mode == "holdout" and task == "binary":
        summary["curves"] = sinks.plot_curves(metrics.roc_points(predicted), metrics.pr_points(predicted), c.outdir)
    sinks.save_json(summary, f"{c.outdir}/metrics.json")
    return summary
