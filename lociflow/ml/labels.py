"""Class labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_classes(rows: DataFrame, label: str, least: int = 1, selected: Sequence[str] | None = None) -> DataFrame:
    """Rows of the selected classes that have at least so many rows."""
    rows = rows.where(F.col(label).isin(list(selected))) if selected else rows
    counts = rows.groupBy(label).agg(F.count("*").alias("__n")).where(F.col("__n") >= least).select(label)
    return rows.join(counts, label, "left_semi")


def class_counts(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy(label).agg(F.count("*").alias("count"))


def prepare_labels(
    rows: DataFrame, label: str, task: str = "auto", positive: str | None = None
) -> tuple[DataFrame, str, list[str]]:
    """rows with ``y``, the task, and the class names in order of y.

    auto is binary for two classes, else multiclass. Binary: y = 1 for the positive class, by default the second
    of two classes in order, or the first of more; all others are 0. Multiclass: the place in order; needs three.
    """
    names = sorted(r[0] for r in rows.select(label).where(F.col(label).isNotNull()).distinct().collect())
    if task == "auto":
        task = "binary" if len(names) == 2 else "multiclass"
    if task == "binary":
        if len(names) < 2:
            raise ValueError("a binary task needs two classes")
        positive = positive or (names[1] if len(names) == 2 else names[0])
        return rows.withColumn("y", (F.col(label) == positive).cast("int")), task, ["negative", "positive"]
    if task != "multiclass":
        raise ValueError(f"unknown task: {task}")
    if len(names) < 3:
        raise ValueError("a multiclass task needs three classes")
    # As many entries as classes.
    place = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    return rows.withColumn("y", place[F.col(label)]), task, names
