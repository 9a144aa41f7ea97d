"""Exact classification metrics by aggregation and window functions.

Scores with equal values count as one threshold. Each function takes rows of predictions and returns a DataFrame;
only fixed numbers of values ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.operators.places import accumulated


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 if b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def confusion_counts(rows: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    one = lambda c: F.sum(c.cast("long"))
    t, p = F.col(y) == 1, F.col(pred) == 1
    return rows.agg(one(t & p).alias("tp"), one(~t & p).alias("fp"), one(t & ~p).alias("fn"), one(~t & ~p).alias("tn"))


def thresholds(rows: DataFrame, y: str = "y", score: str = "score", group: list[str] | None = None) -> DataFrame:
    """score, tp, fp, pos, neg of every distinct score: what lies at or above it, and the totals. Rows without a score or
    a label count nowhere.

    The scores, of any range, are counted before they are ordered, and added up by stretches of their order."""
    group = group or []
    per = rows.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(*group, F.col(score).alias("score")).agg(
        F.sum(F.col(y).cast("long")).alias("p_here"), F.count("*").alias("__n")
    )
    per = per.select(*group, "score", "p_here", (F.col("__n") - F.col("p_here")).alias("n_here"))
    out = accumulated(per, {"tp": "p_here", "fp": "n_here"}, [F.desc("score")], group)
    return out.select(
        *group, "score", "tp", "fp", "p_here", "n_here", F.col("tp_all").alias("pos"), F.col("fp_all").alias("neg")
    )


def roc_points(rows: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """threshold, fpr, tpr."""
    t = thresholds(rows, y, score)
    return t.select(
        F.col("score").alias("threshold"), ratio(F.col("fp"), F.col("neg")).alias("fpr"),
        ratio(F.col("tp"), F.col("pos")).alias("tpr")
    )


def pr_points(rows: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """threshold, precision, recall."""
    t = thresholds(rows, y, score)
    return t.select(
        F.col("score").alias("threshold"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("pos")).alias("recall")
    )


def areas(rows: DataFrame, y: str = "y", score: str = "score", group: list[str] | None = None) -> DataFrame:
    """roc_auc (ties count half) and pr_auc (average precision, in steps); null if a class is absent."""
    group = group or []
    t = thresholds(rows, y, score, group)
    above = F.col("tp") - F.col("p_here")
    won = F.sum(F.col("n_here").cast("double") * (above.cast("double") + F.col("p_here").cast("double") / 2.0))
    total = F.first("pos").cast("double") * F.first("neg").cast("double")
    step = F.sum(
        F.col("p_here").cast("double") * F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")
    )
    out = t.groupBy(*group) if group else t
    return out.agg(
        F.when(total > 0, won / total).alias("roc_auc"),
        F.when(F.first("pos") > 0, step / F.first("pos").cast("double")).alias("pr_auc")
    )


def binary_metrics(rows: DataFrame, y: str = "y", pred: str = "pred", score: str = "score") -> DataFrame:
    """One row: roc_auc, pr_auc, accuracy, balanced_accuracy, precision, recall, f1, mcc."""
    c = confusion_counts(rows, y, pred)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    recall, special, precision = ratio(tp, tp + fn), ratio(tn, tn + fp), ratio(tp, tp + fp)
    mcc = ratio(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
    flat = c.select(
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), ((recall + special) / 2.0).alias("balanced_accuracy"),
        precision.alias("precision"), recall.alias("recall"), ratio(2.0 * tp, 2.0 * tp + fp + fn).alias("f1"),
        mcc.alias("mcc")
    )
    return areas(rows, y, score).crossJoin(flat)


def class_report(rows: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """label, precision, recall, f1, support of every label that occurs in y or pred."""
    long = rows.select(
        F.explode(
            F.array(
                F.struct(F.col(y).alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p")),
                F.struct(F.col(pred).alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p"))
            )
        ).alias("x"),
        (F.col(y) == F.col(pred)).cast("int").alias("hit")
    ).select("x.*", "hit")
    g = long.groupBy("label").agg(
        F.sum("t").alias("support"), F.sum("p").alias("predicted"), F.sum(F.col("t") * F.col("hit")).alias("tp")
    )
    return g.select(
        "label", ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"), "support"
    )


def confusion_matrix(rows: DataFrame, labels: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """label_true, label_pred, count for every pair of the fixed labels, 0 included."""
    pairs = labels.select(F.col("label").alias("label_true")).crossJoin(
        F.broadcast(labels.select(F.col("label").alias("label_pred")))
    )
    counts = rows.groupBy(F.col(y).alias("label_true"), F.col(pred).alias("label_pred")).agg(F.count("*").alias("n"))
    return pairs.join(counts, ["label_true", "label_pred"], "left").select(
        "label_true", "label_pred", F.coalesce("n", F.lit(0)).cast("long").alias("count")
    )


def multiclass_metrics(
    rows: DataFrame, y: str = "y", pred: str = "pred", proba: str | None = None, classes: int | None = None
) -> DataFrame:
    """One row: accuracy, macro_f1, weighted_f1, macro_precision, macro_recall, and with class probabilities
    one-against-the-rest roc_auc_macro, roc_auc_weighted and pr_auc_macro."""
    r = class_report(rows, y, pred)
    w = F.col("support").cast("double")
    flat = r.agg(
        F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * w) / F.sum(w)).alias("weighted_f1"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall")
    )
    out = rows.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy")).crossJoin(flat)
    if proba is None:
        return out
    each = rows.select(
        y, F.posexplode(F.slice(proba, 1, classes) if classes else F.col(proba)).alias("k", "score")
    ).withColumn("hit", (F.col(y) == F.col("k")).cast("int"))
    a = areas(each, "hit", "score", ["k"]).join(
        rows.groupBy(F.col(y).cast("int").alias("k")).agg(F.count("*").alias("n")), "k"
    )
    return out.crossJoin(
        a.agg(
            F.avg("roc_auc").alias("roc_auc_macro"),
            (F.sum(F.col("roc_auc") * F.col("n")) / F.sum("n")).alias("roc_auc_weighted"),
            F.avg("pr_auc").alias("pr_auc_macro")
        )
    )


def fold_summary(folds: DataFrame, metrics: list[str]) -> DataFrame:
    """metric, mean, std (of the population) over folds."""
    long = folds.unpivot([], [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
