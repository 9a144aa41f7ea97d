"""Writers. Tables go out as Parquet, and as one CSV file with a header where a tool needs it."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping, Sequence
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.operators import blocks
from lociflow.operators.blocks import Blocks
from lociflow.sources import files

log = logging.getLogger("lociflow")


def get_logger(file: str | None = None, level: str = "INFO") -> logging.Logger:
    """The package's logger, to the standard output and to a file."""
    if not log.handlers:
        log.addHandler(logging.StreamHandler())
    if file and not any(getattr(h, "baseFilename", None) == str(Path(file).resolve()) for h in log.handlers):
        Path(file).parent.mkdir(parents=True, exist_ok=True)
        log.addHandler(logging.FileHandler(file))
    for h in log.handlers:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    log.setLevel(level.upper())
    return log


def save_csv(rows: DataFrame, path: str, sep: str = ",") -> str:
    """One file with a header in a folder. All tasks write; rows that are in order stay so."""
    spark = rows.sparkSession
    parts = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex[:12]}"
    head = spark.createDataFrame([tuple(rows.columns)], ", ".join(f"c{i} string" for i in range(len(rows.columns))))
    head.coalesce(1).write.option("sep", sep).csv(f"{parts}.head")
    rows.write.option("header", False).option("sep", sep).csv(f"{parts}.rows")
    return files.join(spark, [f"{parts}.head", f"{parts}.rows"], path, "part-00000.csv")


def save_lines(rows: DataFrame, path: str) -> str:
    """Text (value) as one file in a folder, written by all tasks; rows that are in order stay so."""
    spark = rows.sparkSession
    parts = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex[:12]}"
    rows.select("value").write.text(parts)
    return files.join(spark, [parts], path, "part-00000.txt")


def save_dual(rows: DataFrame, stem: str) -> tuple[str, str]:
    """stem.parquet, and stem.csv from it."""
    rows.write.mode("overwrite").parquet(f"{stem}.parquet")
    return save_csv(rows.sparkSession.read.parquet(f"{stem}.parquet"), f"{stem}.csv"), f"{stem}.parquet"


def try_parquet(rows: DataFrame, path: str) -> bool:
    """Writes Parquet; a failure is logged and False comes back."""
    try:
        rows.write.mode("overwrite").parquet(path)
    except Exception as e:  # noqa: BLE001
        log.warning("no Parquet at %s: %s", path, e)
        return False
    return True


def save_matrix(
    cells: DataFrame, row: str, column: str, value: str, rows: DataFrame, columns: DataFrame, stem: str, fill=None
) -> Blocks:
    """A long table as a matrix in blocks (stem.blocks), and from them stem.csv and stem.parquet. ``rows`` and ``columns``
    (name, no) are every row and column in order."""
    out = blocks.write(cells, row, column, value, rows, columns, f"{stem}.blocks", fill)
    out.save_csv(f"{stem}.csv")
    out.save_parquet(f"{stem}.parquet")
    return out


def save_vectors(rows: DataFrame, column: str, order: str, path: str) -> None:
    """A column of vectors as a .npy file, in order; for results of a size that the driver holds."""
    _save_array(np.array([r[0] for r in rows.orderBy(order).select(column).collect()], np.float32), path)


def save_numbers(rows: DataFrame, column: str, path: str) -> None:
    """A column of whole numbers as a .npy file, sorted; as small as a list of rows."""
    _save_array(np.array(sorted(r[0] for r in rows.select(column).collect()), np.int64), path)


def _save_array(values: np.ndarray, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    np.save(path, values)


def save_splits(
    tables: Mapping[str, Blocks], train: Sequence[str], test: Sequence[str], folder: str, meta: Mapping
) -> dict[str, str]:
    """Each matrix with a row for each sample as train_val_NAME and test_NAME, rows in the order of the lists, in both
    formats; and split_meta.json."""
    out = {}
    for part, samples in (("train_val", train), ("test", test)):
        for name, matrix in tables.items():
            stem = f"{folder}/{part}_{name}"
            out[f"{part}_{name}_csv"] = matrix.save_csv(f"{stem}.csv", samples)
            out[f"{part}_{name}_parquet"] = matrix.save_parquet(f"{stem}.parquet", samples)
    out["split_meta_json"] = f"{folder}/split_meta.json"
    save_json({**meta, "samples": {"train_val": list(train), "test": list(test)}}, out["split_meta_json"])
    return out


def save_json(content: Mapping, path: str) -> None:
    save_text(json.dumps(content, indent=2, ensure_ascii=False, default=str), path)


def save_text(content: str, path: str) -> None:
    """Writes text in any store that Spark reaches; without a session, in a local file."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(content, encoding="utf-8")
        return
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


def report_text(report: Sequence[Mapping], names: Sequence[str]) -> str:
    """Precision, recall, F1 and support of each class as text."""
    width = max([5, *map(len, names)])
    lines = [f"{'':>{width}}  precision  recall  f1-score  support", ""]
    for r in sorted(report, key=lambda r: r["label"]):
        lines.append(f"{names[int(r['label'])]:>{width}}  {r['precision']:9.4f}  {r['recall']:6.4f}  {r['f1']:8.4f}  {r['support']:7d}")
    return "\n".join(lines) + "\n"


def plot_curves(roc: DataFrame, pr: DataFrame, folder: str) -> dict[str, str | None]:
    """ROC and precision-recall curves as images, or None for each where matplotlib is missing."""
    try:
        import matplotlib

        matplotlib.use("Agg")
        from matplotlib import pyplot as plt
    except ImportError:
        log.warning("no curves: matplotlib is missing")
        return {"roc_curve": None, "pr_curve": None}
    out = {}
    for name, rows, x, y in (("roc_curve", roc, "fpr", "tpr"), ("pr_curve", pr, "recall", "precision")):
        points = rows.orderBy(F.desc("threshold")).select(x, y).collect()
        fig, ax = plt.subplots()
        ax.plot([p[0] for p in points], [p[1] for p in points])
        ax.set_xlabel(x)
        ax.set_ylabel(y)
        out[name] = f"{folder}/{name}.png"
        fig.savefig(out[name])
        plt.close(fig)
    return out


def ticks(low: float, high: float, n: int = 5) -> list[float]:
    """n values from low to high, or the one there is."""
    return [low] if low == high else [low + (high - low) * i / (n - 1) for i in range(n)]


#: What the chart calls the kinds of points, and their colours.
KINDS = {"observed": "#2a7f62", "simulated": "#7f8c9b", "original": "#c0392b"}


#: Side of a cell of the chart, in its own units.
CELL = 2


def cells(ranked: DataFrame, low: float, high: float, n: int, width: int, height: int, margin: int) -> DataFrame:
    """x, y, kind, n of the cells of the chart that hold points: every point counts in one, the target as a kind of its
    own. There are no more than cells of the chart for each kind, however many points."""
    from lociflow.operators.simulate import scale

    x = scale(F.col("rank").cast("double"), F.lit(1.0), F.lit(float(n)), margin, width - margin)
    y = scale(F.col("predicted_phenotype"), F.lit(low), F.lit(high), height - margin, margin)
    middle = lambda c: (F.floor(c / CELL) * CELL + CELL / 2).cast("double")
    known = F.when(F.col("source_type").isin(*KINDS), F.col("source_type")).otherwise("simulated")
    kind = F.when(F.col("is_target"), "original").when(known == "original", "simulated").otherwise(known)
    return ranked.groupBy(middle(x).alias("x"), middle(y).alias("y"), kind.alias("kind")).agg(F.count("*").alias("n"))


def scatter_svg(
    ranked: DataFrame, title: str, path: str, width: int = 900, height: int = 520, margin: int = 60,
    most: int | None = None
) -> None:
    """Predicted phenotype by rank as an SVG, with ticks, a legend and the target's label. Spark counts the points in the
    cells of a grid; a cell is drawn once, with the number of its points (data-n) and the stronger the more they are.
    ``most`` thins the points out to about so many before, evenly by rank, but never the first, the last, the observed
    ones or the target."""
    n, low, high = ranked.agg(F.count("*"), F.min("predicted_phenotype"), F.max("predicted_phenotype")).first()
    if not n:
        raise ValueError("nothing to draw")
    low, high = float(low), float(high)
    target = ranked.where("is_target").select("rank", "predicted_phenotype").first()
    if most:
        step = max(1, n // most)
        ranked = ranked.where(
            (F.col("rank") % step == 0) | F.col("is_target") | F.col("rank").isin(1, n) | (F.col("source_type") == "observed")
        )
    body, mark = [], ""
    found = cells(ranked, low, high, n, width, height, margin).collect()
    for p in sorted(found, key=lambda p: (p.kind == "original", p.x, p.y, p.kind)):
        own = p.kind == "original"
        strength = 1.0 if own else round(min(1.0, 0.35 + 0.1 * p.n.bit_length()), 2)
        body.append(f'<circle cx="{p.x:g}" cy="{p.y:g}" r="{5 if own else 2}" fill="{KINDS[p.kind]}" fill-opacity="{strength}" data-n="{p.n}"/>')
        if own and target:
            mark = f'<text x="{p.x + 8:g}" y="{p.y - 8:g}">target: rank {target["rank"]}, {target.predicted_phenotype:.4g}</text>'
    place = lambda v, a, b, p, q: (p + q) / 2 if a == b else p + (v - a) / (b - a) * (q - p)
    axes = [f'<path d="M{margin} {margin}V{height - margin}H{width - margin}" fill="none" stroke="#333"/>']
    for v in ticks(1, n):
        at = place(v, 1, n, margin, width - margin)
        axes.append(f'<path d="M{at:.1f} {height - margin}v5" stroke="#333"/><text x="{at:.1f}" y="{height - margin + 18}" text-anchor="middle">{round(v)}</text>')
    for v in ticks(low, high):
        at = place(v, low, high, height - margin, margin)
        axes.append(f'<path d="M{margin} {at:.1f}h-5" stroke="#333"/><text x="{margin - 8}" y="{at + 4:.1f}" text-anchor="end">{v:.4g}</text>')
    for i, (name, colour) in enumerate(KINDS.items()):
        axes.append(f'<circle cx="{width - margin - 90}" cy="{margin + 18 * i}" r="4" fill="{colour}"/><text x="{width - margin - 80}" y="{margin + 18 * i + 4}">{name}</text>')
    text = title.replace("&", "&amp;").replace("<", "&lt;")
    labels = (
        f'<text x="{width / 2}" y="{margin / 2}" text-anchor="middle">{text}</text>'
        f'<text x="{width / 2}" y="{height - 15}" text-anchor="middle">rank</text>'
        f'<text x="15" y="{height / 2}" transform="rotate(-90 15 {height / 2})" text-anchor="middle">predicted phenotype</text>'
    )
    head = f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}" font-family="sans-serif" font-size="13"><rect width="100%" height="100%" fill="white"/>'
    save_text(f"{head}{''.join(axes)}{''.join(body)}{mark}{labels}</svg>\n", path)
