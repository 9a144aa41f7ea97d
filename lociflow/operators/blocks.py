"""Matrices in blocks: dense stretches of rows, written by tasks, from which wide files are put together.

A row of the block table holds one matrix row's cells in one stretch of ``width`` columns. The names of rows and columns
are tables of their own, with their places; none of them is a plan's column or passes through the driver, so a matrix may
be of any width.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.operators.checks import require_known
from lociflow.operators.places import placed

WIDTH = 1000
#: Columns up to which a matrix is also written as a table with a column for each, which makes its schema.
MOST_COLUMNS = 5_000


def index(names: DataFrame, name: str, order: Sequence | None = None) -> DataFrame:
    """name, no: each distinct name's place from 0, by ``order`` (columns of names) or by itself."""
    by = list(order) if order else [F.col(name)]
    once = names.groupBy(name).agg(*[F.min(c).alias(f"__by{i}") for i, c in enumerate(by)])
    out = placed(once, "no", [*[F.col(f"__by{i}") for i in range(len(by))], F.col(name)])
    return out.select(F.col(name).alias("name"), (F.col("no") - 1).alias("no"))


def _quoted(name: Column) -> Column:
    """A name as a CSV field."""
    inner = F.regexp_replace(F.regexp_replace(name, r"\\", r"\\\\"), '"', r'\\"')
    return F.when(name.rlike('[",\r\n]'), F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(name)


def _joined(rows: DataFrame, *keys: str) -> DataFrame:
    """keys and line: segments of a row put together in the order of their stretches."""
    parts = F.sort_array(F.collect_list(F.struct("stretch", "segment")))
    return rows.groupBy(*keys).agg(parts.alias("__parts")).select(
        *keys, F.array_join(F.transform("__parts", lambda p: p["segment"]), ",").alias("line")
    )


@dataclass
class Blocks:
    """A matrix under a folder: blocks (no, stretch, cells), rows and columns (name, no). ``key`` heads its rows' names."""

    spark: SparkSession
    folder: str
    key: str
    n_rows: int
    n_columns: int
    width: int

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def part(self, rows: tuple[int, int], columns: tuple[int, int]) -> DataFrame:
        """no, stretch, cells of the blocks that rows and columns (half-open) touch: the others are not read."""
        (a, b), (c, d) = rows, columns
        return self.table("blocks").where(
            (F.col("no") >= a) & (F.col("no") < b) & F.col("stretch").between(c // self.width, (d - 1) // self.width)
        )

    def cells(self) -> DataFrame:
        """row, column, value of every cell."""
        flat = self.table("blocks").select("no", "stretch", F.posexplode("cells").alias("i", "value"))
        rows = self.table("rows").withColumnsRenamed({"name": "row"})
        columns = self.table("columns").withColumnsRenamed({"name": "column", "no": "__c"})
        flat = flat.withColumn("__c", F.col("stretch") * self.width + F.col("i"))
        return flat.join(rows, "no").join(columns, "__c").select("row", "column", "value")

    def chosen(self, names: Sequence[str] | None) -> DataFrame:
        """name, no and place of the rows named, in that order, or of all."""
        rows = self.table("rows")
        if names is None:
            return rows.withColumn("place", F.col("no"))
        wanted = self.spark.createDataFrame(list(enumerate(names)), "place long, name string")
        require_known(wanted, rows, "name", "samples without rows", KeyError)
        return rows.join(wanted, "name")

    def stretches(self) -> DataFrame:
        """stretch and the names of its columns in order."""
        held = self.table("columns").groupBy(F.floor(F.col("no") / self.width).alias("stretch"))
        held = held.agg(F.sort_array(F.collect_list(F.struct("no", "name"))).alias("__names"))
        return held.select("stretch", F.transform("__names", lambda x: x["name"]).alias("names"))

    def lines(self, names: Sequence[str] | None = None) -> DataFrame:
        """place and value: the lines of the matrix as CSV, the header before all others."""
        text = F.array_join(F.transform("cells", lambda x: x.cast("string")), ",", "")
        body = _joined(self.table("blocks").select("no", "stretch", text.alias("segment")), "no")
        body = self.chosen(names).join(body, "no").select(
            "place", F.concat_ws(",", _quoted(F.col("name")), "line").alias("value")
        )
        head = self.stretches().select(
            F.lit(-1).cast("long").alias("place"), "stretch",
            F.array_join(F.transform("names", _quoted), ",").alias("segment")
        )
        head = _joined(head, "place").select("place", F.concat(_quoted(F.lit(self.key)), F.lit(","), "line").alias("value"))
        return head.unionByName(body)

    def save_csv(self, path: str, names: Sequence[str] | None = None) -> str:
        """One file, as its readers ask, its rows in order."""
        from lociflow.sources import sinks

        return sinks.save_lines(self.lines(names).orderBy("place"), path)

    def save_parquet(self, path: str, names: Sequence[str] | None = None) -> str:
        """A table with a column for each name up to ``MOST_COLUMNS``; of a wider matrix the rows in their stretches (name,
        place, stretch, cells), and beside it the columns' names in theirs (stretch, names)."""
        rows = self.chosen(names)
        held = self.table("blocks").join(rows, "no")
        if self.n_columns > MOST_COLUMNS:
            held = held.select(F.col("name").alias(self.key), "place", "stretch", "cells")
            held.sort("place", "stretch").write.mode("overwrite").parquet(path)
            self.stretches().write.mode("overwrite").parquet(names_path(path))
            return path
        columns = [r.name for r in self.table("columns").orderBy("no").collect()]  # no more than MOST_COLUMNS
        parts = F.sort_array(F.collect_list(F.struct("stretch", "cells")))
        whole = held.groupBy("place", "name").agg(F.flatten(F.transform(parts, lambda p: p["cells"])).alias("cells"))
        flat = whole.sort("place").select(
            F.col("name").alias(self.key), *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)]
        )
        flat.write.mode("overwrite").parquet(path)
        return path


def names_path(path: str) -> str:
    """Where the columns' names of a matrix in stretches are."""
    return f"{path.rstrip('/').removesuffix('.parquet')}.columns.parquet"


def long_parquet(spark: SparkSession, path: str, key: str, name: str, value: str, kind: str) -> DataFrame:
    """key, name, value of every cell of a matrix that ``save_parquet`` wrote, however wide."""
    table = spark.read.parquet(path)
    if table.columns != [key, "place", "stretch", "cells"]:
        cells = [F.col(f"`{c}`").cast(kind).alias(c) for c in table.columns if c != key]
        return table.unpivot([key], cells, name, value)
    held = table.join(spark.read.parquet(names_path(path)), "stretch")
    flat = held.select(key, F.explode(F.arrays_zip(F.col("names").alias("n"), F.col("cells").alias("v"))).alias("x"))
    return flat.select(key, F.col("x.n").alias(name), F.col("x.v").cast(kind).alias(value))


def _fields(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for line in b.column(0).to_pylist():
            row = next(csv.reader([line], escapechar="\\", doublequote=False))
            for at in range(1, len(row), most):
                part = row[at : at + most]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]]), pa.array([(at - 1) // most], pa.int64()), pa.array([part], pa.list_(pa.string()))],
                    ["key", "stretch", "cells"]
                )


def long_csv(spark: SparkSession, path: str, key: str, name: str, value: str, kind: str) -> DataFrame:
    """key, name, value of every cell of a matrix that ``save_csv`` wrote, however wide: its columns are no schema's. Names
    hold no line ends."""
    rows = spark.read.text(path).mapInArrow(lambda b: _fields(b, WIDTH), "key string, stretch long, cells array<string>")
    head = rows.where(F.col("key") == key).select("stretch", F.col("cells").alias("names"))
    held = rows.where(F.col("key") != key).join(head, "stretch")
    flat = held.select("key", F.explode(F.arrays_zip(F.col("names").alias("n"), F.col("cells").alias("v"))).alias("x"))
    return flat.select(F.col("key").alias(key), F.col("x.n").alias(name), F.col("x.v").cast(kind).alias(value))


def write(
    cells: DataFrame, row: str, column: str, value: str, rows: DataFrame, columns: DataFrame, folder: str, fill=None,
    width: int = WIDTH
) -> Blocks:
    """Writes a long table as blocks. ``rows`` and ``columns`` (name, no) tell every row and column and their places; cells
    that the table lacks are ``fill``; two different values for one cell are an error."""
    spark = cells.sparkSession
    rows.select("name", "no").write.mode("overwrite").parquet(f"{folder}/rows")
    columns.select("name", "no").write.mode("overwrite").parquet(f"{folder}/columns")
    rows, columns = (spark.read.parquet(f"{folder}/{n}") for n in ("rows", "columns"))
    n_rows, n_columns = rows.count(), columns.count()
    kind = cells.schema[value].dataType
    held = cells.select(F.col(row).alias("__row"), F.col(column).alias("__column"), F.col(value).alias("__value"))
    held = held.join(rows.select(F.col("name").alias("__row"), "no"), "__row").join(
        columns.select(F.col("name").alias("__column"), F.col("no").alias("__c")), "__column"
    )
    # Cells are sorted, never searched for one another: the work on a block grows with its width, not with its square.
    packed = held.groupBy("no", F.floor(F.col("__c") / width).alias("stretch")).agg(
        F.sort_array(F.collect_list(F.struct((F.col("__c") % width).cast("int").alias("i"), "__value"))).alias("__all")
    )
    once = F.filter("__all", lambda x, j: ~x.eqNullSafe(F.get("__all", j - 1)))
    packed = packed.select("no", "stretch", F.map_from_entries(once).alias("__map"))
    last = max(0, (n_columns - 1) // width)
    every = rows.select("no", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("stretch"))
    size = F.least(F.lit(width), F.lit(n_columns) - F.col("stretch") * width).cast("int")
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    known = F.coalesce(F.map_keys("__map"), F.array().cast("array<int>"))
    lacking = F.transform(
        F.array_except(places, known), lambda i: F.struct(i.alias("key"), F.lit(None).cast(kind).alias("value"))
    )
    whole = F.sort_array(F.when(F.col("__map").isNull(), lacking).otherwise(F.concat(F.map_entries("__map"), lacking)))
    filled = F.transform(whole, lambda x: F.coalesce(x["value"], F.lit(fill).cast(kind)))
    out = every.join(packed, ["no", "stretch"], "left").select("no", "stretch", filled.alias("cells"))
    # Rows in order, so that a reader of some rows or stretches skips the others by the files' own statistics.
    out.repartitionByRange("no", "stretch").sortWithinPartitions("no", "stretch").write.mode("overwrite").parquet(
        f"{folder}/blocks"
    )
    return Blocks(spark, folder, row, n_rows, n_columns, width)
