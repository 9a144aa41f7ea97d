"""Places of rows in an order, and running sums along it, without a window over all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.sources import workspace


def numbered(
    rows: DataFrame, name: str, bins: Sequence[Column], order: Sequence, group: Sequence[str] = ()
) -> DataFrame:
    """rows with ``name``, their place from 1 within their group, by the bins and then by ``order``.

    The bins cut the order into stretches: only their counts are added up in one place, and only rows of one bin are
    sorted together. They must be few beside the rows and even enough for a task each."""
    keys = [f"__bin{i}" for i in range(len(bins))]
    rows = rows.withColumns(dict(zip(keys, bins, strict=True)))
    counts = rows.groupBy(*group, *keys).agg(F.count("*").alias("__count"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__count").over(before), F.lit(0))).drop("__count")
    own = F.row_number().over(Window.partitionBy(*group, *keys).orderBy(*order))
    joined = rows.withColumn("__own", own)
    counts = counts.withColumnsRenamed({c: f"__of_{c}" for c in (*group, *keys)})
    same = None
    for c in (*group, *keys):
        one = F.col(c).eqNullSafe(F.col(f"__of_{c}"))
        same = one if same is None else same & one
    out = joined.join(counts, same).withColumn(name, F.col("__own") + F.col("__before"))
    return out.drop(*keys, "__own", "__before", *[f"__of_{c}" for c in (*group, *keys)])


def hash_bin(hexadecimal: Column) -> Column:
    """One of 4096 even stretches of the order of a hash in hexadecimal digits."""
    return F.substring(hexadecimal, 1, 3)


def _stretches(rows: DataFrame, order: Sequence, group: Sequence[str], parts: int | None) -> DataFrame:
    """rows in stretches of about equal size, each sorted, with their stretch (__part) and place in it (__id). Spark cuts
    the order at splitters that it samples from the rows, so a group of any size lies in as many stretches as it fills.
    They are written, as all that follows must see the same cut."""
    cut = [*map(F.col, group), *order]
    ranged = rows.repartitionByRange(parts, *cut) if parts else rows.repartitionByRange(*cut)
    ranged = ranged.sortWithinPartitions(*cut).withColumn("__id", F.monotonically_increasing_id())
    path = workspace.folder(rows.sparkSession, "stretches")
    ranged.withColumn("__part", F.shiftright("__id", 33)).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _with(held: DataFrame, counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """held joined to what is known of its stretches: a row for each group and stretch."""
    keys = [*group, "__part"]
    counts = counts.withColumnsRenamed({c: f"__of_{c}" for c in keys})
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    return held.join(counts, same).drop(*[f"__of_{c}" for c in keys])


def placed(rows: DataFrame, name: str, order: Sequence, group: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """rows with ``name``, their place from 1 within their group by ``order``. The stretches' counts alone are added up
    in one place; within a stretch a row's place is known from how it was written."""
    held = _stretches(rows, order, group, parts)
    counts = held.groupBy(*group, "__part").agg(F.count("*").alias("__count"), F.min("__id").alias("__first"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("__count").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = _with(held, counts.withColumn("__before", before), group)
    place = F.col("__id") - F.col("__first") + F.col("__before") + 1
    return out.withColumn(name, place.cast("long")).select(*rows.columns, name)


def accumulated(
    rows: DataFrame, sums: Mapping[str, str], order: Sequence, group: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """rows with running sums along ``order`` within their group: for each name the sum of a column up to and with the row,
    and as ``<name>_all`` that of the whole group. Only rows of one stretch are added up together."""
    held = _stretches(rows, order, group, parts)
    counts = held.groupBy(*group, "__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    above = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *group, "__part", *[F.coalesce(F.sum(f"__{n}").over(above), F.lit(0)).alias(f"__before_{n}") for n in sums],
        *[F.sum(f"__{n}").over(whole).alias(f"{n}_all") for n in sums]
    )
    own = Window.partitionBy(*group, "__part").orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    for n, c in sums.items():
        held = held.withColumn(n, F.sum(c).over(own))
    out = _with(held, counts, group)
    for n in sums:
        out = out.withColumn(n, F.col(n) + F.col(f"__before_{n}"))
    return out.select(*rows.columns, *sums, *[f"{n}_all" for n in sums])
