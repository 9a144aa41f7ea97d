"""Joins of points with the closed intervals that hold them.

Catalyst has only an equality join with a condition left over, which compares every point of a chromosome with
every interval. Here intervals are listed under the bins they touch and points under the one bin they lie in, so
the join is an equality on (chromosome, bin) and each match arises once. Very long intervals go to a coarser level
of bins, so none is listed under more than ``COARSER`` + 1 bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of the finest level in positions; each further level is this many times coarser.
WIDTH, COARSER, LEVELS = 256, 64, 5


def stab(
    points: DataFrame, intervals: DataFrame, chrom: str = "chrom", pos: str = "pos", start: str = "start",
    end: str = "end", width: int = WIDTH, how: str = "inner"
) -> DataFrame:
    """points joined to intervals with ``start <= pos <= end`` on the same chromosome.

    Columns of both sides must differ but for ``chrom``. ``how`` is inner, left or left_semi.
    """
    size = F.col(end) - F.col(start)
    level = F.lit(0)
    for k in range(1, LEVELS):
        level = F.when(size >= width * COARSER**k, k).otherwise(level)
    listed = intervals.where(F.col(start) <= F.col(end)).withColumn("__level", level)
    bin_width = F.lit(width) * F.pow(F.lit(COARSER), F.col("__level")).cast("long")
    bin_of = lambda c: F.floor(c / bin_width)
    listed = listed.withColumn(
        "__bin", F.explode(F.sequence(bin_of(F.col(start)), bin_of(F.col(end))))
    ).withColumnRenamed(chrom, "__chrom")
    # Points are listed only for the levels that some interval has, one as a rule: one row with LEVELS values at most.
    used = intervals.where(F.col(start) <= F.col(end)).agg(F.collect_set(level).alias("__used"))
    place = lambda k: F.struct(k.alias("level"), F.floor(F.col(pos) / (F.lit(width) * F.pow(F.lit(COARSER), k).cast("long"))).alias("bin"))
    placed = points.crossJoin(F.broadcast(used)).withColumn(
        "__levels", F.explode(F.transform("__used", place))
    ).drop("__used")
    hit = (F.col(chrom) == F.col("__chrom")) & (F.col("__levels.level") == F.col("__level")) & (F.col("__levels.bin") == F.col("__bin")) & F.col(pos).between(
        F.col(start), F.col(end)
    )
    if how == "inner":
        return placed.join(listed, hit).drop("__levels", "__level", "__bin", "__chrom")
    if how not in ("left", "left_semi"):
        raise ValueError(f"how must be inner, left or left_semi, not {how}")
    # What holds a point depends on its place alone, so it is settled once for each place.
    hits = stab(points.select(chrom, pos).distinct(), intervals, chrom, pos, start, end, width)
    if how == "left_semi":
        return points.join(hits.select(chrom, pos).distinct(), [chrom, pos], "left_semi")
    return points.join(hits, [chrom, pos], "left")


def stab_values(points: DataFrame, intervals: DataFrame, value: str, out: str, keys: list[str], **columns) -> DataFrame:
    """keys and the sorted set of ``value`` over the intervals that hold each point, for points that any holds."""
    return stab(
        points.select(*keys).distinct(), intervals, **columns
    ).groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(out))
