"""Variant call files as text: plain, gzip, or block-gzip. The last is read by many tasks at once, and an index of its
ranges lets a reader that knows its sites leave out the others; a gzip file is one task, so its rows are dealt out after it
is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.genotype import variant_type
from lociflow.functions.names import allele_site_id, standard_chrom
from lociflow.operators.genotypes import first_by
from lociflow.operators.intervals import stab
from lociflow.sources import bgzf, ranges

FIXED = 9
#: Compressed bytes of a range that the index knows by itself.
INDEXED_BYTES = 1 << 20


def _rows(
    spark: SparkSession, path: str, parts: list[ranges.Range] | None = None, range_bytes: int = ranges.RANGE_BYTES
) -> DataFrame:
    """ord and value of every line; of a block-gzip file only of the given ranges."""
    if parts is not None or bgzf.is_blocked(spark, path):
        parts = ranges.cut(ranges.files(spark, path), range_bytes) if parts is None else parts
        return bgzf.read(spark, parts)
    return spark.read.text(path).withColumn("ord", F.monotonically_increasing_id())


def _fields(rows: DataFrame) -> DataFrame:
    rows = rows.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    return rows.select("ord", F.split("value", "\t").alias("f"))


def lines(
    spark: SparkSession, path: str, partitions: int | None = None, range_bytes: int = ranges.RANGE_BYTES
) -> DataFrame:
    """ord and the tab-separated fields of every record. A block-gzip file is read in ranges of ``range_bytes``, small
    ones together; what one task must read is dealt out to ``partitions``."""
    rows = _rows(spark, path, None, range_bytes)
    dealt = partitions and path.endswith((".gz", ".bgz")) and not bgzf.is_blocked(spark, path)
    return _fields(rows.repartition(partitions) if dealt else rows)


def index(spark: SparkSession, path: str, range_bytes: int = INDEXED_BYTES) -> DataFrame:
    """no, chrom, low, high: of each range of a block-gzip file and each standard chromosome in it the least and greatest
    position."""
    f = F.col("f")
    rows = _fields(bgzf.read(spark, ranges.cut(ranges.files(spark, path), range_bytes))).select(
        F.shiftright("ord", bgzf.PLACE_BITS).alias("no"), standard_chrom(F.get(f, F.lit(0))).alias("chrom"),
        F.get(f, F.lit(1)).cast("long").alias("pos")
    )
    return rows.where(F.col("chrom").isNotNull()).groupBy("no", "chrom").agg(
        F.min("pos").alias("low"), F.max("pos").alias("high")
    )


def ranges_at(
    spark: SparkSession, path: str, sites: DataFrame, known: DataFrame, range_bytes: int = INDEXED_BYTES
) -> list[ranges.Range]:
    """The ranges of a block-gzip file that may hold a site (chrom, pos), by its index."""
    points = sites.select("chrom", "pos").distinct()
    found = stab(points, known, start="low", end="high").select("no").distinct()
    wanted = {r.no for r in found.collect()}  # no more than the driver has cut
    return [r for r in ranges.cut(ranges.files(spark, path), range_bytes) if r.no in wanted]


def lines_at(
    spark: SparkSession, path: str, sites: DataFrame, known: DataFrame, range_bytes: int = INDEXED_BYTES
) -> DataFrame:
    """The records of the ranges that may hold a site: all of its sites' records, and some of others."""
    return _fields(_rows(spark, path, ranges_at(spark, path, sites, known, range_bytes)))


def samples(spark: SparkSession, path: str) -> list[str]:
    """Sample names in the order of the header, which stands in the first file's first range."""
    found = ranges.files(spark, path)
    first = ranges.cut(found[:1])[:1] if found and bgzf.is_blocked(spark, path) else None
    head = _rows(spark, path, first).where(F.col("value").startswith("#CHROM")).limit(1).collect()
    if not head:
        raise ValueError(f"{path} has no header line")
    return head[0].value.rstrip("\r\n").split("\t")[FIXED:]


def _alts(f: Column) -> Column:
    return F.filter(F.split(F.upper(F.get(f, F.lit(4))), ","), lambda a: (a != ".") & (a != ""))


def first_alt(rows: DataFrame) -> DataFrame:
    """ord, chrom, pos, ref, alt with the first alternative allele, empty if there is none."""
    f = F.col("f")
    out = rows.select(
        "ord", standard_chrom(F.get(f, F.lit(0))).alias("chrom"), F.get(f, F.lit(1)).cast("long").alias("pos"),
        F.upper(F.get(f, F.lit(3))).alias("ref"), F.coalesce(F.get(_alts(f), F.lit(0)), F.lit("")).alias("alt")
    )
    return out.where(F.col("chrom").isNotNull())


def all_alts(rows: DataFrame) -> DataFrame:
    """ord, chrom, pos, ref, alt with a row for each alternative allele; no row at all is an error."""
    f = F.col("f")
    out = rows.select(
        "ord", standard_chrom(F.get(f, F.lit(0))).alias("chrom"), F.get(f, F.lit(1)).cast("long").alias("pos"),
        F.upper(F.get(f, F.lit(3))).alias("ref"), F.explode(_alts(f)).alias("alt")
    ).where(F.col("chrom").isNotNull())
    if out.isEmpty():
        raise ValueError("no variant with an alternative allele on a numbered chromosome")
    return out


def calls(rows: DataFrame, names: list[str]) -> DataFrame:
    """ord, chrom, pos, sample, gt of every sample; gt is the GT part by the record's own FORMAT, ``./.`` if it
    has none."""
    f = F.col("f")
    place = F.array_position(F.split(F.get(f, F.lit(8)), ":"), "GT")
    own = F.posexplode(F.slice(f, FIXED + 1, len(names)))
    out = rows.where(F.size("f") > FIXED).select(
        "ord", standard_chrom(F.get(f, F.lit(0))).alias("chrom"), F.get(f, F.lit(1)).cast("long").alias("pos"),
        place.cast("int").alias("place"), own.alias("i", "cell")
    ).where(F.col("chrom").isNotNull())
    gt = F.when(F.col("place") > 0, F.try_element_at(F.split("cell", ":"), F.col("place")))
    name = F.array(*map(F.lit, names))
    return out.select(
        "ord", "chrom", "pos", F.element_at(name, F.col("i") + 1).alias("sample"),
        F.coalesce(gt, F.lit("./.")).alias("gt")
    )


def labelled(variants: DataFrame, sites: DataFrame, by_position: bool = False) -> DataFrame:
    """site_id, chrom, pos, ref, alt, variant_type of the variants that a site table asks for: by position, and by
    alleles as well if the table has both. The type comes from the table (its last row for the key), else from
    the alleles. A table without alleles gives no types unless ``by_position``."""
    alleles = not sites.where("ref IS NOT NULL AND alt IS NOT NULL").isEmpty()
    keys = ["chrom", "pos", "ref", "alt"] if alleles else ["chrom", "pos"]
    kept = variants.join(sites.select(*keys).distinct(), keys, "left_semi")
    own = variant_type(F.col("ref"), F.col("alt"))
    if alleles or by_position:
        last = sites.withColumn(
            "__o", F.monotonically_increasing_id()
        ).groupBy(*keys).agg(F.max_by("variant_type", "__o").alias("__label"))
        kept = kept.join(last, keys, "left").withColumn("variant_type", F.coalesce("__label", own)).drop("__label")
    else:
        kept = kept.withColumn("variant_type", own)
    kept = first_by(kept, ["chrom", "pos", "ref", "alt"], "ord")
    return kept.select(
        allele_site_id(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")).alias("site_id"), "chrom", "pos",
        "ref", "alt", "variant_type"
    )
