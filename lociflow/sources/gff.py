"""GFF3 and GTF annotation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.attributes import attributes, labels
from lociflow.functions.names import standard_chrom, strip
from lociflow.sources import files

#: The fields of a record.
FIELDS = ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes")


def records(lines: DataFrame) -> DataFrame:
    """ord and the nine fields of every record among lines of text (value, and ord if they have one). Comments and lines
    with another number of fields go; so do the sequence lines after ##FASTA, as they have one field."""
    order = F.col("ord") if "ord" in lines.columns else F.monotonically_increasing_id()
    parts = F.split(strip(F.col("value")), "\t")
    rows = lines.select(order.alias("ord"), "value").where(~strip(F.col("value")).startswith("#"))
    rows = rows.select("ord", parts.alias("p")).where(F.size("p") == len(FIELDS))
    return rows.select("ord", *[F.get("p", F.lit(i)).alias(f) for i, f in enumerate(FIELDS)])


def features(rows: DataFrame, wanted: str | Sequence[str]) -> DataFrame:
    """ord, chromosome, start, end, feature, strand, id, name, parent, attributes (text), attrs (map) of the wanted
    types; rows whose bounds are no whole numbers go."""
    names = [wanted.strip()] if isinstance(wanted, str) else list(dict.fromkeys(w.strip() for w in wanted if w.strip()))
    if not names:
        raise ValueError("name at least one feature type")
    rows = rows.where(F.col("type").isin(names)).withColumn("attrs", attributes(F.col("attributes")))
    own, name, parent = labels(F.col("attrs"))
    whole = lambda c: F.when(F.col(c).rlike(r"^\s*[+-]?[0-9]+\s*$"), strip(F.col(c)).try_cast("long"))
    out = rows.select(
        "ord", F.col("seqid").alias("chromosome"), whole("start").alias("start"), whole("end").alias("end"),
        F.col("type").alias("feature"), "strand", own.alias("id"), name.alias("name"), parent.alias("parent"),
        "attributes", "attrs"
    )
    return out.dropna(subset=["start", "end"])


def read(spark: SparkSession, path: str, wanted: str | Sequence[str] = "gene") -> DataFrame:
    return features(records(spark.read.text(path)), wanted)


def read_cached(
    spark: SparkSession, path: str, wanted: str | Sequence[str] = "gene", cache: str | None = None,
    force_rebuild: bool = False
) -> DataFrame:
    """read from a Parquet copy of the records, by default beside the file, that is made anew when the file, or any file
    of the folder, has changed or is asked to. A copy counts once it is whole."""
    copy = f"{cache or path.rstrip('/') + '.records'}/{files.signature(spark, path)['digest']}"
    if force_rebuild or not files.exists(spark, f"{copy}/_SUCCESS"):
        records(spark.read.text(path)).write.mode("overwrite").parquet(copy)
    return features(spark.read.parquet(copy), wanted)


def merged(rows: DataFrame) -> DataFrame:
    """features with those of one id and type as one: the outermost bounds and the first of the other labels, as
    a feature database keeps them. Features without an id stay as they are."""
    named, plain = rows.where("id <> ''"), rows.where("id = ''")
    first = lambda c: F.min_by(c, "ord").alias(c)
    one = named.groupBy("chromosome", "feature", "id").agg(
        F.min("ord").alias("ord"), F.min("start").alias("start"), F.max("end").alias("end"), *map(
            first, ("strand", "name", "parent", "attributes")
        )
    )
    return one.withColumn("attrs", attributes(F.col("attributes"))).select(*rows.columns).unionByName(plain)


def intervals(rows: DataFrame) -> DataFrame:
    """features on standard chromosomes, as ``operators.sites.extend_genes`` takes them."""
    return rows.withColumn("chrom", standard_chrom(F.col("chromosome"))).where(F.col("chrom").isNotNull())
