"""Delimited tables. Every column is read as text and cast where its meaning is known; nothing is inferred."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions.names import empty_to_null, standard_chrom, strip
from lociflow.operators.checks import require_known

GENOTYPE_COLUMN = re.compile(r"Chr\d+:\d+")
#: Other names of the columns of a site table.
ALIASES = {
    "Chromosome": ("chrom", "chr"),
    "Position": ("pos",),
    "REF": ("ref_allele",),
    "ALT": ("alt_allele",),
    "VARIANT_TYPE": (),
}


def text_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", False).option("enforceSchema", False).csv(path)


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{what} lacks the columns {', '.join(missing)}")


def number(c: Column) -> Column:
    """Text to double; what is no number becomes null."""
    x = strip(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def _trait(name: str = "Trait") -> Column:
    return F.coalesce(F.col(name), F.lit("nan"))


def gwas(df: DataFrame, max_pvalue: float = 1e6) -> DataFrame:
    """chrom, pos, trait of hits (Chromosome, Position, Trait[, pvalue]) with a p-value under the limit."""
    require_columns(df, ["Chromosome", "Position", "Trait"], "the GWAS table")
    if "pvalue" in df.columns:
        df = df.where(number(F.col("pvalue").cast("string")) < max_pvalue)
    pos = number(F.col("Position").cast("string")).cast("long")
    return df.select(
        standard_chrom(F.col("Chromosome").cast("string")).alias("chrom"), pos.alias("pos"), _trait().alias("trait")
    ).dropna(subset=["chrom", "pos"])


def qtl(df: DataFrame, min_lod: float = 0.0, min_pve: float = 0.0) -> DataFrame:
    """chrom, start, end, trait, qtl of intervals whose LOD and PVE, where given, exceed the limits; bounds in
    order."""
    require_columns(df, ["Chromosome", "start_pos", "end_pos", "Trait"], "the QTL table")
    for name, least in (("LOD", min_lod), ("PVE", min_pve)):
        if name in df.columns:
            df = df.where(number(F.col(name).cast("string")) > least)
    a, b = (number(F.col(c).cast("string")).cast("long") for c in ("start_pos", "end_pos"))
    name = F.col("QTL").cast("string") if "QTL" in df.columns else F.lit("")
    out = df.select(
        standard_chrom(F.col("Chromosome").cast("string")).alias("chrom"), a.alias("__a"), b.alias("__b"),
        _trait().alias("trait"), name.alias("qtl")
    ).dropna(subset=["chrom", "__a", "__b"])
    return out.select(
        "chrom", F.least("__a", "__b").alias("start"), F.greatest("__a", "__b").alias("end"), "trait", "qtl"
    )


def first_column(df: DataFrame, name: str) -> DataFrame:
    """The distinct, non-empty values of a table's first column, as ``name``."""
    return df.select(empty_to_null(F.col(f"`{df.columns[0]}`").cast("string")).alias(name)).dropna().distinct()


def site_table(df: DataFrame) -> DataFrame:
    """chrom, pos, ref, alt, variant_type from a table with any of the known column names; ref and alt are null
    where the table lacks them."""
    by_lower = {c.strip().lower(): c for c in df.columns}
    found = {}
    for name, others in ALIASES.items():
        if name in df.columns:
            found[name] = name
        elif hit := next((by_lower[o] for o in (name.lower(), *others) if o in by_lower), None):
            found[name] = hit
    if missing := [n for n in ("Chromosome", "Position", "VARIANT_TYPE") if n not in found]:
        raise ValueError(f"the site table lacks the columns {', '.join(missing)}")
    x = number(F.col(f"`{found['Position']}`").cast("string"))
    pos = F.when(
        x.isNotNull() & (x != F.floor(x)), F.raise_error(F.concat(F.lit("not a whole position: "), x.cast("string")))
    ).otherwise(x).cast("long")
    allele = lambda n: empty_to_null(F.upper(F.col(f"`{found[n]}`"))) if n in found else F.lit(None).cast("string")
    out = df.select(
        standard_chrom(F.col(f"`{found['Chromosome']}`").cast("string")).alias("chrom"), pos.alias("pos"),
        allele("REF").alias("ref"), allele("ALT").alias("alt"),
        empty_to_null(F.coalesce(F.col(f"`{found['VARIANT_TYPE']}`"), F.lit("nan"))).alias("variant_type")
    )
    return out.dropna(subset=["chrom", "pos", "variant_type"])


def numbered(df: DataFrame, name: str = "ord") -> DataFrame:
    """Rows with their order in the file: increasing within a file, as partitions are read in order."""
    return df.withColumn(name, F.monotonically_increasing_id())


def genotype_features(columns: Sequence[str]) -> list[str]:
    """The columns after ``sample``, each of the form ChrN:position."""
    if not columns or columns[0] != "sample":
        raise ValueError("the first column of a genotype table is sample")
    if bad := [c for c in columns[1:] if not GENOTYPE_COLUMN.fullmatch(c)]:
        raise ValueError(f"not genotype columns: {bad[:20]}")
    return list(columns[1:])


def genotypes(df: DataFrame) -> DataFrame:
    """ord, sample and a tinyint column for each site. Values other than 0, 1 and 2 are an error. Rows keep the ``ord``
    that they have."""
    features = genotype_features([c for c in df.columns if c != "ord"])
    typed = (df if "ord" in df.columns else numbered(df)).select(
        "ord", strip(F.col("sample")).alias("sample"), *[F.col(f"`{c}`").cast("double").alias(c) for c in features]
    )
    bad = typed.where(
        F.exists(F.array(*[F.col(f"`{c}`") for c in features]), lambda v: v.isNull() | ~v.isin(0.0, 1.0, 2.0))
    ).limit(1).collect() if features else []
    if bad:
        raise ValueError(f"genotypes other than 0, 1 and 2, first for sample {bad[0]['sample']}")
    return typed.select("ord", "sample", *[F.col(f"`{c}`").cast("tinyint").alias(c) for c in features])


def phenotypes(df: DataFrame) -> DataFrame:
    """ord, sample, value and 0/1 columns loc*."""
    columns = [c for c in df.columns if c != "ord"]
    if columns[:2] != ["sample", "value"]:
        raise ValueError("a phenotype table begins with sample and value")
    if bad := [c for c in columns[2:] if not c.startswith("loc")]:
        raise ValueError(f"not location columns: {bad[:20]}")
    return (df if "ord" in df.columns else numbered(df)).select(
        "ord", strip(F.col("sample")).alias("sample"), F.col("value").cast("double").alias("value"),
        *[F.col(f"`{c}`").cast("double").cast("int").alias(c) for c in columns[2:]]
    )


def importance(df: DataFrame) -> DataFrame:
    """ord, feature, importance_gain, importance_split."""
    require_columns(df, ["feature", "importance_gain", "importance_split"], "the importance table")
    return (df if "ord" in df.columns else numbered(df)).select(
        "ord", "feature", F.col("importance_gain").cast("double").alias("importance_gain"),
        F.col("importance_split").cast("double").alias("importance_split")
    )


def last_effects(df: DataFrame) -> DataFrame:
    """site_id, effect; of several rows the last counts."""
    require_columns(df, ["Chromosome", "Position", "site_id", "var_effect"], "the effect table")
    rows = df if "ord" in df.columns else numbered(df)
    return rows.groupBy("site_id").agg(F.max_by(F.col("var_effect").cast("double"), "ord").alias("effect"))


def variant_effects(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Effect of each genotype feature; none may lack."""
    last = last_effects(df)
    wanted = df.sparkSession.createDataFrame([(f,) for f in features], "site_id string")
    known = last.where("effect IS NOT NULL")
    require_known(wanted, known, "site_id", "features without an effect")
    return {r["site_id"]: r["effect"] for r in wanted.join(known, "site_id").collect()}


def excel(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """A sheet of a workbook, read on the driver; workbooks are small."""
    import pandas as pd

    return spark.createDataFrame(pd.read_excel(path, sheet_name=sheet))


def sheet(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A sheet of a workbook, or a delimited or Parquet table by the ending of the path."""
    if path.lower().endswith((".xlsx", ".xls", ".xlsm")):
        return excel(spark, path, name)
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else text_table(
        spark, path, "\t" if path.lower().endswith(".tsv") else ","
    )


def phenotype_genotype(phenotype: DataFrame, genotype: DataFrame) -> DataFrame:
    """Phenotype rows with their sample's genotypes, in the order of the phenotypes; an empty result is an error."""
    out = phenotype.join(genotype.drop("ord"), "sample")
    if out.isEmpty():
        raise ValueError("no sample has both a phenotype and a genotype")
    return out.orderBy("ord")


def sample_rows(rows: DataFrame, sample: str) -> DataFrame:
    out = rows.where(F.col("sample").cast("string") == str(sample))
    if out.isEmpty():
        raise ValueError(f"no row of sample {sample}")
    return out
