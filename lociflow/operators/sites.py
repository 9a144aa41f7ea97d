"""Candidate sites: variants with an associated trait, within an interval of a trait, or both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.functions.names import chrom_order, first_of, strip
from lociflow.operators.intervals import stab, stab_values

_NONE = "cast(array() as array<string>)"


def gwas_traits(gwas: DataFrame) -> DataFrame:
    """chrom, pos, gwas_traits: the sorted set of traits of each position."""
    return gwas.groupBy("chrom", "pos").agg(F.array_sort(F.collect_set("trait")).alias("gwas_traits"))


def merge_values(column: str):
    """Sorted set of the stripped, non-empty parts of a comma-separated column, as text."""
    filled = F.when(strip(F.col(column)) != "", strip(F.col(column)))
    return F.array_join(F.array_sort(F.collect_set(filled)), ",")


def select_sites(
    variants: DataFrame, gwas: DataFrame, qtl: DataFrame, mode: str = "union", shared: str = "trait"
) -> DataFrame:
    """chrom, pos, ref, alt, qtl_trait, gwas_trait of the variants (chrom, pos, ref, alt) to keep.

    union: a trait is associated with the position or an interval holds it. intersect: some trait does both, and
    both columns list just those; with ``shared="site"`` it is enough that each side has any trait.
    """
    if mode not in ("union", "intersect"):
        raise ValueError(f"mode must be union or intersect, not {mode}")
    qtl = qtl.select("chrom", "start", "end", strip(F.col("trait")).alias("__trait")).where(F.col("__trait") != "")
    hits = stab_values(variants, qtl, "__trait", "qtl_traits", ["chrom", "pos"])
    sites = variants.join(gwas_traits(gwas), ["chrom", "pos"], "left").join(hits, ["chrom", "pos"], "left")
    g, q = F.coalesce("gwas_traits", F.expr(_NONE)), F.coalesce("qtl_traits", F.expr(_NONE))
    sites = sites.withColumn("gwas_traits", g).withColumn("qtl_traits", q)
    if mode == "union":
        sites = sites.where((F.size("gwas_traits") > 0) | (F.size("qtl_traits") > 0))
    elif shared == "site":
        sites = sites.where((F.size("gwas_traits") > 0) & (F.size("qtl_traits") > 0))
    else:
        both = F.array_sort(F.array_intersect("gwas_traits", "qtl_traits"))
        sites = sites.withColumn("gwas_traits", both).withColumn(
            "qtl_traits", F.col("gwas_traits")
        ).where(F.size("gwas_traits") > 0)
    # Traits go by position, so equal rows are all there is to merge.
    listed = lambda c: strip(F.array_join(c, ",")).alias(c.removesuffix("s"))
    return sites.select("chrom", "pos", "ref", "alt", listed("qtl_traits"), listed("gwas_traits")).distinct()


def extend_genes(genes: DataFrame, ext_len: int = 0) -> DataFrame:
    """chrom, gene_id, gene_start, gene_end from features (chrom, start, end, id, name, parent): the first label
    that is filled names the gene; bounds reach ext_len further, not below 1; what then ends before 1 is dropped."""
    named = genes.select(
        "chrom", F.greatest(F.col("start") - ext_len, F.lit(1)).alias("gene_start"),
        (F.col("end") + ext_len).alias("gene_end"),
        first_of(F.col("id"), F.col("name"), F.col("parent")).alias("gene_id")
    )
    return named.where(
        F.col("gene_id").isNotNull() & F.col("chrom").isNotNull() & (F.col("gene_end") >= F.col("gene_start"))
    )


def map_to_genes(sites: DataFrame, genes: DataFrame) -> DataFrame:
    """A row for each site and gene that holds it; traits of equal rows are merged."""
    hit = stab(sites, genes, start="gene_start", end="gene_end")
    keys = ["chrom", "pos", "gene_id", "gene_start", "gene_end", "ref", "alt"]
    return hit.groupBy(*keys).agg(
        merge_values("qtl_trait").alias("qtl_trait"), merge_values("gwas_trait").alias("gwas_trait")
    )


def gene_subset(rows: DataFrame, genes: DataFrame | None) -> DataFrame:
    """Rows of the listed genes; all rows if there is no list or it is empty."""
    if genes is None or genes.isEmpty():
        return rows
    return rows.join(genes.select("gene_id").distinct(), "gene_id", "left_semi")


def in_order(rows: DataFrame, *then: str) -> DataFrame:
    """By chromosome number, position and further columns."""
    return rows.orderBy(chrom_order(F.col("chrom")), "chrom", "pos", *then)
