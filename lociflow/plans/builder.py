"""Site dataset: hits, intervals, genes, variants and a genome to matrices of genotypes, effects and genes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.embed.cache import CachedEmbedder
from lociflow.functions.names import chrom_order, site_id
from lociflow.operators import blocks, effects, genotypes, sites, splits
from lociflow.operators.genotypes import first_by
from lociflow.plans.resume import Stages
from lociflow.sources import bgzf, fasta, gff, sinks, tables, vcf
from lociflow.sources.config import BuilderConfig

#: Settings that do not change what a stage holds.
_IGNORED = ("outdir", "resume", "wide", "split", "test_ratio", "seed", "isolated_samples_path")


def signed(c: BuilderConfig) -> tuple[dict, dict]:
    """The settings and inputs that a run is known by."""
    return {k: v for k, v in asdict(c).items() if k not in _IGNORED}, {
        k: v for k, v in asdict(c).items() if k.endswith("_path")
    }


def _samples(spark: SparkSession, path: str) -> list[list[str]]:
    """Names of the header and the names that samples go by, in order; as many as the header has."""
    raw = spark.createDataFrame(list(enumerate(vcf.samples(spark, path))), "idx int, raw_sample string")
    return [[r["raw_sample"], r["sample"]] for r in genotypes.standard_samples(raw).orderBy("idx").collect()]


def run(spark: SparkSession, c: BuilderConfig) -> dict[str, str]:
    """Runs the stages that are not done yet and returns the paths of the results."""
    stages = Stages(spark, c.outdir, *signed(c), c.resume)
    embed = CachedEmbedder(c.embedder, f"{c.outdir}/embeddings", **(c.embedder_options or {}))
    lines = vcf.lines(spark, c.vcf_path, spark.sparkContext.defaultParallelism)
    genome = fasta.read_pieces(spark, c.fasta_path, overlap=max(fasta.OVERLAP, 4 * c.k + 1_000))
    out: dict[str, str] = {}

    def csv(name: str, rows: DataFrame) -> None:
        out[name] = sinks.save_csv(rows, f"{c.outdir}/{name}.csv")

    gwas = tables.gwas(tables.text_table(spark, c.gwas_path), c.max_pvalue)
    qtl = tables.qtl(tables.text_table(spark, c.qtl_path), c.min_lod, c.min_pve)
    chosen = stages.run("initial_sites", lambda: sites.select_sites(vcf.first_alt(lines), gwas, qtl, c.type))
    if chosen.isEmpty():
        raise ValueError("no site is selected")
    csv(
        "sites_union_or_intersect",
        sites.in_order(chosen, "ref", "alt").select("chrom", "pos", "qtl_trait", "gwas_trait")
    )

    # One row for each position; gene sites are among them, so effects are computed once for both.
    single = first_by(chosen, ["chrom", "pos"], "ref", "alt")
    effect = stages.run("all_site_variant_effects", lambda: effects.variant_effects(single, genome, c.k, embed))
    csv("all_site_variant_effect", sites.in_order(effect.select("chrom", "pos", "site_id", "var_effect")))

    found = gff.intervals(
        gff.merged(
            gff.read_cached(spark, c.gff3_path, c.gff3_feature, f"{c.outdir}/annotation")
        ) if c.use_gffutils else gff.read(spark, c.gff3_path, c.gff3_feature)
    )
    wanted = tables.first_column(tables.text_table(spark, c.gene_list_path), "gene_id") if c.gene_list_path else None
    in_gene = stages.run(
        "gene_sites",
        lambda: sites.gene_subset(sites.map_to_genes(chosen, sites.extend_genes(found, c.ext_len)), wanted)
    )
    if in_gene.isEmpty():
        raise ValueError("no site lies in a gene")
    csv(
        "sites_in_gene",
        sites.in_order(
            in_gene, "gene_id", "gene_start", "gene_end", "ref", "alt"
        ).select("chrom", "pos", "qtl_trait", "gwas_trait", "gene_id")
    )

    mapping = stages.note("samples", lambda: _samples(spark, c.vcf_path))
    names = spark.createDataFrame([(i, *x) for i, x in enumerate(mapping)], "idx int, raw_sample string, sample string")
    order = [sample for _, sample in mapping]
    csv("sample_mapping", names.orderBy("idx").select("raw_sample", "sample"))

    def called() -> DataFrame:
        """Of a block-gzip file only the ranges with sites in genes are read again."""
        own = lines
        if bgzf.is_blocked(spark, c.vcf_path):
            known = stages.run("variant_index", lambda: vcf.index(spark, c.vcf_path))
            own = vcf.lines_at(spark, c.vcf_path, in_gene, known)
        return genotypes.long_genotypes(vcf.calls(own, order), in_gene)

    calls = stages.run("genotypes", called)

    gene_effect = effect.join(
        in_gene.select(site_id(F.col("chrom"), F.col("pos")).alias("site_id")).distinct(), "site_id", "left_semi"
    )
    csv("variant_effect_by_site", sites.in_order(gene_effect.select("chrom", "pos", "site_id", "var_effect")))
    matrix = stages.run("variant_effects", lambda: genotypes.effect_matrix(calls, gene_effect))
    features = stages.run(
        "gene_features",
        lambda: effects.gene_features(effects.gene_sequences(in_gene, calls, genome), in_gene, names, embed)
    )

    if c.wide or c.split:
        by_sample = names.select(F.col("sample").alias("name"), F.col("idx").cast("long").alias("no"))
        by_site = blocks.index(
            calls.select("site_id", "chrom", "pos"), "site_id", [chrom_order(F.col("chrom")), F.col("chrom"), F.col("pos")]
        )
        by_gene = blocks.index(features.select("gene_id"), "gene_id")
        made = {
            name: sinks.save_matrix(rows, row, column, value, rows_by, columns_by, f"{c.outdir}/{name}", fill)
            for name, rows, row, column, value, rows_by, columns_by, fill in (
                ("genotype_site_by_sample", calls, "site_id", "sample", "dosage", by_site, by_sample, 0),
                ("genotype_sample_by_site", calls, "sample", "site_id", "dosage", by_sample, by_site, 0),
                ("variant_effect_sample_by_site", matrix, "sample", "site_id", "value", by_sample, by_site, 0.0),
                ("gene_feature_sample_by_gene", features, "sample", "gene_id", "value", by_sample, by_gene, 0.0),
            )
        }
        out |= {name: f"{c.outdir}/{name}.parquet" for name in made}
    if c.split:
        isolated = []
        if c.isolated_samples_path:
            isolated = [
                r[0] for r in tables.first_column(tables.text_table(spark, c.isolated_samples_path), "sample").collect()
            ]
            if unknown := sorted(set(isolated) - set(order)):
                raise ValueError(f"isolated samples that the variants lack: {unknown[:20]}")
        train, test = splits.split_samples(order, isolated, c.test_ratio, c.seed)
        matrices = {
            "genotype_012": made["genotype_sample_by_site"],
            "variant_effect_matrix": made["variant_effect_sample_by_site"],
            "gene_sequence_feature_matrix": made["gene_feature_sample_by_gene"],
        }
        meta = {"split_test_ratio": c.test_ratio, "split_random_state": c.seed, "isolated_samples": isolated}
        out |= sinks.save_splits(matrices, train, test, f"{c.outdir}/splits", meta)
    return out


def score_all_variants(
    spark: SparkSession, vcf_path: str, fasta_path: str, outdir: str, k: int = 100, embedder: str = "kmer",
    options: Mapping | None = None
) -> DataFrame:
    """Effects of every alternative allele of a VCF file, written as CSV and Parquet."""
    genome = fasta.read_pieces(spark, fasta_path, overlap=max(fasta.OVERLAP, 4 * k + 1_000))
    found = effects.variant_effects(
        vcf.all_alts(vcf.lines(spark, vcf_path)), genome, k,
        CachedEmbedder(embedder, f"{outdir}/embeddings", **(options or {}))
    )
    ordered = sites.in_order(found, "ref", "alt").select("chrom", "pos", "site_id", "var_effect")
    return spark.read.parquet(sinks.save_dual(ordered, f"{outdir}/all_variant_effects")[1])
