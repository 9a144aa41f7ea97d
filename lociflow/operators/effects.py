"""Effects of variants and of whole genes, as distances of embeddings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.functions.names import site_id
from lociflow.functions.sequence import apply_variants, flanks
from lociflow.functions.vectors import l2
from lociflow.operators.genotypes import first_by
from lociflow.sources import workspace

Embed = Callable[[DataFrame], DataFrame]
#: Bases that a slice of a piece holds, beside those that it reaches over its ends.
SLICE = 1_024


def _written(rows: DataFrame, name: str) -> DataFrame:
    """rows from a copy on disk: what embeds them and what joins the vectors to them then reads the copy, where each would
    otherwise read the genome and put the sequences together again."""
    path = workspace.folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _slices(genome: DataFrame, step: int, k: int) -> DataFrame:
    """chrom, slice, seq, seq_start: pieces cut up so that a variant meets few bases besides its own; each slice reaches
    k bases over its ends."""
    core = F.greatest(F.lit(1), F.least(F.col("seq_len") - F.col("piece") * step, F.lit(step)))
    start = lambda j: F.greatest(F.lit(1), F.col("piece") * step + j * SLICE + 1 - k).cast("long")
    cut = lambda j: F.struct(
        (F.col("piece") * -(-step // SLICE) + j).alias("slice"),
        F.substring("seq", (start(j) - F.col("seq_start") + 1).cast("int"), F.lit(SLICE + 2 * k)).alias("seq"),
        start(j).alias("seq_start")
    )
    # The pieces themselves are not repeated for each slice.
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.floor((core - 1) / SLICE)), cut)
    return genome.select("chrom", F.explode(every).alias("__s")).select("chrom", "__s.*")


def allele_windows(variants: DataFrame, genome: DataFrame, k: int) -> DataFrame:
    """variants with upstream_seq, downstream_seq, ref_seq and alt_seq, from genome (chrom, seq). Variants on
    chromosomes that the genome lacks are dropped. ``genome`` may be in pieces (chrom, seq, seq_start, seq_len),
    see ``sources.fasta.pieces``: then each flank comes from the piece that it touches, the bases before a variant from
    that of its position, those after it from that of the base after its reference allele, however long that is. A
    piece must reach k bases over its ends."""
    if "seq_start" not in genome.columns:
        joined = variants.join(genome.select("chrom", "seq"), "chrom")
        up, down = flanks(F.col("seq"), F.col("pos"), F.col("ref"), k)
        out = joined.withColumn("upstream_seq", up).withColumn("downstream_seq", down).drop("seq")
    else:
        meta = genome.schema["piece"].metadata
        if meta["overlap"] < k:
            raise ValueError(f"pieces that reach {meta['overlap']} bases over their ends are too short for windows of {k}")
        lengths = genome.where("piece = 0").select("chrom", "seq_len")
        step, place = meta["step"], lambda p: F.greatest(F.lit(0), F.least(p, F.col("seq_len")) - 1)
        held = lambda p: F.floor(place(p) / step) * -(-step // SLICE) + F.floor(place(p) % step / SLICE)
        whole = {"seq_len": F.col("seq_len"), "seq_start": F.col("seq_start")}
        parts = _slices(genome, step, k)
        up, down = flanks(F.col("seq"), F.col("pos"), F.col("ref"), k, **whole)
        out = variants.join(F.broadcast(lengths), "chrom").withColumn("slice", held(F.col("pos"))).join(parts, ["chrom", "slice"])
        out = out.withColumn("upstream_seq", up).drop("seq", "slice", "seq_start")
        out = out.withColumn("slice", held(F.col("pos") + F.length("ref"))).join(parts, ["chrom", "slice"])
        out = out.withColumn("downstream_seq", down).drop("seq", "slice", "seq_start", "seq_len")
    return out.withColumn(
        "ref_seq", F.concat("upstream_seq", "ref", "downstream_seq")
    ).withColumn("alt_seq", F.concat("upstream_seq", "alt", "downstream_seq"))


def variant_effects(variants: DataFrame, genome: DataFrame, k: int, embed: Embed) -> DataFrame:
    """chrom, pos, ref, alt, site_id, var_effect. ``embed`` maps (seq) to (seq, embedding); each distinct sequence
    is embedded once."""
    windows = allele_windows(variants, genome, k).select("chrom", "pos", "ref", "alt", "ref_seq", "alt_seq")
    windows = _written(windows, "windows")
    vectors = embed(windows.select(F.explode(F.array("ref_seq", "alt_seq")).alias("seq")).distinct())
    out = windows.join(
        vectors.select(F.col("seq").alias("ref_seq"), F.col("embedding").alias("__r")), "ref_seq"
    ).join(vectors.select(F.col("seq").alias("alt_seq"), F.col("embedding").alias("__a")), "alt_seq")
    return out.select(
        "chrom", "pos", "ref", "alt", site_id(F.col("chrom"), F.col("pos")).alias("site_id"),
        l2(F.col("__r"), F.col("__a")).alias("var_effect")
    )


def stretches(intervals: DataFrame, genome: DataFrame, start: str, end: str, *keys: str) -> DataFrame:
    """keys and seq: the bases of each interval (chrom, start, end; closed, cut at the sequence's ends), put together in
    order from the slices of pieces that it touches. Intervals on chromosomes that the genome lacks are dropped."""
    step = genome.schema["piece"].metadata["step"]
    lengths = genome.where("piece = 0").select("chrom", "seq_len")
    slices = -(-step // SLICE)
    place = lambda p: F.greatest(F.lit(1), F.least(p, F.col("seq_len"))) - 1
    held = lambda p: F.floor(place(p) / step) * slices + F.floor(place(p) % step / SLICE)
    wanted = intervals.select("chrom", *keys, F.col(start).alias("__start"), F.col(end).alias("__end")).join(
        F.broadcast(lengths), "chrom"
    )
    low, high = F.greatest(F.lit(1), F.col("__start")), F.least(F.col("__end"), F.col("seq_len"))
    touched = F.sequence(held(low), F.greatest(held(low), held(high)))
    # An interval meets slices, never whole pieces, which may be a hundred times as long.
    rows = wanted.withColumn("slice", F.explode(touched)).join(_slices(genome, step, 0), ["chrom", "slice"])
    piece = F.floor(F.col("slice") / slices)
    a = F.greatest(low, F.col("seq_start"))
    b = F.least(high, F.col("seq_start") + SLICE - 1, (piece + 1) * step)
    part = F.when(
        a <= b, F.substring("seq", (a - F.col("seq_start") + 1).cast("int"), (b - a + 1).cast("int"))
    ).otherwise("")
    joined = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("slice", part.alias("part")))).alias("__parts"))
    return joined.select(*keys, F.array_join(F.transform("__parts", lambda x: x["part"]), "").alias("seq"))


def gene_sequences(gene_sites: DataFrame, genotypes: DataFrame, genome: DataFrame) -> DataFrame:
    """gene_id, sample, ref_seq, seq: of every gene the sequence of each sample that carries a variant in it, with the
    sample's variants put in. The others have the reference's; no row is made for them. ``genome`` is in pieces."""
    genes = first_by(
        gene_sites.select("gene_id", "chrom", "gene_start", "gene_end"), ["gene_id"], "chrom", "gene_start", "gene_end"
    )
    genes = stretches(genes, genome, "gene_start", "gene_end", "gene_id", "gene_start").withColumnRenamed("seq", "ref_seq")
    own = first_by(gene_sites, ["gene_id", "pos"], "ref", "alt").select(
        "gene_id", "pos", "ref", "alt", site_id(F.col("chrom"), F.col("pos")).alias("site_id")
    )
    carried = own.join(genotypes.where("dosage > 0").select("site_id", "sample", "dosage"), "site_id")
    carried = carried.groupBy("gene_id", "sample").agg(
        F.collect_list(F.struct("pos", "ref", "alt", "dosage")).alias("variants")
    )
    made = apply_variants(F.col("ref_seq"), F.col("gene_start"), F.col("variants"))
    return carried.join(genes, "gene_id").select("gene_id", "sample", "ref_seq", made.alias("seq"))


def gene_features(sequences: DataFrame, genes: DataFrame, samples: DataFrame, embed: Embed) -> DataFrame:
    """gene_id, sample, value of every gene and sample: distance of the sample's sequence from the reference; 0 if they
    are equal or the sample has none in ``sequences``."""
    changed = sequences.where(F.col("seq") != F.col("ref_seq")).select("gene_id", "sample", "ref_seq", "seq")
    changed = _written(changed, "sequences")
    vectors = embed(changed.select(F.explode(F.array("ref_seq", "seq")).alias("seq")).distinct())
    moved = changed.join(vectors.select("seq", F.col("embedding").alias("__s")), "seq").join(
        vectors.select(F.col("seq").alias("ref_seq"), F.col("embedding").alias("__r")), "ref_seq"
    )
    moved = moved.select("gene_id", "sample", l2(F.col("__r"), F.col("__s")).alias("__d"))
    every = genes.select("gene_id").distinct().crossJoin(samples.select("sample").distinct())
    return every.join(moved, ["gene_id", "sample"], "left").select(
        "gene_id", "sample", F.coalesce("__d", F.lit(0.0)).alias("value")
    )
