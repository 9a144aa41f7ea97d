"""Queries that run whole workflows over files made of the driver's tables, and read their outputs back.

Parts are the words of a small genome and a variant each, suppliers trait intervals and genes. The files are written as
the readers expect them (FASTA, VCF, GFF3, CSV), with repeated records, names of several forms, missing genotypes and
alleles; each query's SQL states an output in terms of the tables.
"""

from __future__ import annotations

from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.embed.cache import CachedEmbedder
from lociflow.functions import names
from lociflow.ml import metrics, models
from lociflow.operators import blocks, checks, effects, genotypes, simulate, splits
from lociflow.operators.places import placed
from lociflow.plans import builder, classifier, phenotypes, resume, simulator
from lociflow.queries import (
    _AREA, _MEANS, _MULTI, _SCORED, _calls, _importance, _long, _multi, _scored, _sheet, _t, _text, _window_sql, query,
)
from lociflow.sources import bgzf, config, fasta, gff, sinks, tables, vcf, workspace

# --- files -----------------------------------------------------------------------------------------------------

RAW_SAMPLES = ("s1", "S_2", "abc", "x1", "5", "sample_06")
SAMPLES = ("sample_1", "sample_2", "sample_3", "sample_1_4", "sample_5", "sample_6")
GTS = ("0/0", "0/1", "1|1", "./.", "./1", "1/2", "1", "2|0")
DOSES = (0, 1, 2, 0, 0, 2, 1, 1)
K, EXTRA, PVALUE, LOD = 6, 3, 0.15, 3

_MADE: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf: str, name: str, make):
    """What several queries of a session share: a run of a workflow, whose files each of them reads. A second call of a
    query reads them too; clearing ``_MADE`` makes the next one run the workflow again."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def _words(spark: SparkSession, sf: str) -> DataFrame:
    """A word of four letters for each part: p, z, c (chromosome number), slot, word."""
    letter = lambda e: F.substring(F.lit("ACGT"), (F.expr(e) % 4).cast("int") + 1, F.lit(1))
    word = F.concat(letter("p * 7 + z"), letter("p + 1"), letter("z"), letter("p * 3"))
    rows = _t(spark, sf, "part").select(F.col("p_partkey").alias("p"), F.col("p_size").cast("long").alias("z"))
    return rows.select(
        "p", "z", (F.col("p") % 5 + 1).alias("c"), F.floor(F.col("p") / 5).alias("slot"), word.alias("word")
    )


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Variant records: p, dup, c, pos, ref, alt (as written), z."""
    w = _words(spark, sf)
    ref = F.when(F.col("p") % 7 == 3, F.substring("word", 2, 2)).otherwise(F.substring("word", 2, 1))
    other = F.translate(F.substring("word", 2, 1), "ACGT", "CGTA")
    alt = F.when(F.col("p") % 6 == 1, F.concat(F.col("ref"), F.lit("GT"))).when(
        F.col("p") % 6 == 2, F.concat(F.col("other"), F.lit(",ttt"))
    ).when(F.col("p") % 6 == 3, ".").otherwise(F.col("other"))
    rows = w.select(
        "p", "z", "c", (F.col("slot") * 4 + 2).alias("pos"), ref.alias("ref"), other.alias("other")
    ).withColumn("alt", alt).drop("other")
    again = rows.where("p % 13 = 0").withColumn("alt", F.lit("CC")).withColumn("dup", F.lit(1))
    return rows.withColumn("dup", F.lit(0)).unionByName(again)


def _text_file(rows: DataFrame, path: str, *order: str) -> None:
    sinks.save_lines(rows.orderBy(*order), path)


def _files(spark: SparkSession, sf: str) -> str:
    return _once(spark, sf, "files", lambda: _write_files(spark, sf))


def _write_files(spark: SparkSession, sf: str) -> str:
    d = workspace.folder(spark, "genome")
    w = _words(spark, sf)
    # Blocks of 35 words are two lines of 70 letters, so no chromosome is ever a row.
    ranked = placed(w.select("c", "p", "word"), "n", ["p"], ["c"]).withColumn("block", F.floor((F.col("n") - 1) / 35))
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda x: x["word"]), "")
    pairs = ranked.groupBy("c", "block").agg(letters.alias("seq"))
    cut = F.concat_ws("\n", F.substring("seq", 1, 70), F.when(F.length("seq") > 70, F.substring("seq", 71, 70)))
    heads = w.select("c", F.lit(-1).cast("long").alias("block")).distinct()
    more = spark.createDataFrame(
        [(99, 0, ">1 later\nAAAA"), (100, 0, ">scaffold\nTTTT")], "c long, block long, value string"
    )
    _text_file(
        heads.select("c", "block", F.format_string(">chr_%02d made of parts", "c").alias("value")).unionByName(
            pairs.select("c", "block", cut.alias("value"))
        ).unionByName(more), f"{d}/g.fa", "c", "block"
    )

    r = _records(spark, sf)
    gts = F.array(*map(F.lit, GTS))
    calls = [
        F.element_at(
            gts, ((F.col("p") + 3 * i + F.col("z") + F.col("dup")) % 8).cast("int") + 1
        ) for i in range(len(RAW_SAMPLES))
    ]
    plain = F.col("p") % 11 == 0
    cells = [F.when(plain, "9").otherwise(F.concat(F.lit("9:"), x)) for x in calls]
    chrom = F.when(F.col("p") % 2 == 0, F.col("c").cast("string")).otherwise(F.concat(F.lit("chr0"), F.col("c")))
    line = F.concat_ws(
        "\t", chrom, F.col("pos").cast("string"), F.lit("."), F.col("ref"), F.col("alt"), F.lit("."), F.lit("."),
        F.lit("."), F.when(plain, "DP").otherwise("DP:GT"), *cells
    )
    top = [
        (-2, 0, "##fileformat=VCFv4.2"),
        (-1, 0, "\t".join(("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *RAW_SAMPLES)))
    ]
    lines = spark.createDataFrame(top, "p long, dup int, value string").unionByName(
        r.select("p", "dup", line.alias("value"))
    )
    _text_file(lines, f"{d}/v.vcf", "p", "dup")

    s = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("s"), "s_name", F.col("s_nationkey").cast("long").alias("n")
    ).withColumn("c", F.col("s") % 5 + 1).withColumn("at", F.floor(F.col("s") / 5) * 40)
    gene = lambda kind, more: s.select("s", F.lit(kind).alias("kind"), F.concat_ws("\t", F.concat(F.lit("Chr"), F.col("c")), F.lit("made"), F.lit(kind), F.col("at") + 5, F.col("at") + 29 + more, F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit("ID="), F.col("s_name"), F.lit(f";Name={kind}%20of%20"), F.col("s"))).alias("value"))
    # Some genes have a second record, further to the right and with another name.
    again = gene("gene", 6).where("s % 4 = 0").withColumn("kind", F.lit("h"))
    again = again.withColumn("value", F.replace("value", F.lit("Name=gene"), F.lit("Name=again")))
    note = spark.createDataFrame([(-1, "", "##gff-version 3")], "s long, kind string, value string")
    _text_file(
        note.unionByName(gene("gene", 0)).unionByName(again).unionByName(gene("mRNA", 2)), f"{d}/a.gff3", "s", "kind"
    )

    p = _words(spark, sf)
    trait = F.when(F.col("z") % 3 == 0, "A").when(F.col("z") % 3 == 1, "N").otherwise(" R ")
    gwas = p.select(
        F.when(F.col("p") % 17 == 0, "scaffold").otherwise(F.concat(F.lit("chr"), F.col("c"))).alias("Chromosome"),
        (F.col("slot") * 4 + 2).alias("Position"), F.trim(trait).alias("Trait"), (F.col("z") / 100).alias("pvalue")
    )
    sinks.save_csv(gwas, f"{d}/gwas.csv")
    left, right = F.col("at") + 11, F.col("at") + 11 + 2 * F.col("n")
    odd = F.col("s") % 2 == 1
    qtl = s.select(
        F.col("c").alias("Chromosome"), F.when(odd, right).otherwise(left).alias("start_pos"),
        F.when(odd, left).otherwise(right).alias("end_pos"),
        F.element_at(F.array(*map(F.lit, "ANR")), (F.col("s") % 3).cast("int") + 1).alias("Trait"),
        F.col("n").alias("LOD")
    )
    sinks.save_csv(qtl, f"{d}/qtl.csv")
    site = _records(spark, sf).where("dup = 0 AND z % 2 = 0").select(
        F.col("c").alias("chr"), "pos", F.lower("ref").alias("ref_allele"),
        F.substring_index("alt", ",", 1).alias("alt_allele"), F.concat(F.lit("t"), F.col("z") % 3).alias("variant_type")
    )
    sinks.save_csv(site.where("alt_allele <> '.'"), f"{d}/sites.tsv", "\t")
    return d


# --- the same in SQL -------------------------------------------------------------------------------------------

_L = lambda e: f"substr('ACGT', (({e}) % 4)::INT + 1, 1)"
_BASE = f"""
WITH w AS (SELECT p_partkey AS p, p_size AS z, p_partkey % 5 + 1 AS c, p_partkey // 5 AS slot, {_L('p_partkey * 7 + p_size')} || {_L('p_partkey + 1')} || {_L('p_size')} || {_L('p_partkey * 3')} AS word FROM part),
g AS (SELECT c, string_agg(word, '' ORDER BY p) AS seq FROM w GROUP BY c),
r0 AS (SELECT p, z, c, slot * 4 + 2 AS pos, CASE WHEN p % 7 = 3 THEN substr(word, 2, 2) ELSE substr(word, 2, 1) END AS ref, translate(substr(word, 2, 1), 'ACGT', 'CGTA') AS other FROM w),
r AS (SELECT p, z, c, pos, ref, 0 AS dup, CASE p % 6 WHEN 1 THEN [ref || 'GT'] WHEN 2 THEN [other, 'TTT'] WHEN 3 THEN []::VARCHAR[] ELSE [other] END AS alts FROM r0
      UNION ALL SELECT p, z, c, pos, ref, 1, ['CC'] FROM r0 WHERE p % 13 = 0),
v AS (SELECT DISTINCT c, pos, ref, coalesce(alts[1], '') AS alt FROM r),
gw AS (SELECT c, slot * 4 + 2 AS pos, CASE z % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS trait FROM w WHERE z < {round(100 * PVALUE)} AND p % 17 <> 0),
s AS (SELECT s_suppkey AS s, s_name, s_nationkey AS n, s_suppkey % 5 + 1 AS c, (s_suppkey // 5) * 40 AS off FROM supplier),
q AS (SELECT c, off + 11 AS lo, off + 11 + 2 * n AS hi, ['A', 'N', 'R'][s % 3 + 1] AS trait FROM s WHERE n > {LOD}),
ga AS (SELECT c, pos, string_agg(DISTINCT trait, ',' ORDER BY trait) AS gt FROM gw GROUP BY 1, 2),
qa AS (SELECT v.c, v.pos, string_agg(DISTINCT trait, ',' ORDER BY trait) AS qt FROM v JOIN q ON v.c = q.c AND v.pos BETWEEN lo AND hi GROUP BY 1, 2),
st AS (SELECT v.c, v.pos, ref, alt, coalesce(qt, '') AS qtl_trait, coalesce(gt, '') AS gwas_trait FROM v LEFT JOIN ga USING (c, pos) LEFT JOIN qa USING (c, pos) WHERE gt IS NOT NULL OR qt IS NOT NULL),
"""


def _freq(s: str, x: str) -> str:
    """Share of one letter among A, C, G and T, in single precision."""
    return f"(CASE WHEN length(translate({s}, 'N', '')) = 0 THEN 0 ELSE (length({s}) - length(translate({s}, '{x}', '')))::DOUBLE / length(translate({s}, 'N', '')) END)::FLOAT::DOUBLE"


def _distance(a: str, b: str) -> str:
    return "sqrt(" + " + ".join(f"({_freq(a, x)} - {_freq(b, x)}) ** 2" for x in "ACGT") + ")"


def _effect_sql(source: str) -> str:
    """c, pos, ref, alt, var_effect of the rows of a source of variants."""
    return f"""(SELECT c, pos, ref, alt, round({_distance('up || ref || down', 'up || alt || down')}, 6) AS var_effect FROM (
      SELECT x.c, x.pos, x.ref, x.alt, {_window_sql(f'x.pos - {K}', 'x.pos - 1', 'g.seq')} AS up, {_window_sql('x.pos + length(x.ref)', f'x.pos + length(x.ref) + {K - 1}', 'g.seq')} AS down FROM {source} x JOIN g USING (c)))"""


_EFFECTS = _BASE + f"""
one AS (SELECT c, pos, arg_min(ref, ref || '>' || alt) AS ref, arg_min(alt, ref || '>' || alt) AS alt FROM st GROUP BY c, pos),
e AS {_effect_sql('one')},
"""
_GENES = _EFFECTS + f"""
n AS (SELECT c, s_name AS gene_id, greatest(1, off + 5 - {EXTRA}) AS gs, off + 29 + {EXTRA} + CASE WHEN s % 4 = 0 THEN 6 ELSE 0 END AS ge FROM s),
gx AS (SELECT st.c, st.pos, ref, alt, gene_id, gs, ge, qtl_trait, gwas_trait FROM st JOIN n ON st.c = n.c AND pos BETWEEN gs AND ge),
i AS (SELECT unnest(range({len(SAMPLES)})) AS i),
sm AS (SELECT i, [{', '.join(f"'{x}'" for x in SAMPLES)}][i + 1] AS sample FROM i),
lr AS (SELECT c, pos, max(p) AS p, max(z) AS z, max(dup) AS dup FROM r GROUP BY c, pos),
k AS (SELECT DISTINCT c, pos FROM gx),
d AS (SELECT k.c, k.pos, sample, (CASE WHEN p % 11 = 0 THEN 0 ELSE {list(DOSES)}[((p + 3 * i + z + dup) % 8)::INT + 1] END)::TINYINT AS dosage FROM k JOIN lr USING (c, pos), sm),
"""
_NAME = "'Chr' || c AS chrom, pos"
_SITE = "'Chr' || c || ':' || pos AS site_id"


def _settings(spark: SparkSession, sf: str) -> config.BuilderConfig:
    d = _files(spark, sf)
    return config.BuilderConfig(
        vcf_path=f"{d}/v.vcf", fasta_path=f"{d}/g.fa", gff3_path=f"{d}/a.gff3", gwas_path=f"{d}/gwas.csv", qtl_path=f"{d}/qtl.csv", outdir=workspace.folder(spark, "built"),
        use_gffutils=True, ext_len=EXTRA, k=K, max_pvalue=PVALUE, min_lod=LOD, split=True, test_ratio=0.4, embedder_options={"k": 1},
    )


def _built(spark: SparkSession, sf: str) -> tuple[config.BuilderConfig, dict[str, str]]:
    def make():
        c = _settings(spark, sf)
        return c, builder.run(spark, c)

    return _once(spark, sf, "built", make)


def _csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return tables.text_table(spark, path, sep)


def _long_of(matrix: DataFrame, key: str, name: str, value: str, kind: str) -> DataFrame:
    return matrix.unpivot([key], [F.col(f"`{c}`").cast(kind).alias(c) for c in matrix.columns if c != key], name, value)


# --- the builder's outputs -------------------------------------------------------------------------------------


@query(_BASE + f"z AS (SELECT 1) SELECT {_NAME}, qtl_trait, gwas_trait FROM st")
def built_sites(spark, sf):
    out = _csv(spark, _built(spark, sf)[1]["sites_union_or_intersect"])
    return out.select(
        "chrom", F.col("pos").cast("long").alias("pos"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("qtl_trait", "gwas_trait")]
    )


@query(_EFFECTS + f"z AS (SELECT 1) SELECT {_NAME}, {_SITE}, var_effect FROM e")
def built_site_effects(spark, sf):
    out = _csv(spark, _built(spark, sf)[1]["all_site_variant_effect"])
    return out.select(
        "chrom", F.col("pos").cast("long").alias("pos"), "site_id",
        F.round(F.col("var_effect").cast("double"), 6).alias("var_effect")
    )


@query(_GENES + f"z AS (SELECT 1) SELECT {_NAME}, qtl_trait, gwas_trait, gene_id FROM gx")
def built_gene_sites(spark, sf):
    out = _csv(spark, _built(spark, sf)[1]["sites_in_gene"])
    return out.select(
        "chrom", F.col("pos").cast("long").alias("pos"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("qtl_trait", "gwas_trait")], "gene_id"
    )


@query(_GENES + f"z AS (SELECT 1) SELECT {_SITE}, var_effect FROM e JOIN k USING (c, pos)")
def built_gene_site_effects(spark, sf):
    out = _csv(spark, _built(spark, sf)[1]["variant_effect_by_site"])
    return out.select("site_id", F.round(F.col("var_effect").cast("double"), 6).alias("var_effect"))


_PAIRS = ", ".join(f"('{a}', '{b}')" for a, b in zip(RAW_SAMPLES, SAMPLES, strict=True))


@query(_GENES + f"z AS (SELECT 1) SELECT raw_sample, sample, count(*) AS sites, sum(dosage)::BIGINT AS alleles FROM (VALUES {_PAIRS}) AS m(raw_sample, sample) JOIN d USING (sample) GROUP BY ALL")
def built_samples(spark, sf):
    """The sample mapping with what the genotypes hold of each sample under its new name."""
    out = _built(spark, sf)[1]
    calls = blocks.long_parquet(spark, out["genotype_sample_by_site"], "sample", "site_id", "dosage", "tinyint")
    return _csv(spark, out["sample_mapping"]).join(calls, "sample").groupBy("raw_sample", "sample").agg(
        F.count("*").alias("sites"), F.sum("dosage").cast("long").alias("alleles")
    )


@query(_GENES + f"z AS (SELECT 1) SELECT {_SITE}, sample, dosage FROM d")
def built_genotypes(spark, sf):
    path = _built(spark, sf)[1]["genotype_sample_by_site"]
    return blocks.long_parquet(spark, path, "sample", "site_id", "dosage", "tinyint")


@query(_GENES + f"z AS (SELECT 1) SELECT {_SITE}, sample, dosage FROM d")
def built_genotypes_by_site(spark, sf):
    path = _built(spark, sf)[1]["genotype_site_by_sample"]
    return _long_of(_csv(spark, path.replace(".parquet", ".csv")), "site_id", "sample", "dosage", "tinyint")


@query(_GENES + f"z AS (SELECT 1) SELECT {_SITE}, sample, round(dosage * var_effect, 4) AS value FROM d JOIN e USING (c, pos)")
def built_effect_matrix(spark, sf):
    """The products with each effect rounded to six places first, as the effects' own table states them."""
    out = _built(spark, sf)[1]
    rows = blocks.long_parquet(spark, out["variant_effect_sample_by_site"], "sample", "site_id", "value", "double")
    calls = blocks.long_parquet(spark, out["genotype_sample_by_site"], "sample", "site_id", "dosage", "tinyint")
    rounded = F.col("dosage") * F.round(F.col("value") / F.nullif("dosage", F.lit(0)), 6)
    value = F.when(F.col("dosage") == 0, F.col("value")).otherwise(rounded)
    return rows.join(calls, ["sample", "site_id"]).select("sample", "site_id", F.round(value, 4).alias("value"))


_GENE_MATRIX = _GENES + f"""
gv AS (SELECT gene_id, any_value(c) AS c, any_value(gs) AS gs, any_value(ge) AS ge, pos, arg_min(ref, ref || '>' || alt) AS ref, arg_min(alt, ref || '>' || alt) AS alt FROM gx GROUP BY gene_id, pos),
gr AS (SELECT DISTINCT gene_id, gs, substr(seq, gs::INT, (ge - gs + 1)::INT) AS ref_seq FROM gx JOIN g USING (c)),
ca AS (SELECT gene_id, sample, pos, ref, alt FROM gv JOIN d USING (c, pos) JOIN gr USING (gene_id, gs) WHERE dosage > 0 AND pos + length(ref) <= gs + length(ref_seq)),
b AS (SELECT gene_id, gs, ref_seq, sample, unnest(range(1, length(ref_seq) + 1)) AS j FROM gr, sm),
pc AS (SELECT b.gene_id, b.sample, ref_seq, j, CASE WHEN ca.pos = gs + j - 1 THEN ca.alt WHEN ca.pos IS NOT NULL THEN '' ELSE substr(ref_seq, j, 1) END AS x
       FROM b LEFT JOIN ca ON ca.gene_id = b.gene_id AND ca.sample = b.sample AND gs + j - 1 BETWEEN ca.pos AND ca.pos + length(ca.ref) - 1),
sq AS (SELECT gene_id, sample, any_value(ref_seq) AS ref_seq, string_agg(x, '' ORDER BY j) AS seq FROM pc GROUP BY gene_id, sample),
"""


@query(_GENE_MATRIX + f"z AS (SELECT 1) SELECT gene_id, sample, round({_distance('seq', 'ref_seq')}, 6) AS value FROM sq")
def built_gene_features(spark, sf):
    path = _built(spark, sf)[1]["gene_feature_sample_by_gene"]
    out = blocks.long_parquet(spark, path, "sample", "gene_id", "value", "double")
    return out.withColumn("value", F.round("value", 6))


@query(_GENE_MATRIX + "z AS (SELECT 1) SELECT gene_id, sample, ref_seq, seq FROM sq WHERE (gene_id, sample) IN (SELECT (gene_id, sample) FROM gv JOIN d USING (c, pos) WHERE dosage > 0)")
def gene_sequences(spark, sf):
    """The sequences of the samples that carry a variant of a gene, put together from pieces shorter than most genes."""
    c, _ = _built(spark, sf)
    stage = lambda name: resume.stage(spark, c.outdir, name)
    return effects.gene_sequences(
        stage("gene_sites"), stage("genotypes"), fasta.read_pieces(spark, c.fasta_path, 16, 4, range_bytes=1000)
    )


@query(_GENES + f"z AS (SELECT 1) SELECT 'genotype_012' AS name, count(*) AS cells, sum(dosage)::DOUBLE AS total, {len(SAMPLES)} AS samples, ceil({len(SAMPLES)} * 0.4::DOUBLE)::INT AS tested FROM d")
def built_splits(spark, sf):
    """Both parts of the genotype matrix, one read as CSV and one as Parquet, hold all of it between them."""
    out = _built(spark, sf)[1]
    columns = ("sample", "site_id", "dosage", "int")
    train = blocks.long_csv(spark, out["train_val_genotype_012_csv"], *columns)
    test = blocks.long_parquet(spark, out["test_genotype_012_parquet"], *columns)
    rows = train.withColumn("tested", F.lit(0)).unionByName(test.withColumn("tested", F.lit(1)))
    tested = F.count_distinct(F.when(F.col("tested") == 1, F.col("sample"))).cast("int")
    return rows.agg(
        F.lit("genotype_012").alias("name"), F.count("*").alias("cells"), F.sum("dosage").cast("double").alias("total"),
        F.count_distinct("sample").cast("int").alias("samples"), tested.alias("tested")
    )


@query(_GENE_MATRIX + f"tot AS (SELECT 'variant_effect_matrix' AS name, sample, round(sum(dosage * var_effect), 2) AS total, count(*) AS cells FROM d JOIN e USING (c, pos) GROUP BY ALL UNION ALL SELECT 'gene_sequence_feature_matrix', sample, round(sum(round({_distance('seq', 'ref_seq')}, 6)), 2), count(*) FROM sq GROUP BY ALL UNION ALL SELECT 'genotype_012', sample, sum(dosage)::DOUBLE, count(*) FROM d GROUP BY ALL) SELECT * FROM tot")
def built_split_matrices(spark, sf):
    """Each sample's row of each split matrix, whichever part it is in."""
    out = _built(spark, sf)[1]
    rows = []
    for name in ("genotype_012", "variant_effect_matrix", "gene_sequence_feature_matrix"):
        for part in ("train_val", "test"):
            long = blocks.long_parquet(spark, out[f"{part}_{name}_parquet"], "sample", "name", "value", "double")
            rows.append(long.select(F.lit(name).alias("name"), "sample", "value"))
    whole = rows[0]
    for r in rows[1:]:
        whole = whole.unionByName(r)
    return whole.groupBy("name", "sample").agg(F.round(F.sum("value"), 2).alias("total"), F.count("*").alias("cells"))


@query(_BASE + "z AS (SELECT 1) SELECT 'Chr' || c AS chrom, pos, ref, alt, qtl_trait, gwas_trait, 0 AS made_again FROM st")
def resumed_sites(spark, sf):
    """A second run takes every stage from the first: none is made again."""
    c, _ = _built(spark, sf)
    before = builder.Stages(spark, c.outdir, *builder.signed(c)).done
    builder.run(spark, replace(c, wide=False, split=False))
    again = sum(before.get(k) != v for k, v in builder.Stages(spark, c.outdir, *builder.signed(c)).done.items())
    return resume.stage(spark, c.outdir, "initial_sites").withColumn("made_again", F.lit(again))


@query(_BASE + f"al AS (SELECT c, pos, ref, unnest(alts) AS alt FROM r), ae AS {_effect_sql('al')} SELECT {_NAME}, {_SITE}, var_effect FROM ae")
def scored_variants(spark, sf):
    def make():
        d, out = _files(spark, sf), workspace.folder(spark, "scored")
        builder.score_all_variants(spark, f"{d}/v.vcf", f"{d}/g.fa", out, K, "kmer", {"k": 1})
        return out

    out = _csv(spark, _once(spark, sf, "scored", make) + "/all_variant_effects.csv")
    return out.select(
        "chrom", F.col("pos").cast("long").alias("pos"), "site_id",
        F.round(F.col("var_effect").cast("double"), 6).alias("var_effect")
    )


# --- readers and windows ---------------------------------------------------------------------------------------


@query(
    _BASE + "z AS (SELECT 1) SELECT 'Chr' || c AS chromosome, off + 5 AS start, off + 29 AS \"end\", 'mRNA' AS feature, s_name AS id, 'mRNA of ' || s AS name FROM s WHERE true UNION ALL SELECT 'Chr' || c, off + 5, off + 29, 'gene', s_name, 'gene of ' || s FROM s UNION ALL SELECT 'Chr' || c, off + 5, off + 35, 'gene', s_name, 'again of ' || s FROM s WHERE s % 4 = 0".replace(
        "off + 29 AS", "off + 31 AS"
    )
)
def gff_scan(spark, sf):
    return gff.read(
        spark, f"{_files(spark, sf)}/a.gff3", ["gene", "mRNA", "gene"]
    ).select("chromosome", "start", "end", "feature", "id", "name")


@query(_BASE + "z AS (SELECT 1) SELECT 'Chr' || c AS chromosome, off + 5 AS start, off + 29 + CASE WHEN s % 4 = 0 THEN 6 ELSE 0 END AS \"end\", s_name AS id, 'gene of ' || s AS name FROM s")
def gff_merged(spark, sf):
    """From the copy of the records: genes of one id as one, with the first record's name."""
    path = f"{_files(spark, sf)}/a.gff3"
    rows = _once(spark, sf, "records", lambda: gff.read_cached(spark, path, "gene", workspace.folder(spark, "records")))
    return gff.merged(rows).select("chromosome", "start", "end", "id", "name")


@query(_BASE + "z AS (SELECT 1) SELECT 'Chr' || c AS chrom, pos, ref, coalesce(alts[1], '') AS alt FROM r")
def vcf_first_alt(spark, sf):
    return vcf.first_alt(vcf.lines(spark, f"{_files(spark, sf)}/v.vcf")).select("chrom", "pos", "ref", "alt")


@query(_BASE + f"i AS (SELECT unnest(range({len(SAMPLES)})) AS i) SELECT 'Chr' || c AS chrom, pos, [{', '.join(repr(x) for x in RAW_SAMPLES)}][i + 1] AS sample, CASE WHEN p % 11 = 0 THEN './.' ELSE {list(GTS)}[((p + 3 * i + z + dup) % 8)::INT + 1] END AS gt FROM r, i")
def vcf_calls(spark, sf):
    path = f"{_files(spark, sf)}/v.vcf"
    return vcf.calls(vcf.lines(spark, path), vcf.samples(spark, path)).select("chrom", "pos", "sample", "gt")


def _blocked(spark: SparkSession, sf: str) -> str:
    """The variants as a block-gzip file of small blocks."""
    rows = spark.read.text(f"{_files(spark, sf)}/v.vcf")
    return _once(spark, sf, "blocked", lambda: bgzf.save(rows, f"{workspace.folder(spark, 'blocked')}.vcf.gz", 4_000))


_CALLS = f"SELECT 'Chr' || c AS chrom, pos, [{', '.join(repr(x) for x in RAW_SAMPLES)}][i + 1] AS sample, CASE WHEN p % 11 = 0 THEN './.' ELSE {list(GTS)}[((p + 3 * i + z + dup) % 8)::INT + 1] END AS gt FROM r, i"


@query(_BASE + f"i AS (SELECT unnest(range({len(SAMPLES)})) AS i) {_CALLS}")
def vcf_block_calls(spark, sf):
    """All genotypes of a block-gzip file, by tasks that each read some blocks."""
    path = _blocked(spark, sf)
    rows = vcf.calls(vcf.lines(spark, path, range_bytes=3_000), vcf.samples(spark, path))
    return rows.select("chrom", "pos", "sample", "gt")


@query(_BASE + f"i AS (SELECT unnest(range({len(SAMPLES)})) AS i) SELECT * FROM ({_CALLS}) WHERE (chrom, pos) IN (SELECT ('Chr' || c, slot * 4 + 2) FROM w WHERE z = 7)")
def vcf_region_calls(spark, sf):
    """Genotypes at the sites of the parts of one size: only ranges that the index has such a site in are read."""
    path = _blocked(spark, sf)
    sites = _words(spark, sf).where("z = 7").select(
        F.concat(F.lit("Chr"), F.col("c")).alias("chrom"), (F.col("slot") * 4 + 2).alias("pos")
    )
    # Written, as the plan that looks up the sites reads it twice.
    at = workspace.folder(spark, "index")
    vcf.index(spark, path, 2_000).write.parquet(at)
    known = spark.read.parquet(at)
    rows = vcf.calls(vcf.lines_at(spark, path, sites, known, 2_000), vcf.samples(spark, path))
    return rows.join(sites.distinct(), ["chrom", "pos"], "left_semi").select("chrom", "pos", "sample", "gt")


@query(_BASE + "z AS (SELECT 1) SELECT 'Chr' || c AS chrom, length(seq) AS seq_len, sha1(seq) AS seq_sha1 FROM g")
def fasta_genome(spark, sf):
    """Of the records of one chromosome the first, read by ranges that cut lines and headers and put together again from
    its pieces."""
    got = fasta.read_pieces(spark, f"{_files(spark, sf)}/g.fa", 50, 20, range_bytes=997)
    core = F.col("piece") * 50 + 1
    part = F.substring("seq", (core - F.col("seq_start") + 1).cast("int"), F.lit(50))
    whole = got.groupBy("chrom", "seq_len").agg(F.sort_array(F.collect_list(F.struct("piece", part.alias("part")))).alias("p"))
    seq = F.array_join(F.transform("p", lambda x: x["part"]), "")
    return whole.select("chrom", "seq_len", F.sha1(seq).alias("seq_sha1"))


_LONG_REF = _BASE + f"x AS (SELECT p, w.c, slot * 4 + 2 AS pos, substr(seq, (slot * 4 + 2)::INT, (1 + p % 90)::INT) AS ref, 'T' AS alt, seq FROM w JOIN g USING (c)), y AS (SELECT p, ref, alt, {_window_sql('pos - 12', 'pos - 1', 'seq')} AS up, {_window_sql('pos + length(ref)', 'pos + length(ref) + 11', 'seq')} AS down FROM x)"


@query(_LONG_REF + " SELECT p, up || ref || down AS ref_seq, up || alt || down AS alt_seq FROM y")
def piecewise_windows(spark, sf):
    """Reference alleles of up to 90 bases over pieces of 50 that reach 20 over their ends."""
    genome = fasta.read_pieces(spark, f"{_files(spark, sf)}/g.fa", 50, 20, range_bytes=1500)
    v = _words(spark, sf).select(
        "p", F.concat(F.lit("Chr"), F.col("c")).alias("chrom"), (F.col("slot") * 4 + 2).alias("pos"),
        F.lit("T").alias("alt"), (F.col("slot") * 4 + 2 + F.col("p") % 90).alias("end")
    )
    refs = effects.stretches(v, genome, "pos", "end", "p").withColumnRenamed("seq", "ref")
    return effects.allele_windows(v.join(refs, "p").drop("end"), genome, 12).select("p", "ref_seq", "alt_seq")


_TABLE = [f"Chr{c}:{p}" for c in range(1, 6) for p in range(1, 41)]


@query("SELECT g.site_id, g.sample, g.dosage FROM (" + "SELECT chrom || ':' || pos AS site_id, sample, arg_max(dose, ord)::TINYINT AS dosage FROM (SELECT o_orderkey AS ord, 'Chr' || (o_custkey % 5 + 1) AS chrom, o_custkey % 40 + 1 AS pos, 'sample_' || (o_orderkey % 9 + 1) AS sample, CASE (o_orderkey % 8)::INT WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 5 THEN 2 WHEN 6 THEN 1 ELSE 1 END AS dose FROM orders) GROUP BY chrom, pos, sample" + ") g JOIN (SELECT DISTINCT 'Chr' || (c_custkey % 5 + 1) || ':' || (c_custkey % 40 + 1) AS site_id FROM customer WHERE c_nationkey = 3) USING (site_id)")
def geno_sites(spark, sf):
    """Genotypes of the sites of some customers alone."""
    c = _t(spark, sf, "customer").where("c_nationkey = 3")
    wanted = c.select(
        F.concat(F.lit("Chr"), (F.col("c_custkey") % 5 + 1).cast("string")).alias("chrom"),
        (F.col("c_custkey") % 40 + 1).alias("pos")
    )
    return genotypes.long_genotypes(_calls(spark, sf), wanted).select("site_id", "sample", "dosage")


@query("SELECT c_name AS sample, f.k AS site_id, f.v::TINYINT AS dosage FROM (SELECT c_name, unnest([{'k': 'Chr1:10', 'v': c_custkey % 3}, {'k': 'Chr2:7', 'v': c_nationkey % 3}]) AS f FROM customer)")
def genotype_table(spark, sf):
    raw = _t(spark, sf, "customer").select(
        F.concat(F.lit(" "), "c_name").alias("sample"), F.col("c_custkey").alias("ord"),
        _text_of("c_custkey % 3").alias("Chr1:10"), _text_of("c_nationkey % 3").alias("Chr2:7")
    )
    return _long_of(
        tables.genotypes(raw.select("sample", "Chr1:10", "Chr2:7", "ord")).drop("ord"), "sample", "site_id", "dosage",
        "tinyint"
    )


def _text_of(expression: str):
    return F.expr(expression).cast("string")


@query("SELECT c_custkey AS ord, c_name AS sample, c_acctbal AS value, (c_nationkey < 9)::INT AS loc_low, (c_nationkey >= 9)::INT AS loc_high FROM customer")
def phenotype_table(spark, sf):
    raw = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("ord"), F.concat("c_name", F.lit(" ")).alias("sample"),
        _text("c_acctbal").alias("value"), _text_of("cast(c_nationkey < 9 as double)").alias("loc_low"),
        _text_of("cast(c_nationkey >= 9 as double)").alias("loc_high")
    )
    return tables.phenotypes(raw)


@query("SELECT p_partkey AS ord, CASE WHEN p_partkey % 11 = 0 THEN 'loc_' ELSE 'Chr1:' END || p_partkey AS feature, p_size::DOUBLE AS importance_gain, (p_partkey % 13)::DOUBLE AS importance_split FROM part")
def importance_table(spark, sf):
    return tables.importance(
        _importance(spark, sf).select(
            "ord", "feature", _text("importance_gain").alias("importance_gain"),
            _text("importance_split").alias("importance_split")
        )
    )


@query("SELECT 'Chr' || (p_partkey % 7) || ':1' AS site_id, arg_max(p_retailprice, p_partkey) AS effect FROM part GROUP BY 1")
def effect_table(spark, sf):
    raw = _t(spark, sf, "part").select(
        F.col("p_partkey").alias("ord"), F.lit("Chr1").alias("Chromosome"), F.lit("1").alias("Position"),
        F.concat(F.lit("Chr"), _text_of("p_partkey % 7"), F.lit(":1")).alias("site_id"),
        _text("p_retailprice").alias("var_effect")
    )
    return tables.last_effects(raw)


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def missing_keys(spark, sf):
    known = _t(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return checks.missing(_t(spark, sf, "orders"), known, "o_custkey")


_TESTED = "greatest(count(*) FILTER (c_nationkey = 3), ceil(count(*) * 0.2::DOUBLE))"


@query(f"SELECT 'test' AS split, count(*) FILTER (c_nationkey = 3) AS isolated, {_TESTED}::BIGINT AS samples FROM customer UNION ALL SELECT 'train_val', 0, (count(*) - {_TESTED})::BIGINT FROM customer")
def sample_split(spark, sf):
    """How many samples of each part there are, and how many of them were set apart."""
    rows = _t(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") == 3).alias("apart"))
    counts = splits.split_rows(rows, "c_custkey", "apart", 0.2).groupBy("split").agg(
        F.count_if("apart").alias("isolated"), F.count("*").alias("samples")
    )
    both = spark.createDataFrame([("test",), ("train_val",)], "split string").join(counts, "split", "left")
    return both.select("split", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("isolated", "samples")])


# --- embeddings, classes, predictions ---------------------------------------------------------------------------


@query(
    "SELECT sha1(text) AS seq_sha1, " + ", ".join(f"round((CASE WHEN n = 0 THEN 0 ELSE n{x} / n END)::FLOAT::DOUBLE, 6) AS f{x}" for x in "acgt") + " FROM (SELECT text, " + ", ".join(f"(length(text) - length(translate(lower(text), '{x}', '')))::DOUBLE AS n{x}" for x in "acgt") + ", na + nc + ng + nt AS n FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL))"
)
def seq_cache_dedupe(spark, sf):
    """The cache after two calls: every distinct sequence has been embedded once."""

    def make():
        path = workspace.folder(spark, "embeddings")
        embed, texts = CachedEmbedder("KMER", path, k=1), _t(spark, sf, "documents").select(F.col("text").alias("seq"))
        embed(texts.where("length(seq) % 2 = 0"))
        embed(texts)
        return path

    rows = spark.read.parquet(_once(spark, sf, "cache", make))
    return rows.select(
        "seq_sha1", *[F.round(F.col("embedding")[i].cast("double"), 6).alias(f"f{x}") for i, x in enumerate("acgt")]
    )


_LABELLED = _BASE + f"""
t AS (SELECT c, pos, ref, alts[1] AS alt, 't' || (z % 3) AS variant_type FROM r WHERE dup = 0 AND z % 2 = 0 AND len(alts) > 0),
al AS (SELECT DISTINCT c, pos, ref, unnest(alts) AS alt FROM r),
lb AS (SELECT c, pos, ref, alt, variant_type FROM al JOIN t USING (c, pos, ref, alt)),
"""


def _prepared(spark: SparkSession, sf: str) -> str:
    def make():
        d, out = _files(spark, sf), workspace.folder(spark, "classes")
        c = classifier.ClassifierConfig(
            f"{d}/sites.tsv", f"{d}/v.vcf", f"{d}/g.fa", out, k=K, embedder_options={"k": 1}, min_class_size=2
        )
        classifier.prepare(spark, c)
        return out

    return _once(spark, sf, "classes", make)


_ALLELE_ID = "'Chr' || c || ':' || pos || ':' || ref || '>' || alt AS site_id"


@query(_LABELLED + f"z AS (SELECT 1) SELECT {_ALLELE_ID}, variant_type, up || ref || down AS ref_seq, up || alt || down AS alt_seq FROM (SELECT x.*, {_window_sql(f'x.pos - {K}', 'x.pos - 1', 'g.seq')} AS up, {_window_sql('x.pos + length(x.ref)', f'x.pos + length(x.ref) + {K - 1}', 'g.seq')} AS down FROM lb x JOIN g USING (c))")
def class_sequences(spark, sf):
    return _csv(
        spark, f"{_prepared(spark, sf)}/variant_sequences.tsv", "\t"
    ).select("site_id", "variant_type", "ref_seq", "alt_seq")


@query(_LABELLED + f"z AS (SELECT 1) SELECT {_ALLELE_ID}, variant_type, (dense_rank() OVER (ORDER BY variant_type) - 1)::INT AS label_id FROM lb")
def class_labels(spark, sf):
    return _csv(spark, f"{_prepared(spark, sf)}/labels.tsv", "\t").select(
        "site_id", "variant_type", F.col("label_id").cast("int").alias("label_id")
    )


@query(_LABELLED + "z AS (SELECT 1) SELECT variant_type, count(*) AS count FROM lb GROUP BY 1")
def class_distribution(spark, sf):
    return _csv(
        spark, f"{_prepared(spark, sf)}/label_distribution.tsv", "\t"
    ).select("variant_type", F.col("count").cast("long").alias("count"))


_SEQS = f"(SELECT x.*, {_window_sql(f'x.pos - {K}', 'x.pos - 1', 'g.seq')} AS up, {_window_sql('x.pos + length(x.ref)', f'x.pos + length(x.ref) + {K - 1}', 'g.seq')} AS down FROM lb x JOIN g USING (c))"


@query(_LABELLED + f"z AS (SELECT 1) SELECT {_ALLELE_ID}, 15 AS n, round({_freq('(up || alt || down)', 'A')}, 6) AS alt_a, round({_freq('(up || ref || down)', 'A')}, 6) AS ref_a, round({_freq('(up || alt || down)', 'T')} - {_freq('(up || ref || down)', 'T')}, 6) AS diff_t, length(ref)::DOUBLE AS ref_len, length(alt)::DOUBLE AS alt_len FROM {_SEQS}")
def class_features(spark, sf):
    rows = spark.read.parquet(f"{_prepared(spark, sf)}/features.parquet")
    part = lambda i: F.col("features")[i].cast("double")
    return rows.select(
        "site_id", F.size("features").alias("n"), F.round(part(0), 6).alias("alt_a"),
        F.round(part(4), 6).alias("ref_a"), F.round(part(11), 6).alias("diff_t"), part(12).alias("ref_len"),
        part(13).alias("alt_len")
    )


class _Sum:
    """A fitted model in the form of other libraries: names of its features, and predict."""

    feature_names_in_ = ("n_chars", "doc_id")

    def predict(self, rows):
        return rows["n_chars"] * 0.5 - rows["doc_id"]


@query("SELECT doc_id, n_chars * 0.5::DOUBLE - doc_id AS predicted_phenotype FROM documents")
def model_predictions(spark, sf):
    rows = _t(spark, sf, "documents").select("doc_id", "n_chars")
    return models.predict_frame(_Sum(), rows, ["doc_id", "n_chars"]).select("doc_id", "predicted_phenotype")


@query(f"SELECT doc_id::VARCHAR AS site_id, 'test' AS split, CASE WHEN y = 1 THEN 'positive' ELSE 'negative' END AS true_label, CASE WHEN pred = 1 THEN 'positive' ELSE 'negative' END AS pred_label, round(1 - score, 9) AS prob_negative, round(score, 9) AS prob_positive FROM ({_SCORED})")
def prediction_table(spark, sf):
    rows = _scored(spark, sf).select(
        _text("doc_id").alias("site_id"), "y", "pred", F.array(1 - F.col("score"), F.col("score")).alias("proba")
    )
    out = models.prediction_table(rows, ["negative", "positive"], "test")
    return out.select(
        "site_id", "split", "true_label", "pred_label",
        *[F.round(c, 9).alias(c) for c in ("prob_negative", "prob_positive")]
    )


_EACH = f"WITH m AS ({_MULTI}), x AS (SELECT y, k, (vec_id * (k + 3)) % 101 / 101.0::DOUBLE AS score, (y = k)::INT AS hit FROM m, (SELECT unnest(range(10)) AS k)), t AS (SELECT k, score, sum(hit)::BIGINT AS ph, (count(*) - sum(hit))::BIGINT AS nh FROM x GROUP BY 1, 2), c AS (SELECT *, sum(ph) OVER w AS tp, sum(nh) OVER w AS fp, sum(ph) OVER a AS pos, sum(nh) OVER a AS neg FROM t WINDOW w AS (PARTITION BY k ORDER BY score DESC ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY k)), u AS (SELECT k, sum(nh::DOUBLE * ((tp - ph)::DOUBLE + ph::DOUBLE / 2)) / (any_value(pos)::DOUBLE * any_value(neg)::DOUBLE) AS roc, sum(ph::DOUBLE * tp::DOUBLE / (tp + fp)::DOUBLE) / any_value(pos)::DOUBLE AS pr, any_value(pos) AS n FROM c GROUP BY k HAVING any_value(pos) > 0)"


@query(_EACH + " SELECT round(avg(roc), 9) AS roc_auc_macro, round(sum(roc * n) / sum(n), 9) AS roc_auc_weighted, round(avg(pr), 9) AS pr_auc_macro FROM u")
def multiclass_areas(spark, sf):
    proba = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: (F.col("vec_id") * (k + 3)) % 101 / F.lit(101.0))
    out = metrics.multiclass_metrics(_multi(spark, sf).withColumn("proba", proba), proba="proba", classes=10)
    return out.select(*[F.round(c, 9).alias(c) for c in ("roc_auc_macro", "roc_auc_weighted", "pr_auc_macro")])


@query(f"WITH m AS ({_MULTI}) SELECT a.range::INT AS label_true, b.range::INT AS label_pred, (SELECT count(*) FROM m WHERE y = a.range AND pred = b.range)::BIGINT AS count FROM range(10) a, range(10) b")
def confusion_file(spark, sf):
    def make():
        ids = spark.range(10).select(F.col("id").cast("int").alias("label"))
        return sinks.save_csv(
            metrics.confusion_matrix(_multi(spark, sf), ids), workspace.folder(spark, "confusion"), "\t"
        )

    rows = _csv(spark, _once(spark, sf, "confusion", make), "\t")
    return rows.select(
        *[F.col(c).cast("int").alias(c) for c in ("label_true", "label_pred")],
        F.col("count").cast("long").alias("count")
    )


@query(f"SELECT y, count(*)::BIGINT AS count FROM ({_SCORED}) GROUP BY 1")
def label_counts(spark, sf):
    from lociflow.ml import labels

    return labels.class_counts(_scored(spark, sf), "y")


@query(f"SELECT sample, value, (location = 'east')::INT AS loc_east, (location = 'north')::INT AS loc_north, (location = 'south')::INT AS loc_south FROM ({_MEANS})")
def pheno_file(spark, sf):
    """The processed sheet, written and read as the simulator reads it."""
    out = _once(
        spark, sf, "sheet", lambda: phenotypes.run(_sheet(spark, sf), workspace.folder(spark, "sheet"), ["SPY"], "1")
    )
    return tables.phenotypes(_csv(spark, out["SPY"])).drop("ord")


# --- the simulator ----------------------------------------------------------------------------------------------

_SIM = [f"Chr{i}:{10 * i}" for i in range(1, 7)]
_SIM_EFFECT = {f: 0.25 * (i + 1) for i, f in enumerate(_SIM)}
#: By gain: the first of three sites changes slowest.
_SIM_TOP = [_SIM[4], _SIM[1], _SIM[3]]
_SIM_LOC = {"loc_f": 0.5, "loc_hi": -0.25}


def _sim_sql() -> str:
    """Every combination and every other sample under every location of the sample with the least key."""
    own = [f"(m + {_SIM.index(f)}) % 3" for f in _SIM_TOP]
    digits = [f"(id // {3 ** (2 - i)}) % 3" for i in range(3)]
    target = " + ".join(f"({o}) * {3 ** (2 - i)}" for i, o in enumerate(own))
    total = " + ".join(
        f"{_SIM_EFFECT[f]}::DOUBLE * ({digits[_SIM_TOP.index(f)] if f in _SIM_TOP else f'(m + {i}) % 3'})" for i,
        f in enumerate(_SIM)
    )
    seen = " + ".join(f"{_SIM_EFFECT[f]}::DOUBLE * ((c_custkey + {i}) % 3)" for i, f in enumerate(_SIM))
    return f"""
WITH o AS (SELECT (SELECT min(o_custkey) FROM orders) AS m),
l AS (SELECT o_orderkey AS ord, o_totalprice AS value, (o_orderstatus = 'F')::INT AS loc_f, (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS loc_hi FROM orders, o WHERE o_custkey = m),
gr AS (SELECT loc_f, loc_hi, count(*)::BIGINT AS row_count, row_number() OVER (ORDER BY min(ord)) AS n FROM l GROUP BY 1, 2),
gp AS (SELECT 'group_' || lpad(n::VARCHAR, 3, '0') AS group_id, row_count, 0.5::DOUBLE * loc_f - 0.25::DOUBLE * loc_hi AS shift FROM gr),
t AS (SELECT range AS id, m, {target} AS target FROM range(27), o),
u AS (SELECT CASE WHEN id = target THEN 'original' ELSE 'sim_' || lpad(id::VARCHAR, 6, '0') END AS combination_id, CASE WHEN id = target THEN 's' || m ELSE 's' || m || '_sim_' || lpad(id::VARCHAR, 6, '0') END AS sample, id = target AS is_target, {total} AS total FROM t
      UNION ALL SELECT 'observed_' || lpad((row_number() OVER (ORDER BY c_custkey) - 1)::VARCHAR, 6, '0'), 's' || c_custkey, false, {seen} FROM customer, o WHERE c_custkey <> m),
rk AS (SELECT group_id, row_count, combination_id, sample, is_target, total + shift AS predicted_phenotype, row_number() OVER (PARTITION BY group_id ORDER BY total + shift DESC, combination_id, sample)::BIGINT AS rank FROM u, gp)
"""


def _simulated(spark: SparkSession, sf: str) -> str:
    def make():
        d = workspace.folder(spark, "simulated")
        c, o = _t(spark, sf, "customer").orderBy("c_custkey"), _t(spark, sf, "orders")
        m = o.agg(F.min("o_custkey")).first()[0]
        sinks.save_csv(
            c.select(
                F.concat(F.lit("s"), "c_custkey").alias("sample"),
                *[((F.col("c_custkey") + i) % 3).alias(f) for i, f in enumerate(_SIM)]
            ),
            f"{d}/g.csv"
        )
        seen = o.orderBy("o_orderkey")
        sinks.save_csv(
            seen.select(
                F.concat(F.lit("s"), "o_custkey").alias("sample"), F.col("o_totalprice").alias("value"),
                (F.col("o_orderstatus") == "F").cast("int").alias("loc_f"),
                F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("loc_hi")
            ),
            f"{d}/p.csv"
        )
        gains = [("loc_f", 99.0)] + [(f, float(9 - _SIM_TOP.index(f)) if f in _SIM_TOP else 0.0) for f in _SIM]
        sinks.save_csv(
            spark.createDataFrame(
                [(f, g, 1.0) for f, g in gains], "feature string, importance_gain double, importance_split double"
            ),
            f"{d}/i.csv"
        )
        sinks.save_csv(
            spark.createDataFrame(
                [("Chr1", 1, f, e) for f, e in _SIM_EFFECT.items()],
                "Chromosome string, Position int, site_id string, var_effect double"
            ),
            f"{d}/e.csv"
        )
        s = config.SimulatorConfig(f"{d}/g.csv", f"{d}/p.csv", f"{d}/i.csv", f"{d}/e.csv", f"s{m}", f"{d}/out", top_n=3)
        simulator.run(spark, s, simulator.linear_model(dict.fromkeys(_SIM, 1.0) | _SIM_LOC))
        return s.outdir

    return _once(spark, sf, "simulated", make)


@query(_sim_sql() + "SELECT group_id, row_count, combination_id, sample, is_target, predicted_phenotype, rank FROM rk")
def simulated_ranking(spark, sf):
    rows = _csv(spark, f"{_simulated(spark, sf)}/ranking.csv")
    return rows.select(
        "group_id", F.col("row_count").cast("long").alias("row_count"), "combination_id", "sample",
        F.col("is_target").cast("boolean").alias("is_target"),
        F.col("predicted_phenotype").cast("double").alias("predicted_phenotype"),
        F.col("rank").cast("long").alias("rank")
    )


@query(_sim_sql() + "SELECT group_id, row_count, rank AS target_rank, predicted_phenotype AS target_prediction, 27::BIGINT AS combinations FROM rk WHERE is_target")
def simulated_summary(spark, sf):
    rows = spark.read.option("multiLine", True).json(f"{_simulated(spark, sf)}/summary.json")
    return rows.select("combinations", F.explode("groups").alias("g")).select(
        "g.group_id", "g.row_count", "g.target_rank", "g.target_prediction", "combinations"
    )


@query(_sim_sql() + "SELECT group_id, count(*) AS points, count(*) FILTER (is_target) AS targets FROM rk GROUP BY 1")
def simulated_chart(spark, sf):
    """Points that the cells of each group's chart count, and among them the target."""
    out = _simulated(spark, sf)
    files = spark.read.option("wholetext", True).text(f"{out}/group_*.svg").select(
        F.regexp_extract("_metadata.file_path", r"(group_[0-9]+)\.svg", 1).alias("group_id"), "value"
    )
    counted = lambda size: F.aggregate(
        F.regexp_extract_all("value", F.lit(f'r="{size}" [^>]*data-n="([0-9]+)"')), F.lit(0).cast("long"),
        lambda total, x: total + x.cast("long")
    )
    return files.select("group_id", counted("[25]").alias("points"), counted("5").alias("targets"))


