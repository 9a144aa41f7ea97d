"""Queries over the driver's tables, each with the SQL that states the same.

The tables have no genomic content, so they stand in for it: line items are variants and hits, parts are trait
intervals, suppliers genes, customers samples, orders calls, documents sequences, embeddings embeddings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.functions import attributes, genotype, names, sequence, vectors
from lociflow.ml import labels, metrics
from lociflow.operators.places import numbered
from lociflow.operators import blocks, effects, genotypes, intervals, phenotype, simulate, sites, splits
from lociflow.sources import tables, vcf, workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _text(c: str):
    return F.col(c).cast("string")


# --- roles ---------------------------------------------------------------------------------------------------

_V = "SELECT DISTINCT 'Chr' || (l_suppkey % 12 + 1) AS chrom, l_partkey AS pos, substr('ACGT', (l_partkey % 4)::INT + 1, 1) AS ref, substr('CGTA', (l_partkey % 4)::INT + 1, 1) AS alt FROM lineitem"
_G = "SELECT 'Chr' || (l_suppkey % 12 + 1) AS chrom, l_partkey AS pos, l_returnflag AS trait FROM lineitem WHERE l_discount < 0.01"
_Q = "SELECT 'Chr' || (p_partkey % 12 + 1) AS chrom, p_partkey AS \"start\", p_partkey + p_size AS \"end\", CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS trait FROM part WHERE p_size > 10"
_N = "SELECT 'Chr' || (s_suppkey % 12 + 1) AS chrom, greatest(1, 20 * s_suppkey - 5) AS gene_start, 20 * s_suppkey + 20 AS gene_end, s_name AS gene_id FROM supplier"
_SITES = f"""
WITH v AS ({_V}), g AS ({_G}), q AS ({_Q}),
ga AS (SELECT chrom, pos, list_sort(list(DISTINCT trait)) AS gt FROM g GROUP BY 1, 2),
qa AS (SELECT v.chrom, v.pos, list_sort(list(DISTINCT trait)) AS qt FROM v JOIN q ON v.chrom = q.chrom AND v.pos BETWEEN q."start" AND q."end" GROUP BY 1, 2),
b AS (SELECT v.chrom, v.pos, v.ref, v.alt, coalesce(qt, []::VARCHAR[]) AS qt, coalesce(gt, []::VARCHAR[]) AS gt FROM v LEFT JOIN ga USING (chrom, pos) LEFT JOIN qa USING (chrom, pos)),
"""
_UNION = _SITES + "s AS (SELECT chrom, pos, ref, alt, array_to_string(qt, ',') AS qtl_trait, array_to_string(gt, ',') AS gwas_trait FROM b WHERE len(qt) > 0 OR len(gt) > 0)"


def _variants(spark: SparkSession, sf: str) -> DataFrame:
    i = (F.col("pos") % 4).cast("int") + 1
    return _t(spark, sf, "lineitem").select(
        F.concat(F.lit("Chr"), _text_of(F.col("l_suppkey") % 12 + 1)).alias("chrom"), F.col("l_partkey").alias("pos")
    ).distinct().select(
        "chrom", "pos", F.substring(F.lit("ACGT"), i, F.lit(1)).alias("ref"),
        F.substring(F.lit("CGTA"), i, F.lit(1)).alias("alt")
    )


def _text_of(c):
    return c.cast("string")


def _gwas(spark: SparkSession, sf: str) -> DataFrame:
    raw = _t(spark, sf, "lineitem").select(
        F.concat(F.lit("chr_0"), _text_of(F.col("l_suppkey") % 12 + 1)).alias("Chromosome"),
        F.col("l_partkey").alias("Position"), F.col("l_returnflag").alias("Trait"), F.col("l_discount").alias("pvalue")
    )
    return tables.gwas(raw, 0.01)


def _qtl(spark: SparkSession, sf: str) -> DataFrame:
    raw = _t(spark, sf, "part").select(
        _text_of(F.col("p_partkey") % 12 + 1).alias("Chromosome"),
        (F.col("p_partkey") + F.col("p_size")).alias("start_pos"), F.col("p_partkey").alias("end_pos"),
        F.when(F.col("p_size") % 3 == 0, "A").when(F.col("p_size") % 3 == 1, "N").otherwise("R").alias("Trait"),
        F.col("p_size").alias("LOD")
    )
    return tables.qtl(raw, min_lod=10)


def _genes(spark: SparkSession, sf: str) -> DataFrame:
    raw = _t(spark, sf, "supplier").select(
        F.concat(F.lit("Chr"), _text_of(F.col("s_suppkey") % 12 + 1)).alias("chrom"),
        (F.col("s_suppkey") * 20).alias("start"), (F.col("s_suppkey") * 20 + 15).alias("end"), F.lit("").alias("id"),
        F.col("s_name").alias("name"), F.lit("").alias("parent")
    )
    return sites.extend_genes(raw, 5)


# --- names, tables -------------------------------------------------------------------------------------------


@query("SELECT c_custkey, 'Chr' || coalesce(nullif(ltrim(regexp_extract(c_name, '([0-9]+)', 1), '0'), ''), '0') AS chrom, c_name || ':' || c_custkey AS site_id FROM customer")
def std_chrom(spark, sf):
    return _t(spark, sf, "customer").select(
        "c_custkey", names.standard_chrom(F.col("c_name")).alias("chrom"),
        names.site_id(F.col("c_name"), F.col("c_custkey")).alias("site_id")
    )


@query("""
WITH b AS (SELECT s_suppkey AS idx, 'S_' || (s_suppkey % 7) || CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'x' END AS raw_sample FROM supplier),
n AS (SELECT idx, raw_sample, 'sample_' || regexp_extract(raw_sample, '([0-9]+)', 1) AS base FROM b)
SELECT idx, raw_sample, CASE WHEN row_number() OVER (PARTITION BY base ORDER BY idx) > 1 THEN base || '_' || (idx + 1) ELSE base END AS sample FROM n
""")
def std_sample_dedupe(spark, sf):
    raw = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("idx"),
        F.concat(
            F.lit("S_"), _text_of(F.col("s_suppkey") % 7), F.when(F.col("s_suppkey") % 5 == 0, "").otherwise("x")
        ).alias("raw_sample")
    )
    return genotypes.standard_samples(raw)


@query(_G)
def gwas_filter(spark, sf):
    return _gwas(spark, sf)


@query(_Q.replace(" FROM part", ", '' AS qtl FROM part"))
def qtl_filter_swap(spark, sf):
    return _qtl(spark, sf)


@query(f"SELECT chrom, pos, string_agg(DISTINCT trait, ',' ORDER BY trait) AS gwas_traits FROM ({_G}) GROUP BY 1, 2")
def gwas_trait_sets(spark, sf):
    return sites.gwas_traits(_gwas(spark, sf)).withColumn("gwas_traits", F.array_join("gwas_traits", ","))


@query(f"WITH v AS ({_V}), q AS ({_Q}) SELECT v.chrom, v.pos, q.\"start\", q.\"end\", q.trait FROM v JOIN q ON v.chrom = q.chrom AND v.pos BETWEEN q.\"start\" AND q.\"end\"")
def interval_stab(spark, sf):
    return intervals.stab(_variants(spark, sf).select("chrom", "pos"), _qtl(spark, sf).drop("qtl"))


@query(_UNION + " SELECT * FROM s")
def sites_union(spark, sf):
    return sites.select_sites(_variants(spark, sf), _gwas(spark, sf), _qtl(spark, sf), "union")


@query(_SITES + "s AS (SELECT chrom, pos, ref, alt, list_sort(list_intersect(qt, gt)) AS t FROM b) SELECT chrom, pos, ref, alt, array_to_string(t, ',') AS qtl_trait, array_to_string(t, ',') AS gwas_trait FROM s WHERE len(t) > 0")
def sites_intersect(spark, sf):
    return sites.select_sites(_variants(spark, sf), _gwas(spark, sf), _qtl(spark, sf), "intersect")


_MAPPED = _UNION + f", n AS ({_N}), m AS (SELECT s.chrom, s.pos, n.gene_id, n.gene_start, n.gene_end, s.ref, s.alt, s.qtl_trait, s.gwas_trait FROM s JOIN n ON s.chrom = n.chrom AND s.pos BETWEEN n.gene_start AND n.gene_end)"


@query(_MAPPED + " SELECT * FROM m")
def sites_to_genes(spark, sf):
    return sites.map_to_genes(sites_union(spark, sf), _genes(spark, sf))


@query(_MAPPED + " SELECT * FROM m WHERE gene_id IN (SELECT s_name FROM supplier WHERE s_nationkey < 12)")
def gene_subset(spark, sf):
    wanted = _t(spark, sf, "supplier").where("s_nationkey < 12").select("s_name")
    return sites.gene_subset(sites_to_genes(spark, sf), tables.first_column(wanted, "gene_id"))


@query(f"SELECT chrom, pos, row_number() OVER (ORDER BY substr(chrom, 4)::BIGINT, pos)::BIGINT AS place FROM ({_V})")
def chrom_natural_sort(spark, sf):
    bins = [names.chrom_order(F.col("chrom")), F.shiftright(F.col("pos"), 10)]
    return numbered(_variants(spark, sf), "place", bins, ["pos"]).select(
        "chrom", "pos", F.col("place").cast("long").alias("place")
    )


# --- genotypes -----------------------------------------------------------------------------------------------

_GT = "CASE (o_orderkey % 8)::INT WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '1|1' WHEN 3 THEN './.' WHEN 4 THEN './1' WHEN 5 THEN '1/2' WHEN 6 THEN '1' ELSE '2|0' END"
_DOSE = "CASE (o_orderkey % 8)::INT WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 5 THEN 2 WHEN 6 THEN 1 ELSE 1 END"
_CALLS = f"SELECT o_orderkey AS ord, 'Chr' || (o_custkey % 5 + 1) AS chrom, o_custkey % 40 + 1 AS pos, 'sample_' || (o_orderkey % 9 + 1) AS sample, {_DOSE} AS dose FROM orders"
_LONG = f"SELECT chrom || ':' || pos AS site_id, sample, arg_max(dose, ord)::TINYINT AS dosage FROM ({_CALLS}) GROUP BY chrom, pos, sample"
_EFFECT = "SELECT 'Chr' || (p_partkey % 5 + 1) || ':' || (p_partkey % 35 + 1) AS site_id, max(p_retailprice / 1000.0::DOUBLE) AS var_effect FROM part GROUP BY 1"


def _gt():
    k = (F.col("o_orderkey") % 8).cast("int")
    return F.element_at(F.array(*map(F.lit, ("0/0", "0/1", "1|1", "./.", "./1", "1/2", "1", "2|0"))), k + 1)


def _calls(spark, sf):
    return _t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ord"), F.concat(F.lit("Chr"), _text_of(F.col("o_custkey") % 5 + 1)).alias("chrom"),
        (F.col("o_custkey") % 40 + 1).alias("pos"),
        F.concat(F.lit("sample_"), _text_of(F.col("o_orderkey") % 9 + 1)).alias("sample"), _gt().alias("gt")
    )


def _long(spark, sf):
    calls = _calls(spark, sf)
    return genotypes.long_genotypes(calls, calls.select("chrom", "pos"))


def _effects(spark, sf):
    # Some sites of the genotypes have no part, so no effect.
    return _t(spark, sf, "part").groupBy(
        F.concat(
            F.lit("Chr"), _text_of(F.col("p_partkey") % 5 + 1), F.lit(":"), _text_of(F.col("p_partkey") % 35 + 1)
        ).alias("site_id")
    ).agg(F.max(F.col("p_retailprice") / F.lit(1000.0)).alias("var_effect"))


SAMPLES = [f"sample_{i}" for i in range(1, 10)]


@query(f"SELECT o_orderkey, {_GT} AS gt, ({_DOSE})::TINYINT AS dosage FROM orders")
def gt_encode(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", _gt().alias("gt"), genotype.encode_gt(_gt()).alias("dosage"))


@query(_LONG)
def geno_long(spark, sf):
    return _long(spark, sf).select("site_id", "sample", "dosage")


@query(f"SELECT site_id, {', '.join(f'''coalesce(max(dosage) FILTER (sample = '{s}'), 0)::TINYINT AS {s}''' for s in SAMPLES)} FROM ({_LONG}) GROUP BY site_id")
def geno_pivot(spark, sf):
    return genotypes.wide(_long(spark, sf), ["site_id"], "sample", "dosage", SAMPLES, 0).select(
        "site_id", *[F.col(s).cast("tinyint").alias(s) for s in SAMPLES]
    )


_COLUMNS = [f"Chr{c}:{p}" for c in range(1, 6) for p in range(1, 41)]


@query(f"SELECT sample, {', '.join(f'''coalesce(max(dosage) FILTER (site_id = '{s}'), 0)::TINYINT AS \"{s}\"''' for s in _COLUMNS)} FROM ({_LONG}) GROUP BY sample")
def geno_transpose(spark, sf):
    """A row for each sample and a column for each site, put together from blocks of 64 columns."""
    long = _long(spark, sf)
    columns = spark.createDataFrame(list(enumerate(_COLUMNS)), "no long, name string")
    made = blocks.write(
        long, "sample", "site_id", "dosage", blocks.index(long.select("sample"), "sample"), columns,
        workspace.folder(spark, "transposed"), 0, width=64
    )
    return spark.read.parquet(made.save_parquet(f"{made.folder}/wide"))


@query("SELECT o_custkey, arg_min(o_totalprice, o_orderkey) AS first_price, arg_max(o_totalprice, o_orderkey) AS last_price FROM orders GROUP BY 1")
def first_last_wins(spark, sf):
    o = _t(spark, sf, "orders")
    first = genotypes.first_by(o, ["o_custkey"], "o_orderkey").select(
        "o_custkey", F.col("o_totalprice").alias("first_price")
    )
    return first.join(
        genotypes.last_values(
            o, ["o_custkey"], "o_orderkey", "o_totalprice"
        ).withColumnRenamed("o_totalprice", "last_price"),
        "o_custkey"
    )


@query(f"WITH e AS ({_EFFECT}) SELECT g.site_id, g.sample, (g.dosage::FLOAT * coalesce(e.var_effect, 0)::FLOAT)::FLOAT AS value FROM ({_LONG}) g LEFT JOIN e USING (site_id)")
def effect_matrix(spark, sf):
    return genotypes.effect_matrix(_long(spark, sf), _effects(spark, sf))


# --- sequences -----------------------------------------------------------------------------------------------


def _upper(t: str) -> str:
    """Upper case as Spark has it: one letter becomes two."""
    return f"upper(replace({t}, 'ß', 'ss'))"


def _window_sql(s: str, e: str, t: str = "text") -> str:
    return f"CASE WHEN {e} < {s} THEN '' ELSE repeat('N', greatest(0, 1 - ({s}))::INT) || CASE WHEN greatest(1, {s}) <= least(length({t}), {e}) THEN {_upper(f'substr({t}, greatest(1, {s})::INT, (least(length({t}), {e}) - greatest(1, {s}) + 1)::INT)')} ELSE '' END || repeat('N', greatest(0, ({e}) - length({t}))::INT) END"


@query(f"SELECT doc_id, {_window_sql('doc_id % 50 - 20', 'doc_id % 50 + 15')} AS w FROM documents")
def fasta_window(spark, sf):
    p = F.col("doc_id") % 50
    return _t(spark, sf, "documents").select("doc_id", sequence.window(F.col("text"), p - 20, p + 15).alias("w"))


@query(f"""
WITH d AS (SELECT doc_id, text, doc_id % 40 + 1 AS pos, {_upper('substr(text, (doc_id % 40 + 1)::INT, 2)')} AS ref, 'T' AS alt FROM documents),
w AS (SELECT doc_id, pos, ref, alt, {_window_sql('pos - 8', 'pos - 1')} AS upstream_seq, {_window_sql('pos + length(ref)', 'pos + length(ref) + 7')} AS downstream_seq FROM d)
SELECT doc_id, upstream_seq || ref || downstream_seq AS ref_seq, upstream_seq || alt || downstream_seq AS alt_seq FROM w
""")
def ref_alt_windows(spark, sf):
    d = _t(spark, sf, "documents").withColumn("pos", F.col("doc_id") % 40 + 1)
    d = d.select(
        "doc_id", F.col("doc_id").cast("string").alias("chrom"), "pos",
        F.upper(F.substring("text", F.col("pos").cast("int"), F.lit(2))).alias("ref"), F.lit("T").alias("alt"), "text"
    )
    genome = d.select("chrom", F.col("text").alias("seq"))
    return effects.allele_windows(d.drop("text"), genome, 8).select("doc_id", "ref_seq", "alt_seq")


@query("SELECT p_partkey, CASE WHEN length(r) = 1 AND length(a) = 1 THEN 'SNV' WHEN length(r) = length(a) THEN 'MNV' WHEN length(r) < length(a) THEN 'Insertion' ELSE 'Deletion' END AS variant_type FROM (SELECT p_partkey, substr(p_name, 1, (p_size % 3)::INT + 1) AS r, substr(p_type, 1, (p_partkey % 3)::INT + 1) AS a FROM part)")
def variant_type(spark, sf):
    r, a = F.substring("p_name", F.lit(1), F.col("p_size") % 3 + 1), F.substring(
        "p_type", F.lit(1), (F.col("p_partkey") % 3).cast("int") + 1
    )
    return _t(spark, sf, "part").select("p_partkey", genotype.variant_type(r, a).alias("variant_type"))


@query("SELECT p_partkey AS ord, 'Chr' || (p_partkey % 12 + 1) AS chrom, p_partkey AS pos, upper(p_type) AS ref, upper(unnest(string_split(replace(p_name, ' ', ','), ','))) AS alt FROM part")
def vcf_alt_explode(spark, sf):
    f = F.array(
        _text_of(F.col("p_partkey") % 12 + 1), _text("p_partkey"), F.lit("."), F.col("p_type"),
        F.replace("p_name", F.lit(" "), F.lit(","))
    )
    return vcf.all_alts(_t(spark, sf, "part").select(F.col("p_partkey").alias("ord"), f.alias("f")))


@query("SELECT event_id, event_type AS name, (user_id % 5)::VARCHAR || ',' || (user_id % 5 + 5)::VARCHAR AS tags, 'e ' || event_id || '+x' AS note FROM events")
def gff_attrs(spark, sf):
    low, high = _text_of(F.col("user_id") % 5), _text_of(F.col("user_id") % 5 + 5)
    text = F.concat(
        F.lit("ID="), _text("event_id"), F.lit("; Name="), F.col("event_type"), F.lit(";tag="), high, F.lit(";tag="),
        low, F.lit(',;note "e%20'), _text("event_id"), F.lit('+x";junk')
    )
    a = F.col("attrs")
    return _t(spark, sf, "events").withColumn("attrs", attributes.attributes(text)).select(
        "event_id", attributes.labels(a)[1].alias("name"), a["tag"].alias("tags"), a["note"].alias("note")
    )


_PAIRS = "SELECT a.vec_id, a.embedding AS x, b.embedding AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"


@query(f"SELECT vec_id, round(sqrt(list_sum([(x[i]::DOUBLE - y[i]::DOUBLE) ** 2 FOR i IN range(1, len(x) + 1)])), 6) AS var_effect FROM ({_PAIRS})")
def variant_effect_l2(spark, sf):
    e = _t(spark, sf, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    return e.join(b, "vec_id").select(
        "vec_id", F.round(vectors.l2(F.col("embedding"), F.col("y")), 6).alias("var_effect")
    )


@query(f"SELECT vec_id, len(y) + len(x) + len(x) + 3 AS n, round(y[1]::DOUBLE, 6) AS first_alt, round((y[1] - x[1])::DOUBLE, 6) AS first_diff, (vec_id % 3 - vec_id % 5)::DOUBLE AS delta FROM ({_PAIRS})")
def feature_concat(spark, sf):
    e = _t(spark, sf, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    v = vectors.features(F.col("embedding"), F.col("y"), "all", F.col("vec_id") % 5, F.col("vec_id") % 3)
    return e.join(b, "vec_id").withColumn("v", v).select(
        "vec_id", F.size("v").cast("long").alias("n"), F.round(F.col("v")[0].cast("double"), 6).alias("first_alt"),
        F.round(F.col("v")[128].cast("double"), 6).alias("first_diff"),
        F.element_at("v", -1).cast("double").alias("delta")
    )


@query(f"""
SELECT doc_id, substr(text, 1, 9) || 'XY' || substr(text, 11, 9) || substr(text, 25) AS seq FROM documents WHERE length(text) >= 20 UNION ALL
SELECT doc_id, CASE WHEN length(text) >= 10 THEN substr(text, 1, 9) || 'XY' || substr(text, 11) WHEN length(text) = 9 THEN text || 'XYZZZ' ELSE text END
FROM documents WHERE length(text) < 20 OR text IS NULL
""")
def apply_variants(spark, sf):
    """Three variants apply in part: the second overlaps the first and is skipped, the fourth has dosage 0; those beyond
    the end of a short text are skipped too."""
    t = F.col("text")
    at = lambda p, n: F.substring(t, p, n)
    v = lambda p, r, a, d: F.struct(F.lit(p).alias("pos"), r.alias("ref"), F.lit(a).alias("alt"), F.lit(d).alias("dosage"))
    variants = F.array(
        v(120, at(20, 5), "", 2), v(110, at(10, 1), "XY", 1), v(110, at(10, 3), "ZZZ", 1), v(130, at(30, 2), "Q", 0),
        v(90, at(1, 1), "Q", 1)
    )
    d = _t(spark, sf, "documents")
    return d.select("doc_id", sequence.apply_variants(t, F.lit(101), variants).alias("seq"))


# --- splits, phenotypes, simulation --------------------------------------------------------------------------


def _sha(key: str) -> str:
    return f"sha1('42:' || {key}::VARCHAR)"


@query(f"SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality ORDER BY {_sha('doc_id')}, doc_id) - 1) % 5)::INT AS fold FROM labels")
def strat_kfold(spark, sf):
    return splits.stratified_folds(_t(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query(f"SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY {_sha('doc_id')}, doc_id) <= round(count(*) OVER (PARTITION BY lang) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM documents")
def strat_holdout(spark, sf):
    return splits.stratified_holdout(_t(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id")


_SHEET = "SELECT user_id::VARCHAR AS sample, max(value) FILTER (event_id % 4 = 0) AS v0, max(value) FILTER (event_id % 4 = 1) AS v1, max(value) FILTER (event_id % 4 = 2) AS v2, max(value) FILTER (event_id % 4 = 3) AS v3 FROM events GROUP BY 1"
_MELT = f"SELECT sample, 'SPY' AS trait, t.year, t.location, t.value FROM (SELECT sample, unnest([{{'year': '2019', 'location': 'north', 'value': v0}}, {{'year': '2020', 'location': 'north', 'value': v1}}, {{'year': '2019', 'location': 'south', 'value': v2}}, {{'year': '2020', 'location': 'east', 'value': v3}}]) AS t FROM ({_SHEET})) WHERE t.value IS NOT NULL"
_MEANS = f"SELECT sample, location, round_even(avg(value) * 1000, 0) / 1000 AS value FROM ({_MELT}) GROUP BY 1, 2"


def _sheet(spark, sf):
    part = lambda k: F.max(F.when(F.col("event_id") % 4 == k, F.col("value")))
    return _t(spark, sf, "events").groupBy(_text("user_id").alias("sample")).agg(
        part(0).alias("SPY_2019_north"), part(1).alias("SPY_2020_north"), part(2).alias("SPY_2019_south"),
        part(3).alias("SPY_2020_east"), F.count("*").alias("TGW_2020_east")
    )


@query(_MELT)
def pheno_melt(spark, sf):
    return phenotype.melt(_sheet(spark, sf), "SPY")


@query(_MEANS)
def pheno_loc_mean(spark, sf):
    return phenotype.location_means(phenotype.melt(_sheet(spark, sf), "SPY"))


@query(f"SELECT sample, value, (location = 'east')::INT AS loc_east, (location = 'north')::INT AS loc_north, (location = 'south')::INT AS loc_south FROM ({_MEANS})")
def pheno_onehot(spark, sf):
    return phenotype.process_trait(_sheet(spark, sf), "SPY")


@query("SELECT c_custkey, c_name AS sample, c_acctbal AS value, n_orders FROM customer JOIN (SELECT o_custkey, count(*)::BIGINT AS n_orders FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def pheno_geno_merge(spark, sf):
    p = _t(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("sample"), F.col("c_acctbal").alias("value"), F.col("c_custkey").alias("ord")
    )
    g = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders")).join(
        p.select(F.col("c_custkey").alias("o_custkey"), "sample"), "o_custkey"
    ).select("sample", "n_orders")
    return tables.phenotype_genotype(p, g).select("c_custkey", "sample", "value", "n_orders")


@query("SELECT c_custkey, c_name AS sample FROM customer WHERE c_name = 'Customer#000000012'")
def one_sample(spark, sf):
    return tables.sample_rows(
        _t(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("sample")), "Customer#000000012"
    )


def _importance(spark, sf):
    return _t(spark, sf, "part").select(
        F.col("p_partkey").alias("ord"),
        F.concat(F.when(F.col("p_partkey") % 11 == 0, "loc_").otherwise("Chr1:"), _text("p_partkey")).alias("feature"),
        F.col("p_size").cast("double").alias("importance_gain"),
        (F.col("p_partkey") % 13).cast("double").alias("importance_split")
    )


@query("SELECT 'Chr1:' || p_partkey AS feature, row_number() OVER (ORDER BY p_size DESC, p_partkey % 13 DESC, p_partkey)::BIGINT AS place FROM part WHERE p_partkey % 11 <> 0 AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') ORDER BY 2 LIMIT 10")
def top_features(spark, sf):
    wanted = _t(spark, sf, "lineitem").where("l_returnflag = 'R'").select(
        F.concat(F.lit("Chr1:"), _text("l_partkey")).alias("feature")
    )
    got = simulate.top_features(_importance(spark, sf), wanted, 10)
    return spark.createDataFrame([(f, i + 1) for i, f in enumerate(got)], "feature string, place long")


_FEATURES = [f"Chr{i}:{10 * i}" for i in range(1, 7)]
_MUTABLE = [_FEATURES[3], _FEATURES[0], _FEATURES[4], _FEATURES[1]]
#: The base sample is the customer of the least key.
_FIRST = "(SELECT min(c_custkey) FROM customer)"
_BASE = {f: f"(({_FIRST} + {i}) % 3)" for i, f in enumerate(_FEATURES)}
_EFFECTS = {f: 0.25 * (i + 1) for i, f in enumerate(_FEATURES)}


def _combo_sql() -> str:
    n = len(_MUTABLE)
    d = [f"((id // {3 ** (n - 1 - i)}) % 3)" for i in range(n)]
    own = [_BASE[f] for f in _MUTABLE]
    target = "(" + " + ".join(f"{g} * {3 ** (n - 1 - i)}" for i, g in enumerate(own)) + ")"
    name = f"'s' || {_FIRST}"
    changed = [f"({x} <> {o})" for x, o in zip(d, own, strict=True)]
    listed = "list_filter([" + ", ".join(
        f"CASE WHEN {c} THEN '{f}' END" for c, f in zip(changed, _MUTABLE, strict=True)
    ) + "], lambda x: x IS NOT NULL)"
    pairs = "list_filter([" + ", ".join(
        f"CASE WHEN {c} THEN '{f}:' || ({x}) END" for c, f, x in zip(changed, _MUTABLE, d, strict=True)
    ) + "], lambda x: x IS NOT NULL)"
    total = " + ".join(f"{_EFFECTS[f]}::DOUBLE * {d[_MUTABLE.index(f)] if f in _MUTABLE else _BASE[f]}" for f in _FEATURES)
    return f"""SELECT CASE WHEN id = {target} THEN {name} ELSE {name} || '_sim_' || lpad(id::VARCHAR, 6, '0') END AS sample, CASE WHEN id = {target} THEN 'original' ELSE 'sim_' || lpad(id::VARCHAR, 6, '0') END AS combination_id, id = {target} AS is_target, {name} AS source_sample, CASE WHEN id = {target} THEN 'original' ELSE 'simulated' END AS source_type, len({listed})::INT AS mutated_feature_count, array_to_string({listed}, ';') AS mutated_features, array_to_string({pairs}, ';') AS mutated_feature_genotypes, {total} AS total FROM (SELECT range AS id FROM range({3**n}))"""


def _total():
    return F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double"))


def _combos(spark, sf):
    first = _t(spark, sf, "customer").agg(F.min("c_custkey")).first()[0]
    base = {f: (first + i) % 3 for i, f in enumerate(_FEATURES)}
    return simulate.combinations(spark, base, f"s{first}", _FEATURES, _MUTABLE, _EFFECTS)


@query(_combo_sql())
def combos(spark, sf):
    return _combos(spark, sf).withColumn("total", _total()).drop("features")


_OBS = "SELECT c_custkey AS ord, 's' || c_custkey AS sample, " + ", ".join(f'((c_custkey + {i}) % 3)::TINYINT AS f{i}' for i in range(6)) + " FROM customer"


def _observed(spark, sf):
    g = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("ord"), F.concat(F.lit("s"), _text("c_custkey")).alias("sample"),
        *[((F.col("c_custkey") + i) % 3).cast("tinyint").alias(f) for i, f in enumerate(_FEATURES)]
    )
    return simulate.observed(g, _FEATURES, _EFFECTS, "s1")


_OBS_SQL = f"SELECT sample, 'observed_' || lpad((row_number() OVER (ORDER BY ord) - 1)::VARCHAR, 6, '0') AS combination_id, {' + '.join(f'f{i} * {_EFFECTS[f]}::DOUBLE' for i, f in enumerate(_FEATURES))} AS total FROM ({_OBS}) WHERE sample <> 's1'"


@query(_OBS_SQL)
def observed_weighted(spark, sf):
    return _observed(spark, sf).select("sample", "combination_id", _total().alias("total"))


@query(f"SELECT sample, combination_id, total FROM ({_combo_sql()}) UNION ALL SELECT * FROM ({_OBS_SQL})")
def combined_frame(spark, sf):
    return _combos(spark, sf).unionByName(_observed(spark, sf)).select("sample", "combination_id", _total().alias("total"))


_LOCROWS = "SELECT o_orderkey AS ord, o_totalprice AS value, (o_orderstatus = 'F')::INT AS loc_f, (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS loc_hi FROM orders"
_GROUPS = f"""
SELECT 'group_' || lpad(n::VARCHAR, 3, '0') AS group_id, CASE WHEN loc_f = 1 AND loc_hi = 1 THEN 'loc_f__loc_hi' WHEN loc_f = 1 THEN 'loc_f' WHEN loc_hi = 1 THEN 'loc_hi' ELSE 'location_group_' || lpad(n::VARCHAR, 3, '0') END AS location_label, row_count, actual_value_mean, loc_f, loc_hi
FROM (SELECT loc_f, loc_hi, count(*)::BIGINT AS row_count, round(avg(value), 4) AS actual_value_mean, row_number() OVER (ORDER BY min(ord)) AS n FROM ({_LOCROWS}) GROUP BY 1, 2)
"""


def _groups(spark, sf):
    rows = _t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ord"), F.col("o_totalprice").alias("value"),
        (F.col("o_orderstatus") == "F").cast("int").alias("loc_f"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("loc_hi")
    )
    return simulate.location_groups(rows, ["loc_f", "loc_hi"]).withColumn(
        "actual_value_mean", F.round("actual_value_mean", 4)
    )


@query(_GROUPS)
def loc_groups(spark, sf):
    return _groups(spark, sf)


@query(f"SELECT group_id, combination_id, total + 0.5::DOUBLE * loc_f - 0.25::DOUBLE * loc_hi AS predicted_phenotype, row_number() OVER (PARTITION BY group_id ORDER BY total + 0.5::DOUBLE * loc_f - 0.25::DOUBLE * loc_hi DESC, combination_id, sample)::BIGINT AS rank FROM ({_combo_sql()}), ({_GROUPS})")
def loc_cross_rank(spark, sf):
    from lociflow.plans.simulator import linear_model

    model = linear_model(dict.fromkeys(_FEATURES, 1.0) | {"loc_f": 0.5, "loc_hi": -0.25})
    scored = model(_combos(spark, sf).crossJoin(F.broadcast(_groups(spark, sf))), _FEATURES)
    return simulate.rank_predictions(scored).select("group_id", "combination_id", "predicted_phenotype", "rank")


@query("SELECT o_orderkey, round(60 + (o_totalprice - lo) / (hi - lo) * 780, 6) AS x FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)")
def rank_scale(spark, sf):
    o = _t(spark, sf, "orders")
    ends = o.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    return o.crossJoin(F.broadcast(ends)).select(
        "o_orderkey", F.round(simulate.scale(F.col("o_totalprice"), F.col("lo"), F.col("hi"), 60, 840), 6).alias("x")
    )


# --- labels, metrics -----------------------------------------------------------------------------------------



@query(f"""
WITH v AS ({_V}), t AS (SELECT 'Chr' || (p_partkey % 12 + 1) AS chrom, p_partkey AS pos, substr('ACGT', (p_partkey % 4)::INT + 1, 1) AS ref, CASE WHEN p_size % 2 = 0 THEN substr('CGTA', (p_partkey % 4)::INT + 1, 1) ELSE 'NN' END AS alt, p_type AS variant_type FROM part)
SELECT v.chrom || ':' || v.pos || ':' || v.ref || '>' || v.alt AS site_id, v.chrom, v.pos, v.ref, v.alt, t.variant_type FROM v JOIN t ON v.chrom = t.chrom AND v.pos = t.pos AND v.ref = t.ref AND v.alt = t.alt
""")
def tsv_allele_semi(spark, sf):
    i = (F.col("p_partkey") % 4).cast("int") + 1
    raw = _t(spark, sf, "part").select(
        _text_of(F.col("p_partkey") % 12 + 1).alias("CHR"), F.col("p_partkey").alias("Pos"),
        F.substring(F.lit("ACGT"), i, F.lit(1)).alias("ref_allele"),
        F.when(F.col("p_size") % 2 == 0, F.substring(F.lit("CGTA"), i, F.lit(1))).otherwise("NN").alias("alt_allele"),
        F.col("p_type").alias("variant_type")
    )
    return vcf.labelled(_variants(spark, sf).withColumn("ord", F.lit(1)), tables.site_table(raw))


@query(f"WITH v AS ({_V}) SELECT v.chrom || ':' || v.pos || ':' || v.ref || '>' || v.alt AS site_id, v.chrom, v.pos, v.ref, v.alt, 'SNV' AS variant_type FROM v WHERE (chrom, pos) IN (SELECT ('Chr' || (p_partkey % 12 + 1), p_partkey) FROM part)")
def label_fallback(spark, sf):
    raw = _t(spark, sf, "part").select(
        _text_of(F.col("p_partkey") % 12 + 1).alias("chrom"), F.col("p_partkey").alias("pos"),
        F.col("p_type").alias("variant_type")
    )
    return vcf.labelled(_variants(spark, sf).withColumn("ord", F.lit(1)), tables.site_table(raw))


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de', 'fr') AND lang IN (SELECT lang FROM documents GROUP BY 1 HAVING count(*) >= 20)")
def class_filter(spark, sf):
    return labels.filter_classes(_t(spark, sf, "documents").select("doc_id", "lang"), "lang", 20, ["en", "de", "fr"])


@query("SELECT lang, count(*)::BIGINT AS count FROM documents GROUP BY 1")
def class_counts(spark, sf):
    return labels.class_counts(_t(spark, sf, "documents"), "lang")


@query("SELECT doc_id, lang, (dense_rank() OVER (ORDER BY lang) - 1)::INT AS y FROM documents")
def label_encode(spark, sf):
    return labels.prepare_labels(_t(spark, sf, "documents").select("doc_id", "lang"), "lang")[0]


@query("SELECT doc_id, (lang = 'fr')::INT AS y FROM documents")
def label_binary(spark, sf):
    rows = _t(spark, sf, "documents").select("doc_id", "lang")
    return labels.prepare_labels(rows, "lang", "binary", "fr")[0].select("doc_id", "y")


_SCORED = "SELECT l.doc_id, l.quality AS y, (d.n_chars % 97)::DOUBLE / 97 AS score, ((d.n_chars % 97)::DOUBLE / 97 >= 0.5)::INT AS pred FROM labels l JOIN documents d USING (doc_id)"


def _scored(spark, sf):
    s = (F.col("n_chars") % 97).cast("double") / F.lit(97)
    return _t(spark, sf, "labels").join(_t(spark, sf, "documents"), "doc_id").select(
        "doc_id", F.col("quality").alias("y"), s.alias("score"), (s >= 0.5).cast("int").alias("pred")
    )


_AREA = f"""
WITH p AS ({_SCORED}), t AS (SELECT score, sum(y)::BIGINT AS ph, (count(*) - sum(y))::BIGINT AS nh FROM p GROUP BY 1),
c AS (SELECT *, sum(ph) OVER w AS tp, sum(nh) OVER w AS fp, sum(ph) OVER () AS pos, sum(nh) OVER () AS neg FROM t WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
"""


@query(_AREA + "SELECT round(sum(nh::DOUBLE * ((tp - ph)::DOUBLE + ph::DOUBLE / 2)) / (any_value(pos)::DOUBLE * any_value(neg)::DOUBLE), 9) AS roc_auc, round(sum(ph::DOUBLE * tp::DOUBLE / (tp + fp)::DOUBLE) / any_value(pos)::DOUBLE, 9) AS pr_auc FROM c")
def roc_auc_avg_precision(spark, sf):
    return metrics.areas(_scored(spark, sf)).select(
        F.round("roc_auc", 9).alias("roc_auc"), F.round("pr_auc", 9).alias("pr_auc")
    )


@query(_AREA + "SELECT round(score, 9) AS threshold, round(fp::DOUBLE / neg, 9) AS fpr, round(tp::DOUBLE / pos, 9) AS tpr FROM c")
def roc_points(spark, sf):
    return metrics.roc_points(_scored(spark, sf)).select(*[F.round(c, 9).alias(c) for c in ("threshold", "fpr", "tpr")])


@query(_AREA + "SELECT round(score, 9) AS threshold, round(tp::DOUBLE / (tp + fp), 9) AS precision, round(tp::DOUBLE / pos, 9) AS recall FROM c")
def pr_points(spark, sf):
    return metrics.pr_points(_scored(spark, sf)).select(
        *[F.round(c, 9).alias(c) for c in ("threshold", "precision", "recall")]
    )


_COUNTS = f"SELECT sum(y * pred)::DOUBLE AS tp, sum((1 - y) * pred)::DOUBLE AS fp, sum(y * (1 - pred))::DOUBLE AS fn, sum((1 - y) * (1 - pred))::DOUBLE AS tn FROM ({_SCORED})"


@query(f"SELECT round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 9) AS balanced_accuracy, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 9) AS mcc FROM ({_COUNTS})")
def binary_metrics(spark, sf):
    return metrics.binary_metrics(_scored(spark, sf)).select(
        *[F.round(c, 9).alias(c) for c in ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "mcc")]
    )


_MULTI = "SELECT vec_id, label AS y, CASE WHEN vec_id % 3 = 0 THEN (label + 1) % 10 ELSE label END AS pred FROM embeddings"


def _multi(spark, sf):
    return _t(spark, sf, "embeddings").select(
        "vec_id", F.col("label").alias("y"),
        F.when(F.col("vec_id") % 3 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("pred")
    )


_REPORT = f"""
WITH m AS ({_MULTI}), l AS (SELECT y AS label FROM m UNION SELECT pred FROM m),
r AS (SELECT label, (SELECT count(*) FROM m WHERE y = label)::DOUBLE AS support, (SELECT count(*) FROM m WHERE pred = label)::DOUBLE AS predicted, (SELECT count(*) FROM m WHERE pred = label AND y = label)::DOUBLE AS tp FROM l),
f AS (SELECT label, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END AS f1, support::BIGINT AS support FROM r)
"""


@query(_REPORT + "SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM f")
def class_report(spark, sf):
    return metrics.class_report(_multi(spark, sf)).select(
        "label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query(_REPORT + "SELECT round((SELECT avg((y = pred)::INT) FROM m), 9) AS accuracy, round(avg(f1), 9) AS macro_f1, round(sum(f1 * support) / sum(support), 9) AS weighted_f1, round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall FROM f")
def multiclass_metrics(spark, sf):
    out = metrics.multiclass_metrics(_multi(spark, sf))
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query(f"WITH m AS ({_MULTI}) SELECT a.range::INT AS label_true, b.range::INT AS label_pred, (SELECT count(*) FROM m WHERE y = a.range AND pred = b.range)::BIGINT AS count FROM range(10) a, range(10) b")
def confusion(spark, sf):
    ids = spark.range(10).select(F.col("id").cast("int").alias("label"))
    return metrics.confusion_matrix(_multi(spark, sf), ids)


@query(f"WITH p AS (SELECT doc_id % 5 AS fold, avg((y = pred)::INT) AS accuracy, avg(pred) AS rate FROM ({_SCORED}) GROUP BY 1), u AS (SELECT 'accuracy' AS metric, accuracy AS v FROM p UNION ALL SELECT 'rate', rate FROM p) SELECT metric, round(avg(v), 9) AS mean, round(stddev_pop(v), 9) AS std FROM u GROUP BY 1")
def cv_summary(spark, sf):
    folds = _scored(spark, sf).groupBy((F.col("doc_id") % 5).alias("fold")).agg(
        F.avg((F.col("y") == F.col("pred")).cast("double")).alias("accuracy"), F.avg("pred").alias("rate")
    )
    return metrics.fold_summary(folds, ["accuracy", "rate"]).select(
        "metric", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std")
    )
