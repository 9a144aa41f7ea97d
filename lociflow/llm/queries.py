"""The queries opN_<name> and, where SQL can state them, their SQL.

Each takes (spark, sf_dir), applies one operator with production parameters to its whole table and returns the
columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.llm import (
    jaccard, mixing, negatives, neighbours, pii, quality, ranked_search, secret_scan, shards, spm, substring_dedup,
    suffix_dedup, toxicity,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(_documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_documents(spark, sf_dir))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the compacted table holds it: size and digest, whether its shard is a merged one, the rows of
    that shard and the number of shards. Its SQL says what these are where all documents fit in a file of the target
    size, as in the tables that SQL is run on; the tests hold larger tables against the manifest."""
    out = shards.compacted(_documents(spark, sf_dir))
    return out.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"),
        "lang", "source", "n_chars", (F.col("level") > 0).alias("merged"), "shard_rows", "n_shards"
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(_documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece counts, the digest of the ids, and the digest of the text that they decode to."""
    return spm.encode(_documents(spark, sf_dir), digest=True)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_documents(spark, sf_dir))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(_documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    table = table.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.mine(table, F.col("vec_id") % 50 == 0)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP1_SQL = r"""
WITH s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, 15))::BIGINT AS u
  FROM documents
), p AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3]::HUGEINT AS weight
  FROM s GROUP BY source
), f AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER ()::HUGEINT AS budget,
         coalesce(sum(3 * source_size) OVER before, 0)::HUGEINT AS held,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::HUGEINT AS rest,
         row_number() OVER (ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, source NULLS LAST) AS fill
  FROM p
  WINDOW before AS (ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT held AS lh, rest AS lr FROM f WHERE cap * rest >= weight * (budget - held) ORDER BY fill LIMIT 1
), t AS (
  SELECT source, source_size,
         CASE WHEN source_size = 0 THEN 0.0::DOUBLE
              WHEN cap * lr <= weight * (budget - lh) THEN cap::DOUBLE
              ELSE (weight * (budget - lh))::DOUBLE / lr::DOUBLE END AS target
  FROM f, l
), r AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE) ELSE 0 END::BIGINT AS repeats
  FROM t
), c AS (
  SELECT s.doc_id, s.size, r.source_size::BIGINT AS source_size, r.target, r.repeats,
         round(r.target - (r.repeats * r.source_size)::DOUBLE)::BIGINT AS part,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS seen
  FROM s JOIN r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, (repeats * size + greatest(0, least(size, part - seen)))::BIGINT AS taken FROM c
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mixing, op2_suffix_dedup, op3_secrets, op4_jaccard_join, op5_neighbours, op6_sharding, op7_quality,
        op8_sentencepiece, op9_pii, op10_substring_dedup, op11_hard_negatives,
        op12_toxicity, op13_ranked_search
    )
}
OP6_SQL = """
SELECT doc_id, strlen(text)::BIGINT AS n_bytes, sha256(text) AS text_sha256, lang, source, n_chars, true AS merged,
       (count(*) OVER ())::BIGINT AS shard_rows, 1 AS n_shards
FROM documents
"""

OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS k FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), x AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 75 * (na.n + nb.n - common)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""

OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d
), g AS (
  SELECT doc_id, i, CASE WHEN i + 7 <= len(w) THEN md5_number(array_to_string(w[i:i + 7], ' ')) END AS k8, CASE WHEN i + 9 <= len(w) THEN md5_number(array_to_string(w[i:i + 9], ' ')) END AS k10, CASE WHEN i + 150 <= len(w) THEN md5_number(array_to_string(w[i:i + 150], ' ')) END AS k151 FROM p
), c AS (
  SELECT doc_id, i, (k8 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, k8) > 1)::INT AS r8, (k10 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, k10) > 1)::INT AS r10, (k151 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, k151) > 1)::INT AS r151 FROM g
), v AS (
  SELECT doc_id, r151, max(r8) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c8, max(r10) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS c10 FROM c
), o AS (
  SELECT doc_id, sum(c8) AS n8, sum(c10) AS n10, max(r151) AS long FROM v GROUP BY doc_id
), l AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n8, 0)::BIGINT AS n_repeat_words, coalesce(n10, 0) AS n10, coalesce(long, 0) AS long
  FROM d LEFT JOIN o USING (doc_id) JOIN l USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 4 * n10 > n_words OR long = 1) AS kept
FROM m
"""

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), g AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i + 12 <= len(w) THEN array_to_string(w[i:i + 12], ' ') END AS k FROM p
), f AS (
  SELECT k, min(doc_id) AS least FROM g WHERE k IS NOT NULL GROUP BY k
), m AS (
  SELECT g.doc_id, g.i, g.word,
         max(CASE WHEN f.least < g.doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY g.doc_id ORDER BY g.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM g LEFT JOIN f USING (k)
), o AS (
  SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '') AS kept FROM m GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id)
"""

OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), d AS (
  SELECT row_number() OVER () AS r, doc_id, w, len(w)::BIGINT AS n FROM t WHERE len(w) > 0
), a AS (
  SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM d
), p AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL
), f AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term), a
), q AS (
  SELECT item_id, term, count(*)::BIGINT AS k FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
  ) GROUP BY ALL
), s AS (
  SELECT item_id, d.r, doc_id, sum(k * w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l))))::BIGINT AS score
  FROM q JOIN f w USING (term) JOIN p USING (term) JOIN d ON d.r = p.r, a GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""

SQL: dict[str, str] = {
    "op1_mixing": OP1_SQL, "op4_jaccard_join": OP4_SQL, "op6_sharding": OP6_SQL, "op7_quality": OP7_SQL,
    "op10_substring_dedup": OP10_SQL, "op11_hard_negatives": OP11_SQL,
    "op13_ranked_search": OP13_SQL
}
