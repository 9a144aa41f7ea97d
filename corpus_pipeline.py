"""From documents to token ids in five stages, each over all that the one before has kept.

1. Documents that the quality rules reject go.
2. Of each group of near duplicates one document stays.
3. Secrets are replaced by the name of their kind.
4. Sources are repeated or thinned out to their target weights.
5. The mix is encoded.

Null texts and texts without words go in the first stage; rows without an id go through all; extra columns, whatever
their names, go through unchanged up to the last stage, which returns doc_id, source, n_pieces and ids alone, a row for
each time the mix takes a document; very long texts are read whole; an empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.llm import jaccard, mixing, quality, secret_scan, spm
from lociflow.llm._stage import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, each row judged by itself: null and empty texts go, repeated rows
    share their verdict."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id, then the least hash of its text; without an id
    only if the whole group has none. Repeated rows count once; a document with no other like it stays."""
    return jaccard.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by [kind]; of overlapping ones the first names the place. Null texts stay
    null; n_chars is counted again."""
    out = secret_scan.redact(docs)
    return out.withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
    ) if "n_chars" in docs.columns else out


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it: some of them not at all. A null source is a source of
    its own; texts without words are never taken; repeated rows are taken equally often."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces and ids of every row; null and empty texts have no pieces."""
    return spm.encode(docs, keep=("source",))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good),
    ("near duplicates", distinct),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: SQL cannot express the encoding; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{i + 1}")
    return docs
