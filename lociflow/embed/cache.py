"""Embedding a column of sequences once for each distinct sequence, across runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.embed.registry import load

BATCH = 64
SCHEMA = "seq string, embedding array<float>"


def infer(seqs: DataFrame, embedder: str, **options) -> DataFrame:
    """(seq, embedding) of distinct sequences; each worker loads the model once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load(embedder, **options)
        for b in batches:
            for i in range(0, len(b), BATCH):
                part = b["seq"].iloc[i : i + BATCH].tolist()
                yield pd.DataFrame({"seq": part, "embedding": list(encode(part))})

    return seqs.select("seq").mapInPandas(run, SCHEMA)


def embedder_id(embedder: str, **options) -> str:
    return "/".join([embedder.lower(), *(f"{k}={options[k]}" for k in sorted(options) if k != "device")])


class CachedEmbedder:
    """Callable (seq) -> (seq, embedding). With a path, results are kept in a Parquet table by embedder and
    SHA-1 of the sequence, and only sequences that it lacks are inferred."""

    def __init__(self, embedder: str = "kmer", path: str | None = None, **options) -> None:
        self.embedder, self.path, self.options = embedder, path and path.rstrip("/"), options
        self.key = embedder_id(embedder, **options)

    def __call__(self, seqs: DataFrame) -> DataFrame:
        spark = seqs.sparkSession
        wanted = seqs.select("seq").where("seq IS NOT NULL").distinct()
        if not self.path:
            return infer(wanted, self.embedder, **self.options)
        wanted = wanted.withColumn("seq_sha1", F.sha1("seq"))
        known = self.known(spark)
        missing = wanted.join(known, "seq_sha1", "left_anti")
        new = infer(missing, self.embedder, **self.options)
        rows = new.select(F.lit(self.key).alias("embedder_id"), F.sha1("seq").alias("seq_sha1"), "embedding")
        rows.write.mode("append").partitionBy("embedder_id").parquet(self.path)
        return wanted.join(self.known(spark), "seq_sha1").select("seq", "embedding")

    def known(self, spark) -> DataFrame:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return spark.createDataFrame([], "seq_sha1 string, embedding array<float>")
        table = spark.read.schema("embedder_id string, seq_sha1 string, embedding array<float>").parquet(self.path)
        return table.where(F.col("embedder_id") == self.key).select("seq_sha1", "embedding").dropDuplicates(["seq_sha1"])
