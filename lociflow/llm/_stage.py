"""Tables written between the jobs of one operator."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset (local tests) a temporary
    folder is made and set for the session.
    """
    path = spark.conf.get(CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CONF} to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="lociflow-")
        spark.conf.set(CONF, path)
        delete_on_exit(spark, path)
    return path.rstrip("/")


def delete_on_exit(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    delete_on_exit(spark, path)
    return path


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: the lineage ends there, and a lost
    executor costs a re-read rather than a recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Removes the files behind a staged table that nothing will read again."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for d in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:  # none if it has no rows
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(d)
        p.getFileSystem(conf).delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets the shuffle files of finished jobs go. Spark deletes them once the driver's garbage is collected, which on
    its own may be half an hour later; till then every stage of an operator holds its disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Input of a bucket that a Python process works on as a whole, as the optimiser sees its size.
BUCKET_BYTES = 256 << 20


def buckets(df: DataFrame) -> int:
    """Into how many buckets an operator deals what it derives from df: they grow with the input, and each is read by
    itself, so what a process holds does not grow."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size if size < 1 << 60 else 0  # else no size is known
    return max(4 * shuffle_partitions(df.sparkSession), known // BUCKET_BYTES)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once for each context: they need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_lociflow_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    name = Path(tempfile.mkdtemp(prefix="lociflow-zip-")) / "lociflow.zip"
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(name))
    sc._lociflow_shipped = True
