"""Folders for files between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CONF = "spark.checkpoint.dir"


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names for files which all executors share, deleted with the session;
    only where none is named and Spark runs on this machine, in a temporary one."""
    base = spark.conf.get(CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CONF} to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lociflow-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path
