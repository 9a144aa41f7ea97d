"""Small files and signatures of inputs, through Hadoop's file systems."""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession

from lociflow.sources import ranges


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path with its scheme."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return bool(fs.exists(p))


def signature(spark: SparkSession, path: str) -> dict | None:
    """Path, size, newest modification time and a digest over the names, sizes and times of the file, or of all files of a
    folder and its folders but hidden ones; sizes are None where nothing is."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return {"path": path, "size": None, "mtime": None, "digest": None}
    top, found, walk = p.toString(), [], fs.listFiles(p, True)
    while walk.hasNext():
        s = walk.next()
        name = s.getPath().toString().removeprefix(top).lstrip("/")
        if not any(part[0] in "._" for part in name.split("/") if part):
            found.append((name, s.getLen(), s.getModificationTime()))
    text = "\n".join(f"{n}\t{size}\t{time}" for n, size, time in sorted(found))
    return {
        "path": path, "size": sum(f[1] for f in found), "mtime": max([f[2] for f in found], default=0),
        "digest": hashlib.sha1(text.encode()).hexdigest()
    }


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if there is none."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Puts a small file in its place as a whole: it is written beside it and renamed over it, so a reader and a run that
    dies see the old text or the new one."""
    jvm = spark.sparkContext._jvm
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    beside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(beside, p, options)


def delete_others(spark: SparkSession, folder: str, keep: str) -> None:
    """Removes all that stands in a folder but one name."""
    fs, p = _at(spark, folder)
    for s in fs.listStatus(p):
        if s.getPath().getName() != keep:
            fs.delete(s.getPath(), True)


def join(spark: SparkSession, folders: list[str], path: str, name: str) -> str:
    """A folder with one file, put together by a task from the parts in some folders, in the order of the folders and of
    the parts' names. The bytes are passed on as they are read; the folders go."""
    parts = [p for f in folders for p, _ in ranges.files(spark, _at(spark, f)[1].toString())]
    fs, p = _at(spark, path)
    fs.delete(p, True)
    fs.mkdirs(p)
    beside = f"{p.toString()}/.{name}"

    def write(batches):
        import uuid

        own = f"{beside}.{uuid.uuid4().hex}"
        with ranges.created(own) as out:
            for b in batches:
                for part in b.column(0).to_pylist():
                    with ranges.opened(part) as file:
                        for data in ranges.chunks(file, 0, file.size()):
                            out.write(data)
        yield pa.RecordBatch.from_arrays([pa.array([own])], ["path"])

    listed = spark.createDataFrame([(i, x) for i, x in enumerate(parts)], "no int, path string")
    made = listed.coalesce(1).sortWithinPartitions("no").select("path").mapInArrow(write, "path string").collect()[0].path
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if not fs.rename(of(made), of(p, name)):
        raise OSError(f"{made} could not be renamed")
    fs.create(of(p, "_SUCCESS"), True).close()
    for f in folders:
        at, folder = _at(spark, f)
        at.delete(folder, True)
    return path
