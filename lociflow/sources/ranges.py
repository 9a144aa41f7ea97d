"""Byte ranges of files. The driver lists the files and cuts them; the tasks of a Python data source open them and read
their own ranges."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import InputPartition

#: Bytes of a range, and those that are read at once.
RANGE_BYTES, CHUNK = 32 << 20, 1 << 20


@dataclass(frozen=True)
class Range(InputPartition):
    """Bytes from start to end (excluded) of a file of ``size`` bytes; ``no`` counts the ranges in order."""

    no: int
    path: str
    start: int
    end: int
    size: int


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and size of a file, or of the files of a folder in order of their names, without hidden ones."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(s.getPath(), s.getLen()) for s in fs.listStatus(p) if s.isFile()]
    shown = [(q.toString(), n) for q, n in found if len(found) == 1 or q.getName()[0] not in "._"]
    return sorted((q, n) for q, n in shown if n)


def cut(found: list[tuple[str, int]], size: int = RANGE_BYTES, whole: bool = False) -> list[Range]:
    """The files in ranges of ``size`` bytes, or each as one."""
    parts = [
        (path, at, n if whole else min(n, at + size), n) for path, n in found for at in range(0, 1 if whole else n, size)
    ]
    return [Range(i, *p) for i, p in enumerate(parts)]


def packed(ranges: list[Range]) -> str:
    """Ranges as the text of an option."""
    return json.dumps([(r.no, r.path, r.start, r.end, r.size) for r in ranges])


def unpacked(text: str) -> list[Range]:
    return [Range(*r) for r in json.loads(text)]


class Group(InputPartition):
    """Ranges that one task reads."""

    def __init__(self, members: list[Range]) -> None:
        self.members = members


def grouped(parts: list[Range], size: int) -> list[Group]:
    """Ranges in their order, together as long as they take no more than ``size`` bytes."""
    held: list[list[Range]] = []
    taken = 0
    for r in parts:
        if not held or taken + r.end - r.start > size:
            held.append([])
            taken = 0
        held[-1].append(r)
        taken += r.end - r.start
    return [Group(x) for x in held] or [Group([])]


def _system(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return FileSystem.from_uri(path)


def opened(path: str):
    """A file at any place that Arrow knows, for reading at random."""
    system, inner = _system(path)
    return system.open_input_file(inner)


def created(path: str):
    """A new file there, for writing."""
    system, inner = _system(path)
    return system.open_output_stream(inner)


def chunks(file, start: int, end: int) -> Iterator[bytes]:
    file.seek(start)
    while start < end:
        data = file.read(min(CHUNK, end - start))
        if not data:
            return
        start += len(data)
        yield data
