"""Lines of block-gzip files, read in parallel.

Such a file is a chain of small gzip members that each tell their size. A task takes the blocks that begin in its range of
bytes: it looks for the first header whose chain goes on, drops what belongs to a line begun before, and reads on beyond
its range to the end of its last line. So every line is read once, wherever ranges and blocks cut it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from lociflow.sources import ranges
from lociflow.sources.ranges import Range

#: How a member with an extra field begins; the largest block.
MAGIC, MOST = b"\x1f\x8b\x08\x04", 1 << 16
#: A line's number is that of its range and its place there.
PLACE_BITS = 40
BATCH_BYTES = 4 << 20


def block_size(head: bytes) -> tuple[int, int] | None:
    """Bytes of the header and of the whole block that begins with head, None if none does."""
    if len(head) < 18 or head[:4] != MAGIC:
        return None
    end = 12 + int.from_bytes(head[10:12], "little")
    at = 12
    while at + 4 <= min(end, len(head)):
        size = int.from_bytes(head[at + 2 : at + 4], "little")
        if head[at : at + 2] == b"BC" and size == 2:
            return end, int.from_bytes(head[at + 4 : at + 6], "little") + 1
        at += 4 + size
    return None


def _head(file, at: int) -> bytes:
    file.seek(at)
    return file.read(256)


def first_block(file, start: int, size: int, end: int | None = None) -> int:
    """Where the first block at or after start begins; size if there is none, or none that begins before end."""
    if not start:
        return 0
    file.seek(start)
    data = file.read(2 * MOST if end is None else min(2 * MOST, end - start + len(MAGIC) - 1))
    at = data.find(MAGIC)
    while at >= 0:
        found = block_size(_head(file, start + at))
        if found:
            after = start + at + found[1]
            if after == size or after < size and block_size(_head(file, after)):
                return start + at
        at = data.find(MAGIC, at + 1)
    return size


def blocks(file, at: int, end: int, path: str) -> Iterator[tuple[int, bytes]]:
    """Where each block that begins before end ends, and what it holds."""
    while at < end:
        found = block_size(_head(file, at))
        if not found:
            raise ValueError(f"{path}: no block at byte {at}")
        file.seek(at + found[0])
        body = file.read(found[1] - found[0])
        data = zlib.decompress(body[:-8], -15)
        if zlib.crc32(data) != int.from_bytes(body[-8:-4], "little"):
            raise ValueError(f"{path}: the block at byte {at} is damaged")
        at += found[1]
        yield at, data


def lines(file, r: Range) -> Iterator[bytes]:
    """The lines of a range. All ranges but a file's first leave what comes before their first line's end to the one
    before, which reads on to it."""
    drop, rest, at = r.start > 0, b"", -1
    for at, data in blocks(file, first_block(file, r.start, r.size, r.end), r.end, r.path):
        rest += data
        if drop:
            end = rest.find(b"\n")
            if end < 0:
                rest = b""
                continue
            rest, drop = rest[end + 1 :], False
        *whole, rest = rest.split(b"\n")
        yield from whole
    if at < 0 or drop:
        return
    parts = [rest]
    for _, data in blocks(file, at, r.size, r.path):
        end = data.find(b"\n")
        parts.append(data if end < 0 else data[:end])
        if end >= 0:
            yield b"".join(parts)
            return
    if last := b"".join(parts):
        yield last


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.ranges = ranges.unpacked(options["ranges"])
        self.size = int(options["taskbytes"])

    def partitions(self) -> list[ranges.Group]:
        return ranges.grouped(self.ranges, self.size)

    def __getstate__(self) -> dict:
        """A task is sent its own ranges alone."""
        return self.__dict__ | {"ranges": []}

    def read(self, group: ranges.Group) -> Iterator[pa.RecordBatch]:
        order, text, size = [], [], 0
        for path, members in groupby(group.members, lambda r: r.path):
            with ranges.opened(path) as file:
                for r in members:
                    for i, line in enumerate(lines(file, r)):
                        order.append(r.no << PLACE_BITS | i)
                        text.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                        size += len(line)
                        if size > BATCH_BYTES:
                            yield _batch(order, text)
                            order, text, size = [], [], 0
        if order:
            yield _batch(order, text)


def _batch(order: list[int], text: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(text, pa.string())], ["ord", "value"])


class BlockLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "block_lines"

    def schema(self) -> str:
        return "ord long, value string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def is_blocked(spark: SparkSession, path: str) -> bool:
    """Whether the file, or every file of the folder, begins with such a block."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = ranges.files(spark, path)
    for name, size in found:
        p = jvm.org.apache.hadoop.fs.Path(name)
        stream = p.getFileSystem(conf).open(p)
        try:
            head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, min(size, 256)))
        finally:
            stream.close()
        if not block_size(head):
            return False
    return bool(found)


def read(spark: SparkSession, parts: list[Range]) -> DataFrame:
    """ord and value of the lines of some ranges. Small ranges are read together, as many tasks as Spark runs a few times
    over; no task is given more than ``ranges.RANGE_BYTES`` of them."""
    spark.dataSource.register(BlockLines)
    size = sum(r.end - r.start for r in parts)
    task_bytes = min(ranges.RANGE_BYTES, size // (4 * spark.sparkContext.defaultParallelism))
    source = spark.read.format("block_lines").option("ranges", ranges.packed(parts))
    return source.option("taskbytes", str(task_bytes)).load()


def block(data: bytes) -> bytes:
    """A block of at most 65280 bytes of data; without data, the one that ends a file."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    head = MAGIC + b"\0\0\0\0\0\xff\x06\0BC\x02\0" + (len(body) + 25).to_bytes(2, "little")
    return head + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")


def save(rows: DataFrame, path: str, size: int = 65_280) -> str:
    """Writes the lines (value) in their order as one file, as the format asks: its task writes a file under a name of its
    own, and the one of the task that ended goes to its place."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from uuid import uuid4

        own = f"{path}.{uuid4().hex}"
        with ranges.created(own) as out:
            held = b""
            for b in batches:
                held += b"".join(v.encode() + b"\n" for v in b.column(0).to_pylist())
                cut = len(held) - len(held) % size
                for i in range(0, cut, size):
                    out.write(block(held[i : i + size]))
                held = held[cut:]
            out.write((block(held) if held else b"") + block(b""))
        yield pa.RecordBatch.from_arrays([pa.array([own])], ["path"])

    spark = rows.sparkSession
    made = rows.select("value").coalesce(1).mapInArrow(write, "path string").collect()[0].path
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(p(path), False)
    if not fs.rename(p(made), p(path)):
        raise OSError(f"{made} could not be renamed")
    return path
