"""Reference sequences.

Records are read in two passes over byte ranges of the files. The first counts the bases of each range and the records
that begin in it; what a range owes to the one before (an open record, a header that is cut in two) follows from one row
for each range. The second knows the place of every base and gives the pieces of each record from the ranges that they
touch. A chromosome is never a row, and a single line may hold all of it. Compressed files are read as one range each.
"""

from __future__ import annotations

import gzip
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from lociflow.functions.names import standard_chrom
from lociflow.sources import ranges
from lociflow.sources.ranges import Range

STEP, OVERLAP = 100_000, 2_000
_BLANK = b" \t\r\n\v\f"
COUNTS = "no int, k int, name string, bases long, lead long, line boolean, header boolean"
PARTS = "no int, k int, piece long, at long, bases string"


def events(data: Iterator[bytes], line_start: bool, header: bool) -> Iterator[tuple[str, bytes]]:
    """("bases", stretch) and ("record", header line) of a stream that begins within a header line, within another line
    or at the start of one. The rest of a header that began before is passed over."""
    line = bytearray()
    skip = header
    for chunk in data:
        at = 0
        while at < len(chunk):
            if header:
                end = chunk.find(b"\n", at)
                line += chunk[at : end if end >= 0 else len(chunk)]
                at = end + 1 if end >= 0 else len(chunk)
                if end >= 0:
                    if not skip:
                        yield "record", bytes(line)
                    header, skip, line_start = False, False, True
                    line.clear()
            elif line_start and chunk[at] == 62:
                header = True
                at += 1
            else:
                # A header begins with its sign right after a line's end, which may be in the chunk before.
                end = chunk.find(b"\n>", at)
                end = len(chunk) if end < 0 else end + 1
                yield "bases", chunk[at:end].translate(None, _BLANK)
                line_start = chunk[end - 1] == 10
                at = end
    if header and not skip:
        yield "record", bytes(line)


def _stream(file, r: Range) -> Iterator[bytes]:
    """The bytes of a range, and what a header that begins in it needs from the next."""
    if r.path.endswith((".gz", ".bgz")):
        with gzip.GzipFile(fileobj=file) as plain:
            while data := plain.read(ranges.CHUNK):
                yield data
        return
    yield from ranges.chunks(file, r.start, r.end)
    if _open_header(file, r):
        for data in ranges.chunks(file, r.end, r.size):
            end = data.find(b"\n")
            yield data[: end + 1] if end >= 0 else data
            if end >= 0:
                return


def _line_start(file, place: int) -> bool:
    if not place:
        return True
    file.seek(place - 1)
    return file.read(1) == b"\n"


def _open_header(file, r: Range) -> bool:
    """Whether a header that begins in the range ends beyond it."""
    place = r.end
    while place > r.start:
        begin = max(r.start, place - ranges.CHUNK)
        file.seek(begin)
        end = file.read(place - begin).rfind(b"\n")
        if end >= 0:
            return begin + end + 1 < r.end and _at(file, begin + end + 1) == b">"
        place = begin
    return _line_start(file, r.start) and _at(file, r.start) == b">"


def _at(file, place: int) -> bytes:
    file.seek(place)
    return file.read(1)


def _count(file, r: Range) -> Iterator[pa.RecordBatch]:
    """Of a range a row with k = -1: the bases before its first record (taken to be no header's), those of its first,
    cut line, whether it has a line's end, and whether a header is open at its end; and of each record that begins in it
    a row with its header's first word and its bases within the range."""
    compressed = r.path.endswith((".gz", ".bgz"))
    start = compressed or _line_start(file, r.start)
    lead, line = 0, start
    if not start:
        for data in ranges.chunks(file, r.start, r.end):
            end = data.find(b"\n")
            lead += len((data if end < 0 else data[:end]).translate(None, _BLANK))
            if end >= 0:
                line = True
                break
    names, bases = [None], [0]
    for what, data in events(_stream(file, r), start, False):
        if what == "record":
            words = data.split(None, 1)
            names.append(words[0].decode("utf-8", "replace") if words and not data[:1].isspace() else "")
            bases.append(0)
        else:
            bases[-1] += len(data)
    n = len(names)
    header = not compressed and _open_header(file, r)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r.no] * n, pa.int32()), pa.array(range(-1, n - 1), pa.int32()), pa.array(names, pa.string()),
            pa.array(bases, pa.int64()), pa.array([lead] * n, pa.int64()), pa.array([line] * n, pa.bool_()),
            pa.array([header] * n, pa.bool_())
        ],
        ["no", "k", "name", "bases", "lead", "line", "header"]
    )


def _cut(file, r: Range, state: tuple, step: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """The parts of pieces that the range holds. state: whether it begins within a header, and the open record (range and
    number) with its bases so far."""
    header, no, k, at = state
    start = r.path.endswith((".gz", ".bgz")) or _line_start(file, r.start)
    own = -1
    held: list[bytes] = []
    size = 0

    def parts() -> pa.RecordBatch:
        data = b"".join(held)
        rows = []
        for piece in range(max(0, (at - overlap) // step), (at + len(data) + overlap - 1) // step + 1):
            low, high = max(at, piece * step - overlap), min(at + len(data), (piece + 1) * step + overlap)
            if low < high:
                rows.append((no, k, piece, low, data[low - at : high - at].decode("latin-1")))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(c, t) for c, t in zip(
                    zip(*rows, strict=True) if rows else [()] * 5,
                    (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True
                )
            ],
            ["no", "k", "piece", "at", "bases"]
        )

    for what, data in events(_stream(file, r), start, header):
        if what == "record":
            if size and k >= 0:
                yield parts()
            own += 1
            no, k, at, held, size = r.no, own, 0, [], 0
        elif data:
            held.append(data)
            size += len(data)
            if size >= max(step, ranges.CHUNK):
                if k >= 0:
                    yield parts()
                at, held, size = at + size, [], 0
    if size and k >= 0:
        yield parts()


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.ranges = ranges.unpacked(options["ranges"])
        self.states = json.loads(options["states"]) if "states" in options else None
        self.task_bytes = options["taskbytes"]
        self.step, self.overlap = int(options.get("step", STEP)), int(options.get("overlap", OVERLAP))

    def partitions(self) -> list[ranges.Group]:
        return ranges.grouped(self.ranges, int(self.task_bytes))

    def read(self, group: ranges.Group) -> Iterator[pa.RecordBatch]:
        for r in group.members:
            with ranges.opened(r.path) as file:
                if self.states is None:
                    yield from _count(file, r)
                else:
                    yield from _cut(file, r, self.states[r.no], self.step, self.overlap)


class FastaRanges(DataSource):
    """Without states the counts of ranges, with them the parts of pieces."""

    @classmethod
    def name(cls) -> str:
        return "fasta_ranges"

    def schema(self) -> str:
        return PARTS if "states" in self.options else COUNTS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def _resolved(parts: list[Range], rows: list) -> tuple[list[tuple], dict[int, int]]:
    """The state at the start of each range, and the bases that the last record of a range has in the ranges after it,
    from one row for each range (bases, lead, line, header, records, bases of its last)."""
    by_no = {r.no: r for r in rows}
    states, more = [], {}
    header, no, k, at, path = False, -1, -1, 0, None
    for p in parts:
        if p.path != path:
            header, no, k, at, path = False, -1, -1, 0, p.path
        states.append((header, no, k, at))
        r = by_no[p.no]
        first = r.bases - (r.lead if header else 0)
        if no >= 0:
            more[no] = more.get(no, 0) + first
        at += first
        if r.records:
            no, k, at = p.no, r.records - 1, r.last
        header = r.header if r.line or r.records else header or r.header
    return states, more


def read_pieces(
    spark: SparkSession, path: str, step: int = STEP, overlap: int = OVERLAP, range_bytes: int = ranges.RANGE_BYTES
) -> DataFrame:
    """chrom, piece, seq, seq_start, seq_len: stretches of ``step`` bases that reach ``overlap`` further on both sides,
    of the first record of each standard chromosome name. ``path`` is a file or a folder of files."""
    spark.dataSource.register(FastaRanges)
    found = ranges.files(spark, path)
    plain = ranges.cut([f for f in found if not f[0].endswith((".gz", ".bgz"))], range_bytes)
    packed = ranges.cut([f for f in found if f[0].endswith((".gz", ".bgz"))], whole=True)
    parts = [Range(i, r.path, r.start, r.end, r.size) for i, r in enumerate(sorted([*plain, *packed], key=lambda r: (r.path, r.start)))]
    if not parts:
        return spark.createDataFrame(
            [], "chrom string, piece long, seq string, seq_start long, seq_len long"
        ).withMetadata("piece", {"step": step, "overlap": overlap})
    # Small ranges are read together, as many tasks as Spark runs a few times over.
    size = sum(r.end - r.start for r in parts)
    task_bytes = min(ranges.RANGE_BYTES, max(range_bytes, size // (4 * spark.sparkContext.defaultParallelism)))
    source = spark.read.format("fasta_ranges").option("ranges", ranges.packed(parts)).option("taskbytes", str(task_bytes))
    counts = source.load()
    # One row for each range goes to the driver; the records stay.
    last = F.max_by("bases", "k")
    rows = counts.groupBy("no").agg(
        F.sum(F.when(F.col("k") < 0, F.col("bases"))).alias("bases"), F.first("lead").alias("lead"),
        F.first("line").alias("line"), F.first("header").alias("header"),
        (F.count("*") - 1).cast("int").alias("records"), last.alias("last")
    ).collect()
    states, more = _resolved(parts, rows)
    later = spark.createDataFrame(
        [(r.no, r.records - 1, more.get(r.no, 0)) for r in rows if r.records], "no int, k int, more long"
    )
    records = counts.where("k >= 0").join(F.broadcast(later), ["no", "k"], "left").withColumn(
        "chrom", standard_chrom(F.col("name"))
    ).where(F.col("chrom").isNotNull())
    size = (F.col("bases") + F.coalesce("more", F.lit(0))).alias("seq_len")
    records = records.groupBy("chrom").agg(F.min(F.struct("no", "k", size)).alias("r")).select("chrom", "r.*")
    parts_of = source.option("states", json.dumps(states)).option("step", str(step)).option("overlap", str(overlap)).load()
    made = parts_of.groupBy("no", "k", "piece").agg(F.sort_array(F.collect_list(F.struct("at", "bases"))).alias("parts"))
    # Joined before they meet the records: a reader's own expressions on a piece then never join it again.
    made = made.select("no", "k", "piece", F.array_join(F.transform("parts", lambda x: x["bases"]), "").alias("seq"))
    # Every piece of a wanted record by its own key: a chromosome's pieces are dealt to all tasks. A record without bases
    # has one empty piece.
    last_piece = F.floor((F.greatest("seq_len", F.lit(1)) - 1) / step)
    wanted = records.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last_piece)))
    start = F.greatest(F.lit(1), F.col("piece") * step + 1 - overlap)
    out = wanted.join(made, ["no", "k", "piece"], "left").select(
        "chrom", "piece", F.coalesce("seq", F.lit("")).alias("seq"), start.cast("long").alias("seq_start"), "seq_len"
    )
    return out.withMetadata("piece", {"step": step, "overlap": overlap})


def pieces(whole: DataFrame, step: int = STEP, overlap: int = OVERLAP) -> DataFrame:
    """The same columns from sequences that are rows already (chrom, seq)."""
    rows = whole.withColumn("seq_len", F.length("seq").cast("long")).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.floor((F.greatest("seq_len", F.lit(1)) - 1) / step)))
    )
    start = F.greatest(F.lit(1), F.col("piece") * step + 1 - overlap)
    end = F.least(F.col("seq_len"), (F.col("piece") + 1) * step + overlap)
    out = rows.select(
        "chrom", F.col("piece").cast("long").alias("piece"),
        F.substring("seq", start.cast("int"), (end - start + 1).cast("int")).alias("seq"),
        start.cast("long").alias("seq_start"), "seq_len"
    )
    return out.withMetadata("piece", {"step": step, "overlap": overlap})
