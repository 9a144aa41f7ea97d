"""A table of immutable shards with size-tiered compaction.

Arrivals are appended as small Parquet shards, each arrival in a version of its own. Compaction sorts the live shards
into tiers by size and merges runs of a tier, at least ``fan_in`` similar shards or as many as fill a file of the target
size, into one shard; on request it also merges what is left over. All runs of a round are tasks of one job, without a
shuffle. Every change writes its files first and then commits a manifest with the next version number: the manifest is
written beside its place and renamed into it, and the rename fails if another writer was first; an append is then
committed upon the other's version, and a merge too unless the other has removed what it merged. A reader takes the
newest manifest and sees all of a change or nothing of it.

A writer registers its folder before it writes and signs off after its commit. ``vacuum`` removes files that no manifest
of the kept versions names, but for those in a registered folder, until that is older than any writer may take.

All paths go through Hadoop's file systems, so the table may lie in any store that Spark reads and writes.

The manifest also holds the table's schema. An arrival may bring new columns, which widen it: rows that came before
read null there, in merges too. Columns that an arrival lacks are null in its rows. Names are told apart as Spark does
it, without regard to case, and keep their first spelling. A column of another type than the table's is refused before
anything is written. The first arrival settles the schema, an empty one too.

Edge cases: an empty arrival commits a version without shards; columns may be null or have any names; texts of any
length are moved as they are; of shards of one size the one with the least path is merged first; repeated rows are kept;
a job that dies leaves files that no manifest names, and may be run again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociflow.llm._stage import new_path
from lociflow.llm._text import require

TARGET_BYTES = 128 << 20
FAN_IN = 4
#: Sizes within this factor belong to one tier.
TIER = 4
#: Runs that are merged in one job, each by a task of its own; further runs are merged by further jobs.
MOST_RUNS = 256
#: Age from which the folder of a writer that has not signed off counts as left by a dead one.
EXPIRES_S = 7 * 24 * 3600
ZIPPED_UNIONS = "spark.sql.unionOutputPartitioning"
#: Shards up to which their list is sent to every task.
MOST_BROADCAST = 20_000


@dataclass(frozen=True)
class Shard:
    path: str
    size: int
    rows: int
    level: int


class Conflict(RuntimeError):
    """Another writer has committed this version."""


def widened(schema: T.StructType | None, arrival: T.StructType) -> T.StructType:
    """The table's schema with the arrival's new columns at its end, all of them nullable."""
    fields = list(schema.fields) if schema else []
    have = {f.name.lower(): f for f in fields}
    for f in arrival:
        old = have.get(f.name.lower())
        if old is None:
            have[f.name.lower()] = f
            fields.append(T.StructField(f.name, f.dataType, True))
        elif old.dataType != f.dataType:
            raise TypeError(f"column {f.name}: {f.dataType.simpleString()}, the table has {old.dataType.simpleString()}")
    return T.StructType(fields)


class ShardTable:
    def __init__(self, spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN) -> None:
        self.spark, self.path, self.target, self.fan_in = spark, path.rstrip("/"), target_bytes, fan_in
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)
        for folder in ("manifests", "writers", "data"):
            self._fs.mkdirs(self._path(f"{self.path}/{folder}"))

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def _list(self, folder: str) -> list[tuple[str, int]]:
        p = self._path(folder)
        return sorted(
            (s.getPath().toString(), s.getLen()) for s in self._fs.listStatus(p)
        ) if self._fs.exists(p) else []

    def version(self) -> int:
        """Newest committed version; 0 for a new table."""
        return max(
            [int(p.rsplit("/v", 1)[1][:12]) for p, _ in self._list(f"{self.path}/manifests") if p.endswith(".json")],
            default=0
        )

    def shards(self, version: int | None = None) -> list[Shard]:
        return self._manifest(version)[0]

    def schema(self, version: int | None = None) -> T.StructType | None:
        """None before the first arrival."""
        return self._manifest(version)[1]

    def _manifest(self, version: int | None = None) -> tuple[list[Shard], T.StructType | None]:
        version = self.version() if version is None else version
        if not version:
            return [], None
        stream = self._fs.open(self._path(f"{self.path}/manifests/v{version:012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        held = json.loads(text)
        return [Shard(**s) for s in held["shards"]], T.StructType.fromJson(held["schema"])

    def _commit(self, base: int, shards: list[Shard], schema: T.StructType, what: str) -> int:
        version = base + 1
        final = self._path(f"{self.path}/manifests/v{version:012d}.json")
        beside = self._path(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(beside, False)
        manifest = {
            "version": version, "what": what, "schema": schema.jsonValue(), "shards": [asdict(s) for s in shards]
        }
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        try:
            context.rename(beside, final, options)
        except Exception as e:
            self._fs.delete(beside, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {version} exists") from e
            raise
        return version

    def _begin(self) -> str:
        """A new folder of data, registered."""
        name = uuid.uuid4().hex
        self._fs.create(self._path(f"{self.path}/writers/{name}"), False).close()
        return f"{self.path}/data/{name}"

    def _end(self, folder: str) -> None:
        self._fs.delete(self._path(f"{self.path}/writers/{folder.rsplit('/', 1)[1]}"), False)

    def _update(
        self, what: str, edit: Callable[[list[Shard]], list[Shard]], arrival: T.StructType | None = None,
        tries: int = 100
    ) -> int:
        """Commits edit(live shards), and a schema with the arrival's columns, upon the newest version, again where
        another writer was first."""
        for _ in range(tries):
            base = self.version()
            live, schema = self._manifest(base)
            try:
                return self._commit(base, edit(live), widened(schema, arrival or T.StructType()), what)
            except Conflict:
                continue
        raise Conflict(f"{tries} other writers were first")

    def append(self, rows: DataFrame, arrival: str | None = None) -> int:
        """Adds rows as new shards, one for each task, and commits them. ``arrival`` names the column that tells several
        arrivals apart and is not stored: they are written by one job, and each is committed as a version of its own,
        in order."""
        schema = T.StructType([f for f in rows.schema if f.name != arrival])
        widened(self.schema(), schema)  # refuses another type before anything is written
        folder = self._begin()
        writer = rows.write.option("compression", "zstd")
        (writer.partitionBy(arrival) if arrival else writer).parquet(folder)
        inner = [d for d, _ in self._list(folder) if "=" in d.rsplit("/", 1)[1]] if arrival else [folder]
        added = self._written(folder, inner, schema)
        version = self.version()
        for name in sorted(inner, key=lambda d: (len(d), d)) or [folder]:
            version = self._update(
                "append", lambda live, new=added.get(name, []): live + [s for s in new if s.rows], schema
            )
        self._end(folder)
        return version

    def _written(self, folder: str, inner: list[str], schema: T.StructType, level: int = 0) -> dict[str, list[Shard]]:
        """The files in each inner folder, as shards in order of their names; one job counts the rows by the footers."""
        files = {d: [f for f in self._list(d) if f[0].endswith(".parquet")] for d in inner}
        if not any(files.values()):
            return {}
        place = F.substring_index("_metadata.file_path", "/data/", -1)
        rows = self.spark.read.schema(schema).parquet(*[p for fs in files.values() for p, _ in fs])
        counts = {r["place"]: r["count"] for r in rows.groupBy(place.alias("place")).count().collect()}
        return {
            d: [Shard(p, n, counts.get(p.rpartition("/data/")[2], 0), level) for p, n in fs] for d, fs in files.items()
        }

    def _packed(self, shards: list[Shard]) -> list[list[Shard]]:
        """Runs in order of size, as many shards each as fill a file; the last may be short."""
        runs: list[list[Shard]] = [[]]
        for s in sorted(shards, key=lambda s: (s.size, s.path)):
            if runs[-1] and sum(r.size for r in runs[-1]) + s.size > self.target:
                runs.append([])
            runs[-1].append(s)
        return runs

    def plan(self, shards: list[Shard], everything: bool = False) -> list[list[Shard]]:
        """Runs of similarly sized shards to merge; with ``everything``, where no tier has a run, of all small ones."""
        small = [s for s in shards if s.size < self.target * 3 // 4]
        tiers: dict[int, list[Shard]] = {}
        for s in small:
            tier, size = 0, max(1, s.size)
            while size >= TIER:
                size //= TIER
                tier += 1
            tiers.setdefault(tier, []).append(s)
        runs = []
        for tier in sorted(tiers):
            *full, last = self._packed(tiers[tier])
            runs += full + [last] * (len(last) >= self.fan_in)
        runs = [r for r in runs if len(r) > 1]
        return runs or [r for r in self._packed(small) if len(r) > 1] * everything

    def compact(self, everything: bool = False) -> int:
        """Merges until no run is left; commits one version for each round, whose runs are tasks of one job: each reads
        its shards and writes one file. Each round leaves fewer shards, so the rounds come to an end."""
        while True:
            live, schema = self._manifest()
            runs = self.plan(live, everything)[:MOST_RUNS]
            if not runs:
                return self.version()
            folder = self._begin()
            self._merge(runs, folder, schema)
            merged = self._written(folder, [folder], schema)[folder]
            if [m.rows for m in merged] != [sum(s.rows for s in r) for r in runs]:
                raise RuntimeError("a merge lost rows")
            merged = [
                Shard(m.path, m.size, m.rows, 1 + max(s.level for s in r)) for m, r in zip(merged, runs, strict=True)
            ]
            gone = {s.path for r in runs for s in r}

            def edit(now: list[Shard]) -> list[Shard]:
                if not gone <= {s.path for s in now}:  # noqa: B023
                    return now  # another merge was first: its result stands, this one's files are left to vacuum
                return [s for s in now if s.path not in gone] + merged  # noqa: B023

            self._update("compact", edit)
            self._end(folder)

    def _merge(self, runs: list[list[Shard]], folder: str, schema: T.StructType) -> None:
        reads = [self.spark.read.schema(schema).parquet(*[s.path for s in r]).coalesce(1) for r in runs]
        while len(reads) > 1:
            reads = [reads[i].unionAll(reads[i + 1]) if i + 1 < len(reads) else reads[i] for i in range(0, len(reads), 2)]
        # Else Spark would zip the single partitions of all reads into one.
        before = self.spark.conf.get(ZIPPED_UNIONS)
        self.spark.conf.set(ZIPPED_UNIONS, "false")
        try:
            reads[0].write.option("compression", "zstd").parquet(folder)
        finally:
            self.spark.conf.set(ZIPPED_UNIONS, before)

    def vacuum(self, keep_versions: int = 1, expires_s: float = EXPIRES_S) -> int:
        """Removes data that none of the newest versions names, and their manifests; returns how many files. What a
        writer has registered stays, unless it began longer ago than ``expires_s``."""
        # In this order: a folder seen here belongs to a writer that is registered below, or has committed before the
        # manifests are read.
        folders = [d for d, _ in self._list(f"{self.path}/data")]
        now = time.time()
        busy = set()
        for s in self._fs.listStatus(self._path(f"{self.path}/writers")):
            if now - s.getModificationTime() / 1000 < expires_s:
                busy.add(s.getPath().getName())
            else:
                self._fs.delete(s.getPath(), False)
        newest = self.version()
        kept = range(max(1, newest - keep_versions + 1), newest + 1)
        named = {s.path for v in kept for s in self.shards(v)}
        gone = 0
        for folder in folders:
            if folder.rsplit("/", 1)[1] in busy:
                continue
            inner = self._list(folder)
            files = [f for d, _ in inner for f in (self._list(d) if "=" in d.rsplit("/", 1)[1] else [(d, 0)])]
            for p, _ in files:
                if p.endswith(".parquet") and p not in named:
                    gone += bool(self._fs.delete(self._path(p), False))
        for p, _ in self._list(f"{self.path}/manifests"):
            if p.endswith(".json") and int(p.rsplit("/v", 1)[1][:12]) not in kept:
                self._fs.delete(self._path(p), False)
        return gone

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version under its schema; columns that a row's arrival lacked are null."""
        shards, schema = self._manifest(version)
        if not shards:
            return self.spark.createDataFrame([], schema or T.StructType())
        return self.spark.read.schema(schema).parquet(*[s.path for s in shards])


def compacted(docs: DataFrame, arrivals: int = 8, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """Appends docs in so many arrivals, by a hash of doc_id, compacts the table, small shards of all tiers in the end,
    and reads its newest version: all columns, and for each row the shard that holds it, that shard's level and rows,
    and how many shards there are (shard, level, shard_rows, n_shards; a name that docs has gets underscores
    appended)."""
    require(docs, "doc_id")
    spark = docs.sparkSession
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        return name if name.lower() not in taken else free(f"{name}_")

    arrival, place, shard, level, rows_in, n_shards = map(
        free, ("__arrival", "__path", "shard", "level", "shard_rows", "n_shards")
    )
    table = ShardTable(spark, new_path(spark, "shards"), target_bytes, fan_in)
    table.append(docs.withColumn(arrival, F.pmod(F.xxhash64("doc_id"), F.lit(arrivals)).cast("int")), arrival)
    table.compact(everything=True)
    table.vacuum()
    live = sorted(table.shards(), key=lambda s: s.path)
    if not live:
        return docs.limit(0).select(
            "*", F.lit(0).alias(shard), F.lit(0).alias(level), F.lit(0).cast("long").alias(rows_in),
            F.lit(0).alias(n_shards)
        )
    # One row for each shard; their number is known here, and a few thousand may go to every task.
    names = spark.createDataFrame(
        [(s.path.rpartition("/data/")[2], i, s.level, s.rows) for i, s in enumerate(live)],
        f"{place}_of string, {shard} int, {level} int, {rows_in} long"
    )
    rows = table.read().withColumn(place, F.substring_index("_metadata.file_path", "/data/", -1))
    names = F.broadcast(names) if len(live) <= MOST_BROADCAST else names
    return rows.join(
        names, F.col(place) == F.col(f"{place}_of"), "left"
    ).drop(place, f"{place}_of").withColumn(n_shards, F.lit(len(live)))
