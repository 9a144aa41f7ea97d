"""Finds windows of tokens that occur more than once, without a row for every window.

The windows of each document are grouped into runs by their minimiser (see ``_text.window_runs``): equal windows
have equal minimisers at equal offsets. Three rounds settle each run:

1. *Index.* Runs travel as packed blocks of (minimiser hash, hash of the run's text, document, place), dealt by
   minimiser. Runs of one block with equal text meet before the shuffle: one of them is sent on.
2. *Settle.* Where all runs of a minimiser have one text, that text alone decides. Where texts differ, one run of
   each text is asked for its tokens.
3. *Compare.* The tokens asked for are compared window by window by the operator's own structure.

A minimiser with more than ``split`` different texts (a parameter; 0 takes every minimiser so, and the results are the
same at any value) is asked for single windows, dealt by window or compared by an aggregation, so that no task gathers
them. A document is known by its id and a hash of its text, so repeated ids keep apart; a null id
stands for the largest number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm._stage import buckets
from lociflow.llm._text import Rolling, in_batches, require, small_batches, window_runs

NO_ID = (1 << 63) - 1
SPLIT = 5000
#: What a span row says: these windows are removed; compare this run; compare its windows one by one.
REMOVE, COMPARE, SINGLY = 0, 1, 2
#: Rows of a block before it is sent.
BLOCK_ROWS = 400_000

ENTRY = [
    ("gram", np.uint64), ("body", np.uint64), ("doc", np.int64), ("th", np.int64), ("start", np.uint32),
    ("count", np.uint16), ("flag", np.uint8)
]


def keyed(docs: DataFrame) -> DataFrame:
    """rid, th, text: the row's key and its text. 64 bits, as all rows may lack an id or share one."""
    require(docs, "doc_id", "text")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("rid"), F.xxhash64("text").alias("th"), "text"
    )


def pack(start: np.ndarray, count: np.ndarray, kind: int | np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 24) | (count.astype(np.int64) << 4) | kind


def unpack(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return value >> 24, (value >> 4) & 0xFFFFF, value & 15


def to_block(entry: dict[str, np.ndarray]) -> bytes:
    return b"".join(entry[k].astype(t, copy=False).tobytes() for k, t in ENTRY)


def from_blocks(blocks: list[bytes]) -> dict[str, np.ndarray]:
    size = sum(np.dtype(t).itemsize for _, t in ENTRY)
    parts: dict[str, list[np.ndarray]] = {k: [] for k, _ in ENTRY}
    for b in blocks:
        n, at = len(b) // size, 0
        for k, t in ENTRY:
            parts[k].append(np.frombuffer(b, t, n, at))
            at += n * np.dtype(t).itemsize
    return {k: np.concatenate(v) if v else np.zeros(0, dict(ENTRY)[k]) for k, v in parts.items()}


def groups(*keys: np.ndarray) -> np.ndarray:
    """True where sorted rows begin a new group."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


Tokens = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
Settle = Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]


def index(docs: DataFrame, tokens: Callable[[], Tokens], window: int, gram: int, combine: Callable) -> DataFrame:
    """(bucket, block) rows of all runs. ``combine`` takes the entries of a block and returns those to deal by
    minimiser and those that are settled already, which are dealt by document."""
    n = buckets(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = tokens()
        held: list[dict[str, np.ndarray]] = []

        def send() -> pa.RecordBatch:
            entry = {k: np.concatenate([h[k] for h in held]) for k, _ in ENTRY}
            held.clear()
            open_, settled = combine(entry)
            places, blocks = [], []
            for part, by in (
                (open_, open_["gram"] % np.uint64(n)),
                (settled, settled["doc"].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32))
            ):
                by = (by % np.uint64(n)).astype(np.int64)
                o = np.argsort(by, kind="stable")
                cut = np.searchsorted(by[o], np.arange(n + 1))
                for b in np.flatnonzero(np.diff(cut)):
                    rows = o[cut[b] : cut[b + 1]]
                    places.append(b)
                    blocks.append(to_block({k: v[rows] for k, v in part.items()}))
            return pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), pa.array(blocks, pa.binary())], ["bucket", "block"]
            )

        for part, texts in small_batches(batches):
            toks, ends = split(texts)
            roll = Rolling(toks)
            doc, begin, stop, _, h = window_runs(roll, ends, window, gram)
            if not len(doc):
                continue
            rid, th = (
                part.column(part.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("rid", "th")
            )
            held.append(
                {
                    "gram": h, "body": roll.of(begin, stop + window), "doc": rid[doc], "th": th[doc],
                    "start": begin - ends[doc], "count": stop - begin + 1, "flag": np.zeros(len(doc), np.uint8)
                }
            )
            if sum(len(x["doc"]) for x in held) >= BLOCK_ROWS:
                yield send()
        if held:
            yield send()

    return docs.transform(in_batches, run, "bucket int, block binary")


def by_bucket(blocks: DataFrame) -> DataFrame:
    """The rows of every bucket in one partition, one bucket after the other."""
    return blocks.repartition("bucket").sortWithinPartitions("bucket")


def each_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """What stands beside the bucket's number, one bucket at a time."""
    key, held = None, []
    for b in batches:
        for bucket, *rest in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
            if held and bucket != key:
                yield held
                held = []
            key = bucket
            held.append(rest)
    if held:
        yield held


def settle(blocks: DataFrame, rule: Settle) -> DataFrame:
    """(rid, th, value, gram) rows: windows to remove, and runs to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in each_bucket(batches):
            out = rule(from_blocks([x[0] for x in held]))
            for i in range(0, len(out["doc"]), 500_000):
                s = slice(i, i + 500_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["doc"][s]), pa.array(out["th"][s]), pa.array(out["value"][s]),
                        pa.array(out["gram"][s].view(np.int64))
                    ],
                    ["rid", "th", "value", "gram"]
                )

    return by_bucket(blocks.select("bucket", "block")).transform(
        in_batches, run, "rid long, th long, value long, gram long"
    )


def kind(value: str = "value"):
    return F.col(value).bitwiseAND(F.lit(15))


def per_document(spans: DataFrame, name: str) -> DataFrame:
    """One row for each document: all its values."""
    return spans.groupBy("rid", "th").agg(F.collect_list("value").alias(name))


def with_texts(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """docs joined to per-document rows. The small side is hashed, so texts are not sorted."""
    return docs.join(spans.hint("shuffle_hash"), ["rid", "th"], how)
