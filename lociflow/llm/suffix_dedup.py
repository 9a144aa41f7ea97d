"""Suffix-array deduplication of byte strings that occur more than once.

The suffixes that begin at the minimisers of all windows (``_anchors``) make a sparse suffix array that loses no
repeated window: equal windows have equal minimisers at equal offsets. Sampled splitters range-partition these
suffixes by their leading bytes, at the length of a minimiser, so that suffixes which can share a window are
never parted by a splitter and no match straddles two buckets. Each bucket sorts its suffixes, and the reversed
contexts to their left, by multikey quicksort over eight bytes at a time, and takes the longest common prefixes
of neighbours. A window that reaches l bytes to the left and r bytes to the right of its minimiser is repeated if
another suffix lies in the same block of the right order at depth r and of the left order at depth l.

Contract: every byte that is covered by a string of ``window`` bytes which also starts anywhere else, in the same
document or another, is removed. Strings are judged on the input; matches never cross documents. Runs whose whole
text repeats are recognised by 64-bit hashes; all others are compared byte by byte.

Edge cases: a null text is empty; repeated rows are separate documents, so all that they share is removed; texts
shorter than a window stay whole; very long texts are read whole, in a batch of their own; all of several equal strings
are removed, so there are no ties; null ids are kept; an empty table gives an empty result; other columns are not read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm import _anchors as anchors
from lociflow.llm._stage import drop_stage, free_shuffles, shuffle_partitions, staged
from lociflow.llm._text import LOW_BITS, Rolling, in_batches, small_batches, spans_union

WINDOW = 200
GRAM = 64
#: Suffixes that a bucket compares at once; a bucket with more is worked through in stretches of whole minimisers.
STRETCH = 100_000


def byte_tokens():
    table = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)

    def split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=ends[1:])
        return table[np.frombuffer(b"".join(texts), np.uint8)], ends

    return split


#: Flags of an entry: its text repeats within its block; it is settled.
MANY, DONE = 2, 1


def _combine(e: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Of runs of one text in a block the first goes on; if there are several, all are removed."""
    o = np.lexsort((e["body"], e["gram"]))
    new = anchors.groups(e["gram"][o], e["body"][o])
    many = np.zeros(len(o), bool)
    many[o] = (np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1) if len(o) else False
    first = np.zeros(len(o), bool)
    first[o[new]] = True
    open_, settled = {k: v[first] for k, v in e.items()}, {k: v[many] for k, v in e.items()}
    open_["flag"] = np.where(many[first], MANY, 0).astype(np.uint8)
    settled["flag"] = np.full(len(settled["doc"]), DONE, np.uint8)
    return open_, settled


def _settle(e: dict[str, np.ndarray], split: int = anchors.SPLIT) -> dict[str, np.ndarray]:
    done = e["flag"] == DONE
    out = [{k: v[done] for k, v in e.items()} | {"kind": np.zeros(int(done.sum()), np.int64)}]
    e = {k: v[~done] for k, v in e.items()}
    o = np.lexsort((e["start"], e["doc"], e["body"], e["gram"]))
    e = {k: v[o] for k, v in e.items()}
    if len(o):
        new = anchors.groups(e["gram"], e["body"])
        c = np.cumsum(new) - 1
        many = (np.bincount(c) > 1)[c]
        gone = many & (e["flag"] != MANY)
        out.append({k: v[gone] for k, v in e.items()} | {"kind": np.zeros(int(gone.sum()), np.int64)})
        e = {k: v[new] for k, v in e.items()}
        single = ~many[new] & (e["flag"] != MANY)
        g = np.cumsum(anchors.groups(e["gram"])) - 1
        texts = np.bincount(g)
        ask = (texts[g] > 1) & (np.bincount(g, single)[g] > 0)
        kind = np.where(texts[g] > split, anchors.SINGLY, anchors.COMPARE) | np.where(single, 0, 4)
        out.append({k: v[ask] for k, v in e.items()} | {"kind": kind[ask]})
    joined = {k: np.concatenate([x[k] for x in out]) for k in ("doc", "th", "start", "count", "gram", "kind")}
    return joined | {"value": anchors.pack(joined["start"], joined["count"], joined["kind"])}


def _contexts(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The suffixes to compare: their minimiser, what stands left of it (reversed) and right of it; of runs to be
    compared singly each window by itself, as the suffix that begins with it."""
    types = (
        pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(),
        pa.bool_()
    )
    split = byte_tokens()
    for part, texts in small_batches(batches):
        cols = [part.column(part.schema.get_field_index(c)).to_pylist() for c in ("rid", "th", "asked")]
        rows: list[tuple] = []
        for rid, th, asked, text in zip(*cols, texts, strict=True):
            values = np.array(asked, np.int64)
            start, count, kind = anchors.unpack(values)
            grams = np.zeros(0, np.uint64)
            if ((kind & 3) == anchors.COMPARE).any():
                grams = Rolling(split([text])[0]).grams(gram) >> np.uint64(LOW_BITS)
            for s, c, k in zip(start.tolist(), count.tolist(), kind.tolist(), strict=True):
                if k & 3 == anchors.COMPARE:
                    # The minimiser lies in the first and in the last window of the run: the leftmost least gram.
                    a = s + c - 1 + int(np.argmin(grams[s + c - 1 : s + window - gram + 1]))
                    rows.append(
                        (
                            text[a : a + gram], text[s:a][::-1], text[a + gram : s + c - 1 + window], rid, th, s, c,
                            a - s, k < 4, False
                        )
                    )
                else:
                    rows += [
                        (
                            text[w : w + gram], b"", text[w + gram : w + window], rid, th, w, 1, 0, k < 4, True
                        ) for w in range(s, s + c)
                    ]
        for i in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows[i : i + 20_000], strict=True), types, strict=True)],
                ["head", "left", "right", "rid", "th", "start", "count", "at", "test", "singly"]
            )


def multikey_order(rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Order of zero-padded byte strings: by the first eight bytes, then, among those still equal, the next, and
    last by length."""
    n, width = rows.shape
    keys = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -width % 8)))).view(">u8").astype(np.uint64)
    keys = np.concatenate([keys, length.astype(np.uint64)[:, None]], axis=1)
    order = np.argsort(keys[:, 0], kind="stable")
    rank = np.maximum.accumulate(np.where(anchors.groups(keys[order, 0]), np.arange(n), 0))
    for j in range(1, keys.shape[1]):
        new = anchors.groups(rank)
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        o = np.lexsort((keys[order[at], j], rank[at]))
        order[at] = order[at][o]
        k = keys[order[at], j]
        rank[at] = at[np.maximum.accumulate(np.where(anchors.groups(rank[at], k), np.arange(len(at)), 0))]
    return order


def neighbour_lcp(rows: np.ndarray, length: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each string with the one before it in the order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for i in range(1, len(order), 50_000):
        b, a = order[i : i + 50_000], order[i - 1 : i - 1 + min(50_000, len(order) - i)]
        differ = rows[a] != rows[b]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[i : i + len(b)] = np.minimum(first, np.minimum(length[a], length[b]))
    return out


def _matrix(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(
        b"".join(t.ljust(width, b"\0") for t in texts), np.uint8
    ).reshape(len(texts), width), np.array([len(t) for t in texts], np.int64)


def repeated_windows(
    right: list[bytes], left: list[bytes], count: np.ndarray, at: np.ndarray, weight: np.ndarray, window: int
) -> list[tuple[int, int, int]]:
    """(row, first window, number of windows) of the windows that another row has too. Row i has count[i]
    windows; window j of it reaches at[i] - j bytes to the left of its minimiser. A row of weight 2 stands for
    several."""
    n = len(right)
    spread = int(at.max()) if n else 0
    R, r_len = _matrix(right, window)
    L, l_len = _matrix(left, max(8, spread))
    r_order, l_order = multikey_order(R, r_len), multikey_order(L, l_len)
    r_lcp, l_lcp = neighbour_lcp(R, r_len, r_order), neighbour_lcp(L, l_len, l_order)
    least = at - count + 1
    hits_row, hits_w = [], []
    r_block, l_block = np.empty(n, np.int64), np.empty(n, np.int64)
    for reach in range(max(0, int(least.min())), spread + 1):
        rows = np.flatnonzero((least <= reach) & (at >= reach))
        if len(rows) < 2:
            continue
        r_block[r_order] = np.cumsum(r_lcp < window - reach)
        l_block[l_order] = np.cumsum(l_lcp < reach)
        key = r_block[rows] * np.int64(n + 1) + l_block[rows]
        o = np.argsort(key)
        new = anchors.groups(key[o])
        g = np.cumsum(new) - 1
        twice = np.bincount(g, weight[rows[o]])[g] > 1
        hit = rows[o[twice]]
        hits_row.append(hit)
        hits_w.append(at[hit] - reach)
    if not hits_row:
        return []
    row, w = np.concatenate(hits_row), np.concatenate(hits_w)
    o = np.lexsort((w, row))
    row, w = row[o], w[o]
    new = anchors.groups(row, w - np.arange(len(w)))
    first = np.flatnonzero(new)
    return list(zip(row[first].tolist(), w[first].tolist(), np.diff(np.append(first, len(row))).tolist(), strict=True))


def _bucket(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def finish(rows: list[tuple]) -> pa.RecordBatch:
        got = repeated_windows(
            [r[0] + r[2] for r in rows], [r[1] for r in rows], np.array([r[6] for r in rows]),
            np.array([r[7] for r in rows]), np.array([1 if r[8] else 2 for r in rows]), window
        )
        out = [
            (rows[i][3], rows[i][4], (rows[i][5] + w) << 24 | c << 4 | anchors.REMOVE) for i, w, c in got if rows[i][8]
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.int64()))],
            ["rid", "th", "value"]
        )

    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(9)), strict=True):
            if len(held) >= STRETCH and held[-1][0] != row[0]:
                yield finish(held)
                held = []
            held.append(row)
    if held:
        yield finish(held)


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for part, texts in small_batches(batches):
        ids, values = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "gone"))
        kept, gone, lists = [], [], []
        for text, v in zip(texts, values, strict=True):
            start, count, _ = anchors.unpack(np.array(v, np.int64)) if v else (none, none, none)
            s, e = spans_union(start, start + count - 1 + window)
            at, keep = 0, []
            for a, b in zip(s.tolist(), e.tolist(), strict=True):
                keep.append(text[at:a])
                at = b
            kept.append(b"".join([*keep, text[at:]]))
            gone.append(int((e - s).sum()))
            lists.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist(), strict=True)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(gone, pa.int64()),
                pa.array(lists, span), pa.array(kept, pa.binary())
            ],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
        )


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, split: int = anchors.SPLIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed runs of bytes, half-open) and kept (the remaining
    bytes; a cut may fall within a character)."""
    if not 8 <= gram <= window:
        raise ValueError("gram must lie between 8 and window")
    rows = anchors.keyed(docs)
    found = staged(
        anchors.settle(anchors.index(rows, byte_tokens, window, gram, _combine), lambda e: _settle(e, split)), "strings"
    )
    free_shuffles(docs.sparkSession)
    schema = "head binary, left binary, right binary, rid long, th long, start long, count int, at int, test boolean"
    # One pass over the texts for both ways of comparing: texts are dealt out here and at the end, no third time.
    asked = anchors.per_document(found.where(anchors.kind().bitwiseAND(F.lit(3)) != anchors.REMOVE), "asked")
    contexts = anchors.with_texts(rows, asked, "inner").transform(
        in_batches, lambda it: _contexts(it, window, gram), f"{schema}, singly boolean"
    )
    suffixes = staged(contexts, "suffixes", "zstd")
    free_shuffles(docs.sparkSession)
    buckets = suffixes.where("NOT singly").drop("singly").repartitionByRange(shuffle_partitions(docs.sparkSession), "head").sortWithinPartitions("head")
    repeated = buckets.transform(in_batches, lambda it: _bucket(it, window), "rid long, th long, value long")
    gone = found.where(anchors.kind() == anchors.REMOVE).select("rid", "th", "value").unionByName(repeated)
    if not found.where(anchors.kind().bitwiseAND(F.lit(3)) == anchors.SINGLY).isEmpty():
        # Windows around a minimiser with too many texts for one bucket: an aggregation, combined before its shuffle.
        single = suffixes.where("singly").select(F.concat("head", "right").alias("bytes"), "rid", "th", "start", "test")
        twice = single.groupBy("bytes").agg(
            F.sum(F.when(F.col("test"), 1).otherwise(2)).alias("n")
        ).where("n > 1").select("bytes")
        more = single.where("test").join(twice, "bytes", "left_semi")
        gone = gone.unionByName(
            more.select("rid", "th", (F.shiftleft(F.col("start"), 24) + (1 << 4) + anchors.REMOVE).alias("value"))
        )
    # Written, so that the texts are dealt out once what the comparison took of the disk has gone.
    gone = staged(gone, "repeated")
    drop_stage(found)
    drop_stage(suffixes)
    free_shuffles(docs.sparkSession)
    full = anchors.with_texts(rows, anchors.per_document(gone, "gone"), "left")
    full = full.select(F.when(F.col("rid") != anchors.NO_ID, F.col("rid")).alias("doc_id"), "text", "gone")
    return full.transform(
        in_batches, lambda it: _cut(it, window),
        "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    )
