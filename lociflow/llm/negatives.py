"""Hard negatives by blocked dense products.

Vectors are scaled and floored to integers, so that every score is an integer and products in float64 are exact below
2**53 (beyond it blocks are multiplied in extended precision, exact to 2**63, and scores that no long can hold
saturate). Anchors are broadcast in groups of bounded size; rows are read in blocks by all tasks, and each block is
multiplied with the blocks of anchors. The first pass takes the products of equal labels and keeps each anchor's best
positives; what tasks keep is merged by Spark. The second pass takes the products of different labels and keeps, for each
anchor and positive, the best rows within the window that the positive's score sets. Only rows that a task's own best
ones do not already exclude leave the matrix, so a block's memory is bounded and a label, a vector or an id that a third
of the table repeats changes nothing. Groups of anchors follow each other, each a full pass over the rows; a group is as
large as ``GROUP_BYTES`` allows.

Edge cases: rows with a null label, a null vector, or a null or non-finite component take no part (a component that is
not finite once scaled counts so); vectors of another length than an anchor's are not its candidates; empty vectors have
the score 0. Rows of an anchor's own id are not its others; other repeated rows are candidates each. Repeated anchor rows
of one id, label and vector are one anchor, those that differ one each. A row without an id comes after all ids. A
negative positive score leaves an empty window. An empty table gives an empty result; other columns are not read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm._stage import free_shuffles, new_path, staged
from lociflow.llm._text import in_batches, require

#: Stands for a missing id: the largest number.
NO_ID = (1 << 63) - 1
#: Bytes of anchors that are broadcast at once; anchors and rows of a block.
GROUP_BYTES, BLOCK_ANCHORS, BLOCK_ROWS = 32 << 20, 1024, 2048


def best(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each row, by falling score, then by id."""
    o = np.lexsort((ids, -score, row))
    r = row[o]
    first = np.maximum.accumulate(np.where(np.append(True, r[1:] != r[:-1]), np.arange(len(o)), 0)) if len(o) else o
    return o[np.arange(len(o)) - first < k]


class Best:
    """The first k candidates of each of n searches so far."""

    def __init__(self, n: int, k: int, kind: type) -> None:
        self.k = k
        self.score = np.full((n, k), -np.inf, kind)
        self.id = np.full((n, k), NO_ID, np.int64)

    def offer(self, at: np.ndarray, s: np.ndarray, ids: np.ndarray) -> None:
        """s[i, j] is what candidate ids[j] scores in search at[i], -inf if it is none."""
        worst = self.score[at, -1][:, None]
        s = np.where(s >= worst, s, -np.inf)
        if s.shape[1] > self.k:
            s[s < np.partition(s, -self.k, axis=1)[:, -self.k][:, None]] = -np.inf
        row, col = np.nonzero(s > -np.inf)
        if not len(row):
            return
        hit = np.unique(row)
        old = at[hit]
        rows = np.concatenate([np.repeat(old, self.k), at[row]])
        scores, names = np.append(self.score[old], s[row, col]), np.append(self.id[old], ids[col])
        keep = best(rows, scores, names, self.k)
        self.score[old], self.id[old] = scores[keep].reshape(-1, self.k), names[keep].reshape(-1, self.k)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of integers held in float64: exact, or saturated where no long holds them."""
    size = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if size < 1 << 53:
        return a @ b.T
    out = a.astype(np.longdouble) @ b.T.astype(np.longdouble)
    return np.clip(out, -(np.longdouble(2) ** 63), np.longdouble(2) ** 63 - 1)


def as_long(scores: np.ndarray) -> np.ndarray:
    return scores.astype(np.int64)


class Anchors:
    """Anchors of one length: number, id, label and vector, in order of their labels."""

    def __init__(self, number: list[int], ids: list[int], labels: list[int], vectors: list[np.ndarray]) -> None:
        o = np.argsort(np.array(labels, np.int64), kind="stable")
        self.number, self.id, self.label = (np.array(x, np.int64)[o] for x in (number, ids, labels))
        self.vector = np.array(vectors, np.float64).reshape(len(o), -1)[o]


def scaled(col: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their floored vectors, for each length of vectors; rows with components that are not finite are left
    out."""
    size = pc.list_value_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.concatenate([col.flatten().to_numpy(zero_copy_only=False).astype(np.float64), [0.0]])
    start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(size) else size
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        v = np.floor(scale * values[start[rows][:, None] + np.arange(dim)])
        ok = np.isfinite(v).all(axis=1)
        yield rows[ok], v[ok]


def _blocks(
    batches: Iterator[pa.RecordBatch], anchors: dict[int, Anchors], scale: float
) -> Iterator[tuple[Anchors, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of rows (id, label, vector) in order of their labels, with the anchors of their length."""
    for b in batches:
        ids, labels = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for rows, v in scaled(b.column(2), scale):
            if v.shape[1] not in anchors:
                continue
            o = np.argsort(labels[rows], kind="stable")
            for i in range(0, len(o), BLOCK_ROWS):
                at = o[i : i + BLOCK_ROWS]
                yield anchors[v.shape[1]], ids[rows[at]], labels[rows[at]], v[at]


def _positives(
    batches: Iterator[pa.RecordBatch], anchors: dict[int, Anchors], k: int, scale: float
) -> Iterator[pa.RecordBatch]:
    """Each anchor's best rows of its own label among those of the task."""
    found = {d: Best(len(a.id), k, np.longdouble) for d, a in anchors.items()}
    for a, ids, labels, v in _blocks(batches, anchors, scale):
        for label in np.unique(labels).tolist():
            i, j = np.searchsorted(a.label, [label, label + 1])
            p, q = np.searchsorted(labels, [label, label + 1])
            for at in range(i, j, BLOCK_ANCHORS):
                rows = np.arange(at, min(j, at + BLOCK_ANCHORS))
                s = products(a.vector[rows], v[p:q])
                s[a.id[rows][:, None] == ids[p:q]] = -np.inf
                found[v.shape[1]].offer(rows, s, ids[p:q])
    for d, a in anchors.items():
        row, col = np.nonzero(found[d].score > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(a.number[row]), pa.array(found[d].id[row, col]), pa.array(as_long(found[d].score[row, col]))
            ],
            ["anchor", "id", "score"]
        )


def window_of(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest scores n with low * score <= 100 * n <= high * score, without leaving 64 bits."""
    whole, rest = np.divmod(score, 100)
    return whole * low - ((-rest * low) // 100), whole * high + rest * high // 100


def _negatives(
    batches: Iterator[pa.RecordBatch], anchors: dict[int, Anchors], wanted: dict[int, list[tuple]], k: int,
    window: tuple[int, int], scale: float
) -> Iterator[pa.RecordBatch]:
    """For each anchor and positive the best rows of other labels within the window, among those of the task.
    wanted: an anchor's positives, as (rank, id, score)."""
    found, least, most = {}, {}, {}
    for d, a in anchors.items():
        ranks = max((len(wanted.get(n, ())) for n in a.number.tolist()), default=0)
        least[d], most[d] = np.ones((ranks, len(a.id)), np.longdouble), np.zeros((ranks, len(a.id)), np.longdouble)
        for i, n in enumerate(a.number.tolist()):
            for r, (_, score) in enumerate(wanted.get(n, ())):
                least[d][r, i], most[d][r, i] = window_of(np.int64(score), *window)
        found[d] = [Best(len(a.id), k, np.longdouble) for _ in range(ranks)]
    for a, ids, labels, v in _blocks(batches, anchors, scale):
        d = v.shape[1]
        for at in range(0, len(a.id), BLOCK_ANCHORS):
            rows = np.arange(at, min(len(a.id), at + BLOCK_ANCHORS))
            s = products(a.vector[rows], v)
            s[(a.label[rows][:, None] == labels) | (a.id[rows][:, None] == ids)] = -np.inf
            for r, best_ in enumerate(found[d]):
                low, high = (x[d][r, rows].astype(s.dtype)[:, None] for x in (least, most))
                best_.offer(rows, np.where((s >= low) & (s <= high), s, -np.inf), ids)
    for d, a in anchors.items():
        for r, best_ in enumerate(found[d]):
            row, col = np.nonzero(best_.score > -np.inf)
            if len(row):
                number = a.number[row]
                positive = [wanted[n][r] for n in number.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number), pa.array(a.id[row]), pa.array(np.full(len(row), r, np.int32)),
                        pa.array([p for p, _ in positive], pa.int64()), pa.array([s for _, s in positive], pa.int64()),
                        pa.array(best_.id[row, col]), pa.array(as_long(best_.score[row, col]))
                    ],
                    ["anchor", "anchor_id", "place", "positive_id", "positive_score", "id", "score"]
                )


def _first(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    """The first k rows of each key, numbered from 1: what the tasks have kept is merged."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    table: DataFrame, anchor: Column, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0,
    group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row that ``anchor`` (of the
    table's columns) is true of, and for each of its first ``positives`` other rows of its label, the first
    ``negatives`` rows of other labels whose score is between ``low`` and ``high`` percent of the positive's.

    Scores are inner products of floor(``scale`` * component). ``group_bytes`` bounds the anchors that are broadcast at
    once; it does not change the result."""
    require(table, id_column, vector, label)
    spark = table.sparkSession
    q = lambda name: F.col(f"`{name}`")
    sound = F.expr(f"forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    rows = table.where(q(label).isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.coalesce(q(id_column).cast("long"), F.lit(NO_ID)).alias("id"), q(label).cast("long").alias("label"),
        q(vector).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor")
    )
    plain = rows.select("id", "label", "vector")
    chosen = staged(rows.where("anchor").select("id", "label", "vector").distinct(), "anchors")
    size = chosen.agg(F.coalesce(F.sum(8 * F.size("vector") + 24), F.lit(0)), F.count("*")).first()
    groups = -(-size[0] // group_bytes)
    out = new_path(spark, "negatives")
    schema = "anchor long, anchor_id long, place int, positive_id long, positive_score long, id long, score long"
    spark.createDataFrame([], f"{schema}, rank int").write.parquet(out)
    for g in range(groups):
        # Dealt by all columns, so that one id with many vectors is dealt too.
        own = chosen.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(groups)) == g).collect()
        by_size: dict[int, list[tuple]] = {}
        for n, r in enumerate(own):
            v = np.floor(scale * np.array(r.vector, np.float64))
            if np.isfinite(v).all():
                by_size.setdefault(len(v), []).append((n, r.id, r.label, v))
        anchors = spark.sparkContext.broadcast(
            {d: Anchors(*map(list, zip(*x, strict=True))) for d, x in by_size.items()}
        )
        near = plain.transform(
            in_batches, lambda it, a=anchors: _positives(it, a.value, positives, scale),
            "anchor long, id long, score long"
        )
        held: dict[int, list[tuple]] = {}
        for r in sorted(_first(near, positives, "anchor").collect(), key=lambda r: (r.anchor, r.rank)):
            held.setdefault(r.anchor, []).append((r.id, r.score))
        wanted = spark.sparkContext.broadcast(held)
        far = plain.transform(
            in_batches,
            lambda it, a=anchors, w=wanted: _negatives(it, a.value, w.value, negatives, (low, high), scale), schema
        )
        _first(far, negatives, "anchor", "place").write.mode("append").parquet(out)
        anchors.destroy()
        wanted.destroy()
        free_shuffles(spark)
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return spark.read.schema(f"{schema}, rank int").parquet(out).select(
        real("anchor_id").alias("anchor_id"), real("positive_id").alias("positive_id"), "rank",
        real("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
