"""Approximate nearest neighbours over learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts with few edges between them, and a small
network learns to tell a vector's part from the vector. Every row is indexed under its most probable part; a query
goes to the several parts that are most probable for it, as many as the sample needs for its recall and as its k
neighbours need for room, and all rows found there are ranked by their exact distance. Parts are searched in blocks of
rows and queries, so neither a part of any size nor a vector that a third of the table repeats gathers in one task.
There are more parts the more rows there are, up to what the sample can tell apart; of a larger table each part is
cut again in the same way, by a router that is fitted in a task on a bounded sample of that part alone.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors of another
length than most are searched among those of their own length, all of them; components of any finite size are ranked
rightly, as all arithmetic is on scaled numbers; ties go to the smaller id; repeated rows are separate candidates, but
for those of a query's own id; repeated query rows of one id and vector are one query, those of one id and different
vectors one each; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm._stage import drop_stage, staged
from lociflow.llm._text import in_batches, require

#: The sample that partitions and classifier are fitted on has at most so many rows, those of the least hashes.
FIT_ROWS = 4000
#: Parts at least, and rows for which there is one part more; a part needs 4 * k rows of the sample.
PARTS, PART_ROWS = 16, 8192
GRAPH_NEIGHBOURS = 10
HIDDEN = 64
#: Recall on the sample for which parts are added to a query's route.
SAMPLE_RECALL = 0.95
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 2_048
#: Numbers that a part's cells may take.
WIDE = 1 << 10


@dataclass
class Router:
    """The classifier, how many parts a query visits, the vectors' length, and the binary exponent that their
    components are scaled by."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int
    dim: int
    exponent: int = 0
    #: Whether the rows are too many for the parts that the sample can tell apart.
    deep: bool = False

    def parts(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, the most probable first."""
        z = np.clip((np.ldexp(x, -self.exponent) - self.mean) / self.scale, -1e9, 1e9)
        h = np.tanh(z @ self.w1 + self.b1)
        return np.argsort(-(h @ self.w2 + self.b2), axis=1, kind="stable")


@dataclass
class Tree:
    """The router of all rows, and those of the parts that are cut again. A cell is a part, or a part of it."""

    top: Router
    below: dict[int, Router]

    def cells(self, x: np.ndarray) -> np.ndarray:
        part = self.top.parts(x)[:, 0]
        out = part * WIDE
        for p, router in self.below.items():
            at = np.flatnonzero(part == p)
            if len(at):
                out[at] += router.parts(x[at])[:, 0]
        return out

    def routes(self, x: np.ndarray, depth: int, whole: bool, size: dict[int, int], need: np.ndarray) -> list[list[int]]:
        """The cells that each query visits: of its ``depth`` most probable parts the most probable cells, or with
        ``whole`` all, and then further ones until they hold as many rows as it needs."""
        order = self.top.parts(x)
        inner: dict[int, np.ndarray] = {}
        for p in np.unique(order[:, :depth]).tolist():
            inner[p] = self.below[p].parts(x) if p in self.below else np.zeros((len(x), 1), np.int64)
        out = []
        for i, parts in enumerate(order.tolist()):
            first, rest = [], []
            for p in parts[:depth]:
                cells = (inner[p][i] + p * WIDE).tolist()
                cut = len(cells) if whole or p not in self.below else self.below[p].probes
                first += cells[:cut]
                rest += cells[cut:]
            for p in parts[depth:]:
                rest += range(p * WIDE, p * WIDE + (len(self.below[p].b2) if p in self.below else 1))
            held = sum(size.get(c, 0) for c in first)
            for c in rest:
                if held >= need[i]:
                    break
                first.append(c)
                held += size.get(c, 0)
            out.append(first)
        return out


def usable(column: str, dim: int | None = None) -> Column:
    ok = F.expr(f"forall(`{column}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))") & F.expr(f"exists(`{column}`, x -> x <> 0)")
    return F.coalesce(ok if dim is None else ok & (F.size(column) == dim), F.lit(False))


def exponent(*arrays: np.ndarray) -> int:
    """Of the largest component: scaled by it, squares neither overflow nor vanish. Scaling by powers of two is exact."""
    return int(np.frexp(max(float(np.abs(x).max(initial=0.0)) for x in arrays))[1])


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of x from y, in double precision whatever the size of the components."""
    e = exponent(x, y)
    d = np.ldexp(x, -e) - np.ldexp(y, -e)
    own = np.frexp(np.abs(d).max(1, initial=0.0))[1]
    return np.ldexp(np.sqrt((np.ldexp(d, -own[:, None]) ** 2).sum(1)), own + e)


def exact_neighbours(queries: np.ndarray, rows: np.ndarray, k: int, skip: np.ndarray | None = None) -> np.ndarray:
    """Row numbers of each query's k nearest; ``skip[i]`` is the row that query i leaves out."""
    out = []
    for i in range(0, len(queries), 512):
        q = queries[i : i + 512]
        d = (q**2).sum(1)[:, None] + (rows**2).sum(1)[None] - 2 * q @ rows.T
        if skip is not None:
            d[np.arange(len(q)), skip[i : i + 512]] = np.inf
        near = np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k]
        out.append(np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20, slack: float = 1.05) -> np.ndarray:
    """Cuts a neighbour graph into parts of nearly equal size: from centres far apart, then vertices move to
    the part that holds most of their neighbours while there is room."""
    n = len(x)
    room = int(np.ceil(n / parts * slack))
    centres = [0]
    nearest = ((x - x[0]) ** 2).sum(1)
    for _ in range(parts - 1):
        centres.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((x - x[centres[-1]]) ** 2).sum(1))
    c = x[centres]
    for _ in range(8):
        d = (x**2).sum(1)[:, None] + (c**2).sum(1)[None] - 2 * x @ c.T
        own = d.argmin(1)
        c = np.stack([x[own == p].mean(0) if (own == p).any() else c[p] for p in range(parts)])
    label = np.full(n, -1)
    left = np.full(parts, room)
    for flat in np.argsort(d, axis=None, kind="stable"):
        v, p = divmod(int(flat), parts)
        if label[v] < 0 and left[p]:
            label[v] = p
            left[p] -= 1
    edges = np.concatenate(
        [
            np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()], 1),
            np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])], 1)
        ]
    )
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (edges[:, 0], label[edges[:, 1]]), 1)
        gain = votes - votes[np.arange(n), label][:, None]
        to = gain.argmax(1)
        moved = 0
        size = np.bincount(label, minlength=parts)
        for v in np.argsort(-gain.max(1), kind="stable"):
            p = to[v]
            if gain[v, p] <= 0:
                break
            if size[p] < room:
                size[label[v]] -= 1
                size[p] += 1
                label[v] = p
                moved += 1
        if not moved:
            break
    return label


def train(x: np.ndarray, target: np.ndarray, seed: int, steps: int = 600, rate: float = 0.01) -> tuple[np.ndarray, ...]:
    """One hidden layer, trained by Adam on soft labels."""
    rng = np.random.default_rng(seed)
    shape = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, target.shape[1]), (target.shape[1],)]
    p = [rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 else np.zeros(s) for s in shape]
    m, v = [np.zeros(s) for s in shape], [np.zeros(s) for s in shape]
    for t in range(1, steps + 1):
        i = rng.integers(0, len(x), min(len(x), 512))
        h = np.tanh(x[i] @ p[0] + p[1])
        z = h @ p[2] + p[3]
        z -= z.max(1, keepdims=True)
        e = np.exp(z)
        g = (e / e.sum(1, keepdims=True) - target[i]) / len(i)
        gh = g @ p[2].T * (1 - h**2)
        for j, d in enumerate((x[i].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
            m[j] = 0.9 * m[j] + 0.1 * d
            v[j] = 0.999 * v[j] + 0.001 * d * d
            p[j] -= rate * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
    return tuple(p)


def fit(
    vectors: DataFrame, parts: int | None = None, k: int = 10, seed: int = 5, fit_rows: int = FIT_ROWS
) -> Router | None:
    """From (id, vec) of usable vectors; None if there are none. By default there is a part for every ``PART_ROWS``
    rows, and ``PARTS`` at least. Distinct vectors of the sample are used, so one that many rows repeat does not fill
    a part."""
    lengths = vectors.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not lengths:
        return None
    dim, wanted = int(lengths[0]["dim"]), int(lengths[0]["count"]) // PART_ROWS
    rows = vectors.where(F.size("vec") == dim).orderBy(
        F.xxhash64(F.lit(seed), "id"), "id"
    ).limit(fit_rows).select("vec").collect()
    x = np.unique(np.array([r[0] for r in rows], np.float64), axis=0)
    deep = parts is None and wanted > 2 * (len(x) // (4 * k))
    router = learn(x, parts or max(PARTS, wanted), k, seed, SAMPLE_RECALL**0.5 if deep else SAMPLE_RECALL)
    router.deep = deep
    return router


def learn(x: np.ndarray, parts: int, k: int, seed: int, recall_wanted: float) -> Router:
    """The router of distinct vectors of one length, into as many parts as they can tell apart."""
    n, e, dim = len(x), exponent(x), x.shape[1]
    x = np.ldexp(x, -e)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    parts = max(1, min(parts, n // (4 * k), WIDE))
    if parts == 1:
        return Router(
            mean, scale, np.zeros((dim, HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, 1)), np.zeros(1), 1, dim, e
        )
    graph = exact_neighbours(x, x, min(GRAPH_NEIGHBOURS, n - 1), np.arange(n))
    label = balanced_parts(x, graph, parts)
    soft = np.zeros((n, parts))
    np.add.at(soft, (np.arange(n), label), graph.shape[1])
    np.add.at(soft, (np.repeat(np.arange(n), graph.shape[1]), label[graph.ravel()]), 1)
    router = Router(mean, scale, *train((x - mean) / scale, soft / soft.sum(1, keepdims=True), seed), parts, dim, e)
    order = router.parts(np.ldexp(x, e))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(parts), order.shape), 1)
    # How far down a vector's route its neighbours' parts stand.
    depth = np.take_along_axis(place, order[:, 0][graph], 1)
    recall = np.array([(depth < p).mean() for p in range(1, parts + 1)])
    router.probes = int(np.argmax(recall >= recall_wanted)) + 1 if recall.max() >= recall_wanted else parts
    return router


def fit_below(index: DataFrame, size: dict[int, int], k: int, seed: int) -> dict[int, Router]:
    """Routers of the cells (part) of more than two times ``PART_ROWS`` rows, each fitted in a task on a sample of
    about ``FIT_ROWS`` of its rows: those of the least hashes."""
    large = {p: n for p, n in size.items() if p >= 0 and n > 2 * PART_ROWS}
    if not large:
        return {}
    share = F.create_map(*[F.lit(x) for p, n in large.items() for x in (p, min(1.0, FIT_ROWS / n))])
    place = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = index.where(F.col("part").isin(list(large))).where(place < share[F.col("part")]).select("part", "vec")

    def run(rows: pa.Table) -> pa.Table:
        p = rows.column("part")[0].as_py()
        x = np.unique(_matrix(rows.column("vec").combine_chunks()), axis=0)
        router = learn(x, large[p] // PART_ROWS, k, seed, SAMPLE_RECALL**0.5)
        return pa.table([pa.array([p], pa.int32()), pa.array([pickle.dumps(router)], pa.binary())], ["part", "router"])

    # A router for each part, of which the sample allows FIT_ROWS / (4 * k) at most.
    found = sample.groupBy("part").applyInArrow(run, "part int, router binary").collect()
    return {r["part"] // WIDE: pickle.loads(r["router"]) for r in found}  # noqa: S301


def _counts(index: DataFrame) -> dict[int, int]:
    """Rows of each cell; there are (FIT_ROWS / (4 * k)) ** 2 learned cells at most."""
    return {r["part"]: r["count"] for r in index.where("part >= 0").groupBy("part").count().collect()}


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows whose vectors (second column) have one length, and that length."""
    for b in batches:
        size = pc.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)
        for dim in np.unique(size).tolist():
            yield dim, b if (size == dim).all() else b.filter(pa.array(size == dim))


def _route(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    """Each row's cell; rows of another length are a cell of their own, numbered by that length below 0."""
    for dim, b in _by_length(batches):
        part = tree.cells(_matrix(b.column(1))).astype(np.int32) if dim == tree.top.dim else np.full(len(b), -dim, np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(part)], ["id", "vec", "part"])


def _ask(
    batches: Iterator[pa.RecordBatch], tree: Tree, depth: int, whole: bool, size: dict[int, int], k: int
) -> Iterator[pa.RecordBatch]:
    """The cells that each query (id, vec, own) visits, which hold k rows besides the query's own if there are."""
    for dim, b in _by_length(batches):
        if dim == tree.top.dim:
            need = b.column(2).to_numpy(zero_copy_only=False) + k
            parts = tree.routes(_matrix(b.column(1)), depth, whole, size, need)
        else:
            parts = [[-dim]] * len(b)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(parts, pa.list_(pa.int32()))], ["id", "vec", "parts"]
        )


def _block(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Ranks a block of rows for a block of queries: candidates by matrix product, then exact distances. ``ask`` tells
    the queries of one id apart."""
    rows = [
        np.concatenate(
            [c.to_numpy(zero_copy_only=False) for c in t.column("id").chunks]
        ) if len(t) else np.zeros(0, np.int64) for t in (left, right)
    ]
    q_id, x_id = rows
    out: list[list] = [[], [], [], []]
    if len(q_id) and len(x_id):
        ask = left.column("ask").to_pylist()
        raw_q, raw_x = (_matrix(t.column("vec").combine_chunks()) for t in (left, right))
        e = exponent(raw_q, raw_x)
        q, x = np.ldexp(raw_q, -e), np.ldexp(raw_x, -e)
        xx = (x**2).sum(1)
        for i in range(0, len(q), 256):
            part = q[i : i + 256]
            d = (part**2).sum(1)[:, None] + xx[None] - 2 * part @ x.T
            d[q_id[i : i + 256][:, None] == x_id[None]] = np.inf
            kth = np.partition(d, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(part), np.inf)
            margin = 1e-9 * ((part**2).sum(1) + xx.max()) + kth
            for j in range(len(part)):
                c = np.flatnonzero((d[j] <= margin[j]) & (d[j] < np.inf))
                s = distances(raw_x[c], raw_q[i + j])
                best = np.lexsort((x_id[c], s))[:k]
                out[0] += [q_id[i + j]] * len(best)
                out[1] += [ask[i + j]] * len(best)
                out[2] += x_id[c[best]].tolist()
                out[3] += s[best].tolist()
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["query_id", "ask", "vec_id", "score"])


def search(
    rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
    parts: int | None = None, probes: int | None = None, seed: int = 5
) -> DataFrame:
    """query_id, rank, vec_id, score: of each query row its k nearest other rows that the route finds. ``probes``
    overrides how many parts a query visits; with all of them the search is exact. Where these hold fewer than k other
    rows, the query visits further ones."""
    require(rows, id_col, vec_col)
    spark = rows.sparkSession
    clean = rows.where(usable(vec_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
        is_query.alias("asks")
    )
    router = fit(clean.select("id", "vec"), parts, k, seed)
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    depth = min(probes or router.probes, router.b2.shape[0])
    place = lambda rows, tree: staged(
        rows.select("id", "vec").transform(in_batches, lambda it: _route(it, tree), "id long, vec array<double>, part int"),
        "index"
    )
    tree = Tree(router, {})
    index = place(clean, tree)
    size = _counts(index)
    if router.deep and (below := fit_below(index, size, k, seed)):
        tree, coarse = Tree(router, below), index
        index = place(coarse, tree)
        size = _counts(index)
        drop_stage(coarse)
    repeated = index.groupBy("id").agg(F.count("*").alias("own")).where("own > 1")
    asks = clean.where("asks").select("id", "vec").distinct().join(repeated, "id", "left").select(
        "id", "vec", F.coalesce("own", F.lit(1)).alias("own")
    )
    asked = asks.transform(
        in_batches,
        lambda it: _ask(it, tree, depth, probes is not None, size, k), "id long, vec array<double>, parts array<int>"
    )
    asked = asked.select("id", "vec", F.xxhash64("vec").alias("ask"), F.explode("parts").alias("part"))
    asked = staged(asked, "asked")
    # Blocks of each cell: at most (FIT_ROWS / (4 * k)) ** 2 learned cells, and one for each other length of vectors.
    n_rows = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("row_blocks"))
    n_asked = asked.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("query_blocks"))
    blocks = F.broadcast(n_rows.join(n_asked, "part").select("part", "row_blocks", "query_blocks"))
    left = asked.join(blocks, "part").withColumn(
        "qb", F.pmod(F.xxhash64("id", F.lit(1)), "query_blocks").cast("int")
    ).withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
    right = index.join(blocks, "part").withColumn(
        "rb", F.pmod(F.xxhash64("id", F.lit(2)), "row_blocks").cast("int")
    ).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    keys = ["part", "rb", "qb"]
    found = left.select(
        *keys, "id", "ask", "vec"
    ).groupBy(*keys).cogroup(right.select(*keys, "id", "vec").groupBy(*keys))
    found = found.applyInArrow(lambda a, b: _block(a, b, k), "query_id long, ask long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "ask").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
