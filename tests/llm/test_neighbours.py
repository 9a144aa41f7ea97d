import numpy as np
from pyspark.sql import functions as F

from lociflow.llm import neighbours


def vectors(n=1500, dim=16, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(12, dim))[rng.integers(0, 12, n)] * 2 + rng.normal(size=(n, dim))
    x[100:400] = x[7]  # a vector that many rows repeat
    return [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]


BAD = [
    (1500, None), (1600, [0.0] * 16), (1700, [float("nan")] * 16), (1800, [float("inf")] + [1.0] * 15),
    (1900, [None] + [1.0] * 15), (2000, [1.0] * 3), (2100, [])
]
SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, is_query, k=10):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in ids[[is_query(i) for i in ids]]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        o = np.lexsort((ids, d))[: min(k, len(ids) - 1)]
        out[int(q)] = [(int(ids[j]), float(d[j])) for j in o]
    return out


def test_all_parts_are_exact(spark):
    rows = vectors()
    df = spark.createDataFrame(rows + BAD, SCHEMA).withColumn("part", F.lit(1))
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0, probes=16).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, lambda i: i % 100 == 0)
    assert got == {q: [(k + 1, v, s) for k, (v, s) in enumerate(found)] for q, found in want.items()}


def test_recall_of_the_route(spark):
    rows = vectors(3000)
    got = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()
    want = brute(rows, lambda i: i % 50 == 0)
    near = {(q, round(s, 9)) for q, f in want.items() for _, s in f}
    hits = sum((r.query_id, round(r.score, 9)) in near for r in got)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_few_rows(spark):
    rows = vectors(8)
    got = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()
    assert len(got) == 7
    assert neighbours.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0).count() == 0
    assert neighbours.search(spark.createDataFrame(BAD[:5], SCHEMA), F.col("vec_id") == 0).count() == 0


def test_routes_go_on_where_parts_are_small(spark, monkeypatch):
    """The first part of two holds fewer than k other rows than the query's."""
    w1, w2 = np.zeros((2, 1)), np.array([[5.0, -5.0]])
    w1[0, 0] = 1.0
    monkeypatch.setattr(
        neighbours, "fit", lambda *a: neighbours.Router(np.zeros(2), np.ones(2), w1, np.zeros(1), w2, np.zeros(2), 1, 2)
    )
    for small in (4, 10):
        rows = [(i, [1.0 if i < small else -1.0, float(i)]) for i in range(40)]
        got = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).orderBy("rank").collect()
        want = brute(rows, lambda i: i == 0)[0]
        assert [(r["rank"], r.vec_id, r.score) for r in got] == [(i + 1, *f) for i, f in enumerate(want)]
    # Rows of the query's own id are no candidates: 11 rows of the part leave 8.
    rows += [(0, [1.0, 0.5])] * 2
    got = neighbours.search(
        spark.createDataFrame([(i, [1.0 if i < 9 else -1.0, v[1]]) for i, v in rows], SCHEMA),
        (F.col("vec_id") == 0) & (F.col("embedding")[1] == 0)
    ).collect()
    assert len(got) == 10 and {r.vec_id for r in got} > set(range(1, 9))


def test_parts_are_balanced():
    x = np.array([r[1] for r in vectors(1200)], float)[400:]
    label = neighbours.balanced_parts(x, neighbours.exact_neighbours(x, x, 10, np.arange(len(x))), 8)
    assert np.bincount(label, minlength=8).max() <= np.ceil(len(x) / 8 * 1.05)


def found(spark, rows, is_query, **options):
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), is_query, **options)
    return [tuple(r) for r in got.orderBy("query_id", "rank").collect()]


def test_repeated_queries(spark):
    rows = [(i, [float(i), 1.0]) for i in range(30)]
    once = found(spark, rows, F.col("vec_id") == 0)
    assert found(spark, rows + rows[:1] * 3, F.col("vec_id") == 0) == once and len(once) == 10
    both = found(spark, [*rows, (0, [29.0, 1.0])], F.col("vec_id") == 0)
    assert sorted(v for _, _, v, _ in both) == sorted([*range(1, 11), *range(20, 30)])


def test_components_of_any_size(spark):
    for unit in (1e200, 1e-200, 1e307):
        rows = [(i, [i * unit, unit]) for i in range(1, 17)]
        got = found(spark, rows, F.col("vec_id") == 1)
        assert [v for _, _, v, _ in got] == list(range(2, 12))
        assert np.allclose([s / unit for *_, s in got], range(1, 11))
    rows = [(i, [i * 1e-200, 1e-200]) for i in range(1, 40)] + [(100 + i, [1e200 * i, 1e200]) for i in range(1, 40)]
    assert [v for _, _, v, _ in found(spark, rows, F.col("vec_id") == 1)] == list(range(2, 12))


def test_other_lengths_are_searched_among_their_own(spark):
    rows = [(i, [float(i), 1.0, 2.0]) for i in range(50)] + [(100 + i, [float(i), 1.0]) for i in range(5)]
    got = found(spark, rows, F.col("vec_id").isin(0, 100))
    assert [v for q, _, v, _ in got if q == 0] == list(range(1, 11)) and [
        v for q, _, v, _ in got if q == 100
    ] == [101, 102, 103, 104]


def test_clustered_vectors_prune(spark, monkeypatch):
    """Recall of 0.9 from under half of the rows."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(64, 16))[rng.integers(0, 64, 6000)] * 4 + rng.normal(size=(6000, 16)) * 0.5
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    seen, real = [], neighbours.fit
    monkeypatch.setattr(neighbours, "fit", lambda *a: seen.append(real(*a)) or seen[-1])
    got = found(spark, rows, F.col("vec_id") % 50 == 0)
    assert seen[0].probes < 0.5 * len(seen[0].b2)
    d = ((x[::50, None] - x[None]) ** 2).sum(2)
    d[np.arange(len(d)), np.arange(0, 6000, 50)] = np.inf
    near = {(q * 50, v) for q, row in enumerate(np.argsort(d, 1)[:, :10].tolist()) for v in row}
    assert len({(q, v) for q, _, v, _ in got} & near) >= 0.9 * len(near)


def test_parts_are_cut_again(spark, monkeypatch):
    """More rows than the sample has parts for: cells of cells, with the same recall, from under half of the rows."""
    monkeypatch.setattr(neighbours, "FIT_ROWS", 480)
    monkeypatch.setattr(neighbours, "PART_ROWS", 60)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 12))[rng.integers(0, 40, 8000)] * 5 + rng.normal(size=(8000, 12)) * 0.5
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, [1.0, 2.0])]
    seen, real, fit = [], neighbours.fit_below, neighbours.fit
    monkeypatch.setattr(neighbours, "fit", lambda v, p, k, s: fit(v, p, k, s, 480))
    monkeypatch.setattr(neighbours, "fit_below", lambda *a: seen.append(real(*a)) or seen[-1])
    got = found(spark, rows, F.col("vec_id") % 50 == 0)
    assert len(seen[0]) > 4 and all(len(r.b2) > 1 for r in seen[0].values())
    d = ((x[::50, None] - x[None]) ** 2).sum(2)
    d[np.arange(len(d)), np.arange(0, 8000, 50)] = np.inf
    near = {(q * 50, v) for q, row in enumerate(np.argsort(d, 1)[:, :10].tolist()) for v in row}
    assert len({(q, v) for q, _, v, _ in got} & near) >= 0.9 * len(near) and len(got) == 10 * len(d)
    exact = found(spark, rows, F.col("vec_id") % 50 == 0, probes=1000)
    assert {(q, v) for q, _, v, _ in exact} == near


def test_routes_visit_further_cells():
    """Of the parts visited the probable cells come first, then their others, then those of further parts."""
    plain = lambda n, probes: neighbours.Router(np.zeros(1), np.ones(1), np.zeros((1, 1)), np.zeros(1), np.zeros((1, n)), -np.arange(n, dtype=float), probes, 1)
    tree, w = neighbours.Tree(plain(3, 1), {0: plain(3, 1), 2: plain(2, 1)}), neighbours.WIDE
    size = {0: 1, 1: 2, 2: 3, w: 4, 2 * w: 5, 2 * w + 1: 6}
    routes = lambda need, depth=1, whole=False: tree.routes(np.zeros((1, 1)), depth, whole, size, np.array([need]))[0]
    assert routes(1) == [0] and routes(2) == [0, 1] and routes(7) == [0, 1, 2, w] and routes(99) == [0, 1, 2, w, 2 * w, 2 * w + 1]
    assert routes(1, 2) == [0, w] and routes(1, 1, True) == [0, 1, 2]
