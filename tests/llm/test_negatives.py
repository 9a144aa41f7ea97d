import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lociflow.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int, `id` string, `score` int, `a b` string"


def floors(v):
    return [int(np.floor(256.0 * x)) for x in v]


def plain(rows, anchor=lambda i: i % 50 == 0, positives=5, n=3, low=50, high=95):
    """The contract by sorting all scores, in Python's own integers."""
    rows = [
        (r[0], floors(r[1]), r[2]) for r in rows
        if r[2] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])
    ]
    out, seen = [], set()
    last = lambda i: (i is None, i)
    for a, va, la in rows:
        if a is None or not anchor(a) or (a, tuple(va), la) in seen:
            continue
        seen.add((a, tuple(va), la))
        scored = [(sum(x * y for x, y in zip(va, v, strict=True)), i, c) for i, v, c in rows if len(v) == len(va) and i != a]
        scored.sort(key=lambda x: (-x[0], last(x[1])))
        for p, i, _ in [x for x in scored if x[2] == la][:positives]:
            fit = [x for x in scored if x[2] != la and low * p <= 100 * x[0] <= high * p][:n]
            out += [(a, i, k + 1, j, p, s) for k, (s, j, _) in enumerate(fit)]
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA).repartition(3)


def mined(spark, rows, **options):
    out = negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0, **options)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def awkward(seed, size=400, dim=8):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=dim) + (i % 3)).tolist(), int(rng.integers(0, 4))) for i in range(size)]
    same = rows[7][1]
    for i in range(0, size, 3):  # a third of the rows has one vector, and most of those one label
        rows[i] = (i, same, 1 if i % 9 else rows[i][2])
    return rows + [
        (1000, None, 1), (1001, [], 1), (1050, [], 2), (1002, [1.0] * (dim - 1) + [None], 1), (1003, [float("nan")] * dim, 1),
        (1004, [float("inf")] * dim, 1), (1005, [0.0] * dim, 1), (1100, [0.0] * dim, 2), (1006, [1.0] * dim, None),
        (None, [2.0] * dim, 1), (None, [2.0] * dim, 2), (1150, [1.0] * (dim + 1), 1), (1007, [1.0] * (dim + 1), 1),
        (1008, [0.8] * (dim + 1), 3), (-50, rows[8][1], 2), rows[1], rows[50], rows[51], (50, [1.5] * dim, 1)
    ]


@pytest.mark.parametrize(("seed", "blocks"), [(1, (1024, 2048)), (2, (3, 7))])
def test_mine(spark, monkeypatch, seed, blocks):
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", blocks[0])
    monkeypatch.setattr(negatives, "BLOCK_ROWS", blocks[1])
    rows = awkward(seed)
    want = plain(rows)
    assert len(want) > 20 and mined(spark, rows) == want


def test_groups_of_anchors_give_the_same(spark):
    rows = awkward(3, 250)
    want = plain(rows, positives=2, n=4, low=20, high=80)
    assert want and mined(spark, rows, positives=2, negatives=4, low=20, high=80, group_bytes=300) == want


def test_large_components_stay_exact(spark):
    """Products between 2**53 and 2**63, where neighbouring integers are one in float64."""
    rng = random.Random(4)
    rows = [(i, [float(rng.randrange(1 << 20, 1 << 21)) for _ in range(6)], i % 2) for i in range(120)]
    want = plain(rows)
    assert want and max(r[4] for r in want) > 1 << 53 and mined(spark, rows) == want


def test_scores_that_no_long_holds_saturate(spark):
    rows = [(i, [1e30, float(i)], i % 2) for i in range(60)]
    assert all(r[4] == (1 << 63) - 1 for r in mined(spark, rows))


def test_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(50, [1.0], None), (100, None, 1)]) == []


def test_window():
    for p in [-250, -100, -1, 0, 1, 2, 19, 20, 21, 99, 100, 101, 12345, (1 << 62) + 1]:
        low, high = negatives.window_of(np.int64(p), 50, 95)
        assert (int(low), int(high)) == (-(-p * 50 // 100), p * 95 // 100)


def test_query_against_sql(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) + 0.5).tolist(), int(rng.integers(0, 10))) for i in range(600)]
    rows += [(700, None, 3), (750, [0.5] * 6, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op11_hard_negatives(spark, str(tmp_path))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        want = db.execute(queries.SQL["op11_hard_negatives"]).fetchall()
    assert len(want) > 30 and sorted(map(tuple, got.collect())) == sorted(want)
