from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lociflow.llm import mixing
from tests.llm.data import documents, frame, multiset, words


def water_fill(sizes, weights, epochs=3):
    """Clamp and share again until nothing is above its cap."""
    total, clamped = sum(sizes.values()), {}
    while True:
        free = {s: weights[s] for s in sizes if s not in clamped}
        left = total - sum(clamped.values())
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in share if share[s] > epochs * sizes[s]]
        if not over:
            return clamped | share
        clamped |= {s: epochs * sizes[s] for s in over}


def test_targets_and_taken(spark):
    rows = documents()
    got = mixing.mix_plan(frame(spark, rows)).collect()
    assert multiset((r.doc_id, r.size) for r in got) == multiset((r[0], len(words(r[1]))) for r in rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.repeats * r["size"] + r.extra
    order = sorted([s for s in sizes if s is not None]) + [None]
    want = water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    assert multiset(got) == multiset(mixing.mix_plan(frame(spark, rows)).collect())


def test_small_sources_are_clamped(spark):
    rows = [
        (i, "w " * n, None, s, None, None, None, None) for i,
        (n, s) in enumerate([(10, "a"), (500, "b"), (300, "c"), (0, "d")])
    ]
    got = {r.source: r for r in mixing.mix_plan(frame(spark, rows)).collect()}
    assert got["a"].target == 30.0 and got["a"].taken == 30 and got["d"].taken == 0
    assert got["b"].target == pytest.approx(780 * 2 / 3) and got["c"].target == pytest.approx(260)


def test_mix_repeats_documents(spark):
    rows = [(i, "w " * 10, "en", f"s{i % 2}", 1, 1, "r", None) for i in range(100)]
    out = mixing.mix(frame(spark, rows))
    assert out.columns == [*frame(spark, rows).columns]
    counts = defaultdict(int)
    for r in out.collect():
        counts[r.source] += 1
    assert counts == {"s0": 71, "s1": 29}


def test_clashing_names(spark):
    names = ["copies", "size", "copy", "__n", "__id", "c0", "repeats"]
    docs = frame(spark, documents()).select("*", *[F.lit(777).alias(n) for n in names])
    out = mixing.mix(docs)
    assert out.columns == docs.columns and [tuple(r) for r in out.select(*names).distinct().collect()] == [(777,) * len(names)]
    plain = mixing.mix(frame(spark, documents()))
    assert multiset(out.drop(*names).collect()) == multiset(plain.collect())


def test_null_ids_are_told_apart_by_their_texts(spark):
    rows = [(None, f"w{i} " * 10, None, f"s{i % 2}", *[None] * 4) for i in range(200)]
    counts = [r["count"] for r in mixing.mix(frame(spark, rows)).groupBy("text").count().collect()]
    assert 100 < len(counts) <= 200 and abs(sum(counts) - 200) <= 2


def test_empty(spark):
    assert mixing.mix_plan(frame(spark, [])).count() == 0 and mixing.mix(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_plan(frame(spark, []).drop("source"))
