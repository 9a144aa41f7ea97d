import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from lociflow.llm import queries, ranked_search
from tests.llm.data import documents, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(rows, items, k=20):
    """The contract by scoring every document for every item."""
    docs = [(i, terms(t)) for i, t in rows]
    docs = [(i, w, Counter(w)) for i, w in docs if w]
    n, total = len(docs), sum(len(w) for _, w, _ in docs)
    df = Counter(t for *_, c in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in {x for x in items if x[1] is not None}:
        found = []
        for i, w, c in docs:
            m = 75 + 25 * len(w) * n // total
            s = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def searched(spark, rows, items, **options):
    docs = frame(spark, [(i, t, *[None] * 6) for i, t in rows])
    asked = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, `rank` int")
    out = ranked_search.search(docs, asked, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def corpus(seed, size=120):
    rows = [r[:2] for r in documents(seed, size)]
    rows += [(5000 + i, "The SAME text, of é-terms and x") for i in range(60)] + [rows[3], (None, "the and of x"), (7, "the")]
    items = [(i, t) for i, (_, t) in enumerate(rows[::7]) if t is None or len(t) < 3000]
    return rows, items + [
        (900, "the same the same text"), (901, None), (902, ""), (903, " -- "), (904, "nowhere_found zzzzq"),
        (None, "of é"), items[1], (905, "of"), (905, "x Zz9 X"), (906, "é É"), (907, "the " * 500)
    ]


@pytest.mark.parametrize(("seed", "block", "together", "k"), [(1, 16_384, 8, 20), (2, 7, 2, 3), (3, 50, 1, 1)])
def test_search(spark, monkeypatch, seed, block, together, k):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranked_search, "TOGETHER", together)
    rows, items = corpus(seed)
    want = plain(rows, items, k)
    assert len(want) > 20 and searched(spark, rows, items, k=k) == want


def test_groups_of_items_give_the_same(spark):
    rows, items = corpus(4, 30)
    items = [x for x in items if x[1] is None or len(x[1]) < 300]
    assert searched(spark, rows, items, group_bytes=600) == plain(rows, items)


def test_empty(spark):
    assert searched(spark, [], [(1, "a")]) == [] and searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None), (2, " ")], [(1, "a"), (2, None)]) == []


def test_treaps():
    rng = np.random.default_rng(1)
    impact = rng.integers(0, 20, 500)
    start = np.array([0, 0, 3, 200, 200, 500])
    root, left, right = ranked_search.treaps(start, impact)

    def order(node):
        if node < 0:
            return []
        for child in (left[node], right[node]):
            assert child < 0 or impact[child] <= impact[node]
        return [*order(left[node]), int(node), *order(right[node])]

    for t, r in enumerate(root.tolist()):
        assert order(r) == list(range(start[t], start[t + 1]))


def test_walks_prune():
    """With a few outstanding documents most of the others are not scored."""
    rng = np.random.default_rng(2)
    n = 20_000
    doc = np.concatenate([np.sort(rng.choice(n, 5000, replace=False)) for _ in range(4)])
    term = np.repeat(np.arange(4), 5000)
    impact = rng.integers(1, 100, len(doc))
    impact[np.isin(doc, doc[:25])] = 1000
    block = ranked_search.Block(np.arange(n), doc, term, impact, 4)
    first = ranked_search.First(1, 20)
    visited = ranked_search.walk(block, np.array([0]), np.array([[0, 1, 2, 3, -1]]), np.array([[1, 2, 1, 1, 0]]), first)
    total = np.zeros(n, np.int64)
    np.add.at(total, doc, impact * np.array([1, 2, 1, 1])[term])
    best = np.lexsort((np.arange(n), -total))[:20]
    assert first.id[0].tolist() == best.tolist() and first.score[0].tolist() == total[best].tolist()
    assert visited < 1000


def test_query_against_sql(spark, tmp_path):
    rows, items = corpus(6, 60)
    ids = iter(range(10**6))
    rows = [(next(ids), t) for _, t in rows]
    frame(spark, [(i, t, *[None] * 6) for i, t in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(i, t) for i, (_, t) in enumerate(items)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op13_ranked_search(spark, str(tmp_path))
    with duckdb.connect() as db:
        for t in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet/*.parquet'")
        want = db.execute(queries.SQL["op13_ranked_search"]).fetchall()
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == sorted(want) == sorted(plain(rows, items))
