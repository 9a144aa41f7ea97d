import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lociflow.llm import jaccard, substring_dedup, suffix_dedup
from lociflow.llm._components import components
from lociflow.llm._text import spans_union
from tests.llm.data import documents, frame, multiset, words

BIG = 1 << 62


def removed_words(rows, window):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, BIG), BIG if i is None else i)
    out = []
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < (BIG if i is None else i):
                gone[p : p + window] = [True] * window
        out.append(
            (
                i, len(w), sum(gone),
                hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()
            )
        )
    return multiset(out)


@pytest.mark.parametrize(("window", "gram", "split"), [(13, 5, 5000), (13, 5, 0), (4, 2, 2), (3, 3, 5000)])
def test_substring_dedup(spark, window, gram, split):
    rows = documents()
    got = substring_dedup.dedup(frame(spark, rows), window, gram, split).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256)
    ).collect()
    assert multiset(got) == removed_words(rows, window)


def removed_bytes(rows, window):
    texts = [(r[1] or "").encode() for r in rows]
    count = Counter(t[p : p + window] for t in texts for p in range(len(t) - window + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - window + 1):
            if count[t[p : p + window]] > 1:
                gone[p : p + window] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append(
            (r[0], len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest())
        )
    return multiset(out)


@pytest.mark.parametrize(("window", "gram", "split"), [(200, 64, 5000), (200, 64, 0), (20, 8, 3)])
def test_suffix_dedup(spark, window, gram, split):
    rows = [*documents(), (900, "ab\0\0\0" * 30 + "x" * 300, *[None] * 6), (901, "ab\0\0\0" * 12 + "y", *[None] * 6)]
    got = suffix_dedup.dedup(frame(spark, rows), window, gram, split).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)
    ).collect()
    assert multiset(got) == removed_bytes(rows, window)


def linked(rows, n=5):
    sets = []
    for r in rows:
        w = [x.lower() for x in words(r[1])]
        sets.append(
            frozenset(tuple(w[p : p + n]) for p in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
        )
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                group[find(i)] = find(j)
    least = defaultdict(lambda: BIG)
    for i, r in enumerate(rows):
        least[find(i)] = min(least[find(i)], BIG if r[0] is None else r[0])
    return multiset((r[0], len(sets[i]), None if least[find(i)] == BIG else least[find(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize(("seed", "all_pairs"), [(1, 8), (2, 2), (3, 3)])
def test_jaccard_join(spark, seed, all_pairs):
    rows = documents(seed, 90)
    got = jaccard.join(frame(spark, rows), all_pairs=all_pairs).collect()
    assert multiset(got) == linked(rows)


def test_jaccard_at_the_threshold(spark):
    """Sets of all small sizes that just link, or just don't."""
    rows = []
    for n in range(1, 40):
        base = [f"w{n}x{i}" for i in range(n + 4)]
        for k in (0, 1, 2, 3, n // 7, n // 7 + 1, n // 4, n // 3):
            rows.append((len(rows), " ".join(base[: max(1, len(base) - k)]), *[None] * 6))
            rows.append((len(rows), " ".join(base + [f"y{i}" for i in range(k)]), *[None] * 6))
    assert multiset(jaccard.join(frame(spark, rows), all_pairs=2).collect()) == linked(rows)


def test_near_copies_of_one_text(spark):
    """A group beyond all_pairs, each copy with changes of its own, beside texts that share only a passage."""
    base = [f"b{i}" for i in range(200)]
    rows = []
    for k in range(40):
        w = list(base)
        w[(k * 5) % 200] = f"c{k}"
        rows.append((k, " ".join(w), *[None] * 6))
    for k in range(40):
        rows.append((100 + k, " ".join(base[:60] + [f"d{k}_{i}" for i in range(60 + k % 3)]), *[None] * 6))
    assert multiset(jaccard.join(frame(spark, rows), all_pairs=4).collect()) == linked(rows)


def test_repeated_rows_give_one_set(spark, monkeypatch):
    """Prefix filtering counts the tokens of a set's rows, so it must see each set once."""
    base = [f"b{i}" for i in range(200)]
    rows = []
    for k in range(40):
        w = list(base)
        w[(k * 5) % 200] = f"c{k}"
        rows += [(k if k % 3 else None, " ".join(w), *[None] * 6)] * (1 + k % 4)
    seen = []
    real = jaccard.prefix_pairs
    monkeypatch.setattr(
        jaccard, "prefix_pairs",
        lambda sets: (seen.extend(r.node for r in sets.select("node").collect()), real(sets))[1]
    )
    assert multiset(jaccard.join(frame(spark, rows), all_pairs=4).collect()) == linked(rows)
    assert seen and len(seen) == len(set(seen))


def test_keep_one(spark):
    rows = documents(4)
    want = {c for _, _, c in linked(rows)}
    kept = jaccard.keep_one(frame(spark, rows)).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert sorted(ids) == sorted(c for c in want if c is not None)


def test_keep_one_of_each_group(spark):
    """Texts of one id in several groups, a near copy under the same id, groups without any id."""
    say = lambda k, end="": " ".join(f"g{k}w{i}" for i in range(60)) + end
    rows = [
        (1, say(0)), (1, say(1)), (1, say(1, " x")), (2, say(1, " y")), (3, say(2)), (3, say(2)), (None, say(2)),
        (None, say(3)), (None, say(3)), (None, say(3, " z")), (None, say(4)), (4, ""), (4, ""), (None, ""), (None, "")
    ]
    kept = jaccard.keep_one(frame(spark, [(*r, *[None] * 6) for r in rows])).collect()
    assert sorted(
        (r.text.split()[0][:2], r.doc_id or 0) for r in kept if r.text
    ) == [("g0", 1), ("g1", 1), ("g2", 3), ("g3", 0), ("g4", 0)]
    assert sorted(r.doc_id or 0 for r in kept if not r.text) == [0, 0, 4]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 101), (101, 102), (102, 100), (50, 50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}


@pytest.mark.parametrize("op", [jaccard.join, jaccard.keep_one, substring_dedup.dedup, suffix_dedup.dedup])
def test_empty_tables(spark, op):
    assert op(frame(spark, [])).count() == 0
    assert op(frame(spark, [(1, None, *[None] * 6), (2, "", *[None] * 6)])).count() == 2


def test_spans_union():
    s, e = spans_union(np.array([5, 1, 3, 9]), np.array([6, 3, 4, 9]))
    assert s.tolist() == [1, 5, 9] and e.tolist() == [4, 6, 9]


def test_suffix_automaton():
    sam = substring_dedup.SuffixAutomaton()
    sam.add([1, 2, 3, 1, 2], 7)
    sam.add([2, 3, 1, 1], 3)
    sam.close()
    row, place, owner = substring_dedup.Frozen(sam.freeze()).owners(
        np.array([1, 2, 3, 1, 1, 2, 9, 1, 2], np.uint64), np.array([0, 9]), 2
    )
    assert not row.any() and place.tolist() == list(range(8))
    assert owner.tolist() == [7, 3, 3, 3, 7, BIG * 2 - 1, BIG * 2 - 1, 7]


@pytest.mark.parametrize("window", [1, 2, 4])
def test_matching_statistics_against_all_substrings(window):
    rng = np.random.default_rng(window)
    strings = lambda n: [rng.integers(1, 4, rng.integers(0, 14)).tolist() for _ in range(n)]
    reference, read = strings(25), strings(40)
    sam, first = substring_dedup.SuffixAutomaton(), {}
    for owner, x in enumerate(reversed(reference)):
        sam.add(x, owner)
        for i in range(len(x) - window + 1):
            first.setdefault(tuple(x[i : i + window]), owner)
    sam.close()
    ends = np.cumsum([0, *map(len, read)])
    got = substring_dedup.Frozen(sam.freeze()).owners(np.array([t for x in read for t in x], np.uint64), ends, window)
    want = {
        (r, i): first.get(tuple(x[i : i + window]), BIG * 2 - 1) for r,
        x in enumerate(read) for i in range(len(x) - window + 1)
    }
    assert {(r, i): o for r, i, o in zip(*(a.tolist() for a in got), strict=True)} == want


@pytest.mark.parametrize(("shard_tokens", "broadcast_bytes"), [(50, 0), (50, 1 << 20), (1000, 0), (1000, 1 << 20)])
def test_shards_of_any_size(spark, monkeypatch, shard_tokens, broadcast_bytes):
    """Many shards or few, broadcast or dealt to tasks: the same result, from as many jobs."""
    monkeypatch.setattr(substring_dedup, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(substring_dedup, "TOKEN_BYTES", 40)
    rows = documents(5, 30)
    got = substring_dedup.dedup(frame(spark, rows), 6, 3, broadcast_bytes=broadcast_bytes).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256)
    ).collect()
    assert multiset(got) == removed_words(rows, 6)


def test_eight_shards_in_two_tasks():
    """Shards follow each other in a task; each is held alone, and a batch may end within one."""
    rng = np.random.default_rng(3)
    rows = []
    for shard in range(8):
        base = rng.integers(1, 1 << 62, 30, dtype=np.uint64)
        rows += [(shard, 10 - k, k, 100 * k, base[k : k + 20].tobytes()) for k in range(4)]
    schema = pa.schema([(n, pa.int64()) for n in ("shard", "rid", "th", "start")] + [("tokens", pa.binary())])
    table = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
    got = []
    for half in (table.slice(0, 16), table.slice(16)):
        for out in substring_dedup._shard_by_shard(iter(half.to_batches(max_chunksize=3)), 5):
            got += zip(*(c.to_pylist() for c in out.columns), strict=True)
    # The passage after one's own has a smaller id and covers all of its windows but the first.
    assert sorted(got) == sorted((rid, th, (start + 1) << 24 | 15 << 4) for _, rid, th, start, _ in rows if rid > 7)


def same_hash(spark):
    """Two texts of many words whose 32-bit hashes agree."""
    words = F.concat_ws(" ", *[F.format_string(f"w{k}x%d", F.col("id")) for k in range(40)])
    texts = spark.range(200_000).select("id", F.hash(words).alias("h"), words.alias("t"))
    pair = texts.groupBy("h").agg(F.collect_list("t").alias("ts")).where(F.size("ts") > 1).first()
    return pair.ts[:2]


def test_texts_of_one_short_hash(spark):
    """Null ids and one id with several texts: what repeats nowhere stays, whatever its hash."""
    a, b = same_hash(spark)
    rows = [(1, a, *[None] * 6), (None, a, *[None] * 6), (None, b, *[None] * 6), (1, b + " end", *[None] * 6)]
    got = substring_dedup.dedup(frame(spark, rows)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert multiset(got.collect()) == removed_words(rows, 13)
    rows = rows[:3] + [(1, "c " + b[::-1], *[None] * 6)]
    got = substring_dedup.dedup(frame(spark, rows)).collect()
    assert [r.n_removed for r in got if r.kept == b] == [0]
    got = suffix_dedup.dedup(frame(spark, rows)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)
    ).collect()
    assert multiset(got) == removed_bytes(rows, 200)


def test_keep_one_with_clashing_names(spark):
    names = ["rid", "th", "k", "__id", "__n", "c1", "root"]
    docs = frame(spark, documents()).drop("rid")
    wide = docs.select("*", *[F.lit(777).alias(n) for n in names])
    out = jaccard.keep_one(wide)
    assert out.columns == wide.columns and [tuple(r) for r in out.select(*names).distinct().collect()] == [(777,) * len(names)]
    assert multiset(out.select("doc_id", "text").collect()) == multiset(jaccard.keep_one(docs).select("doc_id", "text").collect())


def test_blocks_of_a_common_token(spark, monkeypatch):
    """Sets with one rare token meet in blocks of any size; the links are the same."""
    rows = documents(6, 80)
    want = multiset(jaccard.join(frame(spark, rows), all_pairs=2).collect())
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 2)
    assert multiset(jaccard.join(frame(spark, rows), all_pairs=2).collect()) == want


def test_texts_are_dealt_out_twice(spark, monkeypatch):
    """Once for both ways of comparing and once for the cut, where every minimiser is compared singly too."""
    dealt = []
    own = suffix_dedup.anchors.with_texts
    monkeypatch.setattr(suffix_dedup.anchors, "with_texts", lambda *a: dealt.append(1) or own(*a))
    docs = spark.createDataFrame([(i, f"{i}abcdefghijklmnop{i}") for i in range(5)], "doc_id long, text string")
    got = suffix_dedup.dedup(docs, 12, 8, 0).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(i, 16) for i in range(5)] and len(dealt) == 2
