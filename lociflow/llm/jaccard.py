"""Near duplicates by an exact join on the Jaccard similarity of word n-grams.

Two sets link if ``100 * intersection >= 75 * union``; then their sizes differ by a third at most, and so many
tokens at most, a seventh of both sizes together, stand in one of them alone. Universe partitioning turns that
into equality: by size band, a hash deals all tokens to segments. With g segments that tell something about a
set and fewer than g differing tokens, one segment holds the same tokens in both sets. Segments are indexed by
the hash of their tokens; a segment may also be indexed with each one of its tokens left out, and then counts
for two, since it shows a single difference as well. For each band a cost model picks how many segments there
are and whether they carry one-deletion neighbourhoods.

Empty segments tell nothing, and one well-covered side of a pair suffices. Sets that share an entry are
candidates: all pairs of a small group, pairs with the least member of a larger one. The larger group's entry is
then lost to its members. Sets that are left with too few entries, by empty segments or by lost entries, also join
each other by prefix filtering, rarest tokens first, but only across the components found so far: a group of
thousands of near copies costs nothing more, and no link between components is lost.

A bitmap of each set, in which every token flips one bit, bounds the difference of a pair from below and drops
most chance candidates; the others are verified on the full sets.

Edge cases: a null or empty text has an empty set and links with nothing; a text with fewer than n words has its
whole sequence as its only token; very long texts are read whole, in a batch of their own; a null doc_id counts as
larger than any other; repeated rows link; of members with one doc_id that with the least hash of its text is the
first; an empty table gives an empty result; other columns are not read by ``join`` and go through ``keep_one``
unchanged, whatever their names. Tokens and sets are 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm import _anchors as anchors
from lociflow.llm._components import components
from lociflow.llm._stage import buckets, drop_stage, staged
from lociflow.llm._text import Rolling, WordHashes, in_batches, mix, numbered, small_batches

N = 5
#: Groups of up to so many sets give all their pairs.
ALL_PAIRS = 8
#: Sets compared with one set in one task.
SALT_ROWS = 256
#: Cost model: entries cost 1 each, and an entry of j tokens meets other sets in proportion to COMMON ** j.
COMMON, MEETING = 0.01, 50.0
BLOCK_ROWS = 750_000
#: Sets with one rare token that are compared with as many others in one task.
BLOCK_SETS = 2_000


def bands(most: int = 1 << 40) -> np.ndarray:
    """Least sizes of the bands; a set of one band can only link with the same band or its neighbours. Wide bands
    spare most sets their second indexing; small sets have narrow ones, as their few segments must fit."""
    out = [1]
    while out[-1] < most:
        out.append(2 * out[-1] if out[-1] >= 16 else max(out[-1] + 1, 4 * (out[-1] - 1) // 3 + 1))
    return np.array(out, np.int64)


BANDS = bands()


def differing(n: int, limit: int | None = None) -> int:
    """Most tokens in which a set of n tokens differs from one that links with it and is no larger than limit."""
    other = 4 * n // 3 if limit is None else min(4 * n // 3, limit)
    return (n + other) // 7


def _gain(n: int, m: int, deletion: bool) -> float:
    """What m segments of a set of n tokens tell, less three standard deviations."""
    empty = (1 - 1 / m) ** n if m > 1 else 0.0
    if not deletion:
        mean = m * (1 - empty)
        var = m * empty * (1 - empty) - m * (m - 1) * max(0.0, empty**2 - (1 - 2 / m) ** n) if m > 2 else 0.0
        return min(n, mean) - 3 * math.sqrt(max(0.0, var))
    one = n / m * (1 - 1 / m) ** (n - 1) if m > 1 else float(n == 1)
    return m * (2 * (1 - empty - one) + one) - 3 * math.sqrt(max(0.0, m * (4 * empty + one)))


def _cost(n: int, m: int, deletion: bool) -> float:
    x = n / m
    size = np.arange(1, max(3, int(x + 6 * math.sqrt(x) + 3)))
    p = m * np.exp(-x + size * math.log(x) - np.array([math.lgamma(s + 1) for s in size]))
    cost = (p * (1 + MEETING * COMMON**size)).sum()
    return cost + (p * size * (size > 1) * (1 + MEETING * COMMON ** (size - 1))).sum() if deletion else cost


@lru_cache(None)
def allocation(band: int) -> tuple[int, bool]:
    """Segments of a band and whether they carry one-deletion neighbourhoods: the cheapest allocation that
    covers all sets of the band and of the next."""
    lo, mid, hi = (int(x) for x in BANDS[band : band + 3])
    hi = min(hi, 4 * (mid - 1) // 3 + 1)  # larger sets of the next band have no partner in this one
    sizes = [
        (lo, differing(lo)), (mid - 1, differing(mid - 1)), (mid, differing(mid, mid - 1)),
        (hi - 1, differing(hi - 1, mid - 1))
    ]
    best: tuple[float, int, bool] | None = None
    for deletion in (False, True):
        covers = lambda m: all(_gain(n, m, deletion) >= h + 1 for n, h in sizes)  # noqa: E731, B023
        m = next(
            (m for m in (max(1, int(hi * f / 200)) for f in range(1, 401)) if covers(m)), None
        ) if hi > 24 or not deletion else next((m for m in range(1, 2 * hi + 1) if covers(m)), None)
        if m and (best is None or _cost(mid, m, deletion) < best[0]):
            best = (_cost(mid, m, deletion), m, deletion)
    return best[1:] if best else (2 * hi, False)


def shingle_sets(texts: list[bytes], hashes: WordHashes, n: int = N) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; letter case folds within ASCII."""
    toks, ends = hashes.flat([t.lower().split() for t in texts])
    roll = Rolling(toks)
    grams = roll.grams(n)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        else:
            out.append(roll.of(np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64))
    return out


def set_hash(tokens: np.ndarray) -> int:
    h = int((mix(tokens + np.uint64(0xA5A5)).sum(dtype=np.uint64) + np.uint64(len(tokens))).item())
    h &= ~1  # even: the last bit of an index entry tells the role
    return h - (1 << 64) if h >= 1 << 63 else h


_ODD = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def signatures(sets: list[np.ndarray], node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Index entries (hash, node + role) of non-empty sets, and for each set and role its (node + role, spare):
    how many entries may be lost before the others no longer suffice. Nodes are even; role 1 is that towards
    partners of the band below."""
    size = np.array([len(s) for s in sets], np.int64)
    toks = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(sets)), size)
    own = np.searchsorted(BANDS, size, "right") - 1
    t = mix(toks + _ODD[0])
    value = mix(t * _ODD[0])
    sigs, nodes, holders, spares = [], [], [], []
    for role in (0, 1):
        band = own - role
        limit = np.where(role, BANDS[own] - 1, 4 * size // 3)
        live = np.flatnonzero((band >= 0) & (4 * limit >= 3 * size))
        if not len(live):
            continue
        needed = (size + np.minimum(4 * size // 3, limit)) // 7 + 1
        plan = {int(b): allocation(int(b)) for b in np.unique(band[live])}
        m, deletion = np.zeros(len(sets), np.int64), np.zeros(len(sets), bool)
        m[live] = [plan[int(b)][0] for b in band[live]]
        deletion[live] = [plan[int(b)][1] for b in band[live]]
        take = np.flatnonzero(m[of])
        r = of[take]
        base = np.cumsum(m) - m
        key = base[r] + (((t[take] >> np.uint64(32)) * m[r].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        total = int(m.sum())
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, key, value[take])
        count = np.bincount(key, minlength=total)
        holder = np.repeat(np.arange(len(sets)), m)
        place = (np.arange(total) - base[holder]).astype(np.uint64) * _ODD[2] + (band + 1).astype(np.uint64)[holder] * _ODD[1]
        full = np.flatnonzero(count)
        sigs.append(mix(sums[full] + place[full]))
        nodes.append(node[holder[full]] + role)
        less = np.flatnonzero(deletion[r] & (count[key] > 1))
        if len(less):
            sigs.append(mix(sums[key[less]] - value[take[less]] + place[key[less]]))
            nodes.append(node[r[less]] + role)
        gain = np.bincount(
            holder, np.where(deletion[holder], np.minimum(count, 2), np.minimum(count, 1)), len(sets)
        ).astype(np.int64)
        spare = gain - needed
        holders.append(node[live] + role)
        # An entry of a segment with deletions may stand for two.
        spares.append(np.where(deletion, spare // 2, spare)[live])
    if not sigs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(sigs), np.concatenate(nodes), np.concatenate(holders), np.concatenate(spares)


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity bitmap of about two bits for each token, a power of two in length and at least 64."""
    size = max(64, 1 << int(2 * len(tokens)).bit_length())
    bits = np.bincount((mix(tokens ^ _ODD[2]) >> np.uint64(16)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """Tokens in which two sets differ at least; the longer bitmap folds onto the shorter."""
    x, y = (np.frombuffer(t, np.uint64) for t in (a, b))
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _members(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for part, texts in small_batches(batches):
        sets = shingle_sets(texts, hashes, n)
        rid, th = (part.column(part.schema.get_field_index(c)) for c in ("rid", "th"))
        yield pa.RecordBatch.from_arrays(
            [
                rid, th, pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary())
            ],
            ["rid", "th", "n", "node", "bits"]
        )


def _entries(batches: Iterator[pa.RecordBatch], n: int, buckets: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    held: list[tuple[np.ndarray, ...]] = []

    def send() -> pa.RecordBatch:
        sig, node, holder, spare = (np.concatenate([h[i] for h in held]) for i in range(4))
        held.clear()
        by = (sig >> np.uint64(20)) % np.uint64(buckets)
        o = np.argsort(by, kind="stable")
        cut = np.searchsorted(by[o], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cut))
        blocks = [sig[o[cut[b] : cut[b + 1]]].tobytes() + node[o[cut[b] : cut[b + 1]]].tobytes() for b in full]
        spares = [b""] * len(full)
        spares[0] = holder.tobytes() + spare.tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array(blocks, pa.binary()), pa.array(spares, pa.binary())],
            ["bucket", "block", "spares"]
        )

    for _, texts in small_batches(batches):
        distinct = {set_hash(s): s for s in shingle_sets(texts, hashes, n) if len(s)}
        if not distinct:
            continue
        held.append(signatures(list(distinct.values()), np.fromiter(distinct, np.int64, len(distinct))))
        if sum(len(h[0]) for h in held) >= BLOCK_ROWS:
            yield send()
    if held:
        yield send()


#: Kinds of rows of the candidate table: a pair; entries that a set may lose; entries that it has lost.
PAIR, SPARE, LOST = 0, 1, 2


def _halves(blocks: list[bytes], first: type) -> tuple[np.ndarray, np.ndarray]:
    a = [np.frombuffer(x, first, len(x) // 16) for x in blocks]
    b = [np.frombuffer(x, np.int64, len(x) // 16, len(x) // 2) for x in blocks]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, first), np.zeros(0, np.int64))


def _distinct(*keys: np.ndarray) -> list[np.ndarray]:
    o = np.lexsort(keys[::-1])
    keys = tuple(k[o] for k in keys)
    keep = anchors.groups(*keys)
    return [k[keep] for k in keys]


def _candidates(batches: Iterator[pa.RecordBatch], all_pairs: int) -> Iterator[pa.RecordBatch]:
    """Rows (kind, a, b): pairs of sets that share an entry; spare and lost entries b of a set and role a. The
    entries of a larger group are lost to its members, as they give only pairs with its least member. One bucket of
    entries is held at a time."""
    for held in anchors.each_bucket(batches):
        for kind, a, b in _bucket([x for x, _ in held], [x for _, x in held if x], all_pairs):
            for i in range(0, len(a), 500_000):
                x = a[i : i + 500_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(b[i : i + 500_000])],
                    ["kind", "a", "b"]
                )


def _bucket(blocks: list[bytes], spares: list[bytes], all_pairs: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    out = [(SPARE, *_distinct(*_halves(spares, np.int64)))] if spares else []
    s, v = _halves(blocks, np.uint64)
    o = np.argsort(s)
    s, v = s[o], v[o]
    same = np.zeros(len(s) + 1, bool)
    np.equal(s[1:], s[:-1], out=same[1:-1]) if len(s) else None
    dup = (same[1:] | same[:-1])[: len(s)]
    if dup.any():
        s, v = _distinct(s[dup], v[dup])
        new = anchors.groups(s)
        g = np.cumsum(new) - 1
        size = np.bincount(g)[g]
        v, entry = v & ~np.int64(1), v
        first = v[np.flatnonzero(new)][g]
        small = size <= all_pairs
        a, b = [first[~new]], [v[~new]]
        left = np.flatnonzero(small)
        for k in range(1, all_pairs):
            i = left[left + k < len(g)]
            i = i[g[i + k] == g[i]]
            if not len(i):
                break
            a.append(v[i])
            b.append(v[i + k])
        a, b = np.concatenate(a), np.concatenate(b)
        ok = a != b
        out.append((PAIR, *_distinct(np.minimum(a, b)[ok], np.maximum(a, b)[ok])))
        out.append((LOST, *np.unique(entry[~small], return_counts=True)))
    return out


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, n, m, x, y = (batch.column(i).to_pylist() for i in range(6))
        keep = [i for i in range(len(a)) if 4 * min(n[i], m[i]) >= 3 * max(n[i], m[i]) and 7 * least_difference(x[i], y[i]) <= n[i] + m[i]]
        if keep:
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"]
            )


def near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that bitmaps and sizes do not rule out."""
    small = pairs.hint("shuffle_hash")
    one = nodes.join(small.withColumnRenamed("a", "node"), "node").select(
        F.col("node").alias("a"), "b", F.col("n").alias("n1"), F.col("bits").alias("bits1")
    )
    both = one.join(nodes.withColumnRenamed("node", "b"), "b").select("a", "b", "n1", "n", "bits1", "bits")
    return both.transform(in_batches, _near, "a long, b long")


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for part, texts in small_batches(batches):
        yield pa.RecordBatch.from_arrays(
            [
                part.column(part.schema.get_field_index("node")),
                pa.array([s.tobytes() for s in shingle_sets(texts, hashes, n)], pa.binary())
            ],
            ["node", "tokens"]
        )


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, salt, b, tokens) in order; the row without b has the tokens of a."""
    key, own = None, np.zeros(0, np.uint64)
    for batch in batches:
        a, b = [], []
        for x, salt, y, tokens in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            other = np.frombuffer(tokens, np.uint64)
            if y is None:
                key, own = (x, salt), other
            elif key == (x, salt) and len(own):
                at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                shared = int((own[at] == other).sum())
                if 100 * shared >= percent * (len(own) + len(other) - shared):
                    a.append(x)
                    b.append(y)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def verify(pairs: DataFrame, sets: DataFrame, percent: int = 75) -> DataFrame:
    """The pairs (a, b) whose sets link. A set with many partners is spread over tasks by salt."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).alias("salts"))
    salted = pairs.join(counts, "a").select("a", "b", F.pmod(F.hash("b"), F.col("salts").cast("int")).alias("salt"))
    others = sets.join(
        salted.withColumnRenamed("b", "node").hint("shuffle_hash"), "node"
    ).select("a", "salt", F.col("node").alias("b"), "tokens")
    own = sets.join(
        salted.select(F.col("a").alias("node"), "salt").distinct().hint("shuffle_hash"), "node"
    ).select(F.col("node").alias("a"), "salt", F.lit(None).cast("long").alias("b"), "tokens")
    rows = own.unionByName(others).repartition("a", "salt").sortWithinPartitions(
        "a", "salt", F.col("b").asc_nulls_first()
    )
    return rows.transform(in_batches, lambda it: _verify(it, percent), "a long, b long")


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        node, comp, tokens = (b.column(i).to_pylist() for i in range(3))
        sets = [np.frombuffer(t, np.int64) for t in tokens]
        size = np.array([len(s) for s in sets], np.int64)
        at = 0
        while at < len(sets):
            n = max(1, int(np.searchsorted(np.cumsum(size[at:]), 200_000, "right")))
            part = slice(at, at + n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(node[part], np.int64), size[part])),
                    pa.array(np.repeat(np.array(comp[part], np.int64), size[part])),
                    pa.array(np.repeat(size[part], size[part])), pa.array(np.concatenate(sets[part]))
                ],
                ["node", "comp", "n", "token"]
            )
            at += n


MARKS = 8


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A parity bitmap of fixed length for each set, as columns of 64 bits."""
    for b in batches:
        node, tokens = (b.column(i).to_pylist() for i in range(2))
        rows = []
        for t in tokens:
            bits = np.bincount(
                (mix(np.frombuffer(t, np.uint64) ^ _ODD[1]) >> np.uint64(16)).astype(np.int64) & (64 * MARKS - 1),
                minlength=64 * MARKS
            ) & 1
            rows.append(np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64))
        m = np.array(rows, np.int64).reshape(len(node), MARKS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node, pa.int64()), *[pa.array(m[:, k]) for k in range(MARKS)]],
            ["node", *[f"m{k}" for k in range(MARKS)]]
        )


def prefix_pairs(sets: DataFrame) -> DataFrame:
    """Pairs of sets of different components that share one of their rarest tokens, early enough: an exact filter.
    From (node, comp, tokens). Where the first token that two ordered sets share stands at places i and j, no more
    than that token and what follows it in either set is shared; and two sets differ in no fewer tokens than their
    parity bitmaps in bits. Both bounds stand in the join's condition, so what fails them is never a row."""
    rows = sets.select("node", "comp", "tokens").transform(
        in_batches, _explode, "node long, comp long, n long, token long"
    )
    # Written, so that the rows of a token that many sets hold meet a plain table and Spark may split their partition.
    df = staged(rows.groupBy("token").agg(F.count("*").alias("df")), "frequencies")
    ranked = rows.join(df, "token").groupBy("node", "comp", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("order")
    )
    prefix = ranked.select(
        "node", "comp", "n",
        F.posexplode(
            F.slice("order", 1, F.col("n").cast("int") - F.ceil(F.col("n") * 3 / 4).cast("int") + 1)
        ).alias("i", "x")
    ).select("node", "comp", "n", "i", "x.token")
    marks = sets.select("node", "tokens").transform(
        in_batches, _marks, "node long, " + ", ".join(f"m{k} long" for k in range(MARKS))
    )
    prefix = staged(prefix.join(marks, "node"), "prefix")
    # A token of many sets is dealt out: its sets are cut into blocks, and each two blocks meet by themselves.
    across = prefix.groupBy("token").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks")
    )
    across = staged(across.where("low < high").select("token", "blocks"), "across")
    found = prefix.join(across, "token").withColumn("own", F.pmod(F.hash("node"), "blocks"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = found.select("*", every.alias("other"))
    right = found.select("*", every.alias("other")).select(
        "token", F.col("own").alias("other"), F.col("other").alias("own"), F.col("node").alias("node2"),
        F.col("comp").alias("comp2"), F.col("n").alias("n2"), F.col("i").alias("i2"),
        *[F.col(f"m{k}").alias(f"o{k}") for k in range(MARKS)]
    )
    differ = " + ".join(f"bit_count(m{k} ^ o{k})" for k in range(MARKS))
    met = left.join(
        right, ["token", "own", "other"]
    ).where(f"node < node2 AND comp <> comp2 AND 4 * n >= 3 * n2 AND 4 * n2 >= 3 * n AND 7 * least(n - i, n2 - i2) >= 3 * (n + n2) AND 7 * ({differ}) <= n + n2")
    return met.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()


def _one_text(rows: DataFrame, least: DataFrame, members: DataFrame) -> DataFrame:
    """(node, text), one row for each node: its row (rid, th) may stand in the table more than once. Only such rows
    are shuffled to drop the others; most tables have none."""
    again = staged(
        members.where("node IS NOT NULL").groupBy("rid", "th").count().where("count > 1").select("rid", "th"), "again"
    )
    if again.isEmpty():
        return anchors.with_texts(rows, least, "inner").select("node", "text")
    once, several = (
        anchors.with_texts(
            rows, least.join(again, ["rid", "th"], how), "inner"
        ).select("node", "text") for how in ("left_anti", "left_semi")
    )
    return once.unionByName(several.dropDuplicates(["node"]))


def grouped(docs: DataFrame, n: int = N, percent: int = 75, all_pairs: int = ALL_PAIRS) -> DataFrame:
    """rid, th, n, root: of each row its key (a null id is NO_ID; the text's hash), the size of its set and its group,
    which is null for an empty set."""
    if percent < 75:
        raise ValueError("the partition scheme covers similarities of 75 percent and more")
    rows = anchors.keyed(docs)
    dealt = buckets(docs)
    members = staged(
        rows.transform(in_batches, lambda it: _members(it, n), "rid long, th long, n long, node long, bits binary"),
        "members"
    )
    nodes = members.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("rid", "th", "n", "bits")).alias("at")
    ).select("node", "at.rid", "at.th", "at.n", "at.bits")
    nodes = staged(nodes, "nodes")
    found = rows.select("text").transform(
        in_batches, lambda it: _entries(it, n, dealt), "bucket int, block binary, spares binary"
    ).transform(anchors.by_bucket)
    found = staged(
        found.transform(in_batches, lambda it: _candidates(it, all_pairs), "kind int, a long, b long"), "candidates"
    )
    pairs = staged(near(found.where(F.col("kind") == PAIR).select("a", "b").distinct(), nodes), "pairs")
    # The same text in several tasks gives the same spare entries: the least is the number.
    spare = found.where(F.col("kind") == SPARE).groupBy("a").agg(F.min("b").alias("spare"))
    lost = found.where(F.col("kind") == LOST).groupBy("a").agg(F.sum("b").alias("lost"))
    crowd = staged(
        spare.join(lost, "a", "left").where(F.col("spare") < F.coalesce("lost", F.lit(0))).select(F.col("a").bitwiseAND(F.lit(-2)).alias("node")).distinct(),
        "crowd"
    )
    drop_stage(found)
    wanted = pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node"))
    ).unionByName(crowd).distinct()
    least = nodes.join(wanted, "node").select("node", "rid", "th")
    sets = staged(
        _one_text(rows, least, members).transform(in_batches, lambda it: _sets(it, n), "node long, tokens binary"),
        "sets", "none"
    )
    links = staged(verify(pairs, sets, percent), "links")
    roots = staged(components(links), "roots")
    crowd = crowd.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("comp"))
    more = near(prefix_pairs(sets.join(crowd.hint("shuffle_hash"), "node")).join(pairs, ["a", "b"], "left_anti"), nodes)
    roots = staged(components(links.unionByName(verify(staged(more, "more"), sets, percent))), "roots")
    named = staged(
        members.join(roots, "node", "left").select("rid", "th", "n", F.coalesce("root", "node").alias("root")), "named"
    )
    for table in (members, nodes, pairs, sets, links, roots):
        drop_stage(table)
    return named


def join(docs: DataFrame, n: int = N, percent: int = 75, all_pairs: int = ALL_PAIRS) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id that links reach from the document."""
    named = grouped(docs, n, percent, all_pairs)
    # Written, so that the members of a group of any size meet a plain table and Spark may split their partition.
    first = staged(named.where("root IS NOT NULL").groupBy("root").agg(F.min("rid").alias("first")), "first")
    out = named.join(first, "root", "left").select("rid", "n", F.coalesce("first", "rid").alias("first"))
    real = lambda c: F.when(F.col(c) != anchors.NO_ID, F.col(c))
    return out.select(real("rid").alias("doc_id"), F.col("n").alias("n_shingles"), real("first").alias("component_id"))


def keep_one(docs: DataFrame, n: int = N, percent: int = 75) -> DataFrame:
    """The documents, with all their columns, that are the least of their group by id and then by the text's hash: one
    for each group, without an id only if the whole group has none. An empty set is a group of its own; its repeated
    rows with an id count once."""
    texts = grouped(docs, n, percent).groupBy("rid", "th").agg(F.first("root").alias("root"), F.count("*").alias("k"))
    least = texts.where("root IS NOT NULL").groupBy("root").agg(
        F.min(F.struct("rid", "th", "k")).alias("at")
    ).select("at.*")
    alone = texts.where("root IS NULL").select(
        "rid", "th", F.when(F.col("rid") == anchors.NO_ID, F.lit(1)).otherwise(F.col("k")).alias("k")
    )
    least = staged(least.unionByName(alone), "kept")
    rows, name = numbered(docs)
    rid, th = F.coalesce(F.col(name["doc_id"]).cast("long"), F.lit(anchors.NO_ID)), F.xxhash64(name["text"])
    kept = rows.join(least.hint("shuffle_hash"), (rid == F.col("rid")) & (th == F.col("th")))
    once = kept.where("k = 1").select(*rows.columns)
    first = kept.where("k > 1").dropDuplicates(["rid", "th"]).select(*rows.columns)
    return once.unionByName(first).toDF(*docs.columns)
