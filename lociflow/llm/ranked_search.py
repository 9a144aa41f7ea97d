"""Ranked lexical search over inverted treaps.

The documents are dealt to blocks, and each block is indexed by itself: for each term a treap of its postings, a binary
tree in order of documents whose nodes are heaps of impacts (what the document's occurrences of the term add to a score).
A search walks the treaps of all its terms at once over ranges of documents: the greatest impacts that the treaps have
within a range sum to a bound of every score there, and a range whose bound cannot enter the first k goes unvisited.
Otherwise the document of the greatest impact is scored, and the ranges before and after it are walked. All ranges of
all searches are walked together, level by level, in arrays. A task keeps each search's first k over its blocks, so later
blocks are pruned by what earlier ones have found; Spark merges what the tasks keep.

Counts (documents, terms, documents of each term) are taken over all documents in a first pass, which reads the texts
once and writes each document's length and its counts of the items' terms; the index is built from that table. Items are
searched in groups of ``GROUP_BYTES`` of text, whose terms are broadcast; more items make more groups, more documents
do not.

Scores: terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. With N
documents that have terms, L terms in all, n terms in a document, tf of them the term, df documents of the term:
w = floor(1000 * ln((2 N + 2) / (2 df + 1))), m = 75 + (25 n N) div L, and a document's score is the sum over the item's
terms, repeats included, of w * ((10**9 tf) div (1000 tf + 12 m)).

Edge cases: null and empty texts and texts without terms are no documents and no searches; equal scores go to the smaller
id, a null id comes last; repeated rows are documents of their own, and count as such; repeated items of one id and text
are one, those of different texts one each; very long texts are counted whole, in batches of their own; an empty table
gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.llm._stage import drop_stage, free_shuffles, new_path, staged
from lociflow.llm._text import in_batches, require, small_batches, term_bytes

NO_ID = (1 << 63) - 1
K = 20
#: Bytes of items that are searched at once; documents of a block; searches whose ranges are walked together.
GROUP_BYTES, BLOCK_DOCS, TOGETHER = 4 << 20, 16_384, 8


class Items:
    """Searches: of each its id and its terms, as numbers of the words of all, with their repeats."""

    def __init__(self, rows: list[tuple[int | None, str]]) -> None:
        self.words: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.terms: list[np.ndarray] = []
        self.repeats: list[np.ndarray] = []
        for item, text in rows:
            counts = Counter(term_bytes((text or "").encode()))
            if counts:
                self.ids.append(item)
                self.terms.append(np.array([self.words.setdefault(t, len(self.words)) for t in counts], np.int64))
                self.repeats.append(np.array(list(counts.values()), np.int64))


def _counts(batches: Iterator[pa.RecordBatch], words: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Of each document its id, its number of terms, and those of the items that it holds with their occurrences."""
    get = words.get
    for part, texts in small_batches(batches):
        n, terms, tfs, ends = [], [], [], [0]
        for t in texts:
            found = term_bytes(t)
            n.append(len(found))
            own = np.fromiter((x for x in map(get, found) if x is not None), np.int32)
            term, tf = np.unique(own, return_counts=True)
            terms.append(term)
            tfs.append(tf)
            ends.append(ends[-1] + len(term))
        offsets = pa.array(ends, pa.int32())
        lists = [
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*x, np.zeros(0, t)]).astype(t)))
            for x, t in ((terms, np.int32), (tfs, np.int64))
        ]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"]
        )


def treaps(start: np.ndarray, impact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Roots, left and right children (-1: none) of the treaps of posting lists that stand end to end, list t from
    start[t]: in order of places, heaps of impacts; of equal impacts the first is higher. The nodes that a new one takes
    the place of leave the right spine, each once, so a list takes time in proportion to its length."""
    left, right = np.full(len(impact), -1, np.int64), np.full(len(impact), -1, np.int64)
    root = np.full(len(start) - 1, -1, np.int64)
    value, lefts, rights = impact.tolist(), left.tolist(), right.tolist()
    for t, (a, b) in enumerate(zip(start[:-1].tolist(), start[1:].tolist(), strict=True)):
        spine: list[int] = []
        for i in range(a, b):
            below = -1
            while spine and value[spine[-1]] < value[i]:
                below = spine.pop()
            lefts[i] = below
            if spine:
                rights[spine[-1]] = i
            spine.append(i)
        if spine:
            root[t] = spine[0]
    return root, np.array(lefts, np.int64), np.array(rights, np.int64)


class Block:
    """The inverted treaps of some documents, which stand in order of their ids."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int) -> None:
        self.ids, self.docs = ids, len(ids)
        o = np.lexsort((doc, term))
        # One node more stands for "none": no document, no impact.
        self.doc, self.impact = np.append(doc[o], -1), np.append(impact[o], 0)
        self.key = term[o] * self.docs + doc[o]
        self.root, self.left, self.right = treaps(np.searchsorted(term[o], np.arange(n_terms + 1)), impact[o])
        self.left, self.right = np.append(self.left, -1), np.append(self.right, -1)

    def within(self, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The highest nodes under the given ones whose documents lie between low and high, both excluded."""
        node = node.copy()
        row, col = np.nonzero(node >= 0)
        while len(row):
            at = node[row, col]
            d = self.doc[at]
            before, after = d <= low[row], d >= high[row]
            step = np.where(before, self.right[at], np.where(after, self.left[at], at))
            node[row, col] = step
            go = (before | after) & (step >= 0)
            row, col = row[go], col[go]
        return node

    def scores(self, doc: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Whole scores of documents: terms[i] and weight[i] are those of the search that doc[i] is scored for."""
        if not len(self.key):
            return np.zeros(len(doc), np.int64)
        want = terms * self.docs + doc[:, None]
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((self.key[at] == want) & (terms >= 0), self.impact[at] * weight, 0).sum(axis=1)


class First:
    """The first k documents of each search so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.score, self.id = k, np.zeros((n, k), np.int64), np.full((n, k), NO_ID, np.int64)

    def offer(self, search: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        hit = np.unique(search)
        rows = np.concatenate([np.repeat(hit, self.k), search])
        s, i = np.concatenate([self.score[hit].ravel(), score]), np.concatenate([self.id[hit].ravel(), ids])
        o = np.lexsort((i, -s, rows))
        start = np.searchsorted(rows[o], hit)
        keep = o[(start[:, None] + np.arange(self.k)).ravel()]
        self.score[hit], self.id[hit] = s[keep].reshape(-1, self.k), i[keep].reshape(-1, self.k)


def walk(block: Block, searches: np.ndarray, terms: np.ndarray, weight: np.ndarray, first: First) -> int:
    """Walks the block's treaps for some searches (terms and weight are padded with -1 and 0) and offers what may be
    among their first k. Returns how many documents were scored."""
    s = np.arange(len(searches))
    low, high = np.full(len(s), -1, np.int64), np.full(len(s), block.docs, np.int64)
    node = np.where(terms >= 0, block.root[np.maximum(terms, 0)], -1)
    visited = 0
    while len(s):
        node = block.within(node, low, high)
        reach = block.impact[node] * weight[s]  # of node -1 the last entry: 0
        bound = reach.sum(axis=1)
        worst, last = first.score[searches[s], -1], first.id[searches[s], -1]
        # At an equal score only a smaller id enters; the first document of the range has its smallest.
        least = block.ids[np.minimum(low + 1, block.docs - 1)]
        live = np.flatnonzero((bound > worst) | (bound == worst) & (bound > 0) & (least < last))
        if not len(live):
            return visited
        s, low, high, node = s[live], low[live], high[live], node[live]
        at = block.doc[node[np.arange(len(live)), reach[live].argmax(axis=1)]]
        score = block.scores(at, terms[s], weight[s])
        visited += len(at)
        first.offer(searches[s], score, block.ids[at])
        # The ranges before and after that document, as far as they hold any.
        a, b = np.flatnonzero(at - low > 1), np.flatnonzero(high - at > 1)
        s, low, high, node = (
            np.concatenate([s[a], s[b]]), np.concatenate([low[a], at[b]]), np.concatenate([at[a], high[b]]),
            np.concatenate([node[a], node[b]])
        )
    return visited


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """The weight of each term by its documents."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df.tolist()], np.int64)


def _search(
    batches: Iterator[pa.RecordBatch], items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int
) -> Iterator[pa.RecordBatch]:
    """First k of each item among the documents (doc_id, n, terms, tfs) of the task, indexed block by block."""
    first = First(len(items.ids), k)
    order = np.argsort([len(t) for t in items.terms], kind="stable")

    def search(held: list[tuple[np.ndarray, ...]]) -> None:
        ids, n, size, term, tf = (np.concatenate([h[i] for h in held]) for i in range(5))
        o = np.argsort(ids, kind="stable")
        place = np.empty(len(o), np.int64)
        place[o] = np.arange(len(o))
        m = np.array([75 + 25 * x * n_docs // n_terms for x in n.tolist()], np.int64)
        doc = np.repeat(np.arange(len(ids)), size)
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
        block = Block(ids[o], place[doc], term, impact, len(weight))
        for i in range(0, len(order), TOGETHER):
            own = order[i : i + TOGETHER]
            wide = max(len(items.terms[j]) for j in own)
            terms, repeats = np.full((len(own), wide), -1, np.int64), np.zeros((len(own), wide), np.int64)
            for r, j in enumerate(own):
                terms[r, : len(items.terms[j])], repeats[r, : len(items.terms[j])] = items.terms[j], items.repeats[j]
            walk(block, own, terms, repeats, first)

    held: list[tuple[np.ndarray, ...]] = []
    for b in batches:
        ids, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        size = np.diff(b.column(2).offsets.to_numpy())
        held.append((ids, n, size, *(b.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))))
        if sum(len(h[0]) for h in held) >= BLOCK_DOCS:
            search(held)
            held = []
    if held:
        search(held)
    row, col = np.nonzero(first.score > 0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(row), pa.array(first.id[row, col]), pa.array(first.score[row, col])], ["item", "doc_id", "score"]
    )


def search(docs: DataFrame, items: DataFrame, k: int = K, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: for each item its ``k`` documents of the highest scores above 0. ``group_bytes``
    bounds the items that are searched at once; it does not change the result."""
    require(docs, "doc_id", "text")
    require(items, "item_id", "text")
    spark = docs.sparkSession
    asked = staged(items.where("text IS NOT NULL").select("item_id", "text").distinct(), "items")
    groups = -(-(asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) // group_bytes)
    item_type = items.schema["item_id"].dataType
    schema = f"item_id {item_type.simpleString()}, rank int, doc_id long, score long"
    out = new_path(spark, "ranked")
    spark.createDataFrame([], schema).write.parquet(out)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    for g in range(groups):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).collect()
        made = Items([(r.item_id, r.text) for r in own])
        if not made.ids:
            continue
        words = spark.sparkContext.broadcast(made.words)
        counted = staged(
            rows.transform(
                in_batches, lambda it, w=words: _counts(it, w.value),
                "doc_id long, n long, terms array<int>, tfs array<long>"
            ),
            "counts"
        ).where("n > 0")
        total = counted.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(made.words), np.int64)
        # As many rows as the group's items have terms.
        for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r.term] = r["count"]
        weight = weights(total[0], df)
        shared = spark.sparkContext.broadcast((made, weight, total[0], total[1] or 1))
        # Fewer and larger tasks than files, but enough for all cores: a task prunes by what it has found before.
        tasks = max(2 * spark.sparkContext.defaultParallelism, total[0] // BLOCK_DOCS)
        best = counted.where(F.size("terms") > 0).coalesce(tasks).transform(
            in_batches, lambda it, s=shared: _search(it, *s.value, k), "item long, doc_id long, score long"
        )
        order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(made.ids)), f"item long, item_id {item_type.simpleString()}")
        doc_id = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
        best.join(F.broadcast(names), "item").select("item_id", "rank", doc_id, "score").write.mode("append").parquet(out)
        words.destroy()
        shared.destroy()
        drop_stage(counted)
        free_shuffles(spark)
    return spark.read.schema(schema).parquet(out)
