"""Substring deduplication with broadcast suffix automata.

Documents are streamed against reference shards: suffix automata of the passages that occur in more than one
document. Each state knows the smallest document id in which its substrings occur, so one pass over a document's words
yields its matching statistics, and for every window whether it stands in an earlier document too. Every word that such
a window covers is removed.

The reference of this operator is the corpus itself, so it grows with it. It is dealt to shards of about
``SHARD_TOKENS`` words by the minimisers of its passages, and a passage can only match in the shard of its own
minimiser. Where all automata together are known to take no more than ``broadcast_bytes``, they are built in tasks,
broadcast, and the passages are streamed against them wherever they lie. A larger reference is not broadcast: each
shard's passages go to one task, which builds the shard's automaton and streams them against it, shard after shard.
Either way the number of jobs is fixed, a task holds the automaton of a shard at a time, and nothing that grows with
the corpus goes through the driver.

What goes before is only combined ahead of the shuffle: runs of windows with one and the same text settle among
themselves which document is the smallest, and a minimiser that has one text in all documents needs no automaton, as
that document decides for all its windows at once.

Contract: a window is ``window`` consecutive words of one document. A word is removed if a window that covers
it also starts in a document with a smaller id. Windows are judged on the input. Words are compared by 64-bit
hashes, passages of one text by 64-bit hashes of those.

Edge cases: a null text has no words; a null doc_id counts as larger than any other, and two nulls as equal;
repeated rows (same id) do not remove each other; texts shorter than a window stay whole; very long texts are read
whole, in a batch of their own; an empty table gives an empty result; other columns are not read, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm import _anchors as anchors
from lociflow.llm._stage import drop_stage, free_shuffles, staged
from lociflow.llm._text import MUL, WordHashes, in_batches, mix, small_batches, spans_union

WINDOW = 13
GRAM = 5
#: Words of a shard, about; bytes of automata that may be broadcast; bytes that a word's states take at most.
SHARD_TOKENS, BROADCAST_BYTES, TOKEN_BYTES = 25_000, 96 << 20, 64


class SuffixAutomaton:
    """Of several token strings. ``first[state]`` is the least owner of the strings that contain its substrings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [anchors.NO_ID]

    def _clone(self, p: int, q: int, token: int) -> int:
        nxt, link = self.next, self.link
        c = len(nxt)
        nxt.append(nxt[q].copy())
        link.append(link[q])
        self.length.append(self.length[p] + 1)
        self.first.append(self.first[q])
        while p >= 0 and nxt[p].get(token) == q:
            nxt[p][token] = c
            p = link[p]
        link[q] = c
        return c

    def add(self, tokens: Sequence[int], owner: int) -> None:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for t in tokens:
            q = nxt[last].get(t)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._clone(last, q, t)
            else:
                new = len(nxt)
                nxt.append({})
                link.append(0)
                length.append(length[last] + 1)
                first.append(owner)
                p = last
                while p >= 0 and t not in nxt[p]:
                    nxt[p][t] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][t]
                    link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, t)
                last = new
            if owner < first[last]:
                first[last] = owner

    def close(self) -> None:
        """Carries owners from every state to those of its suffixes."""
        link, first = self.link, self.first
        for v in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if first[v] < first[link[v]]:
                first[link[v]] = first[v]

    def freeze(self) -> bytes:
        """As arrays; only that form is broadcast and read."""
        size = [len(x) for x in self.next]
        state = np.repeat(np.arange(len(size), dtype=np.uint64), size)
        token = np.fromiter((t for x in self.next for t in x), np.uint64, len(state))
        to = np.fromiter((q for x in self.next for q in x.values()), np.int32, len(state))
        key = _step(state, token)
        o = np.argsort(key)
        parts = (
            key[o], to[o], np.maximum(self.link, 0).astype(np.int32), np.array(self.length, np.int32),
            np.array(self.first, np.int64)
        )
        return np.array([len(key), len(size)], np.int64).tobytes() + b"".join(x.tobytes() for x in parts)


def _step(state: np.ndarray, token: np.ndarray) -> np.ndarray:
    """What a transition is found by."""
    return mix(state.astype(np.uint64) * np.uint64(MUL) ^ token)


class Frozen:
    """A suffix automaton as arrays."""

    def __init__(self, data: bytes) -> None:
        m, n = np.frombuffer(data, np.int64, 2).tolist()
        at = 16
        for name, kind, size in (
            ("key", np.uint64, m), ("to", np.int32, m), ("link", np.int32, n), ("length", np.int32, n),
            ("first", np.int64, n)
        ):
            setattr(self, name, np.frombuffer(data, kind, size, at))
            at += size * np.dtype(kind).itemsize

    def owners(self, tokens: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of strings that stand end to end: string, place and least owner of each window, NO_ID
        where it does not occur. All strings advance together, a token at a time."""
        size = np.diff(ends)
        order = np.argsort(-size, kind="stable")
        state, held = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        rows, places, owners = [], [], []
        for i in range(int(size.max(initial=0))):
            live = order[: np.searchsorted(-size[order], -i, "left")]
            token = tokens[ends[:-1][live] + i]
            v, n, left = state[live], held[live], np.arange(len(live))
            while len(left):
                key = _step(v[left], token[left])
                at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
                hit = self.key[at] == key
                on, off = left[hit], left[~hit]
                v[on] = self.to[at[hit]]
                n[on] += 1
                n[off[v[off] == 0]] = 0
                left = off[v[off] != 0]
                v[left] = self.link[v[left]]
                n[left] = self.length[v[left]]
            # The state of the shortest string that still holds the window: its owners are those of the window.
            while True:
                up = self.link[v]
                more = (n >= window) & (self.length[up] >= window)
                if not more.any():
                    break
                v = np.where(more, up, v)
                n = np.where(more, self.length[v], n)
            state[live], held[live] = v, n
            if i >= window - 1:
                rows.append(live)
                places.append(np.full(len(live), i - window + 1))
                owners.append(np.where(n >= window, self.first[v], anchors.NO_ID))
        if not rows:
            none = np.zeros(0, np.int64)
            return none, none, none
        return np.concatenate(rows), np.concatenate(places), np.concatenate(owners)


def _combine(e: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Of runs of one text in a block, those of the smallest document go on; the others are removed."""
    o = np.lexsort((e["doc"], e["body"], e["gram"]))
    new = anchors.groups(e["gram"][o], e["body"][o])
    least = e["doc"][o][np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))]
    later = np.zeros(len(o), bool)
    later[o] = e["doc"][o] > least
    open_, settled = {k: v[~later] for k, v in e.items()}, {k: v[later] for k, v in e.items()}
    settled["flag"] = np.ones(len(settled["doc"]), np.uint8)
    return open_, settled


def _settle(e: dict[str, np.ndarray], split: int = anchors.SPLIT) -> dict[str, np.ndarray]:
    done = e["flag"] == 1
    out = [{k: v[done] for k, v in e.items()} | {"kind": np.zeros(int(done.sum()), np.int64)}]
    e = {k: v[~done] for k, v in e.items()}
    o = np.lexsort((e["doc"], e["body"], e["gram"]))
    e = {k: v[o] for k, v in e.items()}
    n = len(o)
    if n:
        new = anchors.groups(e["gram"], e["body"])
        least = e["doc"][np.maximum.accumulate(np.where(new, np.arange(n), 0))]
        later = e["doc"] > least
        out.append({k: v[later] for k, v in e.items()} | {"kind": np.zeros(int(later.sum()), np.int64)})
        e = {k: v[~later] for k, v in e.items()}
        gram = anchors.groups(e["gram"])
        g = np.cumsum(gram) - 1
        at = np.flatnonzero(gram)
        mixed = (np.minimum.reduceat(e["doc"], at) != np.maximum.reduceat(e["doc"], at))[g]
        kind = np.where(np.bincount(g)[g] > split, anchors.SINGLY, anchors.COMPARE)
        out.append({k: v[mixed] for k, v in e.items()} | {"kind": kind[mixed]})
    joined = {k: np.concatenate([x[k] for x in out]) for k in ("doc", "th", "start", "count", "gram", "kind")}
    return joined | {"value": anchors.pack(joined["start"], joined["count"], joined["kind"])}


def _passages(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words of the runs that are to be compared."""
    hashes = WordHashes()
    for part, texts in small_batches(batches):
        cols = [part.column(part.schema.get_field_index(c)).to_pylist() for c in ("rid", "th", "asked")]
        rows: list[tuple] = []
        for rid, th, asked, text in zip(*cols, texts, strict=True):
            toks = np.fromiter(map(hashes.__getitem__, text.split()), np.uint64)
            start, count, kind = anchors.unpack(np.array([a["value"] for a in asked], np.int64))
            for s, c, k, a in zip(start.tolist(), count.tolist(), kind.tolist(), asked, strict=True):
                if k == anchors.COMPARE:
                    rows.append((a["gram"], rid, th, s, c, toks[s : s + c - 1 + window].tobytes()))
                else:
                    for w in range(s, s + c):
                        body = toks[w : w + window]
                        own = int(np.bitwise_xor.reduce(body * np.arange(1, 2 * window, 2, dtype=np.uint64)))
                        rows.append((own - (1 << 64) if own >= 1 << 63 else own, rid, th, w, 1, body.tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c, t) for c,
                    t in zip(
                        zip(*rows, strict=True),
                        (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True
                    )
                ],
                ["gram", "rid", "th", "start", "count", "tokens"]
            )


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The automaton of each shard from its passages (shard, tokens, rid), which arrive shard by shard."""
    shard, sam = None, SuffixAutomaton()

    def close() -> pa.RecordBatch:
        sam.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([sam.freeze()], pa.binary())], ["shard", "automaton"]
        )

    for b in batches:
        for own, tokens, rid in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if shard is not None and own != shard:
                yield close()
                sam = SuffixAutomaton()
            shard = own
            sam.add(np.frombuffer(tokens, np.uint64).tolist(), rid)
    if shard is not None:
        yield close()


def _spans(
    automaton: Frozen, rid: np.ndarray, th: np.ndarray, start: np.ndarray, tokens: list[bytes], window: int
) -> pa.RecordBatch:
    """Spans of passages of one shard whose windows have a smaller owner."""
    ends = np.zeros(len(tokens) + 1, np.int64)
    np.cumsum([len(t) // 8 for t in tokens], out=ends[1:])
    row, place, owner = automaton.owners(np.frombuffer(b"".join(tokens), np.uint64), ends, window)
    gone = owner < rid[row]
    row, place = row[gone], place[gone]
    o = np.lexsort((place, row))
    row, place = row[o], place[o]
    first = np.flatnonzero(anchors.groups(row, place - np.arange(len(place))))
    count = np.diff(np.append(first, len(row)))
    src = row[first]
    value = anchors.pack(start[src] + place[first], count, anchors.REMOVE)
    return pa.RecordBatch.from_arrays([pa.array(rid[src]), pa.array(th[src]), pa.array(value)], ["rid", "th", "value"])


def _columns(b: pa.RecordBatch) -> list[np.ndarray]:
    """shard, rid, th and start of passages."""
    return [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]


def _stream(batches: Iterator[pa.RecordBatch], automata: dict[int, bytes], window: int) -> Iterator[pa.RecordBatch]:
    """Passages (shard, rid, th, start, tokens) in any order against automata that the task has."""
    for b in batches:
        shards, rid, th, start = _columns(b)
        for k in np.unique(shards).tolist():
            at = np.flatnonzero(shards == k)
            own = b.column(4).take(pa.array(at)).to_pylist()
            yield _spans(Frozen(automata[k]), rid[at], th[at], start[at], own, window)


def _shard_by_shard(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Passages (shard, rid, th, start, tokens), a shard after the other: builds its automaton and streams them."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]] = []
    shard = None

    def finish() -> pa.RecordBatch:
        rid, th, start = (np.concatenate([h[i] for h in held]) for i in range(3))
        tokens = [t for h in held for t in h[3]]
        sam, once = SuffixAutomaton(), {}
        for t, r in zip(tokens, rid.tolist(), strict=True):
            once[t] = min(r, once.get(t, r))
        for t, r in once.items():
            sam.add(np.frombuffer(t, np.uint64).tolist(), r)
        sam.close()
        return _spans(Frozen(sam.freeze()), rid, th, start, tokens, window)

    for b in batches:
        shards, rid, th, start = _columns(b)
        cut = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(b)]
        for i, j in zip(cut, cut[1:], strict=False):
            if i == j:
                continue
            if held and shards[i] != shard:
                yield finish()
                held = []
            shard = shards[i]
            held.append((rid[i:j], th[i:j], start[i:j], b.column(4).slice(i, j - i).to_pylist()))
    if held:
        yield finish()


def read_against(passages: DataFrame, window: int, n_tokens: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """rid, th, value: the spans that automata of all passages (gram, rid, th, start, tokens) remove from each.
    ``n_tokens`` is how many words the passages have; it bounds what the automata take."""
    spark = passages.sparkSession
    shards = max(1, -(-n_tokens // SHARD_TOKENS))
    shard = F.pmod(F.xxhash64("gram"), F.lit(shards))
    rows = passages.select(shard.alias("shard"), "rid", "th", "start", "tokens")
    if n_tokens * TOKEN_BYTES > broadcast_bytes:
        dealt = rows.repartition("shard").sortWithinPartitions("shard")
        return dealt.transform(in_batches, lambda it: _shard_by_shard(it, window), SPANS)
    rows = staged(rows, "passages")
    once = rows.groupBy("shard", "tokens").agg(F.min("rid").alias("rid"))
    built = once.repartition("shard").sortWithinPartitions("shard").transform(
        in_batches, _build, "shard long, automaton binary"
    )
    automata = spark.sparkContext.broadcast({r["shard"]: bytes(r["automaton"]) for r in built.collect()})
    return rows.transform(in_batches, lambda it: _stream(it, automata.value, window), SPANS)


SPANS = "rid long, th long, value long"


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    for part, texts in small_batches(batches):
        ids, spans = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "gone"))
        kept, words, gone, lists = [], [], [], []
        for text, values in zip(texts, spans, strict=True):
            w = text.split()
            words.append(len(w))
            start, count, _ = anchors.unpack(np.array(values, np.int64)) if values else (none, none, none)
            s, e = spans_union(start, start + count - 1 + window)
            at, keep = 0, []
            for a, b in zip(s.tolist(), e.tolist(), strict=True):
                keep += w[at:a]
                at = b
            kept.append(b" ".join(keep + w[at:] if values else w).decode("utf-8", "replace"))
            gone.append(int((e - s).sum()))
            lists.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist(), strict=True)])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(words, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(lists, span), pa.array(kept, pa.string())
            ],
            ["doc_id", "n_words", "n_removed", "spans", "kept"]
        )


def dedup(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, split: int = anchors.SPLIT,
    broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed words, half-open) and kept (the remaining words, joined by one
    space). Automata that may take more than ``broadcast_bytes`` are not broadcast; ``split`` is the number of texts
    of a minimiser from which its windows are compared one by one. Neither changes the result."""
    if not 1 <= gram <= window:
        raise ValueError("gram must lie between 1 and window")
    rows = anchors.keyed(docs)

    def tokens():
        hashes = WordHashes()
        return lambda texts: hashes.flat([t.split() for t in texts])

    found = staged(
        anchors.settle(anchors.index(rows, tokens, window, gram, _combine), lambda e: _settle(e, split)), "windows"
    )
    asked = found.where(anchors.kind() != anchors.REMOVE).groupBy("rid", "th").agg(
        F.collect_list(F.struct("value", "gram")).alias("asked")
    )
    passages = anchors.with_texts(rows, asked, "inner").transform(
        in_batches, lambda it: _passages(it, window),
        "gram long, rid long, th long, start long, count int, tokens binary"
    )
    # How many words they have: a run of n windows has window - 1 more; asked one by one, each has all its own.
    n, singly = F.shiftright("value", 4).bitwiseAND(F.lit(0xFFFFF)), anchors.kind() == anchors.SINGLY
    words = found.where(anchors.kind() != anchors.REMOVE).agg(
        F.sum(F.when(singly, n * window).otherwise(n + window - 1))
    ).first()[0] or 0
    free_shuffles(docs.sparkSession)
    matched = read_against(passages, window, int(words), broadcast_bytes)
    gone = staged(
        found.where(anchors.kind() == anchors.REMOVE).select("rid", "th", "value").unionByName(matched), "gone"
    )
    drop_stage(found)
    free_shuffles(docs.sparkSession)
    full = anchors.with_texts(rows, anchors.per_document(gone, "gone"), "left")
    full = full.select(F.when(F.col("rid") != anchors.NO_ID, F.col("rid")).alias("doc_id"), "text", "gone")
    return full.transform(
        in_batches, lambda it: _cut(it, window),
        "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"
    )
