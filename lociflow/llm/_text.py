"""Words, documents in batches, and hashes of windows of tokens.

A word is a maximal run of anything but the six ASCII white-space characters. ``bytes.split()`` splits at
exactly those, so all work happens on UTF-8 bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm._stage import ship

#: The word pattern and the white space it leaves out.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of terms (ASCII letters, lower-cased, digits, and all bytes beyond ASCII); the others become spaces.
_TERM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

#: Odd multiplier of the polynomial hashes modulo 2**64, and its inverse.
MUL = 0x9E3779B97F4A7C15
INV = pow(MUL, -1, 1 << 64)

#: Bytes of text that are worked on at once; rows beyond it start a new batch.
BATCH_BYTES = 2 << 20

#: What a task runs on its Arrow batches.
Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def release() -> None:
    """Gives back to the system what a task leaves behind: a Python worker lives on and serves other operators, and
    what each has kept would add up."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_batches(df: DataFrame, run: Run, schema: str) -> DataFrame:
    """df.mapInArrow(run, schema) by workers that give their memory back when a task ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(task, schema)


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns under numbers, so that no name clashes with those an operator adds; and the number of
    each name."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), names


def term_bytes(text: bytes) -> list[bytes]:
    """Terms of a text: maximal runs of ASCII letters and digits and of all characters beyond ASCII, only A-Z
    lower-cased."""
    return text.translate(_TERM).split()


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def require(df: DataFrame, *columns: str) -> None:
    """Checks the columns of an operator's input and readies the executors for its Python code."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    ship(df.sparkSession)


def as_bytes(col: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null becomes empty."""
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def small_batches(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = BATCH_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The rows with their texts, in slices of about ``most`` bytes; a longer text is a slice of its own."""
    for b in batches:
        col = b.column(b.schema.get_field_index(text))
        size = pc.fill_null(pc.binary_length(col.cast(pa.binary())), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        ends = np.cumsum(size)
        while at < len(b):
            base = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, base + most, "right")) - at)
            part = b.slice(at, n)
            yield part, as_bytes(part.column(part.schema.get_field_index(text)))
            at += n


class WordHashes(dict):
    """Word to its 64-bit hash; forgets when it has grown to a fixed number of words."""

    MOST = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def flat(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words end to end, and where each document starts (one more entry than documents)."""
        ends = np.zeros(len(docs) + 1, np.int64)
        np.cumsum([len(d) for d in docs], out=ends[1:])
        get = self.__getitem__
        out = np.fromiter((h for d in docs for h in map(get, d)), np.uint64, int(ends[-1]))
        return out, ends


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of the multiplier and its inverse, grown on demand."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            one = np.ones(size, np.uint64)
            one[1:] = MUL
            self.up = np.cumprod(one, dtype=np.uint64)
            one[1:] = INV
            self.down = np.cumprod(one, dtype=np.uint64)
        return self.up, self.down


_POWERS = Powers()


class Rolling:
    """Hashes of any stretch of a token array in constant time: a polynomial modulo 2**64 over random tokens."""

    def __init__(self, tokens: np.ndarray) -> None:
        n = len(tokens)
        up, self.down = _POWERS.get(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(tokens * up[:n], out=self.sums[1:], dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Of every stretch of k tokens."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by doubling."""
    if len(x) < w:
        return x[:0]
    have, m = 1, x
    while have * 2 <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(m) - (w - have)], m[w - have :]) if have < w else m


#: Minimisers are compared without so many low bits of their hashes; the place takes those.
LOW_BITS = 26


def window_runs(roll: Rolling, ends: np.ndarray, window: int, gram: int) -> tuple[
    np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray
]:
    """Groups the windows of ``window`` tokens of each document by their minimiser.

    The minimiser of a window is its gram of ``gram`` tokens with the least hash (but for its low bits), the
    leftmost of equals. It
    depends on the window's content alone, so equal windows have equal minimisers at equal offsets wherever
    they stand. Consecutive windows with one minimiser form a run.

    Returns document number, first window, last window, minimiser position and minimiser hash of each run.
    """
    none = np.zeros(0, np.int64)
    h = roll.grams(gram)
    spread = window - gram + 1
    low = np.uint64(max(LOW_BITS, len(h).bit_length()))
    key = ((h >> low) << low) | np.arange(len(h), dtype=np.uint64)
    best = sliding_min(key, spread)
    last = ends[1:] - window
    whole = np.flatnonzero(last >= ends[:-1])
    if not len(whole) or not len(best):
        return none, none, none, none, np.zeros(0, np.uint64)
    pos = (best & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    change = np.ones(len(pos) + 1, bool)
    np.not_equal(pos[1:], pos[:-1], out=change[1:-1])
    change[ends[:-1][whole]] = True
    change[last[whole] + 1] = True
    begin = np.flatnonzero(change)
    stop = begin[1:] - 1
    begin = begin[:-1]
    doc = np.searchsorted(ends, begin, "right") - 1
    ok = begin + window <= ends[doc + 1]
    begin, stop, doc = begin[ok], stop[ok], doc[ok]
    at = pos[begin]
    return doc, begin, stop, at, h[at]


def spans_union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal disjoint spans covering the given half-open ones; touching spans become one."""
    if not len(start):
        return start, end
    o = np.argsort(start, kind="stable")
    start, reach = start[o], np.maximum.accumulate(end[o])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return start[first], reach[np.append(first[1:] - 1, len(start) - 1)]
