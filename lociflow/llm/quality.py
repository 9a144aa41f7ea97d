"""Quality rules from the repetition inside each document.

A suffix array over the words of every document, with the longest common prefix (LCP) of neighbours, finds the
maximal repeated substrings: a suffix begins a repeated substring as long as the larger LCP with its two
neighbours. The union of the spans of all repeats of at least ``min_words`` words gives the covered fraction.
Documents of a batch share one array; the document number is the leading key, so suffixes of different
documents never meet. Sorting is prefix doubling over the suffixes that are still tied.

Edge cases: null and empty texts have no words and fail the base rule; very long texts are measured whole, in a batch
of their own; repeats of equal length count alike; repeated rows get equal results; other columns are neither read
nor changed, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm._text import Rolling, WordHashes, in_batches, require, small_batches

#: Symbols that are counted, the repeat window and the base limits.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: The method's own limits: repeats of so many words count, at most this part of the words may lie in them, and
#: none may be longer than this.
REPEAT_WORDS = 10
MAX_COVERED = 0.25
MAX_LONGEST = 150

SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long"


def suffix_array(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions of all tokens in the order of the suffixes of their documents, document by document."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    stop = ends[1:][doc]
    names, ids = np.unique(tokens, return_inverse=True)
    key = doc * np.int64(len(names)) + ids
    sa = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    np.not_equal(key[sa][1:], key[sa][:-1], out=new[1:])
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = ~new
    tied[:-1] |= ~new[1:]
    at, h = np.flatnonzero(tied), 1
    while len(at):
        i = sa[at]
        first = rank[i]
        ahead = i + h
        second = np.where(ahead < stop[i], rank[np.minimum(ahead, n - 1)], -1)
        o = np.lexsort((second, first))
        i, first, second = i[o], first[o], second[o]
        sa[at] = i
        new = np.ones(len(i), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        rank[i] = at[np.maximum.accumulate(np.where(new, np.arange(len(i)), 0))]
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = at[tied]
        h *= 2
    return sa


def repeat_lengths(tokens: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """For every position the length of the longest substring that starts there and occurs elsewhere in its
    document; 0 where that is under ``least``."""
    n = len(tokens)
    out = np.zeros(n, np.int64)
    if n < least:
        return out
    sa = suffix_array(tokens, ends)
    roll = Rolling(tokens)
    stop = ends[np.searchsorted(ends, np.arange(n), "right")]
    a, b = sa[:-1], sa[1:]
    room = np.minimum(stop[a] - a, stop[b] - b)
    ok = (room >= least) & (stop[a] == stop[b])
    a, b, room = a[ok], b[ok], room[ok]
    same = roll.of(a, a + least) == roll.of(b, b + least)
    a, b, room = a[same], b[same], room[same]
    low, high = np.full(len(a), least), room.copy()
    while (open_ := low < high).any():
        mid = (low + high + 1) // 2
        eq = roll.of(a, a + mid) == roll.of(b, b + mid)
        low, high = np.where(open_ & eq, mid, low), np.where(open_ & ~eq, mid - 1, high)
    np.maximum.at(out, a, low)
    np.maximum.at(out, b, low)
    return out


def covered(lengths: np.ndarray, least: int, ends: np.ndarray, width: int | None = None) -> np.ndarray:
    """Words of each document in the union of its repeats of at least ``least`` words (or of their first
    ``width`` words)."""
    n = len(lengths)
    cover = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(lengths >= least)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + (width if width is not None else lengths[at]), -1)
    return per_doc(np.cumsum(cover[:-1]) > 0, ends)


def per_doc(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[ends[1:]] - sums[ends[:-1]]


def duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
#: Bytes that begin a code point of a word.
_LETTER = np.ones(256, bool)
_LETTER[[*range(0x80, 0xC0), 0x20, *range(0x09, 0x0E)]] = False


def _measure(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for part, texts in small_batches(batches):
        tokens, ends = hashes.flat([t.split() for t in texts])
        raw = np.frombuffer(b"".join(texts), np.uint8)
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=at[1:])
        rep = repeat_lengths(tokens, ends, min(least, WINDOW))
        longest = np.zeros(len(texts), np.int64)
        full = np.flatnonzero(np.diff(ends))
        if len(full):
            longest[full] = np.maximum.reduceat(rep, ends[:-1][full])
        longest[longest < least] = 0
        cols = [
            np.diff(ends), per_doc(_LETTER[raw], at), per_doc(_SYMBOL[raw], at),
            np.array([duplicate_lines(t) for t in texts], np.int64), covered(rep, WINDOW, ends, WINDOW),
            covered(rep, least, ends), longest
        ]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        keep = [i for i, f in enumerate(part.schema) if f.name != "text"]
        yield pa.RecordBatch.from_arrays(
            [part.column(i) for i in keep] + [pa.array(c, pa.int64()) for c in cols],
            [part.schema.field(i).name for i in keep] + names
        )


def quality(
    docs: DataFrame, repeat_words: int = REPEAT_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST
) -> DataFrame:
    """doc_id, the measures of SCHEMA, base_failed and kept. Pure per-document work: one scan, no shuffle."""
    require(docs, "doc_id", "text")
    if repeat_words < 1:
        raise ValueError("a repeat has a word at least")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").transform(
        in_batches, lambda it: _measure(it, repeat_words), f"doc_id {kind}, {SCHEMA}"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    repetitive = (F.col("covered_words") > F.col("n_words") * F.lit(max_covered)) | (F.col("longest_repeat") > max_longest)
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repetitive)


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The documents, with all their columns, that ``quality`` keeps. The verdict rides along with the row, so
    nothing is joined back and repeated rows are judged one by one."""
    require(docs, "doc_id", "text")
    least = limits.get("repeat_words", REPEAT_WORDS)
    measured = [f.split()[0] for f in SCHEMA.split(", ")]
    # Columns of the documents go through under numbers: their own names may clash with the measures.
    safe = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"c{i}") for i, c in enumerate(docs.columns)])
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema) if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in small_batches(batches):
            for m in _measure(iter([part]), least):
                yield pa.RecordBatch.from_arrays(
                    [*m.columns, part.column(part.schema.get_field_index("text"))], [*m.schema.names, "text"]
                )

    out = safe.transform(in_batches, run, f"{schema}, {SCHEMA}, text string")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    repetitive = (
        F.col("covered_words") > F.col("n_words") * F.lit(limits.get("max_covered", MAX_COVERED))
    ) | (F.col("longest_repeat") > limits.get("max_longest", MAX_LONGEST))
    return out.where(~failed & ~repetitive).drop(*measured).select(
        *[F.col("text" if c == "text" else f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    )
