"""Personal data: fixed forms, and further identifiers by bootstrapped contextual extraction.

The fixed forms (e-mail and IP addresses, card and phone numbers) seed the search. Where a seed stands, the words
around it make lexical patterns: the two words before it, and the words on either side, whole words of any length (of
the word that it stands in, what lies before or after it). Strings that look like an
identifier but have none of the fixed forms are candidates with patterns of their own. Spark scores the graph of
patterns and instances in rounds: a pattern is as good as the part of its instances that are known, an instance
is accepted when good patterns agree on it, and accepted instances count as known in the next round, in which
their other patterns may reach further candidates. Only candidates of a seed's own shape are ever accepted, and
only by patterns that several different known instances support.

Texts are searched as UTF-8 bytes; offsets are in code points.

Edge cases: null and empty texts have no spans; very long texts are searched whole, in time that grows with their
length; of candidates that overlap the first counts, of those that start together the shorter; repeated rows get equal
results; a pattern or a value that a third of the table holds is aggregated before it is joined; other columns are not
read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm._stage import staged
from lociflow.llm._text import Rolling, in_batches, mix, require, small_batches, spans_union

#: The base kinds in the order of the digest.
KINDS = ("email", "ip", "card", "phone")
FOUND = "found"
#: Rounds of scoring; different known instances that a pattern needs; scores from which patterns count and
#: instances are accepted.
ROUNDS, SUPPORT, PATTERN_SCORE, INSTANCE_SCORE = 3, 3, 0.6, 0.75

_LOCAL = np.zeros(256, bool)
_LOCAL[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")] = True
_LOCAL = _LOCAL.tolist()
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits matches from its first digit or not at all, hence the look-behind: long runs cost linear time.
_IP = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(rb"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
#: What may be an identifier: a stretch of digits and their separators, or a word with an at sign.
_DIGITS = re.compile(rb"(?<![0-9A-Za-z])[(+]?[0-9](?:[().\x20-]{0,2}[0-9])+(?![0-9A-Za-z])")
_DIGIT = re.compile(rb"[0-9]")


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: bytes) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail form, found from the at signs outwards."""
    done, at = 0, text.find(b"@")
    while at >= 0:
        s = at
        while s > done and _LOCAL[text[s - 1]]:
            s -= 1
        if s < at and (m := _DOMAIN.match(text, at + 1)):
            yield s, m.end()
            done = m.end()
        at = text.find(b"@", at + 1)


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches, in bytes."""
    out = [(s, 0, e) for s, e in emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or b"0") <= 255 for p in (q.lstrip(b"0") for q in m[0].split(b"."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(b" ", b"").replace(b"-", b"")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(48 <= c <= 57 for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return out


def shape(value: bytes) -> int | None:
    """The kind that an identifier resembles, or None."""
    if b"@" in value:
        return 0 if len(value) >= 6 else None
    digits = sum(48 <= c <= 57 for c in value)
    if value.count(b".") >= 2 and digits >= 4 and digits <= 12 and not set(value) - set(b"0123456789."):
        return 1
    if 12 <= digits <= 19 and not set(value) - set(b"0123456789 -"):
        return 2
    return 3 if 7 <= digits <= 15 else None


def candidates(text: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of strings that resemble an identifier and touch no base span."""
    found = [(m.start(), m.end()) for m in _DIGITS.finditer(text)] if _DIGIT.search(text) else []
    at = text.find(b"@")
    while at >= 0:
        s, e = at, at + 1
        while s and not text[s - 1 : s].isspace():
            s -= 1
        while e < len(text) and not text[e : e + 1].isspace():
            e += 1
        while e > s and text[e - 1] in b".,;:!?)":
            e -= 1
        found.append((s, e))
        at = text.find(b"@", max(e, at + 1))
    out: list[tuple[int, int, int]] = []
    # Base spans as disjoint stretches in order, so one look tells whether a string touches any.
    begin, end = (
        x.tolist() for x in spans_union(
            np.array([s for s, _, _ in base], np.int64), np.array([e for _, _, e in base], np.int64)
        )
    )
    reach = 0
    for s, e in sorted(found):
        i = bisect_right(end, s)
        if s < reach or i < len(begin) and begin[i] < e:
            continue
        k = shape(text[s:e])
        if k is not None:
            out.append((s, k, e))
            reach = e
    return out


#: A random number for each byte, and whether it is white space.
_BYTE = np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
#: Odd multipliers that tell the words of a pattern apart, for those before a span and those on either side.
_BEFORE, _AROUND = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def patterns(text: bytes, spans: list[tuple[int, int, int]]) -> list[list[int]]:
    """Hashes of the lexical patterns around each span (start, kind, end), in time that grows with the text however
    long its words are."""
    raw = np.frombuffer(text.lower(), np.uint8)
    space = np.concatenate([[True], _SPACE[raw], [True]])
    starts, ends = np.flatnonzero(space[:-2] & ~space[1:-1]), np.flatnonzero(~space[1:-1] & space[2:]) + 1
    roll = Rolling(_BYTE[raw])
    start, end = (np.array([s[i] for s in spans], np.int64) for i in (0, 2))
    last = np.searchsorted(starts, start, "left") - 1  # the word before the span, or the one that it stands in
    after = np.searchsorted(ends, end, "right")
    has_last, has_two, has_after = last >= 0, last >= 1, after < len(ends)
    starts, ends = np.append(starts, 0), np.append(ends, 0)  # for places without a word, which are not used
    one = roll.of(starts[last], np.maximum(starts[last], np.minimum(ends[last], start)))
    two = roll.of(starts[last - 1], np.maximum(starts[last - 1], ends[last - 1]))
    right = roll.of(np.minimum(np.maximum(starts[after], end), ends[after]), ends[after])
    before = mix(two * _BEFORE + one).view(np.int64).tolist()
    around = mix(one * _AROUND + right).view(np.int64).tolist()
    return [
        [b] * two_ + [a] * both for b, a, two_, both in zip(
            before, around, has_two.tolist(), (has_last & has_after).tolist(), strict=True
        )
    ]


def code_point_spans(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    at, n, where = 0, 0, {}
    for c in sorted({x for s, _, e in spans for x in (s, e)}):
        n += len(text[at:c].decode("utf-8", "replace"))
        at, where[c] = c, n
    return [(where[s], k, where[e]) for s, k, e in spans]


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_SEEN = pa.struct(
    [
        ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("seed", pa.bool_()), ("value", pa.int64()),
        ("patterns", pa.list_(pa.int64()))
    ]
)
_SCHEMA = "base array<struct<start:long,kind:int,end:long>>, seen array<struct<start:long,end:long,kind:int,seed:boolean,value:long,patterns:array<long>>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in small_batches(batches):
        bases, seen = [], []
        for t in texts:
            base = sorted(base_spans(t)) if b"@" in t or _DIGIT.search(t) else []
            more = candidates(t, base) if base or b"@" in t or _DIGIT.search(t) else []
            both = base + more
            points = code_point_spans(t, both)
            bases.append([{"start": s, "kind": k, "end": e} for s, k, e in points[: len(base)]])
            rows = []
            own = patterns(t, both) if both else []
            for i, ((s, k, e), (ps, _, pe), p) in enumerate(zip(both, points, own, strict=True)):
                if p:
                    rows.append(
                        {
                            "start": ps, "end": pe, "kind": k, "seed": i < len(base),
                            "value": xxhash.xxh3_64_intdigest(t[s:e].lower()) - (1 << 63), "patterns": p
                        }
                    )
            seen.append(rows)
        yield pa.RecordBatch.from_arrays(
            [
                part.column(part.schema.get_field_index("doc_id")), pa.array(bases, pa.list_(_SPAN)),
                pa.array(seen, pa.list_(_SEEN))
            ],
            ["doc_id", "base", "seen"]
        )


def bootstrap(
    seen: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, pattern_score: float = PATTERN_SCORE,
    instance_score: float = INSTANCE_SCORE
) -> DataFrame:
    """(kind, value) of the candidates that patterns vouch for. ``seen`` has (kind, seed, value, patterns)."""
    edges = seen.select(
        "kind", "value", "seed", F.explode("patterns").alias("pattern")
    ).groupBy("kind", "value", "pattern").agg(F.max("seed").alias("seed"))
    # Patterns that no seed supports often enough at first may become supported by accepted instances; those that
    # hold a single instance never can.
    wide = edges.groupBy("kind", "pattern").agg(F.count("*").alias("n")).where(F.col("n") > support)
    # What is joined to the graph is written first: the values of a pattern that much of the table holds then meet a
    # plain table, and Spark may split their partition.
    wide = staged(wide.select("kind", "pattern"), "patterns")
    edges = staged(edges.join(wide, ["kind", "pattern"]), "graph")
    known = edges.where("seed").select("kind", "value").distinct().withColumn("score", F.lit(1.0))
    for _ in range(rounds):
        scored = edges.join(known, ["kind", "value"], "left")
        good = scored.groupBy("kind", "pattern").agg(
            (F.sum(F.coalesce("score", F.lit(0.0))) / (F.count("*") + 1)).alias("p"), F.count("score").alias("hits")
        )
        good = staged(
            good.where((F.col("hits") >= support) & (F.col("p") >= pattern_score)).select("kind", "pattern", "p"), "good"
        )
        reached = edges.where(~F.col("seed")).join(good, ["kind", "pattern"]).groupBy("kind", "value").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("p"))))).alias("score")
        ).where(F.col("score") >= instance_score)
        seeds = edges.where("seed").select("kind", "value").distinct().withColumn("score", F.lit(1.0))
        known = staged(
            seeds.unionByName(reached.join(seeds.select("kind", "value"), ["kind", "value"], "left_anti")), "known"
        )
    return known.where("score < 1").select("kind", "value")


def find(docs: DataFrame, **scoring) -> DataFrame:
    """doc_id, the number of base spans of each kind, the SHA-256 of their list, and the list of all spans as
    kind:start:end; identifiers that only patterns vouch for have the kind ``found``."""
    require(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = staged(
        docs.select("doc_id", "text").transform(
            in_batches, _scan, f"doc_id {kind}, {_SCHEMA}"
        ).withColumn("row", F.monotonically_increasing_id()),
        "pii"
    )
    seen = rows.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    accepted = bootstrap(seen.select("kind", "seed", "value", "patterns"), **scoring)
    more = seen.where(~F.col("seed")).join(accepted, ["kind", "value"]).groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).alias("more")
    )
    names = F.array(*map(F.lit, (*KINDS, FOUND)))
    text = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)")
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as long)").alias(f"n_{name}") for k,
        name in enumerate(KINDS)
    ]
    return rows.join(more, "row", "left").select(
        "doc_id", *counts, F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(F.concat("base", F.coalesce("more", none))).alias("spans")
    )
