"""Secret scans over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over the trigrams that every match must contain.
A scan indexes its documents block by block: for the trigrams that any rule asks for, postings of the documents
that hold them. A rule's query intersects and unites postings; only the documents it leaves are searched with
the expression. A rule from which no mandatory trigram follows searches every document.

Texts are searched as UTF-8 bytes, so letter case folds within ASCII only; offsets are in code points.

Edge cases: null and empty texts have no spans; very long texts are searched whole, in a block of their own; repeated
rows get equal results; other columns are not read by ``scan`` and go through ``redact`` unchanged, whatever their
names; an empty table gives an empty result. Matches of one rule never overlap, those of different rules may; of
spans that start together the rule named first comes first.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as sre
import re._parser as parser
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lociflow.llm._text import in_batches, numbered, require, small_batches


@dataclass(frozen=True)
class Rule:
    """kind; expression; whether letter case counts; least length of the match, or of ``group``."""

    kind: str
    pattern: str
    ignore_case: bool = False
    least: int = 0
    group: int = 0


#: The base rules, in the order of the digest.
BASE = (
    Rule(
        "assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 6, 2
    ),
    Rule("access", r"AKIA[A-Z0-9]+", False, 20),
    Rule("hex", r"[0-9a-f]+", False, 24),
)
#: Further formats that tell secrets by their own text.
MORE = (
    Rule("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}=*", True),
    Rule("url", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@\"']{1,64}:[^\s/:@\"']{3,128}@[A-Za-z0-9.-]+"),
)
RULES = BASE + MORE

#: At most so many alternatives are followed before a stretch of an expression counts as unknown.
MOST_STRINGS = 64

#: A query is True (every document), ("tri", code), ("and", parts) or ("or", parts).
Query = bool | tuple


def _both(kind: str, parts: list[Query]) -> Query:
    if kind == "and":
        parts = [p for p in parts if p is not True]
        return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(dict.fromkeys(parts)))
    if True in parts or not parts:
        return True
    return parts[0] if len(parts) == 1 else ("or", tuple(dict.fromkeys(parts)))


def _need(strings: set[str]) -> Query:
    """Of a text that holds one of the strings."""
    one = lambda s: _both("and", [("tri", s[i : i + 3]) for i in range(len(s) - 2)])
    return _both("or", [one(s) for s in sorted(strings)])


def _walk(tree, fold: bool) -> tuple[set[str] | None, Query]:
    """The finite set of strings that a piece of an expression can match, or None, and what else it needs."""
    needs: list[Query] = []
    done: set[str] = {""}

    def cut() -> None:
        nonlocal done
        needs.append(_need(done))
        done = {""}

    exact = True
    for op, arg in tree:
        if op is sre.LITERAL:
            c = chr(arg)
            step: set[str] | None = {c.lower() if fold else c} if arg < 128 else None
            more: Query = True
        elif op is sre.IN and len(arg) <= 8 and all(o is sre.LITERAL and v < 128 for o, v in arg):
            step, more = {chr(v).lower() if fold else chr(v) for _, v in arg}, True
        elif op is sre.SUBPATTERN:
            # A group that changes how letters match may hold anything.
            step, more = (None, True) if (arg[1] | arg[2]) & re.IGNORECASE else _walk(arg[3], fold)
        elif op is sre.BRANCH:
            ways = [_walk(b, fold) for b in arg[1]]
            step = set().union(*(w[0] for w in ways)) if all(w[0] is not None for w in ways) else None
            more = _both(
                "or", [_both("and", [w[1], _need(w[0]) if w[0] is not None else True]) for w in ways]
            ) if step is None else _both("or", [w[1] for w in ways])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            inner, more = _walk(body, fold)
            step = None
            if high == 1 and inner is not None:
                step, more = inner | {""}, True
            elif low == high == 1:
                step = inner
            elif low == 0:
                more = True
            elif inner is not None:
                more = _both("and", [more, _need(inner)])
        elif op is sre.AT:
            continue
        else:
            step, more = None, True
        needs.append(more)
        joined = {a + b for a in done for b in step} if step is not None and len(done) * len(step) <= MOST_STRINGS else None
        if joined is None:
            exact = False
            cut()
            if step is not None:
                done = step
        else:
            done = joined
    if exact:
        return done, _both("and", needs)
    cut()
    return None, _both("and", needs)


def trigram_query(pattern: str, ignore_case: bool = False) -> Query:
    """A condition on a text's trigrams that holds wherever the expression matches."""
    tree = parser.parse(pattern)
    if tree.state.flags & re.IGNORECASE and not ignore_case:
        return True  # by a flag inside the expression; only the rule's own setting chooses the index
    strings, more = _walk(tree, ignore_case)
    return _both("and", [more, _need(strings) if strings is not None else True])


def trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams, query[1]))


class TrigramIndex:
    """Postings of a block of documents for the trigrams that a set of queries asks for."""

    def __init__(self, wanted: set[str], fold: bool) -> None:
        self.names = sorted(wanted)
        self.fold = np.arange(256, dtype=np.uint8)
        if fold:
            self.fold[65:91] += 32
        code = np.array([int.from_bytes(t.encode(), "big") for t in self.names], np.uint32)
        self.order = np.argsort(code)
        self.code = code[self.order]
        #: Whether any trigram has these low bits: most of a text is told apart by this small table.
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.code & 0xFFFF] = True
        self.postings: dict[str, np.ndarray] = {}

    def load(self, raw: np.ndarray, ends: np.ndarray) -> None:
        self.postings = {}
        if not self.names or len(raw) < 3:
            return
        x = self.fold[raw].astype(np.uint32)
        x = x[:-2] << 16 | x[1:-1] << 8 | x[2:]
        at = np.flatnonzero(self.maybe[x & 0xFFFF])
        slot = np.minimum(np.searchsorted(self.code, x[at]), len(self.code) - 1)
        ok = self.code[slot] == x[at]
        at, which = at[ok], self.order[slot[ok]]
        doc = np.searchsorted(ends, at, "right") - 1
        inside = at + 3 <= ends[doc + 1]
        both = np.unique(which[inside] * len(ends) + doc[inside])
        which, doc = np.divmod(both, len(ends))
        cut = np.searchsorted(which, np.arange(len(self.names) + 1))
        self.postings = {t: doc[cut[i] : cut[i + 1]] for i, t in enumerate(self.names)}

    def find(self, query: Query, n: int) -> np.ndarray:
        """Documents of the block that may match."""
        if query is True:
            return np.arange(n)
        if query[0] == "tri":
            return self.postings.get(query[1], np.zeros(0, np.int64))
        parts = [self.find(q, n) for q in query[1]]
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
        return out


class Scanner:
    """Finds the spans of all rules in blocks of texts."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.rules = rules
        self.compiled = [re.compile(r.pattern.encode(), re.IGNORECASE if r.ignore_case else 0) for r in rules]
        self.quick = [self._quick(r) for r in rules]
        self.queries = [trigram_query(r.pattern, r.ignore_case) for r in rules]
        self.index = {
            fold: TrigramIndex(
                set().union(
                    *(trigrams(q) for q, r in zip(self.queries, rules, strict=True) if r.ignore_case == fold), set()
                ),
                fold
            ) for fold in (False, True)
        }

    @staticmethod
    def _quick(rule: Rule) -> re.Pattern | None:
        """A run of one class with a least length: shorter runs fail inside the matcher, not one by one."""
        if not rule.group and rule.least and (m := re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)):
            return re.compile(f"{m[1]}{{{rule.least},}}".encode(), re.IGNORECASE if rule.ignore_case else 0)
        return None

    def block(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Of each text the (start, rule, end) of its matches, in bytes."""
        raw = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=ends[1:])
        for index in self.index.values():
            index.load(raw, ends)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, rule in enumerate(self.rules):
            for d in self.index[rule.ignore_case].find(self.queries[k], len(texts)):
                for m in (self.quick[k] or self.compiled[k]).finditer(texts[d]):
                    s, e = m.span(rule.group)
                    if e - s >= rule.least:
                        out[d].append((m.start(), k, m.end()))
        return out


def code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans with offsets in code points."""
    if not spans or text.isascii():
        return spans
    cuts = sorted({x for s, _, e in spans for x in (s, e)})
    at, n, where = 0, 0, {}
    for c in cuts:
        n += len(text[at:c].decode("utf-8", "replace"))
        at, where[c] = c, n
    return [(where[s], k, where[e]) for s, k, e in spans]


def listed(spans: list[tuple[int, int, int]], kinds: Sequence[str]) -> str:
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(spans))


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame, rules: Sequence[Rule] = MORE) -> DataFrame:
    """doc_id, the number of spans of each base rule, the SHA-256 of their list, and the list of all spans as
    kind:start:end. ``rules`` add spans to those of the base rules. One scan, no shuffle."""
    require(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rules = BASE + tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, kinds = Scanner(rules), [r.kind for r in rules]
        for part, texts in small_batches(batches):
            found = [code_points(t, s) for t, s in zip(texts, scanner.block(texts), strict=True)]
            base = [[x for x in s if x[1] < len(BASE)] for s in found]
            counts = [pa.array([sum(x[1] == k for x in s) for s in base], pa.int64()) for k in range(len(BASE))]
            digest = pa.array([hashlib.sha256(listed(s, kinds).encode()).hexdigest() for s in base], pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index("doc_id")), *counts, digest,
                    pa.array([listed(s, kinds) for s in found], pa.string())
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            )

    return docs.select("doc_id", "text").transform(in_batches, run, f"doc_id {kind}, {SCHEMA}")


def redact(docs: DataFrame, rules: Sequence[Rule] = MORE) -> DataFrame:
    """docs with every span replaced by [kind]; overlapping spans become one, named by the first."""
    require(docs, "text")
    rules = BASE + tuple(rules)
    safe, name = numbered(docs)
    text = name["text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for part, texts in small_batches(batches, text):
            at = part.schema.get_field_index(text)
            null = part.column(at).is_null().to_pylist()
            out = []
            for t, spans, no in zip(texts, scanner.block(texts), null, strict=True):
                pieces, reach = [], 0
                for s, k, e in sorted(spans):
                    if s >= reach:
                        pieces += [t[reach:s], b"[" + rules[k].kind.encode() + b"]"]
                    reach = max(reach, e)
                out.append(None if no else b"".join([*pieces, t[reach:]]).decode("utf-8", "replace") if pieces else t.decode("utf-8", "replace"))
            cols = [part.column(i) for i in range(part.num_columns)]
            cols[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, part.schema.names)

    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    return safe.transform(in_batches, run, schema).toDF(*docs.columns)
