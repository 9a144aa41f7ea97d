"""SentencePiece encoding and decoding by batched Viterbi.

A piece model is read from its file; the best segmentation of a text under its scores is found word by word, as
no piece reaches across the space before a word. Distinct words that are not known yet are grouped by length, and
all words of one length advance together: hashes of their substrings probe the sorted keys of the pieces, and a
vectorised maximum over the pieces that end at a position stores a back-pointer. Known words are looked up. Only the
scores of the last positions that a piece can reach are kept, and a back-pointer takes a byte or two, so a word of
any length costs a few bytes for each of its characters.

The segmentation is that of the unigram algorithm: the greatest sum of scores, of equal ones the one whose last
piece starts first; sums are in double precision. For a model of the unigram type this is the library's own
encoding, but for what that loses by summing whole texts in single precision. For one of the BPE type,
whose scores are merge ranks, it is a valid encoding over the same pieces that may differ from the merge order;
it decodes to the same text. Characters without a piece become byte pieces, or the unknown piece.

Edge cases: null and empty texts have no pieces; decoding gives back the text exactly, but for the meta symbol
U+2581, which becomes a space; very long texts and words are encoded in full; ties go as stated above; repeated rows
get equal results; other columns are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm._text import in_batches, require, small_batches

#: Default model: a public vocabulary outside the repository. The path is a parameter everywhere.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Piece types of the model format, and what an unknown character scores below the worst piece.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Words and their bytes that an encoder keeps at most before it forgets them, and cells of scores that are filled at
#: once.
MOST_WORDS, MOST_BYTES, MOST_CELLS = 150_000, 8 << 20, 1 << 19


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(wire) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class Model:
    """Pieces, scores, types and the normaliser's settings of a model file."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[str] = []
        score, kind = [], []
        self.prefix, squeeze, name, charsmap = True, True, "", b""
        for field, value in _fields(data):
            if field == 1:
                f = dict(_fields(value))
                self.pieces.append(f.get(1, b"").decode())
                score.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                kind.append(f.get(3, NORMAL))
            elif field == 3:
                f = dict(_fields(value))
                name, charsmap = f.get(1, b"").decode(), f.get(2, b"")
                self.prefix, squeeze = bool(f.get(3, 1)), bool(f.get(4, 1))
        if charsmap or squeeze:
            raise ValueError(f"only models without normalisation are supported, not {name or 'this one'}")
        self.score, self.kind = np.array(score, np.float32), np.array(kind)
        self.unknown = int(np.flatnonzero(self.kind == UNKNOWN)[0])
        self.bytes_ = np.full(256, -1)
        for i in np.flatnonzero(self.kind == BYTE):
            self.bytes_[int(self.pieces[i][3:5], 16)] = i
        self.fallback = bool((self.bytes_ >= 0).all())
        self.unknown_score = np.float32(self.score[self.kind == NORMAL].min() - UNKNOWN_PENALTY)
        words = [(p, i) for i, p in enumerate(self.pieces) if self.kind[i] in (NORMAL, USER)]
        self.longest = max(len(p) for p, _ in words)
        key = np.array([_hash_text(p) for p, _ in words], np.uint64)
        o = np.argsort(key)
        self.key, self.id = key[o], np.array([i for _, i in words])[o]
        #: Which top bits of a hash any key has: most substrings are no piece and are told so without a search.
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.key >> np.uint64(44)] = True
        if (self.key[1:] == self.key[:-1]).any():
            raise ValueError("two pieces share a hash")
        #: Whether no piece reaches from a word into the next one's space, or across a line feed.
        self.by_word = not any(SPACE in p.lstrip(SPACE) or "\n" in p and len(p) > 1 for p, _ in words)
        plain = [self._plain(i) for i in range(len(self.pieces))]
        self.blob = np.frombuffer(b"".join(plain), np.uint8)
        self.at = np.zeros(len(plain) + 1, np.int64)
        np.cumsum([len(p) for p in plain], out=self.at[1:])

    def _plain(self, i: int) -> bytes:
        """What a piece adds to a decoded text."""
        if self.kind[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.kind[i] == CONTROL:
            return b""
        return " ⁇ ".encode() if self.kind[i] == UNKNOWN else self.pieces[i].replace(SPACE, " ").encode()


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hash_text(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c) + 1) & ((1 << 64) - 1)
    return h


def load(path: str = MODEL) -> Model:
    with open(path, "rb") as f:
        return Model(f.read())


class _Spaced(dict):
    """Numbers of words by what follows their single space."""

    def __init__(self, number) -> None:
        self.number = number

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.number(b" " + word)
        return n


class Encoder:
    """Encodes texts; remembers the pieces of words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.words: dict[bytes, int] = {}
        self.spaced = _Spaced(self._number)
        self.ids = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)
        self.new: list[bytes] = []
        self.held = 0

    def _number(self, word: bytes) -> int:
        """Number of a word given with its spaces."""
        n = self.words.get(word)
        if n is None:
            n = self.words[word] = len(self.words)
            self.new.append(word)
            self.held += len(word)
        return n

    def _split(self, text: bytes) -> list[int]:
        """Word numbers of a text."""
        if not text:
            return []
        if self.model.prefix:
            text = b" " + text
        if not self.model.by_word:
            return [self._number(text)]
        out: list[int] = []
        spaced, number = self.spaced.__getitem__, self._number
        for i, line in enumerate(text.split(b"\n")):
            if i:
                out.append(number(b"\n"))
            if b"  " in line or line.endswith(b" "):
                out += map(number, re.findall(rb" *[^ ]+| +", line))
                continue
            parts = line.split(b" ")
            if parts[0]:
                out.append(number(parts[0]))
            out += map(spaced, parts[1:])
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts end to end, and where each text starts (one more entry than texts)."""
        if len(self.words) > MOST_WORDS or self.held > MOST_BYTES:
            self.forget()
        numbers = [self._split(t) for t in texts]
        self._learn()
        flat = np.fromiter((n for x in numbers for n in x), np.int64, sum(map(len, numbers)))
        size = np.diff(self.ends)[flat]
        out = np.zeros(int(size.sum()), np.int32)
        to = np.cumsum(size) - size
        out = self.ids[np.repeat(self.ends[:-1][flat] - to, size) + np.arange(len(out))]
        words = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) for x in numbers], out=words[1:])
        upto = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(size, out=upto[1:])
        return out, upto[words]

    def _learn(self) -> None:
        if not self.new:
            return
        words = [w.decode("utf-8", "replace").replace(" ", SPACE) for w in self.new]
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w), []).append(i)
        row, ids = [], []
        for size, members in by_size.items():
            step = max(1, MOST_CELLS // (size * min(size, self.model.longest)))
            for a in range(0, len(members), step):
                part = members[a : a + step]
                r, x = self.viterbi([words[i] for i in part])
                row.append(np.array(part)[r])
                ids.append(x)
        row, ids = np.concatenate(row), np.concatenate(ids)
        self.ids = np.concatenate([self.ids, ids[np.argsort(row, kind="stable")].astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.bincount(row, minlength=len(words)))])
        self.new = []

    def viterbi(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best pieces of words of one length: word numbers and piece ids, word by word in order."""
        m, n, size = self.model, len(words), len(words[0])
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size)
        longest = min(size, m.longest)
        back, found = self._forward(code, longest)
        row, start, length = _trace(back)
        ids = self._pieces(code, row, start, length) if found is None else found[
            start + length - 1, longest - length, row
        ].astype(np.int64)
        if m.fallback and (ids == m.unknown).any():
            # An unknown character gives way to the pieces of its bytes.
            raw = [[i] for i in ids.tolist()]
            for x in np.flatnonzero(ids == m.unknown).tolist():
                raw[x] = m.bytes_[list(chr(code[row[x], start[x]]).encode("utf-8", "surrogatepass"))].tolist()
            row = np.repeat(row, [len(x) for x in raw])
            ids = np.array([i for x in raw for i in x])
        return row, ids

    def _forward(self, code: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Length of the best last piece of every prefix, [:, j] of the first j characters; and of words that take one
        stretch the pieces themselves, [j, longest - k] those of k characters that end with character j."""
        m, (n, size) = self.model, code.shape
        back = np.zeros((n, size + 1), np.uint8 if longest < 256 else np.uint16)
        step = max(1, MOST_CELLS // (n * longest))
        # best[i] stands for position a - longest + 1 + i, where a is the begin of the stretch.
        best = np.full((longest + step, n), -np.inf)
        best[longest - 1] = 0.0
        every = np.arange(n)
        found = np.full((size, longest, n), m.unknown, np.int32) if step >= size else None
        for a in range(0, size, step):
            b = min(size, a + step)
            # score[j, longest - k]: of the pieces of k characters that end with character a + j.
            score = np.full((b - a, longest, n), -np.inf)
            score[:, longest - 1] = float(m.unknown_score)
            begin = max(0, a - longest + 1)
            part = code[:, begin:b].astype(np.uint64) + np.uint64(1)
            h = np.zeros(part.shape, np.uint64)
            for k in range(1, longest + 1):
                h = h[:, : part.shape[1] - k + 1] * _BASE + part[:, k - 1 :]
                if not h.shape[1]:
                    break
                skip = max(0, a + 1 - k - begin)  # such a piece ends before the stretch
                own = h[:, skip:]
                some = np.nonzero(m.maybe[own >> np.uint64(44)])
                probe = own[some]
                at = np.minimum(np.searchsorted(m.key, probe), len(m.key) - 1)
                hit = m.key[at] == probe
                place, piece = (some[1][hit] + (begin + skip + k - 1 - a), longest - k, some[0][hit]), m.id[at[hit]]
                score[place] = m.score[piece]
                if found is not None:
                    found[place] = piece
            for j in range(b - a):
                # From the longest piece down: the maximum takes the first of equals.
                ways = best[j : j + longest] + score[j]
                pick = ways.argmax(0)
                best[j + longest] = ways[pick, every]
                back[:, a + j + 1] = longest - pick
            best[:longest] = best[b - a : b - a + longest].copy()
        return back, found

    def _pieces(self, code: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Ids of the pieces that stand at the places given."""
        m = self.model
        out = np.empty(len(row), np.int64)
        for i in range(0, len(row), MOST_CELLS):
            r, s, k = row[i : i + MOST_CELLS], start[i : i + MOST_CELLS], length[i : i + MOST_CELLS]
            h = np.zeros(len(r), np.uint64)
            for t in range(int(k.max(initial=0))):
                more = np.flatnonzero(k > t)
                h[more] = h[more] * _BASE + code[r[more], s[more] + t].astype(np.uint64) + np.uint64(1)
            at = np.minimum(np.searchsorted(m.key, h), len(m.key) - 1)
            out[i : i + MOST_CELLS] = np.where(m.key[at] == h, m.id[at], m.unknown)
        return out


def _trace(back: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and length of the pieces on the best paths, row by row in order."""
    n, size = back.shape[0], back.shape[1] - 1
    if n < 64:
        # Few words, and any of them may be very long: walk each by itself.
        rows, starts, lengths = array("q"), array("q"), array("q")
        for i in range(n):
            own, at = back[i].tolist() if size < 1 << 16 else back[i], size
            first = len(starts)
            while at:
                k = int(own[at])
                at -= k
                starts.append(at)
                lengths.append(k)
                rows.append(i)
            starts[first:] = starts[first:][::-1]
            lengths[first:] = lengths[first:][::-1]
        return tuple(np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64) for x in (rows, starts, lengths))
    row, start, length = [], [], []
    at, live = np.full(n, size), np.arange(n)
    while len(live):
        k = back[live, at[live]].astype(np.int64)
        at[live] -= k
        row.append(live)
        start.append(at[live])
        length.append(k)
        live = live[at[live] > 0]
    row, start, length = np.concatenate(row), np.concatenate(start), np.concatenate(length)
    o = np.lexsort((start, row))
    return row[o], start[o], length[o]


def decode(model: Model, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Texts from piece ids: the pieces' bytes end to end, without the space put before the first."""
    size = np.diff(model.at)[ids]
    to = np.cumsum(size) - size
    flat = model.blob[np.repeat(model.at[:-1][ids] - to, size) + np.arange(int(size.sum()))].tobytes()
    upto = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(size, out=upto[1:])
    cut = upto[ends].tolist()
    out = [flat[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return [t[1:] if model.prefix and t[:1] == b" " else t for t in out]


def encode(docs: DataFrame, path: str = MODEL, digest: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, the columns to keep, n_pieces and ids (array of int), or with ``digest`` the SHA-256 of the ids as
    32-bit little-endian numbers and of the text decoded from them. The model is read once for each task from the
    bytes that travel with it; the file need only be on the driver."""
    require(docs, "doc_id", "text", *keep)
    if set(keep) & {"doc_id", "text", "n_pieces", "ids"}:
        raise ValueError("a column to keep clashes with the result")
    front = ["doc_id", *keep]
    kind = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in front)
    with open(path, "rb") as f:
        data = f.read()
    Model(data)  # a model that is not supported fails here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(data)
        encoder = Encoder(model)
        for part, texts in small_batches(batches):
            ids, ends = encoder.encode(texts)
            own = [part.column(part.schema.get_field_index(c)) for c in front]
            count = pa.array(np.diff(ends), pa.int64())
            if digest:
                raw = [
                    hashlib.sha256(ids[a:b].astype("<i4").tobytes()).hexdigest() for a,
                    b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                back = [hashlib.sha256(t).hexdigest() for t in decode(model, ids, ends)]
                yield pa.RecordBatch.from_arrays(
                    [*own, count, pa.array(raw, pa.string()), pa.array(back, pa.string())],
                    [*front, "n_pieces", "ids_sha256", "decoded_sha256"]
                )
            else:
                yield pa.RecordBatch.from_arrays(
                    [*own, count, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))],
                    [*front, "n_pieces", "ids"]
                )

    extra = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>"
    return docs.select(*[F.col(f"`{c}`") for c in front], "text").transform(
        in_batches, run, f"{kind}, n_pieces long, {extra}"
    )


def decoded(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and text from (doc_id, ids)."""
    require(encoded, "doc_id", "ids")
    kind = encoded.schema["doc_id"].dataType.simpleString()
    with open(path, "rb") as f:
        data = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(data)
        for b in batches:
            rows = [np.array(x or [], np.int64) for x in b.column(1).to_pylist()]
            ends = np.zeros(len(rows) + 1, np.int64)
            np.cumsum([len(r) for r in rows], out=ends[1:])
            texts = decode(model, np.concatenate(rows) if rows else np.zeros(0, np.int64), ends)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").transform(in_batches, run, f"doc_id {kind}, text string")
