import struct
from itertools import product
from pathlib import Path

import numpy as np
import pytest

from lociflow.llm import spm
from tests.llm.data import documents, frame

needs_model = pytest.mark.skipif(not Path(spm.MODEL).exists(), reason="no model file")


def message(*fields):
    """Protocol-buffer bytes of (number, value) pairs."""
    out = b""
    for n, v in fields:
        if isinstance(v, int):
            out += bytes([n << 3]) + varint(v)
        elif isinstance(v, float):
            out += bytes([n << 3 | 5]) + struct.pack("<f", v)
        else:
            out += bytes([n << 3 | 2]) + varint(len(v)) + v
    return out


def varint(v):
    out = b""
    while v > 127:
        out, v = out + bytes([v & 127 | 128]), v >> 7
    return out + bytes([v])


def small_model(fallback=True):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] * fallback
    pieces += [
        (p, s, 1) for p,
        s in (
            ("▁", -3.0), ("a", -3.5), ("b", -3.0), ("ab", -4.0), ("▁a", -3.2), ("ba", -4.0), ("bab", -6.0),
            ("▁▁", -1.0), ("é", -2.0)
        )
    ]
    return message(
        *[(1, message((1, p.encode()), (2, s), (3, k))) for p, s, k in pieces],
        (3, message((1, b"identity"), (3, 1), (4, 0)))
    )


def best(model, word):
    """Viterbi by plain loops: the greatest score, of equals the longest last piece."""
    table = {
        p: (i, float(s)) for i,
        (p, s, k) in enumerate(zip(model.pieces, model.score, model.kind, strict=True)) if k == 1
    }
    score, back = [0.0] + [-np.inf] * len(word), [None] * (len(word) + 1)
    for j in range(1, len(word) + 1):
        for i in range(j):
            hit = table.get(word[i:j]) or ((model.unknown, float(model.unknown_score)) if j == i + 1 else None)
            if hit and score[i] + hit[1] > score[j]:
                score[j], back[j] = score[i] + hit[1], (i, hit[0])
    out, j = [], len(word)
    while j:
        i, p = back[j]
        out = (
            [int(model.bytes_[b]) for b in word[i:j].encode()] if p == model.unknown and model.fallback else [p]
        ) + out
        j = i
    return out


@pytest.mark.parametrize("fallback", [True, False])
def test_viterbi_against_plain_loops(fallback):
    model = spm.Model(small_model(fallback))
    texts = ["", "ab", "abab  baé", "  ", "x\nab", "aaabbb" * 50, "é é", "日本 ab", " a ", "a\n\nb"]
    ids, ends = spm.Encoder(model).encode([t.encode() for t in texts])
    for t, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
        assert ids[a:b].tolist() == (best(model, "▁" + t.replace(" ", "▁")) if t else []), t
    if fallback:
        assert [t.decode() for t in spm.decode(model, ids, ends)] == texts


@needs_model
def test_round_trip(spark):
    rows = [r for r in documents() if r[0] is not None] + [(1000, "a\n b  c \t日 😀 <s> <0x0A>", *[None] * 6)]
    out = spm.encode(frame(spark, rows))
    back = sorted((r.doc_id, r.text) for r in spm.decoded(out).collect())
    assert back == sorted((r[0], r[1] or "") for r in rows)
    assert all(r.n_pieces == len(r.ids) for r in out.collect())
    assert spm.encode(frame(spark, [])).count() == 0


@needs_model
def test_equals_the_library_as_a_unigram_model():
    sp = pytest.importorskip("sentencepiece")
    try:
        from sentencepiece import sentencepiece_model_pb2 as pb
    except ImportError:
        pytest.skip("no protocol buffers")
    m = pb.ModelProto()
    m.ParseFromString(Path(spm.MODEL).read_bytes())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        p.score = max(p.score, -40000.0)  # the library adds in single precision; scores of -1e9 drown all others
    lib = sp.SentencePieceProcessor(model_proto=m.SerializeToString())
    texts = [r[1] or "" for r in documents(7) if len(r[1] or "") < 20000]
    ids, ends = spm.Encoder(spm.Model(m.SerializeToString())).encode([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == lib.encode(texts)


def test_normalising_models_are_refused():
    with pytest.raises(ValueError):
        spm.Model(small_model() + message((3, message((1, b"nmt_nfkc"), (2, b"x"), (4, 0)))))


@pytest.mark.parametrize("cells", [1, 40, 1 << 19])
def test_stretches_of_any_length(monkeypatch, cells):
    """Words longer than what is worked on at once, against plain loops; many short ones too."""
    monkeypatch.setattr(spm, "MOST_CELLS", cells)
    model = spm.Model(small_model())
    texts = ["ab" * 30 + "baé日", "b" * 77, *("".join(w) for w in product("abé", repeat=4))]
    ids, ends = spm.Encoder(model).encode([t.encode() for t in texts])
    assert [
        ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)
    ] == [best(model, "▁" + t) for t in texts]


@needs_model
def test_very_long_word():
    word = ("abcdefgh日" * 60_000).encode()
    model = spm.load()
    encoder = spm.Encoder(model)
    ids, ends = encoder.encode([word])
    assert spm.decode(model, ids, ends) == [word]
    encoder.encode([word, word[:-3] * 2])
    encoder.encode([b"x"])
    assert encoder.held < spm.MOST_BYTES
