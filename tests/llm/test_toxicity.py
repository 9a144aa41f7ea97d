import random
import zlib

import numpy as np

from lociflow.llm import queries, toxicity
from tests.llm.data import documents, frame

INSULTS, GROUPS = ["grobnik", "vuzzle", "skrail"], ["northers", "hillfolk", "é-folk"]


def corpus(seed, size):
    """Toxic: an insult and the mention of a group. Either alone, or neither, is not."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(300)]
    rows = []
    for i in range(size):
        w = rng.choices(vocab, k=rng.randint(5, 120))
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        for words in [INSULTS] * insult + [GROUPS] * group:
            w.insert(rng.randrange(len(w)), rng.choice(words).upper() + rng.choice(["", "!", "."]))
        rows.append((i, " ".join(w), int(insult and group)))
    return rows


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").repartition(2)


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_pairs_of_terms_on_held_out_documents(spark):
    """The machine knows held-out documents; without factors, which is a linear model, it does not."""
    rows = corpus(1, 2500)
    docs, known = frame(spark, [(i, t, *[None] * 6) for i, t, _ in rows]), labels(spark, [(i, 1, y) for i, _, y in rows])
    got = {r.doc_id: r for r in toxicity.toxicity(docs, known).collect()}
    assert len(got) == len(rows) and all(got[i].held_out == held(i) for i in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    right = [got[i].predicted == y for i, _, y in rows if held(i)]
    assert sum(right) >= 0.98 * len(right)
    terms = toxicity.TermIds(18)
    f, y = [terms.of(t.encode()) for _, t, _ in rows], np.array([y for *_, y in rows], float)
    learn = [i for i, *_ in rows if not held(i)]
    linear = toxicity.fit_rows([f[i] for i in learn], y[learn], factors=1, epochs=20)
    linear.factor[:] = 0
    assert np.mean([(linear.score([f[i]])[0] >= 0.5) == y[i] for i in range(len(rows)) if held(i)]) < 0.9


def test_held_out_labels_are_not_learned_from(spark):
    rows = corpus(2, 800)
    docs = frame(spark, [(i, t, *[None] * 6) for i, t, _ in rows])
    score = lambda flip: sorted(
        (r.doc_id, r.score) for r in toxicity.toxicity(
            docs, labels(spark, [(i, 1, 1 - y if flip and held(i) else y) for i, _, y in rows])
        ).collect()
    )
    assert score(False) == score(True)


def test_other_columns_play_no_part(spark):
    rows = corpus(3, 400)
    known = labels(spark, [(i, 1, y) for i, _, y in rows])
    a = frame(spark, [(i, t, "en", "s", 1, 1, "r", None) for i, t, _ in rows])
    b = frame(spark, [(i, t, "de", "z", 9, 2, "q", "x") for i, t, _ in rows])
    assert sorted(toxicity.toxicity(a, known).collect()) == sorted(toxicity.toxicity(b, known).collect())


def test_awkward_rows(spark):
    rows = documents()
    known = [(r[0], 1, int("passage" in (r[1] or "") or i % 3 == 0)) for i, r in enumerate(rows)]
    known += [(None, 1, 1), (rows[0][0], None, None), (rows[1][0], 1, 1), (rows[1][0], 1, 0), (10**12, 1, 1)]
    got = toxicity.toxicity(frame(spark, rows), labels(spark, known)).collect()
    assert len(got) == len(rows) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    by_text = {}
    for r in got:
        by_text.setdefault(dict((x[0], x[1]) for x in rows if x[0] is not None).get(r.doc_id), set()).add(r.score)
    assert all(len(s) == 1 for t, s in by_text.items() if t)
    assert toxicity.toxicity(frame(spark, []), labels(spark, known)).count() == 0


def test_without_labels(spark):
    got = toxicity.toxicity(frame(spark, documents()), labels(spark, [])).collect()
    assert {round(r.score, 9) for r in got} == {0.1} and {r.predicted for r in got} == {0}


def test_the_sample_is_bounded(spark):
    rows = corpus(4, 1000)
    docs = frame(spark, [(i, t, *[None] * 6) for i, t, _ in rows] + [(1, f"other {k}", *[None] * 6) for k in range(50)])
    known = labels(spark, [(i, 1, y) for i, _, y in rows])
    assert 60 < toxicity.sample(docs, known, 100).count() < 140
    full = toxicity.sample(docs, known).collect()
    assert sorted(r.doc_id for r in full) == [i for i, *_ in rows if not held(i)]


def test_query(spark, tmp_path):
    rows = corpus(5, 300)
    frame(spark, [(i, t, *[None] * 6) for i, t, _ in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, [(i, 1, y) for i, _, y in rows]).write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op12_toxicity(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert got.count() == 300
