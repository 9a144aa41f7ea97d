import numpy as np
import pytest
from pathlib import Path

import corpus_pipeline
from lociflow.llm import mixing, spm
from tests.llm.data import documents, frame
from tests.llm.test_dedup import linked
from tests.llm.test_scans import repeats
from tests.llm.data import words

pytestmark = pytest.mark.skipif(not Path(spm.MODEL).exists(), reason="no model file")


def test_run(spark, tmp_path):
    rows = [r for r in documents(9, 80) if r[0] is not None]
    rows += [
        (2000 + i, f"{' '.join(f'u{i}x{j}' for j in range(40))} token = \"{'ab12' * 8}\"", *r[2:]) for i,
        r in enumerate(rows[:6])
    ]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    good = [r for r in rows if len(words(r[1])) >= 20 and 100 * repeats(words(r[1])) <= 30 * len(words(r[1]))]
    one = {c for _, _, c in linked(good)}
    kept = {r[0]: r for r in good if r[0] in one}
    assert {r.doc_id for r in got} <= set(kept)
    # What the mix leaves out is left out by its plan alone.
    docs = frame(spark, list(kept.values()))
    plan = {
        r.doc_id: r.repeats + (r.extra * 2 >= r["size"]) for r in mixing.mix_plan(corpus_pipeline.without_secrets(spark, docs, "")).collect()
    }
    assert sorted(r.doc_id for r in got) == sorted(i for i, n in plan.items() for _ in range(n))
    model = spm.load()
    for r in got:
        text = spm.decode(model, np.array(r.ids, np.int64), np.array([0, len(r.ids)]))[0].decode()
        want = kept[r.doc_id][1]
        assert text == want or ("token" in want and text.endswith('[assign]"') and r.doc_id >= 2000)


def test_run_with_null_ids_and_on_no_rows(spark, tmp_path):
    """Rows without an id go through all stages; of their groups one stays too, that with an id if there is one."""
    say = lambda k: " ".join(f"{k}w{j}" for j in range(40))
    rows = [(None, say(i % 5), *[None] * 6) for i in range(10)] + [(7, say(0), None, "a", *[None] * 4)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, "")
    assert sorted(
        (r.doc_id or 0, r.text[:2]) for r in docs.collect()
    ) == [(0, f"{i}w") for i in range(1, 5)] + [(7, "0w")]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and all(r.n_pieces == len(r.ids) > 0 for r in got)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_stages_keep_the_columns(spark):
    rows = documents(2, 12)
    docs = frame(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, docs.limit(0), "").count() == 0
