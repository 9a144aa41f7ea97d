from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from lociflow.llm import queries, shards
from tests.llm.data import documents, frame, multiset


def table(spark, tmp_path, **options):
    return shards.ShardTable(spark, f"file://{tmp_path}/t", **options)


def test_append_compact_read(spark, tmp_path):
    t = table(spark, tmp_path, target_bytes=1 << 20, fan_in=3)
    rows = [documents(s, 20) for s in range(5)]
    for r in rows:
        t.append(frame(spark, r).coalesce(1))
    assert t.version() == 5 and len(t.shards()) == 5 and {s.level for s in t.shards()} == {0}
    everything = multiset(x for r in rows for x in r)
    assert multiset(t.read().collect()) == everything
    assert t.compact() == 6 and len(t.shards()) == 1 and t.shards()[0].level == 1
    assert multiset(t.read().collect()) == everything
    assert len(t.shards(3)) == 3 and t.read(3).count() == sum(map(len, rows[:3]))
    assert t.vacuum() == 5 and t.read().count() == len(everything)
    assert t.compact() == 6  # nothing is left to merge


def test_plan_merges_similar_sizes(spark, tmp_path):
    t = table(spark, tmp_path, target_bytes=1000, fan_in=3)
    s = lambda *sizes: [shards.Shard(f"p{i}", n, 1, 0) for i, n in enumerate(sizes)]
    assert t.plan(s(10, 10)) == []
    assert [[x.size for x in r] for r in t.plan(s(10, 11, 12, 500, 900))] == [[10, 11, 12]]
    assert [[x.size for x in r] for r in t.plan(s(400, 400, 400))] == [[400, 400]]


def test_one_of_two_writers_wins(spark, tmp_path):
    t = table(spark, tmp_path)
    t.append(frame(spark, documents(1, 20)).coalesce(1))
    with pytest.raises(shards.Conflict):
        t._commit(0, [], t.schema(), "late")
    assert t.version() == 1 and len(t.shards()) == 1


def test_compacted_keeps_every_row(spark):
    rows = documents(3)
    out = shards.compacted(frame(spark, rows), arrivals=5, target_bytes=4 << 20)
    got = out.collect()
    assert multiset(tuple(r)[:8] for r in got) == multiset(rows)
    assert all(r.shard is not None and r.shard_rows > 0 for r in got)
    assert shards.compacted(frame(spark, [])).count() == 0


def test_clashing_names(spark):
    docs = frame(spark, documents(3)).withColumnRenamed("n_words", "shard").withColumnRenamed("rid", "level_")
    out = shards.compacted(docs, arrivals=2)
    assert out.columns == [
        *docs.columns, "shard_", "level", "shard_rows", "n_shards"
    ] and out.where("shard_ IS NULL").count() == 0


def test_rows_name_the_shards_of_the_manifest(spark, tmp_path, monkeypatch):
    """The registered query's table, with the production target: each row stands in the shard that it names."""
    docs = frame(spark, documents(3))
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    made, real = [], shards.compacted
    monkeypatch.setattr(shards, "new_path", lambda spark, name: f"file://{tmp_path}/t")
    monkeypatch.setattr(
        shards, "compacted", lambda *a,
        **k: made.append((k.get("target_bytes", shards.TARGET_BYTES), real(*a, **k))) or made[-1][1]
    )
    assert queries.op6_sharding(spark, str(tmp_path)).count() == docs.count()
    (target, out), live = made[0], sorted(table(spark, tmp_path).shards(), key=lambda x: x.path)
    assert target == 128 << 20
    got = out.groupBy("shard", "level", "shard_rows").count().collect()
    assert sorted(tuple(r) for r in got) == [(i, x.level, x.rows, x.rows) for i, x in enumerate(live)]
    assert max(x.level for x in live) > 0


def test_each_arrival_is_a_version(spark, tmp_path):
    t = table(spark, tmp_path, target_bytes=1 << 20, fan_in=3)
    rows = documents(4)
    docs = frame(spark, rows).coalesce(1).withColumn("day", F.pmod(F.hash("doc_id"), F.lit(3)))
    assert t.append(docs, "day") == 3 and t.version() == 3
    assert [t.read(v).count() for v in (1, 2, 3)] == list(
        accumulate(n for _, n in sorted(docs.groupBy("day").count().collect()))
    )
    assert multiset(t.read().collect()) == multiset(rows)


def test_runs_are_tasks_of_one_job(spark, tmp_path):
    """Two tiers: each run becomes one file, and the rows of the manifest are those of the files."""
    t = table(spark, tmp_path, target_bytes=1 << 30, fan_in=2)
    for i in range(6):
        docs = spark.range(10 if i < 3 else 200_000).withColumn("v", F.rand(i))
        t.append(docs.coalesce(1))
    runs = t.plan(t.shards())
    assert [len(r) for r in runs] == [3, 3]
    t.compact()
    assert sorted(s.rows for s in t.shards()) == [30, 600_000] and {s.level for s in t.shards()} == {1}
    t.compact(everything=True)
    assert [(s.rows, s.level) for s in t.shards()] == [(600_030, 2)] and t.read().count() == 600_030


def test_without_compaction_the_query_differs(spark, tmp_path, monkeypatch):
    docs = frame(spark, documents(3)).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    made = queries.op6_sharding(spark, str(tmp_path)).select("merged", "n_shards", "shard_rows").distinct().collect()
    assert [tuple(r) for r in made] == [(True, 1, docs.count())]
    monkeypatch.setattr(shards.ShardTable, "compact", lambda self, **_: self.version())
    assert queries.op6_sharding(spark, str(tmp_path)).where("merged OR n_shards = 1").count() == 0


def test_vacuum_spares_a_writer_that_has_not_committed(spark, tmp_path, monkeypatch):
    t, other = table(spark, tmp_path), table(spark, tmp_path)
    t.append(frame(spark, documents(1, 20)).coalesce(1))
    commit = shards.ShardTable._commit
    monkeypatch.setattr(shards.ShardTable, "_commit", lambda self, *a: (other.vacuum(), commit(self, *a))[1])
    t.append(frame(spark, documents(2, 20)).coalesce(1))
    assert t.read().count() == len(documents(1, 20)) + len(documents(2, 20))
    folder = t._begin()
    frame(spark, documents(2, 20)).coalesce(1).write.parquet(folder)
    assert t.vacuum() == 0 and t.vacuum(expires_s=0) == 1


def test_a_late_append_is_committed_upon_the_other(spark, tmp_path, monkeypatch):
    t, other = table(spark, tmp_path), table(spark, tmp_path)
    commit, first = shards.ShardTable._commit, []

    def late(self, *a):
        if self is t and not first:
            first.append(1)
            other.append(frame(spark, documents(2, 20)).coalesce(1))
        return commit(self, *a)

    monkeypatch.setattr(shards.ShardTable, "_commit", late)
    assert t.append(frame(spark, documents(1, 20)).coalesce(1)) == 2
    assert t.read().count() == len(documents(1, 20)) + len(documents(2, 20))


def test_a_merge_of_removed_shards_is_dropped(spark, tmp_path, monkeypatch):
    t, other = table(spark, tmp_path, fan_in=2), table(spark, tmp_path, fan_in=2)
    for s in range(3):
        t.append(frame(spark, documents(s, 20)).coalesce(1))
    merge, first = shards.ShardTable._merge, []

    def late(self, *a):
        if self is t and not first:
            first.append(1)
            other.compact(everything=True)
        return merge(self, *a)

    monkeypatch.setattr(shards.ShardTable, "_merge", late)
    t.compact(everything=True)
    assert t.read().count() == sum(len(documents(s, 20)) for s in range(3))


def test_arrivals_with_other_columns(spark, tmp_path):
    """New columns widen the table and outlive compaction and vacuum; another type is refused."""
    t = table(spark, tmp_path, fan_in=2)
    t.append(spark.createDataFrame([(1, "a")], "id long, v string").coalesce(1))
    t.append(spark.createDataFrame([(2, "b", "x")], "ID long, v string, extra string").coalesce(1))
    t.append(spark.createDataFrame([("y", 3, [1.5])], "Extra string, id long, `a b` array<double>").coalesce(1))
    want = [(1, "a", None, None), (2, "b", "x", None), (3, None, "y", [1.5])]

    def held():
        rows = t.read()
        assert rows.columns == ["id", "v", "extra", "a b"]
        return multiset(rows.collect())

    assert held() == multiset(want)
    assert t.read(1).columns == ["id", "v"] and t.read(2).columns == ["id", "v", "extra"]
    t.compact(everything=True)
    assert len(t.shards()) == 1 and held() == multiset(want)
    assert t.vacuum() >= 3 and held() == multiset(want)
    before = t.version()
    with pytest.raises(TypeError, match="extra"):
        t.append(spark.createDataFrame([(4, 7)], "id long, extra int"))
    assert t.version() == before and t.vacuum() == 0 and held() == multiset(want)
    t.append(spark.createDataFrame([], "id long, late date"))
    assert t.read().columns == ["id", "v", "extra", "a b", "late"] and t.read().count() == 3


def test_two_writers_bring_columns(spark, tmp_path, monkeypatch):
    """The one that commits later widens the other's schema."""
    t, other = table(spark, tmp_path), table(spark, tmp_path)
    commit, first = shards.ShardTable._commit, []

    def late(self, *a):
        if self is t and not first:
            first.append(1)
            other.append(spark.createDataFrame([(1, "o")], "id long, theirs string").coalesce(1))
        return commit(self, *a)

    monkeypatch.setattr(shards.ShardTable, "_commit", late)
    t.append(spark.createDataFrame([(2, "m")], "id long, mine string").coalesce(1))
    assert t.read().columns == ["id", "theirs", "mine"]
    assert multiset(t.read().collect()) == multiset([(1, "o", None), (2, None, "m")])


def test_more_runs_than_one_round_takes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shards, "MOST_RUNS", 1)
    t = table(spark, tmp_path, target_bytes=2200, fan_in=2)
    t.append(spark.range(0, 30, 1, 30))
    assert len(t.shards()) == 30
    t.compact(everything=True)
    assert t.plan(t.shards(), everything=True) == [] and t.version() > 5
    assert sorted(r.id for r in t.read().collect()) == list(range(30))
