import random
import time

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lociflow.ml import labels, metrics
from lociflow.operators import blocks, effects, genotypes, intervals, phenotype, places, simulate, sites, splits
from lociflow.sources import fasta, ranges, sinks, tables


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(1, 2), st.integers(1, 300_000)), max_size=30),
    st.lists(st.tuples(st.integers(1, 2), st.integers(1, 300_000), st.integers(-2, 200_000)), max_size=20)
)
def test_stab_is_the_theta_join(spark, points, spans):
    p = spark.createDataFrame([(f"Chr{c}", x) for c, x in points], "chrom string, pos long")
    q = spark.createDataFrame(
        [(f"Chr{c}", s, s + n, i) for i, (c, s, n) in enumerate(spans)], "chrom string, start long, end long, k int"
    )
    got = sorted(map(tuple, intervals.stab(p, q).select("chrom", "pos", "k").collect()))
    assert got == sorted(
        (f"Chr{c}", x, i) for c, x in points for i, (d, s, n) in enumerate(spans) if c == d and s <= x <= s + n
    )
    left = intervals.stab(p, q, how="left")
    assert left.where("k IS NULL").count() == sum(
        not any(c == d and s <= x <= s + n for d, s, n in spans) for c, x in points
    )
    assert intervals.stab(p, q, how="left_semi").count() == sum(
        any(c == d and s <= x <= s + n for d, s, n in spans) for c, x in points
    )


def test_site_selection(spark):
    v = spark.createDataFrame(
        [("Chr1", 5, "A", "C"), ("Chr1", 9, "A", "C"), ("Chr2", 5, "G", "T")],
        "chrom string, pos long, ref string, alt string"
    )
    g = spark.createDataFrame(
        [("Chr1", 5, "h"), ("Chr1", 5, "y"), ("Chr2", 5, "h")], "chrom string, pos long, trait string"
    )
    q = spark.createDataFrame(
        [("Chr1", 1, 9, " y "), ("Chr2", 5, 5, "y")], "chrom string, start long, end long, trait string"
    )
    rows = lambda mode, **k: sorted((r.chrom, r.pos, r.qtl_trait, r.gwas_trait) for r in sites.select_sites(v, g, q, mode, **k).collect())
    assert rows("union") == [("Chr1", 5, "y", "h,y"), ("Chr1", 9, "y", ""), ("Chr2", 5, "y", "h")]
    assert rows("intersect") == [("Chr1", 5, "y", "y")]
    assert len(rows("intersect", shared="site")) == 2
    with pytest.raises(ValueError):
        rows("both")


def test_qtl_and_gwas_rules(spark):
    q = spark.createDataFrame(
        [("1", "20", "10", "t", "3"), ("1", "1", "2", "t", "2"), ("x", "1", "2", "t", "9"), ("1", "a", "2", "t", "9")],
        "Chromosome string, start_pos string, end_pos string, Trait string, LOD string"
    )
    assert [tuple(r) for r in tables.qtl(q, min_lod=2.0).collect()] == [("Chr1", 10, 20, "t", "")]
    g = spark.createDataFrame(
        [("1", "5.7", None, "0.1"), ("1", "6", "t", "0.5"), ("1", "7", "t", "nan")],
        "Chromosome string, Position string, Trait string, pvalue string"
    )
    assert [tuple(r) for r in tables.gwas(g, 0.5).collect()] == [("Chr1", 5, "nan")]
    with pytest.raises(ValueError):
        tables.gwas(g.drop("Trait"))


def test_genes_are_clipped(spark):
    g = spark.createDataFrame(
        [("Chr1", 3, 9, "", "n", ""), ("Chr1", -9, -8, "x", "", ""), ("Chr1", 1, 2, " ", "", "")],
        "chrom string, start long, end long, id string, name string, parent string"
    )
    assert [tuple(r) for r in sites.extend_genes(g, 5).collect()] == [("Chr1", 1, 14, "n")]


def test_sample_names(spark):
    df = spark.createDataFrame(list(enumerate(["1", "Sample_01", "abc", "s2"])), "idx int, raw_sample string")
    assert [r.sample for r in genotypes.standard_samples(df).orderBy("idx").collect()] == [
        "sample_1", "sample_1_2", "sample_3", "sample_2"
    ]


def test_last_record_counts(spark):
    calls = spark.createDataFrame(
        [("Chr1", 5, 1, "a", "0/1"), ("Chr1", 5, 2, "a", "1/1"), ("Chr1", 6, 3, "a", "1/1")],
        "chrom string, pos long, ord long, sample string, gt string"
    )
    got = genotypes.long_genotypes(calls, calls.where("pos = 5")).collect()
    assert [(r.site_id, r.dosage) for r in got] == [("Chr1:5", 2)]


def test_combinations(spark):
    base = {"Chr1:1": 1, "Chr1:2": 2, "Chr1:3": 1}
    df = simulate.combinations(spark, base, "s", list(base), ["Chr1:1", "Chr1:2"], dict.fromkeys(base, 2.0))
    rows = df.collect()
    assert len(rows) == 9 == len({tuple(r.features) for r in rows})
    target = [r for r in rows if r.is_target]
    assert [
        (r.combination_id, r.sample, list(r.features), r.mutated_features) for r in target
    ] == [("original", "s", [2.0, 4.0, 2.0], "")]
    assert simulate.combination_number([1, 2]) == 5
    other = next(r for r in rows if r.combination_id == "sim_000000")
    assert (other.mutated_feature_count, other.mutated_feature_genotypes) == (2, "Chr1:1:0;Chr1:2:0")


def test_location_groups(spark):
    rows = spark.createDataFrame(
        [(1, 2.0, 0, 0), (2, 4.0, 1, 0), (3, 6.0, 0, 0), (4, 1.0, 1, 1)], "ord int, value double, loc_a int, loc_b int"
    )
    got = simulate.location_groups(rows, ["loc_a", "loc_b"]).orderBy("group_id").collect()
    assert [(r.group_id, r.location_label, r.row_count, r.actual_value_mean) for r in got] == [
        ("group_001", "location_group_001", 2, 4.0), ("group_002", "loc_a", 1, 4.0),
        ("group_003", "loc_a__loc_b", 1, 1.0)
    ]


def test_scale_without_width(spark):
    assert spark.range(1).select(simulate.scale(F.lit(3.0), F.lit(3.0), F.lit(3.0), 0, 10)).first()[0] == 5.0


def test_phenotype(spark):
    sheet = spark.createDataFrame(
        [("a", 1.0, 4.005, None, 9.0), ("b", None, None, 2.0, 9.0)],
        "sample string, SPY_2019_x double, SPY_2020_x double, SPY_2019_y double, TGW_2019_y double"
    )
    got = sorted(map(tuple, phenotype.process_trait(sheet, "SPY").collect()))
    assert got == [("a", 2.502, 1, 0), ("b", 2.0, 0, 1)] or got == [("a", 2.503, 1, 0), ("b", 2.0, 0, 1)]
    with pytest.raises(ValueError):
        phenotype.melt(sheet, "ETN")


def test_splits():
    train, test = splits.split_samples([f"s{i}" for i in range(10)], ["s3"], 0.25)
    assert "s3" in test and len(test) == 3 and sorted(train + test) == sorted(f"s{i}" for i in range(10))
    assert splits.split_samples([f"s{i}" for i in range(10)], ["s3"], 0.25) == (train, test)
    assert splits.eval_mode(999) == "cv" and splits.eval_mode(1000) == "holdout"


def test_folds_are_stratified(spark):
    rows = spark.createDataFrame([(i, i % 3) for i in range(60)], "id int, y int")
    counts = splits.stratified_folds(rows, "y", "id", 5).groupBy("y", "fold").count().collect()
    assert len(counts) == 15 and {r["count"] for r in counts} == {4}


def test_subset_keeps_order(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "sample string, v int")
    assert [r.v for r in splits.subset(rows, ["b", "a"]).collect()] == [2, 1]
    with pytest.raises(KeyError):
        splits.subset(rows, ["c"])


def test_metrics_against_plain_python(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 1), rng.randint(0, 9) / 10) for _ in range(200)]
    rows = spark.createDataFrame([(y, s, int(s >= 0.5)) for y, s in data], "y int, score double, pred int")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    ap, last = 0.0, 0.0
    for t in sorted({s for _, s in data}, reverse=True):
        tp = sum(s >= t for s in pos)
        ap += (tp / len(pos) - last) * tp / (tp + sum(s >= t for s in neg))
        last = tp / len(pos)
    got = metrics.binary_metrics(rows).first()
    assert got.roc_auc == pytest.approx(auc) and got.pr_auc == pytest.approx(ap)
    assert got.accuracy == pytest.approx(sum(y == (s >= 0.5) for y, s in data) / 200)
    one = metrics.areas(rows.where("y = 1")).first()
    assert one.roc_auc is None and one.pr_auc == pytest.approx(1.0)


def test_labels(spark):
    rows = spark.createDataFrame([("SNV",), ("SNV",), ("MNV",), ("Deletion",)], "t string")
    out, task, names = labels.prepare_labels(rows, "t")
    assert task == "multiclass" and names == ["Deletion", "MNV", "SNV"] and {(r.t, r.y) for r in out.collect()} == {
        ("SNV", 2), ("MNV", 1), ("Deletion", 0)
    }
    two = rows.where("t <> 'Deletion'")
    out, task, _ = labels.prepare_labels(two, "t")
    assert task == "binary" and {(r.t, r.y) for r in out.collect()} == {("SNV", 1), ("MNV", 0)}
    with pytest.raises(ValueError):
        labels.prepare_labels(rows.where("t = 'SNV'"), "t")
    assert labels.filter_classes(rows, "t", 2).count() == 2


def test_genotype_table(spark):
    ok = spark.createDataFrame([("a", "0", "2")], "`sample` string, `Chr1:5` string, `Chr2:7` string")
    assert tuple(tables.genotypes(ok).drop("ord").first()) == ("a", 0, 2)
    with pytest.raises(ValueError):
        tables.genotypes(ok.withColumn("Chr1:5", F.lit("3")))
    with pytest.raises(ValueError):
        tables.genotype_features(["sample", "Chr1_5"])


def test_split_draws_as_choice_does():
    samples = [f"s{i}" for i in range(10)]
    rest = [s for s in samples if s not in ("s7", "s3")]
    want = ["s7", "s3", *np.random.default_rng(5).choice(np.array(rest, dtype=object), size=2, replace=False)]
    assert splits.split_samples(
        samples, ["s7", "other", "s3", "s7"], 0.4, 5
    ) == ([s for s in samples if s not in want], want)
    assert splits.split_samples(samples, samples, 0.4)[0] == []


def test_places_equal_a_window_over_all_rows(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(500)]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x long, i long")
    for group in ([], ["g"]):
        w = Window.partitionBy(*group).orderBy("x", "i") if group else Window.partitionBy(F.lit(0)).orderBy("x", "i")
        want = df.withColumn("n", F.row_number().over(w))
        got = places.numbered(df, "n", [F.shiftright("x", 5)], ["x", "i"], group)
        assert sorted(
            map(repr, got.select("g", "x", "i", F.col("n").cast("int")).collect())
        ) == sorted(map(repr, want.collect()))


def test_places_by_splitters(spark):
    """One group over eight tasks, small ones, none; ties, nulls and equal rows."""
    rng = random.Random(5)
    rows = [(rng.choice(["a"] * 9 + ["b", None]), rng.choice([None, *range(50)]), i) for i in range(600)]
    df = spark.createDataFrame([*rows, *rows[:5]], "g string, x long, i long")
    for group, parts in (([], 8), (["g"], 8), (["g"], None), ([], 1)):
        order = [F.desc("x"), F.col("i")]
        w = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy(*order)
        want = df.withColumn("n", F.row_number().over(w).cast("long"))
        got = places.placed(df, "n", order, group, parts)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        up = w.rowsBetween(Window.unboundedPreceding, 0)
        per = df.groupBy(*group, "x").agg(F.count("*").alias("k"))
        w = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0)))
        up = w.orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, 0)
        want = per.withColumn("s", F.sum("k").over(up)).withColumn("s_all", F.sum("k").over(w))
        got = places.accumulated(per, {"s": "k"}, [F.desc("x")], group, parts)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    held = places._stretches(df.where("g = 'a'"), [F.col("x"), F.col("i")], ["g"], 8)
    sizes = [r["count"] for r in held.groupBy("__part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * min(sizes)


def test_rows_without_a_score_count_nowhere(spark):
    rows = spark.createDataFrame([(1, 0.9), (0, 0.4), (1, None), (1, 0.3), (None, 0.2)], "y int, score double")
    got = sorted(map(tuple, metrics.thresholds(rows).select("score", "tp", "fp", "pos", "neg").collect()))
    assert got == [(0.3, 2, 1, 2, 1), (0.4, 1, 1, 2, 1), (0.9, 1, 0, 2, 1)]
    assert metrics.areas(rows).first().roc_auc == 0.5


def _csv_rows(spark, path):
    return [tuple(r) for r in spark.read.option("header", True).csv(path).collect()]


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_blocks(spark, tmp_path, width):
    """Any width of stretches; cells, rows and columns without a value; names that CSV must quote."""
    rng = random.Random(width)
    rows, columns = ["b", 'a "q", x', "c", "none"], [f"s{i}" for i in range(10)] + ["no, one"]
    cells = {(r, c): rng.randrange(100) for r in rows[:3] for c in columns[:10] if rng.random() < 0.7}
    long = spark.createDataFrame([(*k, v) for k, v in cells.items()] + [(*next(iter(cells)), next(iter(cells.values())))], "r string, c string, v int")
    names = lambda xs: spark.createDataFrame(list(enumerate(xs)), "no long, name string")
    made = blocks.write(long, "r", "c", "v", names(rows), names(columns), f"{tmp_path}/m", 7, width)
    assert (made.n_rows, made.n_columns) == (4, 11)
    want = [(r, *[cells.get((r, c), 7) for c in columns]) for r in rows]
    wide = spark.read.parquet(made.save_parquet(f"{tmp_path}/p"))
    assert wide.columns == ["r", *columns] and sorted(map(tuple, wide.collect())) == sorted(want)
    assert _csv_rows(spark, made.save_csv(f"{tmp_path}/c")) == [tuple(map(str, r)) for r in want]
    assert (tmp_path / "c").exists() and spark.read.option("header", True).csv(f"{tmp_path}/c").columns == ["r", *columns]
    some = [want[2], want[0]]
    assert _csv_rows(spark, made.save_csv(f"{tmp_path}/d", ["c", "b"])) == [tuple(map(str, r)) for r in some]
    assert sorted(map(tuple, made.cells().collect())) == sorted((r[0], c, x) for r in want for c, x in zip(columns, r[1:], strict=True))
    got = made.part((1, 3), (2, 4)).collect()
    assert {r.no for r in got} == {1, 2} and {r.stretch for r in got} == set(range(2 // width, 3 // width + 1))
    with pytest.raises(KeyError, match="zz"):
        made.lines(["zz"])
    twice = spark.createDataFrame([("b", "s0", 1), ("b", "s0", 2)], "r string, c string, v int")
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        blocks.write(twice, "r", "c", "v", names(rows), names(columns), f"{tmp_path}/t", 0, width)


def test_a_matrix_of_200000_columns(spark, tmp_path):
    """No plan has a column for each of them."""
    n = 200_000
    long = spark.range(n).select(
        F.explode(F.array(F.lit("a"), F.lit("b"))).alias("r"), F.concat(F.lit("c"), "id").alias("c"), (F.col("id") % 7).alias("v")
    ).where("r = 'a' OR v = 3")
    columns = blocks.index(long.select("c", F.substring("c", 2, 9).cast("long").alias("by")), "c", [F.col("by")])
    made = blocks.write(long, "r", "c", "v", blocks.index(long.select("r"), "r"), columns, f"{tmp_path}/m", 0)
    assert (made.n_rows, made.n_columns) == (2, n)
    head, a, b = [r.value.split(",") for r in spark.read.text(made.save_csv(f"{tmp_path}/c")).collect()]
    assert head == ["r", *[f"c{i}" for i in range(n)]]
    assert a == ["a", *[str(i % 7) for i in range(n)]] and b == ["b", *[str(3 * (i % 7 == 3)) for i in range(n)]]
    held = spark.read.parquet(made.save_parquet(f"{tmp_path}/p"))
    assert held.columns == ["r", "place", "stretch", "cells"] and held.count() == 2 * n // blocks.WIDTH
    assert made.part((0, 1), (5000, 6000)).count() == 1


def test_first_rows(spark):
    df = spark.createDataFrame(
        [
            ("k", 2, None, {"a": 1}), ("k", 1, "x", None), (None, 5, "z", None), ("m", None, "n", None),
            ("m", 0, "o", None)
        ],
        "key string, o int, v string, attrs map<string,int>"
    )
    got = genotypes.first_by(df, ["key"], "o")
    assert got.columns == df.columns and sorted((str(r.key), r.v) for r in got.collect()) == [
        ("None", "z"), ("k", "x"), ("m", "n")
    ]


def test_thresholds_of_any_scores(spark):
    rng = random.Random(6)
    rows = [(rng.randint(0, 1), rng.choice([-3.5, 0.0, 0.25, 0.2500001, 1.0, 7.0]), k % 2) for k in range(300)]
    got = {
        (r.g, r.score): (r.tp, r.fp, r.pos, r.neg) for r in metrics.thresholds(
            spark.createDataFrame(rows, "y int, score double, g int"), group=["g"]
        ).collect()
    }
    for g in (0, 1):
        own = [(y, s) for y, s, k in rows if k == g]
        for s in {s for _, s in own}:
            up = [y for y, t in own if t >= s]
            assert got[g, s] == (sum(up), len(up) - sum(up), sum(y for y, _ in own), sum(1 - y for y, _ in own))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.integers(1, 40), st.integers(1, 60),
    st.lists(st.tuples(st.integers(1, 130), st.integers(0, 130)), min_size=1, max_size=20)
)
def test_windows_of_pieces_are_those_of_the_whole(spark, k, step, places_):
    whole = spark.createDataFrame(
        [("Chr1", "".join(random.Random(1).choices("ACGTacgt", k=125)))], "chrom string, seq string"
    )
    seq = whole.first().seq
    v = spark.createDataFrame(
        [(i, "Chr1", p, seq[p - 1 : p - 1 + n], "T") for i, (p, n) in enumerate(places_)],
        "i int, chrom string, pos long, ref string, alt string"
    )
    want = effects.allele_windows(v, whole, k).select("i", "ref_seq", "alt_seq").collect()
    got = effects.allele_windows(v, fasta.pieces(whole, step, k), k).select("i", "ref_seq", "alt_seq").collect()
    assert sorted(got) == sorted(want)
    with pytest.raises(ValueError):
        effects.allele_windows(v, fasta.pieces(whole, step, k - 1), k)


def test_long_reference_alleles(spark):
    whole = spark.createDataFrame([("Chr1", "ACGT" * 2000)], "chrom string, seq string")
    v = spark.createDataFrame(
        [("Chr1", 900, ("ACGT" * 2000)[899:3899], "T")], "chrom string, pos long, ref string, alt string"
    )
    got = effects.allele_windows(v, fasta.pieces(whole, 1000, 2000), 100).first()
    assert got.downstream_seq == ("ACGT" * 2000)[3899:3999] and len(got.upstream_seq) == 100


def test_split_rows_of_any_number(spark):
    rows = spark.range(30_000).withColumn("apart", F.when(F.col("id") % 1000 == 7, True))
    for ratio, tested in ((0.2, 6_000), (0.0005, 30)):
        got = {r.split: r for r in splits.split_rows(rows, "id", "apart", ratio).groupBy("split").agg(
            F.count("*").alias("n"), F.count_if("apart").alias("own")
        ).collect()}
        assert (got["test"].n, got["test"].own, got["train_val"].own) == (tested, 30, 0)
        assert got["train_val"].n == 30_000 - tested
    names = [f"s{i}" for i in range(60_000)]
    began = time.process_time()
    train, test = splits.split_samples(names, names[:20_000], 0.5)
    assert (len(train), len(test)) == (30_000, 30_000) and time.process_time() - began < 5


def test_wide_matrices_are_read_in_long_form(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "MOST_COLUMNS", 4)
    cells = [(f"r{i}", f"c,{j}\"" if j == 3 else f"c{j}", i * 10 + j) for i in range(3) for j in range(7)]
    rows = spark.createDataFrame(cells, "r string, c string, v int")
    made = blocks.write(
        rows, "r", "c", "v", blocks.index(rows.select("r"), "r"), blocks.index(rows.select("c"), "c"), f"{tmp_path}/m", width=3
    )
    for read, path in (
        (blocks.long_parquet, made.save_parquet(f"{tmp_path}/w.parquet")), (blocks.long_csv, made.save_csv(f"{tmp_path}/w.csv"))
    ):
        assert sorted(map(tuple, read(spark, path, "r", "c", "v", "int").collect())) == sorted(cells)
    monkeypatch.setattr(blocks, "MOST_COLUMNS", 7)
    path = made.save_parquet(f"{tmp_path}/n.parquet", ["r2", "r0"])
    some = sorted(c for c in cells if c[0] != "r1")
    assert sorted(map(tuple, blocks.long_parquet(spark, path, "r", "c", "v", "int").collect())) == some


def test_windows_over_slices_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(effects, "SLICE", 7)
    seq = "".join("ACGT"[(i * i + i // 3) % 4] for i in range(203))
    whole = spark.createDataFrame([("Chr1", seq)], "chrom string, seq string")
    v = spark.createDataFrame(
        [("Chr1", p, seq[p - 1 : p - 1 + n], "T") for p in range(1, 204) for n in (1, 9, 60) if p - 1 + n <= 203],
        "chrom string, pos long, ref string, alt string"
    )
    want = effects.allele_windows(v, whole, 5)
    cut = effects._slices(fasta.pieces(whole, 50, 6), 50, 5)
    assert cut.agg(F.max(F.length("seq"))).first()[0] <= 17 and cut.count() >= 203 // 7
    got = effects.allele_windows(v, fasta.pieces(whole, 50, 6), 5)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_small_ranges_are_read_together():
    parts = ranges.cut([("/a", 1000)], 10)
    groups = ranges.grouped(parts, 250)
    assert len(groups) == 4 and [r for g in groups for r in g.members] == parts
    assert len(ranges.grouped(parts, 10)) == 100


def test_one_csv_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.concat(F.lit('a,"'), "id").alias("v, w"))
    ordered = rows.repartition(7).withColumn("n", F.col("k").cast("int")).orderBy("n").select("k", "v, w")
    path = sinks.save_csv(ordered, f"{tmp_path}/t.csv")
    parts = [p.name for p in (tmp_path / "t.csv").iterdir() if p.name[0] not in "._"]
    assert parts == ["part-00000.csv"] and [p.name for p in tmp_path.iterdir()] == ["t.csv"]
    assert len((tmp_path / "t.csv" / parts[0]).read_text().splitlines()) == 1001
    got = [tuple(r) for r in tables.text_table(spark, path).collect()]
    assert got == [(str(i), f'a,"{i}') for i in range(1000)]
    assert sinks.save_csv(ordered.limit(0), path) == path and tables.text_table(spark, path).columns == ["k", "v, w"]


def test_a_plan_does_not_repeat_attributes(spark):
    from lociflow.functions import attributes

    rows = spark.createDataFrame([("ID=a;tag=y,x;tag=z;note=%20",)], "t string")
    made = rows.select(attributes.attributes(F.col("t")).alias("m"))
    assert made.first().m == {"ID": "a", "tag": "x,y,z", "note": " "}
    plan = made._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_url_decode") == 1


def test_work_on_a_block_is_not_the_square_of_its_width(spark, tmp_path):
    took = []
    for n in (4_000, 4_000, 40_000):
        cells = spark.range(n).select(F.lit("a").alias("r"), F.concat(F.lit("c"), "id").alias("c"), (F.col("id") % 7).alias("v"))
        columns = spark.range(n + 9).select(F.concat(F.lit("c"), "id").alias("name"), F.col("id").alias("no"))
        rows = spark.createDataFrame([("a", 0), ("b", 1)], "name string, no long")
        began = time.time()
        made = blocks.write(cells.unionByName(cells), "r", "c", "v", rows, columns, f"{tmp_path}/{len(took)}", 5, 100_000)
        took.append(time.time() - began)
        a, b = [r.cells for r in made.table("blocks").orderBy("no").collect()]
        assert a == [i % 7 for i in range(n)] + [5] * 9 and b == [5] * (n + 9)
    assert took[2] < 6 * took[1]


@pytest.mark.parametrize(("size", "step"), [(7, 50), (7, 16), (7, 7), (1_024, 50)])
def test_intervals_meet_slices_of_pieces(spark, monkeypatch, size, step):
    monkeypatch.setattr(effects, "SLICE", size)
    seq = "".join("ACGT"[(i * i + i // 3) % 4] for i in range(203))
    whole = fasta.pieces(spark.createDataFrame([("Chr1", seq)], "chrom string, seq string"), step, 6)
    rows = [("Chr1", a, a + n) for a in range(-3, 210, 3) for n in (0, 1, 6, 49, 120)]
    got = effects.stretches(
        spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, chrom string, s long, e long"), whole, "s", "e", "i"
    )
    want = {i: seq[max(0, a - 1) : max(0, b)] for i, (_, a, b) in enumerate(rows)}
    assert {r.i: r.seq for r in got.collect()} == want
    joins = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x]
    assert any("slice" in x for x in joins) and not any("piece" in x for x in joins)


def test_a_piece_is_not_joined_again_for_each_slice(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1\n" + "ACGT" * 50 + "\n")
    genome = fasta.read_pieces(spark, f"{tmp_path}/g.fa", 50, 6)
    plan = effects._slices(genome, 50, 5)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert any("array_join" in x for x in plan)
    assert not any("array_join" in x and "Generate explode" in x for x in plan)


def test_effects_put_their_sequences_together_once(spark):
    """Embedding them and joining the vectors to them read what was put together, not the genome again."""
    passed = spark.sparkContext.accumulator(0)

    def counted(rows):
        def each(batches):
            for b in batches:
                passed.add(b.num_rows)
                yield b

        return rows.mapInArrow(each, rows.schema)

    embed = lambda seqs: seqs.distinct().select("seq", F.array(F.length("seq").cast("float")).alias("embedding"))
    genome = fasta.pieces(spark.createDataFrame([("Chr1", "ACGTACGTACGT")], "chrom string, seq string"), 5, 4)
    variants = spark.createDataFrame(
        [("Chr1", 3, "G", "GTT"), ("Chr1", 9, "A", "C")], "chrom string, pos long, ref string, alt string"
    )
    found = effects.variant_effects(counted(variants), genome, 3, embed)
    assert sorted((r.site_id, r.var_effect) for r in found.collect()) == [("Chr1:3", 2.0), ("Chr1:9", 0.0)]
    assert passed.value == 2

    sequences = spark.createDataFrame(
        [("g", "a", "ACGT", "AC"), ("g", "b", "ACGT", "ACGT")], "gene_id string, sample string, ref_seq string, seq string"
    )
    genes = spark.createDataFrame([("g",), ("h",)], "gene_id string")
    samples = spark.createDataFrame([("a",), ("b",)], "sample string")
    features = effects.gene_features(counted(sequences), genes, samples, embed)
    assert sorted(map(tuple, features.collect())) == [("g", "a", 2.0), ("g", "b", 0.0), ("h", "a", 0.0), ("h", "b", 0.0)]
    assert passed.value == 4
