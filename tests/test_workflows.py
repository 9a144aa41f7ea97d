import gzip
import io
import json
import os
import random
import re
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lociflow import __main__ as cli
from lociflow.embed import registry
from lociflow.embed.cache import CachedEmbedder
from lociflow.ml import models
from lociflow.operators import effects, splits
from lociflow.plans import builder, classifier, phenotypes, resume, simulator
from lociflow.sources import bgzf, config, fasta, gff, ranges, sinks, tables, vcf

SEQ = {
    "chr1": "".join(random.Random(1).choices("ACGT", k=400)), "chr_2": "".join(random.Random(2).choices("acgt", k=300))
}


@pytest.fixture(scope="module")
def genome(tmp_path_factory):
    d = tmp_path_factory.mktemp("genome")
    (d / "g.fa").write_text(
        "".join(
            f">{n} some text\n{s[:70]}\n{s[70:]}\n" for n, s in SEQ.items()
        ) + ">chr01 later\nAAAA\n>scaffold\nTTTT\n"
    )
    rng = random.Random(3)
    lines = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\tS_2\tabc\tx1"]
    for name, seq in SEQ.items():
        for pos in range(10, len(seq) - 10, 12):
            ref = seq[pos - 1].upper()
            alt = rng.choice([x for x in "ACGT" if x != ref])
            alt = rng.choice([alt, alt, alt + "G" + "T", f"{alt},{ref}TT"])
            if rng.random() < 0.2:
                ref = seq[pos - 1 : pos + 1].upper()
            gts = "\t".join(f"9:{g}" for g in rng.choices(["0/0", "0/1", "1|1", "./."], k=4))
            lines.append(f"{name}\t{pos}\t.\t{ref}\t{alt}\t.\t.\t.\tDP:GT\t{gts}")
    (d / "v.vcf").write_text("\n".join(lines) + "\n")
    (d / "gwas.csv").write_text("Chromosome,Position,Trait,pvalue\n1,22,h,0.01\nchr2,10,y,0.2\nchr2,34,y,x\n")
    (d / "qtl.csv").write_text("Chromosome,start_pos,end_pos,Trait,LOD\n1,200,20,h,5\n2,1,40,y,0\n")
    (d / "a.gff3").write_text("##gff-version 3\nchr1\tx\tgene\t10\t120\t.\t+\t.\tID=g1;Name=n1\nchr1\tx\tmRNA\t10\t120\t.\t+\t.\tID=t1\nchr2\tx\tgene\t1\t90\t.\t-\t.\tID=g2\nchr2\tx\tgene\t5\tx\t.\t-\t.\tID=g3\n##FASTA\n>chr1\nACGT\n")
    return d


def settings(d, out, **more):
    return config.of(
        config.BuilderConfig,
        {
            "vcf_path": f"{d}/v.vcf", "fasta_path": f"{d}/g.fa", "gff3_path": f"{d}/a.gff3",
            "gwas_path": f"{d}/gwas.csv", "qtl_path": f"{d}/qtl.csv", "outdir": str(out), "k": 8, "split": True,
            "test_ratio": 0.4, **more
        }
    )


def test_readers(spark, genome):
    p = fasta.read_pieces(spark, f"{genome}/g.fa", 100, 10)
    assert sorted((r.chrom, r.piece) for r in p.collect()) == [("Chr1", i) for i in range(4)] + [("Chr2", i) for i in range(3)]
    p = p.where("chrom = 'Chr1' AND piece = 1").first()
    assert (p.seq, p.seq_start, p.seq_len) == (SEQ["chr1"][90:210], 91, 400)
    rows = gff.read(spark, f"{genome}/a.gff3", "gene").orderBy("id").collect()
    assert [(r.id, r.name, r.start, r.end) for r in rows] == [("g1", "n1", 10, 120), ("g2", "g2", 1, 90)]
    assert vcf.samples(spark, f"{genome}/v.vcf") == ["s1", "S_2", "abc", "x1"]


def test_builder_runs_and_resumes(spark, genome, tmp_path):
    out = builder.run(spark, settings(genome, tmp_path))
    sites = resume.stage(spark, str(tmp_path), "initial_sites")
    assert sites.where("chrom = 'Chr1' AND pos = 22 AND gwas_trait = 'h'").count() >= 1
    assert {r.pos for r in sites.where("chrom = 'Chr2'").collect()} >= {10}
    calls = resume.stage(spark, str(tmp_path), "genotypes")
    assert {r[0] for r in calls.select("sample").distinct().collect()} == {
        "sample_1", "sample_2", "sample_3", "sample_1_4"
    }
    wide = spark.read.parquet(out["genotype_sample_by_site"])
    assert wide.count() == 4 and len(wide.columns) == 1 + calls.select("site_id").distinct().count()
    genes = resume.stage(spark, str(tmp_path), "gene_features")
    assert genes.count() == 4 * genes.select("gene_id").distinct().count() and genes.where("value > 0").count() > 0
    meta = json.loads((tmp_path / "splits/split_meta.json").read_text())
    assert len(meta["samples"]["test"]) == 2 and len(meta["samples"]["train_val"]) == 2
    before = sorted(map(tuple, genes.collect()))
    held = lambda name: json.loads((tmp_path / "resume.json").read_text())["stages"][name]["outputs"][0]
    first = held("initial_sites")
    builder.run(spark, settings(genome, tmp_path))
    assert held("initial_sites") == first
    Path(held("gene_sites"), "_SUCCESS").unlink()
    builder.run(spark, settings(genome, tmp_path))
    assert held("initial_sites") == first
    assert sorted(map(tuple, resume.stage(spark, str(tmp_path), "gene_features").collect())) == before
    assert json.loads((tmp_path / "resume.json").read_text())["notes"]["samples"][3] == ["x1", "sample_1_4"]


def test_all_variants_match_plain_python(spark, genome, tmp_path):
    got = builder.score_all_variants(spark, f"{genome}/v.vcf", f"{genome}/g.fa", str(tmp_path), k=6)
    encode = registry.load("kmer")
    want = []
    for line in (genome / "v.vcf").read_text().splitlines():
        if not line.startswith("#"):
            f = line.split("\t")
            seq, pos, ref = SEQ[f[0]].upper(), int(f[1]), f[3]
            for alt in f[4].split(","):
                up, down = seq[max(0, pos - 7) : pos - 1], seq[pos - 1 + len(ref) : pos + 5 + len(ref)]
                a, b = encode([up + ref + down, up + alt + down]).astype(float)
                want.append((f"Chr{f[0][-1]}:{pos}", round(float(((a - b) ** 2).sum() ** 0.5), 9)))
    assert sorted((r.site_id, round(r.var_effect, 9)) for r in got.collect()) == sorted(want)


def test_cache_infers_once(spark, tmp_path):
    e = CachedEmbedder("kmer", f"{tmp_path}/cache", k=2)
    rows = spark.createDataFrame([("ACGT",), ("ACGT",), ("TTTT",)], "seq string")
    assert e(rows).count() == 2
    assert e(rows.union(spark.createDataFrame([("GGGG",)], "seq string"))).count() == 3
    assert spark.read.parquet(f"{tmp_path}/cache").count() == 3
    with pytest.raises(ValueError):
        registry.load("none")


def test_classifier(spark, genome, tmp_path):
    rows = [x.split("\t") for x in (genome / "v.vcf").read_text().splitlines() if not x.startswith("#")]
    (tmp_path / "s.tsv").write_text("chr\tpos\tvariant_type\n" + "".join(f"{r[0]}\t{r[1]}\tt\n" for r in rows))
    c = classifier.ClassifierConfig(
        f"{tmp_path}/s.tsv", f"{genome}/v.vcf", f"{genome}/g.fa", f"{tmp_path}/out", k=6,
        selected_classes=["SNV", "Insertion"], folds=2
    )
    s = classifier.run(spark, c)
    assert s["task_type"] == "binary" and s["eval_mode"] == "cv" and 0 <= s["metrics"]["accuracy"]["mean"] <= 1
    assert spark.read.parquet(f"{tmp_path}/out/predictions.parquet").count() == s["rows"]


def test_simulator(spark, tmp_path):
    sites = [f"Chr1:{i}" for i in range(1, 6)]
    (tmp_path / "g.csv").write_text(
        ",".join(["sample", *sites]) + "\n" + "".join(
            f"s{k}," + ",".join(str((k + i) % 3) for i in range(5)) + "\n" for k in range(4)
        )
    )
    (tmp_path / "p.csv").write_text("sample,value,loc_a,loc_b\ns1,3.5,1,0\ns1,4.5,1,0\ns1,2,0,1\ns2,1,1,0\n")
    (tmp_path / "i.csv").write_text(
        "feature,importance_gain,importance_split\nloc_a,99,1\n" + "".join(f"{s},{i},1\n" for i, s in enumerate(sites))
    )
    (tmp_path / "e.csv").write_text(
        "Chromosome,Position,site_id,var_effect\n" + "".join(
            f"Chr1,{i},{s},{i}.5\n" for i, s in enumerate(sites)
        ) + "Chr1,1,Chr1:1,7\n"
    )
    c = config.of(
        config.SimulatorConfig,
        {
            "genotype_file": f"{tmp_path}/g.csv", "phenotype_file": f"{tmp_path}/p.csv",
            "feature_importance_file": f"{tmp_path}/i.csv", "variant_effect_file": f"{tmp_path}/e.csv",
            "sample_id": "s1", "outdir": f"{tmp_path}/out", "top_n": 2
        }
    )
    ranked = simulator.run(spark, c, simulator.linear_model({sites[0]: 1.0, "loc_a": 5.0}))
    assert ranked.count() == 2 * (9 + 3)
    assert ranked.groupBy("group_id").agg(F.max("rank")).collect()[0][1] == 12
    summary = json.loads((tmp_path / "out/summary.json").read_text())
    assert summary["mutable_features"] == [sites[4], sites[3]] and [g["row_count"] for g in summary["groups"]] == [2, 1]
    assert (tmp_path / "out/group_001.svg").read_text().startswith("<svg")
    with pytest.raises(PermissionError):
        simulator.run(spark, config.of(config.SimulatorConfig, {**c.__dict__, "model_file": "x.pkl"}))


def test_flat_yaml(tmp_path, monkeypatch):
    (tmp_path / "c.yaml").write_text("a: 1  # note\nb: 'x: y'\nc: true\nd:\ne: 1.5\n")
    import builtins

    real = builtins.__import__
    monkeypatch.setattr(
        builtins, "__import__", lambda n, *a,
        **k: (_ for _ in ()).throw(ImportError()) if n == "yaml" else real(n, *a, **k)
    )
    assert config.load_yaml(str(tmp_path / "c.yaml")) == {"a": 1, "b": "x: y", "c": True, "d": None, "e": 1.5}


def test_settings_are_checked(genome, tmp_path):
    for bad in ({"type": "x"}, {"k": -1}, {"test_ratio": 1.0}, {"unknown": 1}):
        with pytest.raises(ValueError):
            settings(genome, tmp_path, **bad)


def test_site_table_names(spark):
    df = spark.createDataFrame(
        [("1", "5", "a", "g", "t"), ("x", "5", "a", "g", "t"), ("1", "6", "", None, "")],
        "CHR string, Pos string, ref_allele string, alt_allele string, variant_type string"
    )
    assert [tuple(r) for r in tables.site_table(df).collect()] == [("Chr1", 5, "A", "G", "t")]
    with pytest.raises(Exception, match="whole position"):
        tables.site_table(df.withColumn("Pos", F.lit("5.5"))).collect()


def test_annotation_copy_follows_the_file(spark, tmp_path):
    f = tmp_path / "a.gff"
    f.write_text("c1\tx\tgene\t1\t9\t.\t+\t.\tID=g;Name=n\nc1\tx\tgene\t5\t20\t.\t+\t.\tID=g\n")
    rows = gff.merged(gff.read_cached(spark, str(f))).collect()
    assert [(r.id, r.start, r.end) for r in rows] == [("g", 1, 20)]
    f.write_text("c1\tx\tgene\t3\t4\t.\t+\t.\tID=h\n")
    assert [r.id for r in gff.read_cached(spark, str(f)).collect()] == ["h"]


def test_phenotype_tables(spark, tmp_path):
    sheet = spark.createDataFrame([("a", 1.0, 2.0)], "sample string, SPY_2019_x double, TGW_2019_y double")
    out = phenotypes.run(sheet, str(tmp_path), ["SPY", "TGW"], "1")
    got = tables.phenotypes(tables.text_table(spark, out["SPY"])).drop("ord").first()
    assert out["SPY"].endswith("SPY_1.csv") and tuple(got) == ("a", 1.0, 1)


def test_command_line_over_file_over_defaults(tmp_path):
    (tmp_path / "c.yaml").write_text("vcf_path: v\nfasta_path: f\noutdir: o\nk: 7\nembedder: other\n")
    args, c = cli.settings(
        ["score", "--config", f"{tmp_path}/c.yaml", "--k", "9", "--embedder-options", "k=2", "half=true"]
    )
    assert (c.vcf_path, c.k, c.embedder, c.embedder_options) == ("v", 9, "other", {"k": 2, "half": True})
    assert args.command == "score"
    # A flag at its default gives way to the file.
    assert cli.settings(["score", "--config", f"{tmp_path}/c.yaml", "--k", "100"])[1].k == 7
    with pytest.raises(ValueError, match="lacks fasta_path"):
        cli.settings(["score", "--vcf-path", "v"])
    with pytest.raises(ValueError, match="unknown"):
        (tmp_path / "d.yaml").write_text("nothing: 1\n")
        cli.settings(["score", "--config", f"{tmp_path}/d.yaml"])
    _, b = cli.settings(
        [
            "build", *[x for n in ("vcf", "fasta", "gff3", "gwas", "qtl") for x in (f"--{n}-path", n)], "--outdir", "o",
            "--gff3-feature", "gene", "mRNA", "--split", "--no-wide"
        ]
    )
    assert b.gff3_feature == ["gene", "mRNA"] and b.split and not b.wide and b.resume


def test_command_runs(spark, tmp_path):
    (tmp_path / "s.csv").write_text("sample,SPY_2019_a,SPY_2020_a\nx,1,2\ny,,4\n")
    cli.main(
        [
            "phenotypes", "--sheet-file", f"{tmp_path}/s.csv", "--outdir", f"{tmp_path}/o", "--traits", "SPY",
            "--stamp", "d"
        ]
    )
    rows = tables.phenotypes(tables.text_table(spark, f"{tmp_path}/o/SPY_d.csv")).collect()
    assert sorted((r.sample, r.value, r.loc_a) for r in rows) == [("x", 1.5, 1), ("y", 4.0, 1)]


def test_workbooks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(
        pd, "read_excel", lambda path,
        sheet_name: seen.append((path, sheet_name)) or pd.DataFrame({"sample": ["a"], "SPY_2019_x": [1.0]})
    )
    assert tables.sheet(
        spark, "b.XLSX", "triple_data"
    ).collect()[0].SPY_2019_x == 1.0 and seen == [("b.XLSX", "triple_data")]


def test_split_files(spark, genome, tmp_path):
    out = builder.run(spark, settings(genome, tmp_path, wide=False))
    meta = json.loads((tmp_path / "splits/split_meta.json").read_text())
    for part, samples in meta["samples"].items():
        for name in ("genotype_012", "variant_effect_matrix", "gene_sequence_feature_matrix"):
            csv = tables.text_table(spark, out[f"{part}_{name}_csv"])
            assert [r["sample"] for r in csv.collect()] == samples and csv.columns == spark.read.parquet(
                out[f"{part}_{name}_parquet"]
            ).columns
    assert meta["samples"]["test"] == splits.split_samples(
        ["sample_1", "sample_2", "sample_3", "sample_1_4"], (), 0.4
    )[1]


def test_models_by_file(spark, tmp_path):
    with pytest.raises(PermissionError):
        models.load_pickle("m.joblib")
    try:
        import joblib  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="joblib"):
            models.load_pickle("m.joblib", True)
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression

    train = models.with_vector(
        spark.createDataFrame(
            [([float(i), float(i * i % 7), float(i % 2)], 3.0 * i + i % 2) for i in range(20)],
            "features array<double>, y double"
        )
    )
    Pipeline(stages=[LinearRegression(featuresCol="x", labelCol="y")]).fit(train).write().save(f"{tmp_path}/model")
    rows = spark.createDataFrame([([5.0, 4.0], 1, "loc_a")], "features array<float>, loc_a int, location_label string")
    got = simulator.model_of(spark, f"{tmp_path}/model", False)(rows, ["a", "b"]).first()
    assert got.predicted_phenotype == pytest.approx(16.0) and got.loc_a == 1
    assert models.build_model("random_forest", 5).getStages()[-1].getMaxDepth() == 30


def test_chart(spark, tmp_path):
    rows = [("observed" if i % 5 == 0 else "simulated", i + 1, 10.0 - i, i == 7) for i in range(40)]
    ranked = spark.createDataFrame(rows, "source_type string, rank int, predicted_phenotype double, is_target boolean")
    sinks.scatter_svg(ranked, "a < b", f"{tmp_path}/all.svg")
    sinks.scatter_svg(ranked, "a < b", f"{tmp_path}/some.svg", most=4)
    whole, some = ((tmp_path / f"{n}.svg").read_text() for n in ("all", "some"))
    assert whole.count('r="2"') + whole.count('r="5"') == 40 and some.count('r="2"') < 25
    for text in (whole, some):
        assert "target: rank 8, 3" in text and "a &lt; b" in text and text.count("simulated") == 1 and text.count("h-5") == 5
        assert text.count('r="5"') == 1
    assert sinks.ticks(2.0, 2.0) == [2.0] and sinks.ticks(0, 4) == [0, 1, 2, 3, 4]


def test_classifier_matrices(spark, genome, tmp_path):
    rows = [x.split("\t") for x in (genome / "v.vcf").read_text().splitlines() if not x.startswith("#")]
    (tmp_path / "s.tsv").write_text("chr\tpos\tvariant_type\n" + "".join(f"{r[0]}\t{r[1]}\tt\n" for r in rows))
    c = classifier.ClassifierConfig(
        f"{tmp_path}/s.tsv", f"{genome}/v.vcf", f"{genome}/g.fa", f"{tmp_path}/out", k=6,
        selected_classes=["SNV", "Insertion"], eval_mode="holdout", matrices=True
    )
    s = classifier.run(spark, c)
    load = lambda n: np.load(f"{tmp_path}/out/{n}.npy")
    ref, alt, diff, x = map(load, ("ref_embeddings", "alt_embeddings", "alt_minus_ref_embeddings", "features"))
    assert len(x) == s["rows"] and np.array_equal(alt - ref, diff) and np.array_equal(x[:, : alt.shape[1]], alt)
    train, test = load("train_indices"), load("test_indices")
    assert sorted([*train, *test]) == list(range(s["rows"]))
    ids = sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/out/features.parquet").select("site_id").collect())
    assert sorted(ids[i] for i in test) == sorted(
        r[0] for r in spark.read.parquet(f"{tmp_path}/out/predictions.parquet").select("site_id").collect()
    )
    assert json.loads((tmp_path / "out/feature_meta.json").read_text())["feature_dim"] == x.shape[1]
    assert sum(s["label_counts"].values()) == s["rows"]


def test_longest_input_of_a_model():
    class Thing:
        def __init__(self, **k):
            self.__dict__.update(k)

    assert registry.max_tokens(Thing(model_max_length=10**30), Thing(config=Thing(max_position_embeddings=512))) == 512
    assert registry.max_tokens(Thing(model_max_length=100), Thing(config=Thing())) == 100
    assert registry.max_tokens(Thing(), Thing()) is None


def plain_pieces(texts, step, overlap):
    """Pieces of FASTA texts by splitting them into lines."""
    records = []
    for text in texts:
        first = True
        for line in text.split("\n"):
            if line.startswith(">"):
                records.append([line[1:].split(None, 1)[0] if line[1:2].strip() else "", ""])
                first = False
            elif not first:
                records[-1][1] += "".join(line.split())
    out, seen = [], set()
    for name, seq in records:
        m = re.fullmatch(r"(?i)chr_?0*([0-9]+)|0*([0-9]+)", name)
        if m and (chrom := f"Chr{m[1] or m[2]}") not in seen:
            seen.add(chrom)
            for i in range(max(1, -(-len(seq) // step))):
                low = max(0, i * step - overlap)
                out.append((chrom, i, seq[low : (i + 1) * step + overlap], low + 1, len(seq)))
    return sorted(out)


@pytest.mark.parametrize("size", [5, 61, 1 << 20])
def test_pieces_from_ranges_of_any_size(spark, tmp_path, monkeypatch, size):
    """Ranges that cut headers, lines and records; one line of a whole chromosome; empty records; a later record of a name;
    signs within headers; files with and without a line's end; a compressed one."""
    rng = random.Random(size)
    say = lambda n: "".join(rng.choices("ACGTacgtN", k=n))
    first = f"stray\n>chr1 a > b\n{say(33)}\n{say(33)}\r\n\n{say(5)}\n>chr2\n>chr3 empty before\n{say(90)}\n> no name\nACGT\n>chr01 later\nAAAA"
    second = f">scaffold\nTTT\n>4\n{say(1)}\n>5\n{say(40)}\n>chr2 later\nCC\n>6"
    if size > 1 << 16:
        second += f"\n{say(3_000_000)}\n>7 long\n{say(10)}"
    third = f">chr8\n{say(70)}\n>chr1\nGG\n"
    d = tmp_path / "fa"
    d.mkdir()
    (d / "a.fa").write_bytes(first.encode())
    (d / "b.fa").write_bytes(second.encode())
    (d / "c.fa.gz").write_bytes(gzip.compress(third.encode()))
    (d / "_SUCCESS").write_text("x")
    step, overlap = (20, 5) if size < 1 << 16 else (100_000, 2_000)
    got = fasta.read_pieces(spark, str(d), step, overlap, range_bytes=size)
    want = plain_pieces([first, second, third], step, overlap)
    assert sorted(map(tuple, got.collect())) == want
    assert max(len(r[2]) for r in want) <= step + 2 * overlap


def test_stretches_over_pieces(spark, genome):
    whole = fasta.read_pieces(spark, f"{genome}/g.fa", 16, 4)
    n = {"Chr1": 400, "Chr2": 300}
    rows = [("Chr1", a, b) for a, b in ((1, 1), (1, 400), (10, 58), (16, 17), (390, 420), (401, 500), (-5, 3), (17, 16))]
    rows += [("Chr2", 295, 300), ("Chr9", 1, 5)]
    got = effects.stretches(
        spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, chrom string, s long, e long"), whole, "s", "e", "i"
    )
    seqs = {"Chr1": SEQ["chr1"], "Chr2": SEQ["chr_2"]}
    want = {i: seqs[c][max(0, a - 1) : max(0, min(b, n[c]))] for i, (c, a, b) in enumerate(rows) if c in n}
    assert {r.i: r.seq for r in got.collect()} == want


def test_an_empty_folder_has_no_pieces(spark, tmp_path):
    assert fasta.read_pieces(spark, str(tmp_path)).count() == 0


def blocked(path, text, size):
    """A block-gzip file with blocks of so many bytes."""
    path.write_bytes(b"".join(bgzf.block(text[i : i + size]) for i in range(0, len(text), size)) + bgzf.block(b""))
    return str(path)


@pytest.mark.parametrize(("block", "cut"), [(7, 5), (7, 40), (50, 100), (50, 1), (1000, 1 << 20), (65280, 3000)])
def test_lines_of_blocks_cut_anywhere(tmp_path, block, cut):
    """Every line once and in order, for blocks and ranges that cut lines, lines of several blocks, and no line's end."""
    rng = random.Random(block)
    for end in (b"", b"\n", b"\n\n"):
        rows = [bytes(rng.choices(b"ab\x1f\x8b\x08\x04\r", k=rng.choice([0, 1, 3, 20, 90]))) for _ in range(60)] + [b"x"]
        text = b"\n".join(rows) + end
        path = blocked(tmp_path / "x.gz", text, block)
        assert gzip.decompress((tmp_path / "x.gz").read_bytes()) == text
        size = (tmp_path / "x.gz").stat().st_size
        got = []
        with ranges.opened(path) as f:
            for r in ranges.cut([(path, size)], cut):
                got += bgzf.lines(f, r)
        assert got == text.split(b"\n")[: -1 if end else None]


def test_damaged_blocks_are_an_error(tmp_path):
    path = blocked(tmp_path / "x.gz", b"line\n" * 100, 50)
    data = bytearray((tmp_path / "x.gz").read_bytes())
    data[len(bgzf.block(b"line\n" * 10)) - 6] ^= 1
    (tmp_path / "x.gz").write_bytes(bytes(data))
    with ranges.opened(path) as f, pytest.raises(ValueError, match="damaged"):
        list(bgzf.lines(f, ranges.Range(0, path, 0, len(data), len(data))))


def test_block_gzip_variants(spark, genome, tmp_path):
    """The same rows as from plain text, by several tasks; by an index, only ranges with wanted sites are read."""
    text = (genome / "v.vcf").read_bytes()
    path = blocked(tmp_path / "v.vcf.gz", text, 300)
    assert bgzf.is_blocked(spark, path) and not bgzf.is_blocked(spark, f"{genome}/v.vcf")
    assert vcf.samples(spark, path) == ["s1", "S_2", "abc", "x1"]
    rows = vcf.lines(spark, path, range_bytes=500)
    assert rows.rdd.getNumPartitions() > 3
    plain = [r.f for r in vcf.lines(spark, f"{genome}/v.vcf").orderBy("ord").collect()]
    assert [r.f for r in rows.orderBy("ord").collect()] == plain
    known = vcf.index(spark, path, 500).cache()
    n = len(ranges.cut(ranges.files(spark, path), 500))
    sites = spark.createDataFrame([("Chr1", 22), ("Chr1", 23), ("Chr2", 10), ("Chr9", 1)], "chrom string, pos long")
    read = vcf.ranges_at(spark, path, sites, known, 500)
    assert 0 < len(read) <= 2 < n
    names = vcf.samples(spark, path)
    at = vcf.calls(vcf.lines_at(spark, path, sites, known, 500), names).join(sites, ["chrom", "pos"], "left_semi")
    want = vcf.calls(vcf.lines(spark, f"{genome}/v.vcf"), names).join(sites, ["chrom", "pos"], "left_semi")
    key = lambda df: sorted(df.select("chrom", "pos", "sample", "gt").collect())
    assert key(at) == key(want) and len(key(at)) == 8
    assert vcf.lines_at(spark, path, sites.where("pos = 1"), known, 500).count() == 0


def test_small_ranges_of_blocks_are_read_by_many_tasks(spark, tmp_path):
    """As many tasks as Spark runs a few times over, whatever the ranges' size; none reads far beyond its ranges."""
    text = b"".join(b"chr1\t%d\t.\tA\tC\n" % i for i in range(1, 4001))
    path = blocked(tmp_path / "v.vcf.gz", text, 300)
    found = ranges.files(spark, path)
    size = found[0][1]
    for cut in (20, 500):
        parts = ranges.cut(found, cut)
        rows = bgzf.read(spark, parts)
        assert 8 <= rows.rdd.getNumPartitions() <= 40
        assert b"".join(r.value.encode() + b"\n" for r in rows.orderBy("ord").collect()) == text
    assert vcf.lines(spark, path, range_bytes=20).rdd.getNumPartitions() <= 40

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            Counted.taken += len(data)
            return data

    file = Counted((tmp_path / "v.vcf.gz").read_bytes())
    assert sum(len(list(bgzf.lines(file, r))) for r in ranges.cut(found, 500)) == 4000
    assert Counted.taken < 12 * size


def test_builder_over_block_gzip(spark, genome, tmp_path):
    path = blocked(tmp_path / "v.vcf.gz", (genome / "v.vcf").read_bytes(), 400)
    plain = builder.run(spark, settings(genome, tmp_path / "a"))
    packed = builder.run(spark, settings(genome, tmp_path / "b", vcf_path=path))
    for name in ("genotype_sample_by_site", "gene_feature_sample_by_gene"):
        a, b = (spark.read.parquet(x[name]) for x in (plain, packed))
        assert a.columns == b.columns and sorted(a.collect()) == sorted(b.collect())


def chain(spark, folder, source, log, die=None):
    """Three stages, each the one before and a row more; dies as the stage named is made."""
    stages = resume.Stages(spark, folder, {"a": 1}, {"in": source})

    def make(name, before):
        def rows():
            log.append(name)
            if name == die:
                raise KeyboardInterrupt
            return before.unionByName(spark.createDataFrame([(name,)], "v string"))

        return stages.run(name, rows)

    one = make("one", spark.read.text(source).withColumnRenamed("value", "v"))
    return sorted(r.v for r in make("three", make("two", one)).collect())


def test_a_run_that_dies_leaves_no_stale_stage(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    source, out, log = str(tmp_path / "in"), str(tmp_path / "out"), []
    (tmp_path / "in/a.txt").write_text("x\n")
    (tmp_path / "in/b.txt").write_text("y\n")
    want = ["one", "three", "two", "x", "y"]
    assert chain(spark, out, source, log) == want and chain(spark, out, source, log) == want
    assert log == ["one", "two", "three"]
    # Dies between the output of a stage and the manifest: the stage runs again, no half is read.
    Path(resume.stage(spark, out, "two").inputFiles()[0].removeprefix("file:")).parent.joinpath("_SUCCESS").unlink()
    save = resume.Stages._save
    monkeypatch.setattr(resume.Stages, "_save", lambda self: save(self) if "two" not in self.done else 1 / 0)
    log.clear()
    with pytest.raises(ZeroDivisionError):
        chain(spark, out, source, log)
    monkeypatch.setattr(resume.Stages, "_save", save)
    # Dies after a stage was made again: the later one of the run before is not taken.
    with pytest.raises(KeyboardInterrupt):
        chain(spark, out, source, log, die="three")
    assert log == ["two", "two", "three"]
    assert chain(spark, out, source, log) == want and log == ["two", "two", "three", "three"]
    assert all(len(list(p.iterdir())) == 1 for p in (tmp_path / "out/stages").iterdir())
    # A file is replaced inside the folder by one of the same size and name.
    log.clear()
    (tmp_path / "in/b.txt").write_text("z\n")
    os.utime(tmp_path / "in/b.txt", (1, 1))
    assert chain(spark, out, source, log) == ["one", "three", "two", "x", "z"] and log == ["one", "two", "three"]


def test_a_replaced_part_is_read_again(spark, tmp_path):
    """Annotation as a folder: its copy follows each file in it."""
    d = tmp_path / "a.gff3"
    d.mkdir()
    line = "chr1\tx\tgene\t{}\t9\t.\t+\t.\tID=g{}\n"
    (d / "part-0").write_text(line.format(5, 1))
    (d / "part-1").write_text(line.format(6, 2))
    starts = lambda: sorted(r.start for r in gff.read_cached(spark, str(d), cache=str(tmp_path / "c")).collect())
    assert starts() == [5, 6]
    (d / "part-0").write_text(line.format(7, 1))
    os.utime(d / "part-0", (5, 5))
    assert starts() == [6, 7]
