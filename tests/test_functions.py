import pytest
from pyspark.sql import functions as F

from lociflow.functions import attributes, genotype, names, sequence, vectors


def one(spark, column, **values):
    schema = ", ".join(
        f"{k} {'string' if isinstance(v, str) or v is None else 'long' if isinstance(v, int) else 'array<double>'}" for k,
        v in values.items()
    )
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("1", "Chr1"), ("chr1", "Chr1"), ("chr01", "Chr1"), ("chr_01", "Chr1"), ("chrX", None),
        ("scaffold_12", "Chr12"), ("NC_029256.1", "Chr29256"), ("0", "Chr0"), (None, None), ("", None)
    ]
)
def test_standard_chrom(spark, name, want):
    assert one(spark, names.standard_chrom(F.col("n")), n=name) == want


@pytest.mark.parametrize(
    ("gt", "want"),
    [("0/0", 0), ("0/1", 1), ("1|1", 2), ("./.", 0), ("./1", 0), ("1/2", 2), ("1", 1), (None, 0), ("1/1/1", 2)]
)
def test_encode_gt(spark, gt, want):
    assert one(spark, genotype.encode_gt(F.col("g")), g=gt) == want


@pytest.mark.parametrize(
    ("r", "a", "want"), [("A", "G", "SNV"), ("AC", "GT", "MNV"), ("A", "AT", "Insertion"), ("AT", "A", "Deletion")]
)
def test_variant_type(spark, r, a, want):
    assert one(spark, genotype.variant_type(F.col("r"), F.col("a")), r=r, a=a) == want


@pytest.mark.parametrize(
    ("s", "e", "want"), [(1, 3, "ACG"), (-1, 2, "NNAC"), (7, 10, "GTNN"), (5, 4, ""), (-3, -1, "NNNN"), (3, 3, "G")]
)
def test_window(spark, s, e, want):
    got = one(spark, sequence.window(F.col("q"), F.col("s"), F.col("e")), q="acgtacgt", s=s, e=e)
    assert got == want


def test_flanks(spark):
    row = spark.createDataFrame([("ACGTACGT", 1, "A")], "q string, p long, r string").select(
        *sequence.flanks(F.col("q"), F.col("p"), F.col("r"), 3)
    ).first()
    assert tuple(row) == ("NNN", "CGT")


def apply(seq, start, variants):
    """Plain statement of the rule."""
    out, cursor = "", 0
    for pos, ref, alt, dosage in sorted(variants):
        at = pos - start
        if dosage > 0 and cursor <= at and at + len(ref) <= len(seq) and seq[at : at + len(ref)].upper() == ref.upper():
            out += seq[cursor:at] + alt
            cursor = at + len(ref)
    return out + seq[cursor:]


@pytest.mark.parametrize(
    "variants",
    [
        [(2, "C", "TT", 1), (2, "CG", "A", 2), (4, "T", "", 1)], [], [(1, "A", "G", 0)], [(0, "A", "G", 1)],
        [(4, "TA", "G", 1)], [(3, "T", "G", 1)], [(1, "ACGT", "", 2)]
    ]
)
def test_apply_variants(spark, variants):
    df = spark.createDataFrame(
        [("ACGT", 1, variants)], "q string, s long, v array<struct<pos:long,ref:string,alt:string,dosage:int>>"
    )
    assert df.select(
        sequence.apply_variants(F.col("q"), F.col("s"), F.col("v"))
    ).first()[0] == apply("ACGT", 1, variants)



def test_attributes(spark):
    got = one(
        spark, attributes.attributes(F.col("a")), a='ID=g1;Note=a%20b;Alias=x;Alias=w; gene_id "G 2";bad;=v;p=a+b%2'
    )
    assert got == {"ID": "g1", "Note": "a b", "Alias": "w,x", "gene_id": "G 2", "p": "a+b%2"}
    assert one(spark, attributes.attributes(F.col("a")), a="") == {}


def test_l2_and_features(spark):
    assert one(spark, vectors.l2(F.col("a"), F.col("b")), a=[0.0, 3.0], b=[4.0, 3.0]) == 4.0
    assert one(spark, vectors.features(F.col("a"), F.col("b"), "alt_minus_ref"), a=[1.0], b=[3.0]) == [2.0]
    with pytest.raises(ValueError):
        vectors.features(F.col("a"), F.col("b"), "other")
