"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the mix in proportion to its weight, but never more than ``max_epochs`` times its
own size; what a clamped source cannot take is shared among the others by weight until none is above its cap.
With caps c and weights w that fixed point is ``target = min(c, level * w)``, so the level follows from one pass
over the sources in order of c / w. Every document is then taken a whole number of times, and a seeded hash
order decides which documents of the source make up the fractional repetition.

Edge cases: a null text has size 0 and is taken 0 times; a null source is a source of its own and comes last;
repeated rows are separate documents, those of a null doc_id are told apart by their texts; very long texts are
counted whole; of sources that fill up together the first by code point comes first; an empty table gives an empty
result; other columns, whatever their names, are not read by ``mix_plan`` and go through ``mix`` unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.llm._stage import staged
from lociflow.llm._text import n_words, numbered, require

#: The hash order of a source's documents is cut into so many slices; only the slice in which the fractional
#: repetition ends is sorted.
SLICES = 4096
WEIGHTS = (5, 2, 1)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = 3, share: float = 1.0
) -> DataFrame:
    """source, weight, source_size, target from rows of (source, size); ``weights`` repeat over the sources in
    code-point order, null last. Sizes and weights are integers, so the target is rounded once."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
    everything = Window.partitionBy(F.lit(0))
    cap = F.col("source_size") * F.lit(max_epochs)
    per = per.withColumn("cap", cap).withColumn(
        "budget",
        F.floor(F.sum("source_size").over(everything) * F.lit(share)).cast("long") if share != 1.0 else F.sum("source_size").over(everything)
    )
    # Sources fill up in order of cap / weight; before each, what the clamped ones hold and what weight is left.
    fill = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("held", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn(
        "left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    fits = F.col("cap").cast("decimal(38,0)") * F.col("left") >= F.col("weight").cast("decimal(38,0)") * (F.col("budget") - F.col("held"))
    per = per.withColumn("open", F.when(fits, F.struct("held", "left")))
    level = F.first("open", ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    per = per.withColumn("level", level)
    poured = (
        F.col("weight").cast("decimal(38,0)") * (F.col("budget") - F.col("level.held"))
    ).cast("double") / F.col("level.left").cast("double")
    clamped = F.col("cap").cast("decimal(38,0)") * F.col("level.left") <= F.col("weight").cast("decimal(38,0)") * (F.col("budget") - F.col("level.held"))
    target = F.when(F.col("level").isNull() | clamped, F.col("cap").cast("double")).otherwise(poured)
    return per.select(
        "source", "weight", "source_size",
        F.when(F.col("source_size") > 0, target).otherwise(F.lit(0.0)).alias("target")
    )


def draw(seed: int, doc_id: Column, text: Column) -> Column:
    """60 seeded bits by which a source's documents are ordered."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(text), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = 3, seed: int = 17, size: Column | None = None,
    share: float = 1.0
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, repeats (whole repetitions), extra (words of the fractional
    one), u (the document's place in its source's order).

    ``taken = repeats * size + extra``. Over a source, taken adds up to its target rounded to a word: the last
    document of the fractional repetition is taken in part.
    """
    require(docs, "doc_id", "source", "text")
    u = draw(seed, F.col("doc_id"), F.col("text"))
    sizes = staged(
        docs.select("doc_id", "source", (n_words(F.col("text")) if size is None else size).alias("size"), u.alias("u")),
        "mix-sizes"
    )
    targets = source_targets(sizes, weights, max_epochs, share)
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("repeats", whole).withColumn(
        "part", F.round(F.col("target") - F.col("repeats") * F.col("source_size")).cast("long")
    )
    slot = F.shiftright("u", 60 - SLICES.bit_length() + 1).cast("int")
    sizes = sizes.withColumn("slot", slot)
    slots = sizes.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    upto = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("before", F.coalesce(F.sum("slot_size").over(upto), F.lit(0)))
    slots = slots.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    room = F.col("part") - F.col("before")
    slots = slots.withColumn(
        "room", F.when(room <= 0, F.lit(0)).when(room >= F.col("slot_size"), F.lit(-1)).otherwise(room)
    )
    rows = sizes.join(
        slots.withColumnsRenamed({"source": "s", "slot": "t"}),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("slot") == F.col("t"))
    ).drop("s", "t")
    cut = F.col("room") > 0
    within = Window.partitionBy("source", "slot").orderBy("u", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    inside = rows.where(cut).withColumn("seen", F.coalesce(F.sum("size").over(within), F.lit(0)))
    inside = inside.withColumn(
        "extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - F.col("seen")))
    ).drop("seen")
    outside = rows.where(~cut).withColumn("extra", F.when(F.col("room") == -1, F.col("size")).otherwise(F.lit(0)))
    out = outside.unionByName(inside)
    return out.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("repeats") * F.col("size") + F.col("extra")).alias("taken"), "repeats",
        F.col("extra").cast("long").alias("extra"), "u"
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """The mixed documents with all columns of docs: every document as often as the plan takes it. A document
    whose fractional repetition is only a part of it counts as whole if that part is at least half of it; texts
    are never cut. Rows of equal (doc_id, source, text) are taken equally often."""
    plan = mix_plan(docs, weights, max_epochs, seed)
    times = F.col("repeats") + F.when(
        (F.col("size") > 0) & (F.col("extra") * 2 >= F.col("size")), F.lit(1)
    ).otherwise(F.lit(0))
    # Repeated rows share what was taken of them.
    plan = plan.groupBy("doc_id", "source", "size", "u").agg(
        F.ceil(F.sum(times) / F.count("*")).cast("int").alias("copies")
    ).where("copies > 0")
    rows, name = numbered(docs)
    doc_id, source, text = (F.col(name[c]) for c in ("doc_id", "source", "text"))
    same = doc_id.eqNullSafe(F.col("doc_id")) & source.eqNullSafe(F.col("source")) & (n_words(text) == F.col("size")) & (draw(seed, doc_id, text) == F.col("u"))
    out = rows.join(plan, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*rows.columns).toDF(*docs.columns)
