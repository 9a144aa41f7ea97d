"""Windows of sequences and sequences with variants. Positions are 1-based, intervals closed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def window(
    seq: Column, start: Column, end: Column, seq_len: Column | None = None, seq_start: Column | None = None
) -> Column:
    """Upper-case bases from start to end, with N for each that lies outside the sequence; empty if end < start.

    ``seq`` may be a part of the whole that begins at ``seq_start`` and covers what is asked; ``seq_len`` is the
    length of the whole.
    """
    n = F.length(seq) if seq_len is None else seq_len
    offset = F.lit(0) if seq_start is None else seq_start - 1
    low, high = F.greatest(start, F.lit(1)), F.least(end, n)
    inside = F.when(
        low <= high, F.upper(F.substring(seq, (low - offset).cast("int"), (high - low + 1).cast("int")))
    ).otherwise("")
    pad = lambda k: F.repeat(F.lit("N"), F.greatest(F.lit(0), k).cast("int"))
    return F.when(end < start, "").otherwise(F.concat(pad(1 - start), inside, pad(end - n)))


def flanks(seq: Column, pos: Column, ref: Column, k: int, **whole: Column) -> tuple[Column, Column]:
    """The k bases before a variant and the k bases after its reference allele."""
    after = pos + F.length(ref)
    return window(seq, pos - k, pos - 1, **whole), window(seq, after, after + k - 1, **whole)


def apply_variants(seq: Column, start: Column, variants: Column) -> Column:
    """A sequence that begins at ``start`` with variants (array of pos, ref, alt, dosage) put in from left to
    right. A variant is skipped if its dosage is 0, it reaches outside, its reference allele does not match, or it
    overlaps one that was applied."""
    ordered = F.filter(
        F.array_sort(
            F.transform(
                variants,
                lambda v: F.struct(
                    v["pos"].cast("long").alias("pos"), v["ref"].alias("ref"), v["alt"].alias("alt"),
                    v["dosage"].cast("int").alias("dosage")
                )
            )
        ),
        lambda v: v["dosage"] > 0
    )
    zero = F.struct(F.lit(0).cast("long").alias("cursor"), F.lit("").alias("done"))

    def step(acc: Column, v: Column) -> Column:
        at = v["pos"] - start.cast("long")
        to = at + F.length(v["ref"])
        fits = (at >= acc["cursor"]) & (to <= F.length(seq))
        same = F.upper(
            F.substring(seq, F.greatest(at + 1, F.lit(1)).cast("int"), F.length(v["ref"]))
        ) == F.upper(v["ref"])
        kept = F.substring(seq, (acc["cursor"] + 1).cast("int"), F.greatest(at - acc["cursor"], F.lit(0)).cast("int"))
        return F.when(
            fits & same, F.struct(to.cast("long").alias("cursor"), F.concat(acc["done"], kept, v["alt"]).alias("done"))
        ).otherwise(acc)

    def rest(acc: Column) -> Column:
        return F.concat(acc["done"], F.substring(seq, (acc["cursor"] + 1).cast("int"), F.length(seq)))

    return F.aggregate(ordered, zero, step, rest)
