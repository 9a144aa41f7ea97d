"""Arithmetic on embeddings (arrays of numbers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2(a: Column, b: Column) -> Column:
    """Euclidean distance in double precision."""
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def features(
    ref: Column, alt: Column, kind: str, ref_len: Column | None = None, alt_len: Column | None = None
) -> Column:
    """Feature vector of a variant from the embeddings of its two alleles: ``alt``, ``alt_minus_ref``,
    ``alt_ref_concat``, or ``all`` (both, their difference, the lengths of both alleles and their difference)."""
    if kind == "alt":
        return alt
    if kind == "alt_minus_ref":
        return difference(alt, ref)
    if kind == "alt_ref_concat":
        return F.concat(alt, ref)
    if kind == "all":
        lengths = [] if ref_len is None or alt_len is None else [
            F.array(ref_len.cast("float"), alt_len.cast("float"), (alt_len - ref_len).cast("float"))
        ]
        return F.concat(alt, ref, difference(alt, ref), *lengths)
    raise ValueError(f"unknown feature type: {kind}")
