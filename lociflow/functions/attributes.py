"""Attribute columns of GFF3 and GTF annotation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lociflow.functions.names import empty_to_null, strip


def percent_decode(c: Column) -> Column:
    """Percent escapes decoded; a plus sign stays, and a value with a malformed escape stays whole."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def _once(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c) with c evaluated once, however often it stands in what is made of it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def attributes(c: Column) -> Column:
    """Map of an attribute text. Items are ``key=value`` or ``key value``; a key that comes again has the sorted
    set of all its comma-separated values."""
    items = F.filter(F.transform(F.split(strip(c), ";"), strip), lambda x: x.contains("=") | x.contains(" "))
    cut = lambda x: F.when(x.contains("="), F.instr(x, "=")).otherwise(F.instr(x, " "))
    pairs = F.transform(
        items,
        lambda x: F.struct(
            strip(F.substring(x, F.lit(1), cut(x) - 1)).alias("k"),
            percent_decode(F.regexp_replace(strip(F.substring(x, cut(x) + 1, F.length(x))), r'^"+|"+$', "")).alias("v")
        )
    )

    def merged(pairs: Column, k: Column) -> Column:
        filled = F.transform(F.filter(pairs, lambda p: (p["k"] == k) & (p["v"] != "")), lambda p: p["v"])
        parts = lambda f: F.array_sort(
            F.array_distinct(F.filter(F.flatten(F.transform(f, lambda v: F.split(v, ","))), lambda v: v != ""))
        )
        return _once(
            filled, lambda f: F.when(F.size(f) == 0, "").when(F.size(f) == 1, F.get(f, F.lit(0))).otherwise(
                F.array_join(parts(f), ",")
            )
        )

    def mapped(pairs: Column) -> Column:
        keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
        return _once(keys, lambda ks: F.map_from_arrays(ks, F.transform(ks, lambda k: merged(pairs, k))))

    made = _once(F.filter(pairs, lambda p: p["k"] != ""), mapped)
    return F.when(c.isNull(), F.create_map().cast("map<string,string>")).otherwise(made)


def labels(attrs: Column) -> tuple[Column, Column, Column]:
    """ID, Name and Parent of a feature, empty if there is none."""
    first = lambda keys: F.coalesce(*[F.when(attrs[k] != "", attrs[k]) for k in keys], F.lit(""))
    own = first(ID_KEYS)
    return own, F.coalesce(empty_to_null(first(NAME_KEYS)), own), first(PARENT_KEYS)


#: Attribute keys in order of preference.
ID_KEYS = ("ID", "gene_id", "transcript_id")
NAME_KEYS = ("Name", "gene_name", "gene_id")
PARENT_KEYS = ("Parent", "transcript_id", "gene_id")
