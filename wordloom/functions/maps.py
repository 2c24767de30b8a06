"""Stripes (word -> count maps) and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions.text import int_or_null


def build_stripe(key: Column, value: Column) -> Column:
    """Aggregate ``key -> value`` rows of a group into a map with sorted keys.

    Rows with a null key add nothing, so a group of only such rows gives ``{}``.
    Keys must be distinct within the group.
    """
    entry = F.when(key.isNotNull(), F.struct(key.alias("k"), value.alias("v")))
    return F.map_from_entries(F.sort_array(F.collect_list(entry)))


def stripe_text(stripe: Column) -> Column:
    """``{k=v, k2=v2}``."""
    return F.concat(F.lit("{"), _joined(stripe, "=", ", "), F.lit("}"))


def encode_stripe(stripe: Column) -> Column:
    """``k:v|k2:v2``."""
    return _joined(stripe, ":", "|")


def parsed_stripe(text: Column) -> Column:
    """The map of ``{k=v, k2=v2}``; null where the braces are missing.

    Pieces without ``=``, with an empty key or with a value that is no 64-bit integer are
    skipped. A repeated key has the sum of its values.
    """
    inside = F.when(text.rlike("^\\{.*\\}$"), F.substr(text, F.lit(2), F.length(text) - 2))
    pieces = F.transform(F.split(inside, ", *"), lambda p: F.struct(
        F.regexp_extract(p, "^(.*)=", 1).alias("k"),
        F.regexp_extract(p, "=([+-]?[0-9]{1,19})$", 1).try_cast("bigint").alias("v")))
    good = F.filter(pieces, lambda e: (e["k"] != "") & e["v"].isNotNull())
    keys = F.array_sort(F.array_distinct(F.transform(good, lambda e: e["k"])))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.aggregate(
        F.filter(good, lambda e: e["k"] == k), F.lit(0).cast("bigint"), lambda n, e: n + e["v"])))


def _joined(stripe: Column, inner: str, outer: str) -> Column:
    pairs = F.transform(
        F.map_entries(stripe),
        lambda e: F.concat(e["key"], F.lit(inner), e["value"].cast("string")),
    )
    return F.array_join(pairs, outer)


def decoded_key(piece: Column) -> Column:
    """Key of one ``k:v`` piece, null when it has no colon."""
    return F.when(piece.contains(":"), F.substring_index(piece, ":", 1))


def decoded_count(piece: Column) -> Column:
    """Count of one ``k:v`` piece, null when it is no 32-bit integer."""
    start = F.locate(":", piece) + 1
    return int_or_null(F.substring(piece, start, F.length(piece)))
