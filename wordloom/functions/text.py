"""Column-to-Column text functions, all built-in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """A column that is worked out once per row, however its result is used.

    It is an explode of one. Spark folds a plain projection into the filters and
    expressions above it, and an inner explode of a column brings a filter of its
    own, so a costly expression would run several times.
    """
    return F.explode(F.array(value))


def lower(text: Column) -> Column:
    return F.lower(text)


def letters_only(text: Column) -> Column:
    """Lower-case; every character outside ``[a-z ]`` becomes one space."""
    return F.regexp_replace(F.lower(text), "[^a-z ]", " ")


def tokens_ws(text: Column) -> Column:
    """Whitespace tokens of the letters-only form, in order, without empties."""
    return _without_empty(F.split(letters_only(text), " +"))


def tokens_find(text: Column) -> Column:
    """All ``[a-z]+`` matches of the lower-cased text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))


def tokens_split(text: Column) -> Column:
    """Lower-cased text split on runs of non-letters, without empties."""
    return _without_empty(raw_tokens(text))


def raw_tokens(text: Column) -> Column:
    """As :func:`tokens_split`, but with the empty first and last pieces left in.

    Cheaper where the caller drops ``''`` anyway, after an explode or as a
    member of a set.
    """
    return F.split(F.lower(text), "[^a-z]+")


def _without_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


def clean_entities(text: Column) -> Column:
    """The three entities a merged corpus is cleaned of become one space each."""
    # Fixed values: &quot; &apos; &amp;
    return F.regexp_replace(text, "&(?:quot|apos|amp);", " ")


def strip_urls(text: Column) -> Column:
    """Delete ``http…`` and then ``www.…`` up to the next space or line end.

    Case-sensitive; a tab does not end a match. ``\\n`` is kept out of the match
    so that a whole text gives the same result as its lines one by one.
    """
    return F.regexp_replace(F.regexp_replace(text, "http[^ \n]+", ""), "www\\.[^ \n]+", "")


def split_sentences(line: Column) -> Column:
    """Pieces between runs of ``.``, ``!`` and ``?``."""
    return F.split(line, "[.!?]+")


def trim_blank(line: Column) -> Column:
    """Strip spaces and tabs (only those) at both ends."""
    return F.btrim(line, F.lit(" \t"))


def valid_token(token: Column) -> Column:
    """Three or more letters ``a-z`` and not made of ``i``, ``v``, ``x`` alone."""
    return token.rlike("^[a-z]{3,}$") & ~token.rlike("^[ivx]+$")


def pair_key(w1: Column, w2: Column) -> Column:
    return F.concat_ws(",", w1, w2)


def tfidf_score(tf: Column, df: Column, n_docs: Column) -> Column:
    """``tf * ln(N / df + 1)``."""
    return tf * F.log(n_docs.cast("double") / df + F.lit(1.0))


def six_decimals(score: Column) -> Column:
    return F.format_string("%.6f", score)


def int_or_null(text: Column) -> Column:
    """32-bit integer, or null when the text is no such integer."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))
