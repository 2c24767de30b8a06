"""Porter stemming as native Spark expressions (no Python on the token path).

Works on whole arrays of lower-case words: each step is one
``transform`` over the array, so a document's distinct words are stemmed
inside the row that holds them and no shuffle on the word is needed. The steps
are written as SQL text, which Spark parses at once; the same expression built
from Column calls takes over a second to put together.

The published 1980 algorithm with its author's two later changes
(``bli -> ble`` and ``logi -> log``); words of one or two letters stay as they
are, but a longer word may get as short as that on the way and still be changed
(``eyed -> ey -> ei``). A consonant *y* is written ``Y`` while the steps run, which makes "vowel"
exactly ``[aeiouy]``. Marking once is enough: a letter's class depends only on
the letters before it, and every rule edits the end of a word.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffix tables of the published algorithm, (suffix, replacement),
# in the order in which they are tried. The first suffix found decides, even
# when its condition then fails.
PLURAL_SUFFIXES = (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", ""))
DOUBLE_SUFFIXES = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
)
SHORT_SUFFIXES = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
BARE_SUFFIXES = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

# Ends a word that is too short to be stemmed, so that no suffix is found on it.
_SHORT = "\x01"

_V, _C = "[aeiouy]", "[^aeiouy]"
_HAS_VOWEL = _V
_M_ABOVE_0 = f"^{_C}*{_V}+{_C}"
_M_ABOVE_1 = f"^{_C}*{_V}+{_C}+{_V}+{_C}"
_M_IS_1 = f"^{_C}*{_V}+{_C}+{_V}*$"
_SHORT_END = f"{_C}{_V}[^aeiouywxY]$"  # consonant, vowel, consonant but w, x, y


def _cut(n: int) -> str:
    """The word ``s`` without its last ``n`` letters."""
    return f"substring(s, 1, length(s) - {n})"


def _by_suffix(rules: Sequence[tuple[str, str]]) -> str:
    """Value of the first rule whose suffix ends the word, else the word itself.

    Rules are tried under their last letter, so most words pass few tests.
    """
    groups: dict[str, list[str]] = {}
    for suffix, value in rules:
        groups.setdefault(suffix[-1], []).append(f"WHEN endswith(s, '{suffix}') THEN {value}")
    letters = [f"WHEN endswith(s, '{letter}') THEN CASE {' '.join(tries)} ELSE s END"
               for letter, tries in groups.items()]
    return f"CASE {' '.join(letters)} ELSE s END"


def _replaced(suffix: str, new: str, *measures: str) -> str:
    """Swap a suffix if what stands before it meets the measures."""
    base = _cut(len(suffix))
    met = " AND ".join(f"rlike({base}, '{m}')" for m in measures)
    return f"CASE WHEN {met} THEN concat({base}, '{new}') ELSE s END"


def _steps() -> list[str]:
    """One SQL expression over ``s`` per step."""
    base, last = _cut(1), "substring(s, -2, 1)"
    mark_y = (f"CASE WHEN length(s) <= 2 THEN concat(s, '{_SHORT}') "
              "WHEN contains(s, 'y') THEN regexp_replace(regexp_replace("
              "s, '(^|[aeiou])y', '$1Y'), 'yy', 'yY') ELSE s END")
    plural = _by_suffix([(old, f"concat({_cut(len(old))}, '{new}')")
                         for old, new in PLURAL_SUFFIXES])
    # "#" tells the next step that an ending was taken off.
    past = _by_suffix([
        ("eed", f"CASE WHEN rlike({_cut(3)}, '{_M_ABOVE_0}') THEN {base} ELSE s END"),
        ("ed", _replaced("ed", "#", _HAS_VOWEL)),
        ("ing", _replaced("ing", "#", _HAS_VOWEL)),
    ])
    twin = f"lower({last}) = lower(substring(s, -3, 1)) AND length(s) > 2 AND rlike({last}, '{_C}')"
    past_tidy = (
        f"CASE WHEN NOT endswith(s, '#') THEN s "
        f"WHEN rlike(s, '(at|bl|iz)#$') THEN concat({base}, 'e') "
        f"WHEN {twin} THEN CASE WHEN {last} IN ('l', 's', 'z') THEN {base} ELSE {_cut(2)} END "
        f"WHEN rlike({base}, '{_M_IS_1}') AND rlike({base}, '{_SHORT_END}') THEN concat({base}, 'e') "
        f"ELSE {base} END"
    )
    final_y = (f"CASE WHEN lower(substring(s, -1, 1)) = 'y' AND rlike({base}, '{_HAS_VOWEL}') "
               f"THEN concat({base}, 'i') ELSE s END")
    double = _by_suffix([(old, _replaced(old, new, _M_ABOVE_0)) for old, new in DOUBLE_SUFFIXES])
    short = _by_suffix([(old, _replaced(old, new, _M_ABOVE_0)) for old, new in SHORT_SUFFIXES])
    bare = _by_suffix([
        (old, _replaced(old, "", _M_ABOVE_1, *(["[st]$"] if old == "ion" else [])))
        for old in BARE_SUFFIXES])
    # The e goes first; what is left, or the word as it was, may lose one of two l.
    one_l = "CASE WHEN endswith({0}, 'll') AND rlike({0}, '" + _M_ABOVE_1 + "') THEN {1} ELSE {0} END"
    final_e_ll = (
        f"CASE WHEN endswith(s, '{_SHORT}') THEN {base} "
        f"WHEN endswith(s, 'e') THEN CASE WHEN rlike({base}, '{_M_ABOVE_1}') OR "
        f"(rlike({base}, '{_M_IS_1}') AND NOT rlike({base}, '{_SHORT_END}')) "
        f"THEN {one_l.format(base, _cut(2))} ELSE s END "
        f"ELSE {one_l.format('s', base)} END"
    )
    return [mark_y, plural, past, past_tidy, final_y, double, short, bare, f"lower({final_e_ll})"]


@cache
def _stem_sql(words: str) -> str:
    out = words
    for step in _steps():
        out = f"transform({out}, s -> {step})"
    return out


def stem_all(words: str) -> Column:
    """Stem every word of an array, keeping order and repeats.

    ``words`` is the name of an array column, or SQL text that gives an array.
    """
    return F.expr(_stem_sql(words))
