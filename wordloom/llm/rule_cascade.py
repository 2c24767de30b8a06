"""Quality rules in a short-circuit cascade. [operator 10]

Each rule is a condition that rejects a document. A sample shows what share of the
documents a rule rejects and what it costs; rules are then ordered by rejections per
cost and a document leaves at the first that rejects it, the later ones unseen. The
order changes what is worked out, never which documents are kept: a measure that a rule
reads is worked out when the cascade comes to the first such rule, so a rejected document
has none of the later ones. ``judged`` adds these for its report.

Only built-in expressions, all of them inside the row: no exchange, and work that
grows with the length of a text times its logarithm at most. Five-word windows are
told apart by 64-bit hashes of their words, within one text.

Cases: a null text has no words and fails. Rows that repeat are judged alike. An
empty table gives an empty result, its rules in the order given. Only the id and the
text are read, so further columns cannot clash.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import deleted, let, saved, without_space, words_of

# Fixed values of the contract.
SYMBOLS = tuple("#*$%&|<>")
WINDOW = 5
# Documents that are looked at to order the rules; a bound on that sample alone.
SAMPLE = 1_000


@dataclass(frozen=True)
class Rule:
    """Rejects a document where ``fails`` is true; ``fails`` reads ``text`` and the counts."""

    name: str
    fails: str


# A share of the words or characters each. The counts come from ``counted``.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 2 * n_words"),
    Rule("repeated_lines", "3 * n_dup_lines > size(split(text, '\\n'))"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    # Eight words in a row, each of two capitals or more.
    Rule("shouting", r"text rlike '(\\p{Lu}{2,}[^\\p{L}]+){8}'"),
    Rule("exclamations", "4 * (length(text) - length(replace(text, '!', ''))) > n_words"),
)


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words in windows of ``window`` words that occur twice or more.

    Texts whose windows all differ, nearly all texts, are done after one look. In the
    others windows are sorted by hash, neighbours that agree give the positions, and
    the sorted positions are swept once.
    """
    starts = lambda w: F.sequence(F.lit(1), F.size(w) - (window - 1))
    hashes = lambda w: F.transform(starts(w), lambda i: F.xxhash64(
        *[F.element_at(w, (i + k).cast("int")) for k in range(window)]))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.zip_with(h, F.sequence(F.lit(1), F.size(h)), lambda x, i: F.struct(
            x.alias("h"), i.alias("i"))))
        pairs = lambda p: F.flatten(F.zip_with(
            F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p)),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(
                F.array().cast("array<int>"))))
        at = let(placed, lambda p: F.array_sort(F.array_distinct(pairs(p))))
        none = F.struct(F.lit(0).alias("n"), F.lit(-1_000_000_000).alias("last"))
        return F.aggregate(at, none, lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"])

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))

    return let(words, lambda w: F.when(F.size(w) < 2, 0).when(F.size(w) <= window, 0).otherwise(
        let(hashes(w), counted))).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(without_space(x)) > 0)
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


# What a rule may read besides the text, each worked out from the text alone.
MEASURES = {
    "n_words": lambda: F.size(words_of(F.col("text"))).cast("long"),
    "word_chars": lambda: F.length(without_space(F.col("text"))).cast("long"),
    "n_symbols": lambda: (F.length("text") - F.length(deleted(F.col("text"), SYMBOLS))).cast("long"),
    "n_dup_lines": lambda: duplicate_lines(F.col("text")),
    "n_repeat_words": lambda: repeat_words(words_of(F.col("text"))),
}


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)``, a null text as an empty one."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)``."""
    return texts(docs, doc_id, text).select("doc_id", "text", *[make().alias(m) for m, make in MEASURES.items()])


def _condition(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.fails), F.lit(False))


def _reads(rule: Rule) -> list[str]:
    return [m for m in MEASURES if re.search(rf"\b{m}\b", rule.fails)]


def _seconds(few: DataFrame, rule: Rule) -> tuple[float, int]:
    """How long ``rule`` takes on raw texts, its measures included, and how many it rejects."""
    rows = few.select("text", *[MEASURES[m]().alias(m) for m in _reads(rule)])
    began = time.perf_counter()
    rejected = rows.agg(F.count_if(_condition(rule))).first()[0]
    return time.perf_counter() - began, rejected


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE, seed: int = 1,
            doc_id: str = "doc_id", text: str = "text") -> list[Rule]:
    """``rules`` by rejections per second on a sample of about ``sample`` rows of ``docs``.

    A rule's cost is the time that it takes on the sampled texts beyond that of a rule
    which looks at nothing, a millisecond at least.
    """
    total = docs.count()
    if not total:
        return list(rules)
    few = saved(texts(docs.sample(fraction=min(1.0, sample / total), seed=seed), doc_id, text))
    nothing = min(_seconds(few, Rule("nothing", "false"))[0] for _ in range(2))
    worth = {}
    for rule in rules:
        took, rejected = min(_seconds(few, rule) for _ in range(2))
        worth[rule.name] = rejected / max(took - nothing, 0.001)
    return sorted(rules, key=lambda r: (-worth[r.name], r.name))


def cascade(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rows(text, …)`` with ``rejected_by``, the first of ``rules`` that rejects, else null.

    A measure is worked out where the first rule reads it, and is null in the rows that
    were rejected before; no later rule looks at these. Measures that ``rows`` has
    already are taken as they are.
    """
    rejected = F.col("rejected_by")
    rows = rows.withColumn("rejected_by", F.lit(None).cast("string"))
    for rule in rules:
        new = [m for m in _reads(rule) if m not in rows.columns]
        rows = rows.select("*", *[F.when(rejected.isNull(), MEASURES[m]()).alias(m) for m in new])
        verdict = F.when(rejected.isNotNull(), rejected).otherwise(F.when(_condition(rule), rule.name))
        rows = rows.withColumn("rejected_by", verdict)
    return rows


def kept(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES,
         sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, rejected_by)`` of every row; nothing is worked out beyond the first rule that rejects."""
    return cascade(texts(docs, doc_id, text), ordered(docs, rules, sample, doc_id=doc_id, text=text)).select(
        "doc_id", "rejected_by")


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: id, counts, ``base_failed``, ``rejected_by``, ``kept``."""
    found = cascade(texts(docs, doc_id, text), ordered(docs, rules, sample, doc_id=doc_id, text=text))
    # The verdict stands; the report has the measures that it did without as well.
    report = [F.when(F.col(m).isNotNull(), F.col(m)).otherwise(make()) if m in found.columns else make()
              for m, make in MEASURES.items()]
    found = found.select("doc_id", "rejected_by", *[c.alias(m) for c, m in zip(report, MEASURES)])
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", base).withColumn(
        "kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
