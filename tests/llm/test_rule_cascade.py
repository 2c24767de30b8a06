import re
from collections import Counter

import pytest

from samples import AWKWARD, DOCS, awkward, empty, prose
from wordloom.llm import rule_cascade as x

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    prose("en", 200, 1), "a b c d e f a b c d e x a b c d e", "a a a a a a", "a b c d e", "a b c d",
    "line one\nline one\n \n \nline two\nline one", "#tag *b* $5 <p> a|b & 7%" * 3, "WORDS!! " * 30,
    "EIGHT WORDS IN CAPITALS STAND HERE, ONE BY ONE " * 2, prose("fr", 50, 2) + "\n" + prose("fr", 50, 2), None, "", "é ñ\x0bü\x0c",
]


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, win in enumerate(windows) if often[win] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def check(got, texts):
    assert len(got) == len(texts)
    for r, text in zip(got, texts):
        want = counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and r.rejected_by is None)


def test_counts_beside_plain_code(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    check(x.judged(docs).orderBy("doc_id").collect(), TEXTS)


def test_awkward_rows(spark):
    got = x.judged(awkward(spark)).collect()
    check(got, [r[1] for r in AWKWARD])
    assert x.judged(empty(spark)).count() == 0


def test_order_does_not_change_the_verdict(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = x.counted(docs)
    one = x.cascade(rows, x.RULES).where("rejected_by is null").select("doc_id").collect()
    other = x.cascade(rows, x.RULES[::-1]).where("rejected_by is null").select("doc_id").collect()
    assert sorted(one) == sorted(other)


def test_rules_that_reject_more_come_first(spark):
    docs = spark.range(200).selectExpr("id as doc_id", "if(id % 4 = 0, 'too short', repeat('# many symbols here ', 9)) as text")
    rules = [x.Rule("never", "false"), x.Rule("often", "n_symbols > 3"), x.Rule("nulls", "cast(null as boolean)")]
    assert x.ordered(docs, rules)[0].name == "often"


@pytest.mark.parametrize("n", [3, 50])
def test_no_python_in_the_plan(spark, n):
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(TEXTS[:n])], DOCS)
    plan = x.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_rejected_rows_see_no_later_rule(spark, monkeypatch):
    """A later rule, and a later measure, that raise at every document that comes to them."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "short"), (2, "# " * 20 + "long enough " * 9)], "doc_id long, text string")
    raises = x.Rule("raises", "raise_error('seen') is null")
    rows = x.cascade(x.texts(docs), [x.RULES[0], x.Rule("symbols", "n_symbols > 10"), raises])
    assert {r.doc_id: r.rejected_by for r in rows.collect()} == {1: "few_words", 2: "symbols"}
    with pytest.raises(Exception, match="seen"):
        x.cascade(x.texts(docs), [x.RULES[0], raises]).collect()
    monkeypatch.setitem(x.MEASURES, "n_repeat_words", lambda: F.raise_error(F.lit("measured")).cast("long"))
    order = [x.RULES[0], x.Rule("symbols", "n_symbols > 10"), x.RULES[1]]
    assert x.cascade(x.texts(docs), order).where("rejected_by is null").count() == 0
    with pytest.raises(Exception, match="measured"):
        x.cascade(x.texts(docs), order[::-1]).select("rejected_by").collect()


def test_kept_is_the_verdict_of_the_report(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    short = {r.doc_id: r.rejected_by is None for r in x.kept(docs).collect()}
    assert short == {r.doc_id: r.rejected_by is None for r in x.judged(docs).collect()}
