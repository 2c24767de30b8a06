"""Brute force and random inputs beside the Spark results."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import plain_porter
from wordloom.functions import porter
from wordloom.functions.porter import stem_all
from wordloom.functions.text import valid_token
from wordloom.operators import cooc, lines, terms, words
from wordloom.sources import lists

SLOW = settings(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

TOP = ["aa", "bb", "c", "dd"]
corpora = st.lists(st.lists(st.sampled_from([*TOP, "zz", "q"]), max_size=12), max_size=8)


def brute_pairs(corpus, d, min_len):
    out = Counter()
    for line in corpus:
        seq = [w for w in line if w in TOP and len(w) >= min_len]
        for i, w1 in enumerate(seq):
            for j, w2 in enumerate(seq):
                if i != j and abs(i - j) <= d:
                    out[w1, w2] += 1
    return dict(out)


def frame(spark, corpus):
    rows = [(i, 0, 0, " ".join(line)) for i, line in enumerate(corpus)]
    return spark.createDataFrame(rows, "doc_id int, line_no int, sent_no int, line string")


@SLOW
@given(corpus=corpora, d=st.integers(1, 4), min_len=st.integers(1, 2))
def test_pairs_equal_brute_force(spark, corpus, d, min_len):
    df, top = frame(spark, corpus), lists.local_table(spark, word=TOP)
    want = brute_pairs(corpus, d, min_len)
    got = {(r.w1, r.w2): r.n for r in cooc.cooc_pairs(df, top, d, min_len).collect()}
    assert got == want
    assert all(got[b, a] == n for (a, b), n in got.items())
    by_window = cooc.cooc_pairs_by_window(df, top, d, min_len)
    assert {(r.w1, r.w2): r.n for r in by_window.collect()} == want
    swept = {(r.w1, r.w2): r.n for r in cooc.cooc_sweep(df, top, 4, min_len).collect() if r.d == d}
    assert swept == want
    seen = {w for line in corpus for w in line if w in TOP and len(w) >= min_len}
    stripes = dict(cooc.cooc_stripes(df, top, d, min_len, keep_empty=True).collect())
    assert set(stripes) == seen
    assert {(w, k): n for w, m in stripes.items() for k, n in m.items()} == want


def test_long_word_lists_take_the_window_way(spark):
    corpus = [["aa", "bb", "zz", "c", "aa"]] * 3 + [["dd"], ["c", "dd", "dd", "bb"]]
    df = frame(spark, corpus)
    long = lists.local_table(spark, word=[*TOP, *(f"x{i}" for i in range(1500))])
    assert lists.small_words(long) is None
    got = {(r.w1, r.w2): r.n for r in cooc.cooc_pairs(df, long, 2).collect()}
    assert got == brute_pairs(corpus, 2, 1)
    stripes = dict(cooc.cooc_stripes(df.where("line = 'dd'"), long, 2, keep_empty=True).collect())
    assert stripes == {"dd": {}}


SUFFIXES = sorted({s for s, _ in (*porter.PLURAL_SUFFIXES, *porter.DOUBLE_SUFFIXES,
                                   *porter.SHORT_SUFFIXES)}
                  | set(porter.BARE_SUFFIXES) | {"ed", "ing", "eed", "y", "e", "ll", "ility", ""})


def test_a_stem_is_its_word_cut_at_the_end(spark):
    heads = ["", "a", "b", "y", "ab", "ba", "yb", "by", "bab", "aba", "bay", "st", "sti", "hopp",
             "fizz", "controll", "abb", "tr", "bebb", "oxy", "relat", "nn", "ww"]
    made = sorted({h + a + b for h in heads for a in SUFFIXES for b in SUFFIXES} - {""})
    rows = lists.local_table(spark, w=made)
    stems = rows.select("w", stem_all("array(w)")[0].alias("s"))
    found = stems.collect()
    assert {w: s for w, s in found if s != plain_porter.stem(w)} == {}
    for w, s in stems.where(valid_token(stems.s)).collect():
        assert w.startswith(s[:-1]) and len(s) <= len(w) + 1, (w, s)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(made=st.lists(st.text(alphabet="abeilnosty", min_size=1, max_size=7), min_size=200, max_size=400))
def test_stems_of_random_words(spark, made):
    stems = spark.createDataFrame([(made,)], "w array<string>").select(stem_all("w")).first()[0]
    assert stems == [plain_porter.stem(w) for w in made]


def test_stems_of_the_whole_vocabulary(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = terms.stem_vocab(terms.vocabulary(docs)).collect()
    assert len(found) > 50_000
    assert {w: s for w, s in found if s != plain_porter.stem(w)} == {}


def test_long_lists_give_the_short_lists_results(spark):
    bodies = ["relational cities city hopping hope time timing mixed", "", "ties times city"] * 4
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id int, text string")
    few = ["time", "relat"]
    pad = [f"{a}{b}{c}q" for a in "bcdfghjklm" for b in "bcdfghjklm" for c in "bcdfghjklmnp"]
    short = lists.local_table(spark, word=few)
    long = lists.local_table(spark, word=few + pad)
    assert lists.small_rows(long) is None
    for per_row in (True, False):
        a = terms.document_frequency(docs, short, per_row).collect()
        assert sorted(a) == sorted(terms.document_frequency(docs, long, per_row).collect())
    assert sorted(words.word_count(docs, short).collect()) == sorted(
        words.word_count(docs, long).collect())
    listed = {"term": ["citi", "hope", "time"], "df": [8, 4, 8]}
    tf = terms.tf_idf(docs, lists.local_table(spark, **listed)).collect()
    more = lists.local_table(spark, term=listed["term"] + pad, df=listed["df"] + [1] * len(pad))
    assert sorted(tf) == sorted(terms.tf_idf(docs, more).collect()) and tf


def test_one_document_holding_most_lines(spark):
    hot = [(0, f"city time word{i % 7}") for i in range(3000)]
    rest = [(i, "city age") for i in range(1, 400)]
    rows = spark.createDataFrame(hot + rest, "doc_id int, text string").repartition(6)
    df = dict(terms.document_frequency(rows, lists.default_stopwords(spark)).collect())
    assert df == {"citi": 400, "time": 1, "ag": 399, "word": 1}
    tf = terms.term_frequency(rows, lists.local_table(spark, term=["citi", "word"])).collect()
    assert {(r.doc_id, r.term): r.tf for r in tf if r.doc_id == 0} == {(0, "citi"): 3000, (0, "word"): 3000}
    assert len(tf) == 401
    stripes = terms.doc_stripes(rows, terms.term_frequency(
        rows, lists.local_table(spark, term=["time"])))
    assert dict(stripes.collect()) == {0: {"time": 3000}} | {i: {} for i in range(1, 400)}


@SLOW
@given(body=st.text(alphabet="aYyéİß .!?\n\thtp:w&;'", max_size=60))
def test_cleaning_whole_texts_equals_cleaning_lines(spark, body):
    whole = spark.createDataFrame([(0, body)], "doc_id int, text string")
    apart = spark.createDataFrame(list(enumerate(body.split("\n"))), "doc_id int, text string")
    a = [(r.line_no, r.sent_no, r.line) for r in lines.sentence_corpus(whole).collect()]
    b = [(r.doc_id, r.sent_no, r.line) for r in lines.sentence_corpus(apart).collect()]
    assert sorted(a) == sorted(b)
