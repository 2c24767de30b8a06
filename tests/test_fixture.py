import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import fixtures as fx
from wordloom.functions import maps, text
from wordloom.functions.porter import stem_all
from wordloom.operators import cooc, lines, terms, words
from wordloom.sources import lists


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fx.DOCS, "doc_id long, text string").persist()


@pytest.fixture(scope="module")
def sentences(docs):
    return lines.sentence_corpus(docs).persist()


@pytest.fixture(scope="module")
def stop(spark):
    raw = spark.createDataFrame([(w,) for w in fx.STOPWORD_LINES], "value string")
    return lists.stopword_set(raw).persist()


@pytest.fixture(scope="module")
def top(spark):
    return lists.local_table(spark, word=fx.TOP_WORDS)


def both_ways(unordered):
    out = {}
    for pair, n in unordered.items():
        a, b = pair.split(",")
        out[a, b] = out[b, a] = n
    return out


def as_pairs(df):
    return {(r.w1, r.w2): r.n for r in df.collect()}


def test_sentences(sentences):
    assert sorted(map(tuple, sentences.collect())) == fx.SENTENCES


def test_stopwords(stop):
    assert sorted(r.word for r in stop.collect()) == ["a's", "for", "of", "the"]
    assert sorted(r.word for r in lists.with_stems(stop).collect()) == ["a'", "a's", "for", "of", "the"]


def test_stopwords_trim_only(spark):
    raw = spark.createDataFrame([("The ",), ("the",), ("\t",)], "value string")
    kept = lists.stopword_set(raw, lowercase=False)
    assert sorted(r.word for r in kept.collect()) == ["The", "the"]


@pytest.mark.parametrize("min_len", [1, 3])
def test_word_count(sentences, stop, min_len):
    counts = words.word_count(sentences, stop, "line", min_len)
    assert dict(counts.collect()) == {w: n for w, n in fx.COUNTS.items() if len(w) >= min_len}
    ranked = [r.word for r in words.top_words(counts, 5).collect()]
    assert ranked == [w for w in fx.COUNTS if len(w) >= min_len][:5]


@pytest.mark.parametrize(("d", "min_len"), list(fx.PAIRS))
@pytest.mark.parametrize("way", [cooc.cooc_pairs, cooc.cooc_pairs_by_window])
def test_pairs(sentences, top, way, d, min_len):
    assert as_pairs(way(sentences, top, d, min_len)) == both_ways(fx.PAIRS[d, min_len])


@pytest.mark.parametrize("d", [1, 2])
@pytest.mark.parametrize("keep_empty", [False, True])
def test_stripes(sentences, top, d, keep_empty):
    stripes = cooc.cooc_stripes(sentences, top, d, 2, keep_empty)
    shown = dict(stripes.select("word", maps.stripe_text(F.col("stripe"))).collect())
    assert shown == fx.STRIPES[d] | ({"viii": "{}"} if keep_empty else {})


def test_sweep(sentences, top):
    swept = cooc.cooc_sweep(sentences, top, 2, 2).collect()
    for d in (1, 2):
        assert {(r.w1, r.w2): r.n for r in swept if r.d == d} == both_ways(fx.PAIRS[d, 2])


def test_layouts_agree_and_differ(sentences, top):
    pairs, stripes = cooc.cooc_pairs(sentences, top, 2, 2), cooc.cooc_stripes(sentences, top, 2)
    assert cooc.compare_layouts(pairs, stripes).first() == Row(n_pairs=7, only_pairs=0, only_stripes=0)
    near = cooc.cooc_stripes(sentences, top, 1)
    assert cooc.compare_layouts(pairs, near).first() == Row(n_pairs=7, only_pairs=4, only_stripes=4)


def test_merge_stripes(sentences, top):
    once = cooc.cooc_stripes(sentences, top, 2)
    merged = cooc.merge_stripes(once.unionByName(once).unionByName(once))
    three = {w: {k: 3 * n for k, n in m.items()} for w, m in once.collect()}
    assert dict(merged.collect()) == three


@pytest.mark.parametrize("row_per_doc", [True, False])
def test_document_frequency(docs, stop, row_per_doc):
    assert dict(terms.document_frequency(docs, stop, row_per_doc).collect()) == fx.DF


def test_document_frequency_of_lines(docs, stop):
    rows = lines.line_scan(docs).withColumnRenamed("line", "text")
    assert dict(terms.document_frequency(rows, stop).collect()) == fx.DF


def test_top_terms(docs, stop):
    df = terms.document_frequency(docs, stop)
    asc = [r.term for r in terms.top_terms(df, 8).collect()]
    desc = [r.term for r in terms.top_terms(df, 8, "desc").collect()]
    assert asc == ["a", "b", "citi", "time", "ag", "amp", "http", "ran"]
    assert desc == ["time", "citi", "b", "a", "z", "y", "x", "viii"]
    with pytest.raises(ValueError):
        terms.top_terms(df, 8, "up")


@pytest.mark.parametrize("row_per_doc", [True, False])
def test_tf_idf(docs, stop, row_per_doc):
    listed = terms.top_terms(terms.document_frequency(docs, stop), 8)
    rows = terms.tf_idf(docs, listed, None, row_per_doc).orderBy("doc_id", "term").collect()
    assert [(r.doc_id, r.term, r.tf, round(r.score, 6)) for r in rows] == fx.TF_IDF
    fixed = terms.tf_idf(docs, listed, 4).orderBy("doc_id", "term").collect()
    assert fixed == rows


def test_tf_idf_with_an_empty_list(docs, spark):
    nothing = spark.createDataFrame([], "term string, df bigint")
    assert terms.tf_idf(docs, nothing).count() == 0


def test_unlisted_df_is_one(docs, spark):
    counts = terms.term_frequency(docs, lists.local_table(spark, term=["citi", "amp"]))
    found = terms.with_df(counts, lists.local_table(spark, term=["citi"], df=[2]))
    assert {(r.doc_id, r.term, r.df) for r in found.collect()} == {
        (1, "citi", 2), (3, "citi", 2), (1, "amp", 1)}


def test_doc_stripes(docs, stop, spark):
    listed = terms.top_terms(terms.document_frequency(docs, stop), 8)
    stripes = terms.doc_stripes(docs, terms.term_frequency(docs, listed))
    encoded = dict(terms.encode_doc_stripes(stripes).collect())
    by_row = terms.encode_doc_stripes(terms.doc_stripes_by_row(docs, listed))
    assert dict(by_row.collect()) == encoded
    assert encoded == {1: "amp:1|citi:4|time:2", 2: "http:1|ran:1|time:1", 3: "citi:2", 4: ""}


def test_decode(spark):
    encoded = spark.createDataFrame([(1, "a:2|b:1"), (1, "a:3|broken|c:x")], "doc_id long, stripe string")
    assert sorted(map(tuple, terms.decode_doc_stripes(encoded).collect())) == [(1, "a", 5), (1, "b", 1)]


def test_term_df_lines(spark):
    rows = [(0, "ok\t9"), (1, "ok\t3"), (2, "bad\tx"), (3, "one"), (4, "a\t1\t2"), (5, ""),
            (6, "big\t99999999999")]
    raw = spark.createDataFrame(rows, "at int, value string")
    assert lists.parse_term_df(raw, order=F.col("at")).collect() == [Row(term="ok", df=3)]
    assert lists.parse_term_df(raw).collect() == [Row(term="ok", df=9)]


def test_valid_token(spark):
    tokens = ["abc", "mixed", "civic", "ab", "viii", "xxx", "vix", "a1c", "Abc"]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    kept = df.where(text.valid_token(F.col("t"))).collect()
    assert [r.t for r in kept] == ["abc", "mixed", "civic"]


def test_stems(spark):
    df = spark.createDataFrame([(list(fx.STEMS),)], "w array<string>")
    assert df.select(stem_all("w")).first()[0] == list(fx.STEMS.values())


def test_url_and_entity_edges(spark):
    cases = {
        "a&amp;b&lt;": "a b&lt;",
        "see http://x y": "see  y",
        "www.http://x y": "www. y",
        "http www.": "http www.",
        "HTTP://X stays": "HTTP://X stays",
        "http://a\tb c": " c",
        "http://a\nb": "\nb",
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = df.select(text.strip_urls(text.clean_entities(F.col("t")))).collect()
    assert [r[0] for r in got] == list(cases.values())


def test_six_decimals(spark):
    df = spark.sql("select 0.1234565D as a, 2D as b")
    got = df.select(text.six_decimals(F.col("a")), text.six_decimals(F.col("b"))).first()
    assert tuple(got) == ("0.123457", "2.000000")


def test_long_lines_are_counted_and_skipped(spark):
    from pyspark.sql import Observation

    rows = spark.createDataFrame([("x" * 19,), ("x" * 18,), ("é" * 10,)], "line string")
    seen = Observation("long")
    kept = lines.skip_long_lines(rows, 20, seen).collect()
    assert [r.line for r in kept] == ["x" * 18]
    assert seen.get["skipped"] == 2


def test_stage_counter(docs):
    df, seen = lines.counted(docs, "documents")
    df.collect()
    assert seen.get["rows"] == 4
