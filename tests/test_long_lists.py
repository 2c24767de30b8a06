"""Long lists: work and memory that grow with the text, results as by hand."""

from pyspark.sql import functions as F

from wordloom.operators import cooc, terms
from wordloom.sources import lists


def filler(n=1_200):
    return [f"q{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}zq" for i in range(n)]


def tree(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_line_is_taken_apart_in_one_pass_over_its_tokens(spark):
    lines = spark.createDataFrame([("a b a c a",), (None,), ("",), ("c",)], "line string")
    top = lists.local_table(spark, word=["a", "c", None])
    found = cooc.top_word_positions(lines, top)
    assert sorted((r.pos, r.word) for r in found.collect()) == [(0, "a"), (0, "c"), (2, "a"), (3, "c"), (4, "a")]
    # A search of all tokens for each different word grows with the square of a line.
    assert "filter(transform(" not in tree(found)


def test_windows_and_gathered_lines_agree(spark):
    lines = spark.createDataFrame([("a b a c a",), ("a b a c a",), (None,), ("",), ("c",)], "line string")
    top = lists.local_table(spark, word=["a", "c", *filler()])
    gathered = cooc.following(lines, top, 3)
    windows = cooc._following_by_window(cooc.top_word_positions(lines, top), 3)
    assert rows(gathered) == rows(windows)
    assert gathered.where("w2 is null and gap is null").count() == 3
    # No window function, and no list of structs that is filtered by a lambda.
    assert "Window" not in tree(gathered) and "lambdafunction" not in tree(windows)


def test_words_of_long_lists_are_stemmed_once(spark):
    docs = spark.createDataFrame([(1, "cities city the"), (1, "city"), (2, None), (None, "running cities")],
                                 "doc_id long, text string")
    listed = lists.local_table(spark, term=["citi", "run", *filler()])
    found = terms.term_frequency(docs, listed, True)
    assert rows(found) == ["Row(doc_id=1, term='citi', tf=1)", "Row(doc_id=1, term='citi', tf=2)",
                           "Row(doc_id=None, term='citi', tf=1)", "Row(doc_id=None, term='run', tf=1)"]
    assert "regexp_replace" not in tree(found)
    stripes = terms.doc_stripes_by_row(docs, listed)
    assert sorted(str(r.stripe) for r in stripes.collect()) == ["{'citi': 1, 'run': 1}", "{'citi': 1}", "{'citi': 2}", "{}"]
    assert "regexp_replace" not in tree(stripes)


def test_a_long_stop_list_meets_counts_only(spark):
    docs = spark.createDataFrame([(1, "cities city the"), (1, "city"), (2, None), (3, ""), (4, "cities running"), (5, "runs")],
                                 "doc_id long, text string")
    stop = lists.local_table(spark, word=["city", "runs", *filler()])
    # "citi" and "run" are stems of stopwords.
    assert rows(terms.document_frequency(docs, stop, row_per_doc=True)) == ["Row(term='the', df=1)"]
    stop = lists.local_table(spark, word=["cities", "the", *filler()])
    found = terms.document_frequency(docs.union(docs), stop, row_per_doc=True)
    assert rows(found) == ["Row(term='run', df=4)"]
    # Where the list is too long to be broadcast, the text is counted below every join.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = tree(terms.document_frequency(docs, stop, row_per_doc=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.rindex("Join") < text.rindex("Aggregate [term")


def test_words_of_one_stem_count_once_in_a_row(spark):
    docs = spark.createDataFrame([(1, "general"), (2, "general generic"), (3, "generic")], "doc_id long, text string")
    found = terms.document_frequency(docs, lists.local_table(spark, word=["the", *filler()]), row_per_doc=True)
    assert rows(found) == ["Row(term='gener', df=3)"]
