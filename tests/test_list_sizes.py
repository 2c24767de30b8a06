"""Short lists stay in the row, long ones are joined: the same results either way."""

import pytest
from pyspark.sql import functions as F

from wordloom.operators import cooc, terms
from wordloom.sources import lists, sinks
from wordloom.sources.text import read_documents, read_lines

ROWS = [(1, "cities city bbbq bbcq x cities"), (1, "bbcq bbbq the city"), (1, "bbcq bbbq the city"),
        (2, None), (3, ""), (None, "city running runs ran"), (4, "zzz yyy")]
WORDS = ["bbbq", "bbcq", "city", "the"]
TERMS = ["citi", "run", "bbbq"]


def filler(n=1_200):
    return [f"q{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}zq" for i in range(n)]


def listed(spark, name, values, **more):
    return lists.local_table(spark, **{name: values}, **more)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def lines(texts):
    return texts.select("doc_id", F.lit(0).alias("line_no"), F.lit(0).alias("sent_no"), F.col("text").alias("line"))


@pytest.mark.parametrize("find", [
    lambda x, t: cooc.following(lines(x), t, 2), lambda x, t: cooc.cooc_pairs(lines(x), t, 1),
    lambda x, t: cooc.cooc_pairs(lines(x), t, 2, min_len=4), lambda x, t: cooc.cooc_sweep(lines(x), t, 3),
    lambda x, t: cooc.pairs_from_stripes(cooc.cooc_stripes(lines(x), t, 2)), lambda x, t: cooc.top_word_lines(lines(x), t)])
def test_word_lists(spark, texts, find):
    short, long = (listed(spark, "word", WORDS + more) for more in ([], filler()))
    assert rows(find(texts, short)) == rows(find(texts, long))


@pytest.mark.parametrize("row_per_doc", [True, False])
def test_term_lists(spark, texts, row_per_doc):
    short, long = (listed(spark, "term", TERMS + more) for more in ([], filler()))
    found = [rows(terms.term_frequency(texts, t, row_per_doc)) for t in (short, long)]
    assert found[0] == found[1]
    if row_per_doc:
        assert found[0].count("Row(doc_id=1, term='citi', tf=1)") == 2
    stripes = [sorted(str((r.doc_id, sorted(r.stripe.items()))) for r in terms.doc_stripes_by_row(texts, t).collect())
               for t in (short, long)]
    assert stripes[0] == stripes[1] and len(stripes[0]) == len(ROWS)


@pytest.mark.parametrize("row_per_doc", [True, False])
def test_stop_lists(spark, texts, row_per_doc):
    short, long = (listed(spark, "word", ["the", *more]) for more in ([], filler()))
    found = [rows(terms.document_frequency(texts, s, row_per_doc)) for s in (short, long)]
    assert found[0] == found[1]
    assert f"Row(term='citi', df={4 if row_per_doc else 2})" in found[0]


def test_a_common_word_of_a_long_list(spark):
    docs = spark.range(3_000).selectExpr("id as doc_id", "0 as line_no", "0 as sent_no", "repeat('city ', 20) as line")
    pairs = cooc.cooc_pairs(docs, listed(spark, "word", WORDS + filler()), 1)
    assert pairs.collect() == [("city", "city", 3_000 * 19 * 2)]


def test_single_file_refuses_many_rows(spark, tmp_path):
    df = spark.range(10).withColumn("x", F.lit(None).cast("string"))
    sinks.write_single_tsv(df, str(tmp_path / "a"), "id", max_rows=10)
    assert len(list((tmp_path / "a").glob("part-*"))) == 1
    with pytest.raises(ValueError):
        sinks.write_single_tsv(df, str(tmp_path / "b"), "id", max_rows=9)


def test_names_of_files(spark, tmp_path):
    names = ["a b.v2.txt", "a+b.txt", "50%.txt", "été.txt", "plain"]
    for n in names:
        (tmp_path / n).write_text("one line\n")
    ids = {"a b.v2", "a+b", "50%", "été", "plain"}
    assert {r.doc_id for r in read_lines(spark, str(tmp_path), "stem").collect()} == ids
    assert {r.doc_id for r in read_documents(spark, str(tmp_path), "stem").collect()} == ids
    assert all(r.doc_id.endswith(tuple(names)) for r in read_lines(spark, str(tmp_path)).collect())


def test_lines_of_a_term_table(spark, tmp_path):
    (tmp_path / "b").write_text("time\t4\t\t\nage\t3\n\tx\n")
    (tmp_path / "a").write_text("city\t5\t\ntime\t9\nage\t3\tmore\n")
    got = {r.term: r.df for r in lists.read_term_df(spark, str(tmp_path)).collect()}
    assert got == {"city": 5, "time": 4, "age": 3}
