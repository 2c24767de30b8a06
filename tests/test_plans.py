"""What the physical plans must look like."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wordloom.operators import cooc, lines, terms, words
from wordloom.session import widths
from wordloom.sources import lists
from wordloom.sources.tables import load_table, row_groups, spread

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def stop(spark):
    return lists.default_stopwords(spark)


@pytest.fixture(scope="module")
def top(spark):
    return lists.local_table(spark, word=[f"w{i}" for i in range(50)])


def test_word_count_filters_before_its_one_exchange(docs, stop):
    text = plan(words.word_count(docs, stop))
    assert exchanges(text) == 1 and "partial_count" in text
    assert text.index("Exchange hash") < text.index("BroadcastHashJoin")
    assert "ReadSchema: struct<text:string>" in text


def test_long_stop_list_joins_the_vocabulary(docs, spark):
    many = lists.local_table(spark, word=[f"s{i}" for i in range(5000)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(words.word_count(docs, many))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    assert text.index("SortMergeJoin") < text.index("partial_count")


def test_top_k_needs_no_global_sort(docs, stop):
    text = plan(words.top_words(words.word_count(docs, stop)))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_pairs_shuffle_counts_only(docs, top):
    text = plan(cooc.cooc_pairs(lines.sentence_corpus(docs), top, 2))
    assert exchanges(text) == 1 and "Join" not in text and "Sort" not in text
    assert text.count("INSET") == 1


def test_sweep_is_one_pass(docs, top):
    text = plan(cooc.cooc_sweep(lines.sentence_corpus(docs), top, 4))
    assert exchanges(text) == 1 and text.count("FileScan") == 1


def test_stripes_with_empties_are_one_pass(docs, top):
    text = plan(cooc.cooc_stripes(lines.sentence_corpus(docs), top, 2, keep_empty=True))
    assert exchanges(text) == 2 and text.count("FileScan") == 1


def test_document_frequency_exchanges(docs, stop):
    assert exchanges(plan(terms.document_frequency(docs, stop, row_per_doc=True))) == 1
    assert exchanges(plan(terms.document_frequency(docs, stop))) == 2


def test_tf_idf_shuffles_listed_terms_once(docs, spark):
    listed = lists.local_table(spark, term=["citi", "time"], df=[2, 3])
    text = plan(terms.tf_idf(docs, listed, 10))
    assert exchanges(text) == 1 and text.count("FileScan") == 1
    assert "BroadcastHashJoin" in text
    text = plan(terms.tf_idf(docs, listed, 10, row_per_doc=True))
    assert exchanges(text) == 0 and text.count("FileScan") == 1
    # The stems are worked out once: one expression, with one marking of y.
    assert text.count("(^|[aeiou])y") == 1
    assert exchanges(plan(terms.doc_stripes_by_row(docs, listed))) == 0


def test_no_query_runs_python_per_row(spark):
    for name, query in entry._QUERIES.items():
        text = plan(query(spark, SF))
        assert not re.search("EvalPython|InPandas|InArrow|MapPartitions", text), name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_spread_leaves_wide_scans_alone(spark, docs):
    assert spread(docs).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(1000, numPartitions=64).toDF("id")
    assert spread(wide) is wide


def test_top_words_of_a_line_are_found_once(docs, top):
    text = plan(cooc.top_word_lines(lines.sentence_corpus(docs), top))
    assert text.count("INSET") == 1


def test_formula_counts_in_one_pass(docs):
    text = plan(terms.word_frequencies(docs))
    assert exchanges(text) == 1 and text.count("FileScan") == 1 and "Join" not in text


def test_spread_deals_out_equal_rows_evenly(spark, tmp_path):
    path = str(tmp_path / "hot.parquet")
    spark.range(8_000, numPartitions=1).selectExpr("'one hot text' as text").write.parquet(path)
    dealt = spread(spark.read.parquet(path))
    sizes = [len(x) for x in dealt.rdd.glom().collect()]
    assert len(sizes) == 8 and max(sizes) < 2_000
    many = spark.read.parquet(path).repartition(4)
    assert spread(many) is many


def test_widths_follow_the_input():
    assert widths(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    large = widths(100 << 40)
    assert int(large["spark.sql.shuffle.partitions"]) == 819_200
    assert large["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def _one_file(spark, path, row_groups):
    """A file of some 15 MB whose text Spark would cut into several splits."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(97, 123, 1500))) for _ in range(14_000)]
    table = pa.table({"doc_id": list(range(len(texts))), "text": texts})
    (path / "documents.parquet").mkdir()
    pq.write_table(table, path / "documents.parquet" / "one.parquet", row_group_size=len(texts) // row_groups)
    return str(path)


def _tasks_with_rows(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_a_file_of_one_row_group_is_read_by_all_cores(spark, tmp_path):
    folder = _one_file(spark, tmp_path, 1)
    scan = spark.read.parquet(f"{folder}/documents.parquet")
    assert scan.rdd.getNumPartitions() >= 4 and _tasks_with_rows(scan) == 1
    assert row_groups(scan, 8) == 1
    assert _tasks_with_rows(load_table(spark, folder, "documents", "doc_id", "text")) == 8


def test_a_file_of_many_row_groups_is_left_alone(spark, tmp_path):
    folder = _one_file(spark, tmp_path, 14)
    scan = spark.read.parquet(f"{folder}/documents.parquet")
    assert row_groups(scan, 99) == 14
    assert "Exchange" not in plan(load_table(spark, folder, "documents"))


def test_the_documents_of_the_bench_are_read_by_all_cores(spark):
    docs = load_table(spark, "/root/testdata/sf0.1", "documents", "doc_id", "text")
    assert _tasks_with_rows(docs) == 8


def test_row_groups_of_empty_tables(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "none.parquet"))
    assert row_groups(spark.read.parquet(str(tmp_path / "none.parquet")), 4) == 0
    assert load_table(spark, str(tmp_path), "none").count() == 0
