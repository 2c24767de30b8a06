"""The registered queries on whole tables, and the pipeline stage by stage."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import connect, differences
from wordloom.llm import sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_beside_its_sql(spark, name):
    assert differences(spark, connect(SF), SF, entry.queries()[name], sql.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op") and n not in sql.oracle_sql()))
def test_query_gives_every_row(spark, name):
    table = "pages" if name.startswith("op8") else "documents"
    assert entry.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_ten_operators_and_a_pipeline():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert entry.queries()["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF).cache()
        rows = docs.collect()
        kept.append(Counter(r.doc_id for r in rows))
        if k < 4:
            assert docs.columns == columns and all(r.text == texts[r.doc_id] for r in rows)
    quality, exact, near, mix, pieces = kept
    assert set(quality) > set(exact) >= set(near) >= set(mix)
    assert max(mix.values()) <= 2 and pieces == mix
    plain = Counter("".join(texts[i].split()) for i in exact)
    assert max(plain.values()) == 1
    words = {i: len(texts[i].split()) for i in near}
    assert sum(words[i] * n for i, n in mix.items()) == pytest.approx(1.5 * sum(words.values()), rel=0.05)
