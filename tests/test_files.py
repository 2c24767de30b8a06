import pytest
from pyspark.sql import functions as F

import fixtures as fx
from wordloom.__main__ import main
from wordloom.sources import lists, sinks
from wordloom.sources.text import file_stem, read_documents, read_lines


@pytest.fixture
def corpus(tmp_path):
    root = tmp_path / "c"
    (root / "sub").mkdir(parents=True)
    (root / "a.txt.xml").write_bytes(b"Hello\nworld\r\nx")
    (root / "sub" / "b.txt").write_bytes(b"last\nline")
    (root / "empty.txt").write_bytes(b"")
    return str(root)


def test_lines_of_nested_files(spark, corpus):
    rows = read_lines(spark, corpus, "stem").collect()
    assert sorted(map(tuple, rows)) == [
        ("a.txt", "Hello"), ("a.txt", "world"), ("a.txt", "x"), ("b", "last"), ("b", "line")]


def test_whole_files(spark, corpus):
    rows = read_documents(spark, corpus).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    assert {r.text for r in rows} - {""} == {"Hello\nworld\r\nx", "last\nline"}
    with pytest.raises(ValueError):
        read_lines(spark, corpus, "name")


def test_document_ids(spark):
    names = ["a.txt.xml", "plain", ".hidden", "x.txt"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(file_stem(F.col("n"))).collect()] == ["a.txt", "plain", "", "x"]


def test_small_files_are_packed(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"{i}.txt").write_text("word\n" * 20)
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        assert read_lines(spark, str(tmp_path)).rdd.getNumPartitions() <= 16
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)


def test_lists_from_files(spark, tmp_path):
    (tmp_path / "stop.txt").write_bytes(b"The \r\n\r\n of\r\nthe\r\n")
    (tmp_path / "top.tsv").write_text("city\t9\ntime\t5\textra\nbare\n")
    (tmp_path / "df.tsv").write_text("a\t1\nb\t2\na\t7\nbad\n")
    stop = lists.read_stopwords(spark, str(tmp_path / "stop.txt"))
    assert sorted(r.word for r in stop.collect()) == ["of", "the"]
    top = lists.read_top_words(spark, str(tmp_path / "top.tsv"))
    assert sorted(r.word for r in top.collect()) == ["bare", "city", "time"]
    df = lists.read_term_df(spark, str(tmp_path / "df.tsv"))
    assert dict(df.collect()) == {"a": 7, "b": 2}


def lines_in(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


def test_sinks_replace_and_sort(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", None)], "k string, n int")
    out = tmp_path / "out"
    for _ in range(2):
        sinks.write_tsv(df, str(out))
        assert sorted(lines_in(out)) == ["a\t1", "b\t2", "c\t"]
    sinks.write_sorted_tsv(df.repartition(3), str(out), "k")
    assert lines_in(out) == ["a\t1", "b\t2", "c\t"]
    sinks.write_single_tsv(df.repartition(3), str(out), F.desc("k"))
    assert len(list(out.glob("part-*"))) == 1 and lines_in(out) == ["c\t", "b\t2", "a\t1"]
    # A result that is too large is refused, and what lies there stays.
    with pytest.raises(ValueError):
        sinks.write_single_tsv(df.repartition(3), str(out), "k", max_rows=2)
    assert lines_in(out) == ["c\t", "b\t2", "a\t1"]
    assert sorted(sinks.hand_over(df, str(tmp_path / "h")).collect()[:1])


def test_jobs_end_to_end(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for doc, body in fx.DOCS:
        (source / f"{doc}.txt").write_text(body)
    (tmp_path / "stop").write_text("\n".join(fx.STOPWORD_LINES))
    (tmp_path / "top").write_text("".join(f"{w}\t1\n" for w in fx.TOP_WORDS))

    def job(*args):
        main([str(a) for a in args])

    at = tmp_path.joinpath
    job("merge", source, at("clean"))
    assert sorted(lines_in(at("clean"))) == sorted(s[3] for s in fx.SENTENCES)
    job("count-words", at("clean"), at("counts"), at("stop"))
    assert lines_in(at("counts")) == sorted(f"{w}\t{n}" for w, n in fx.COUNTS.items())
    job("rank-words", at("counts"), at("ranked"), "--k", 3)
    assert lines_in(at("ranked")) == ["city\t6", "time\t3", "b\t2"]
    job("pairs", at("clean"), at("pairs"), at("top"), 1)
    want = {f"{a},{b}\t{n}" for p, n in fx.PAIRS[1, 1].items()
            for a, b in (p.split(","), p.split(",")[::-1])}
    assert lines_in(at("pairs")) == sorted(want)
    job("stripes", at("clean"), at("stripes"), at("top"), 2, "--keep-empty")
    shown = fx.STRIPES[2] | {"viii": "{}"}
    assert lines_in(at("stripes")) == sorted(f"{w}\t{s}" for w, s in shown.items())
    job("sweep", at("clean"), at("sweep"), at("top"), "--max-distance", 2, "--min-len", 2)
    swept = lines_in(at("sweep"))
    assert len(swept) == 14 and swept[0] == "1\tage,city\t2"
    for extra in ([], ["--whole-files"]):
        job("document-frequency", source, at("df"), at("top8"), at("stop"), "--k", 8, *extra)
        assert lines_in(at("df")) == sorted(f"{t}\t{n}" for t, n in fx.DF.items())
        assert lines_in(at("top8"))[:5] == ["a\t2", "b\t2", "citi\t2", "time\t2", "ag\t1"]
    for extra in ([], ["--whole-files"]):
        job("tf-idf", source, at("scores"), at("top8"), "--n-docs", 4, *extra)
        assert sorted(lines_in(at("scores"))) == [f"{d}\t{t}\t{s:.6f}" for d, t, _, s in fx.TF_IDF]
