"""Options of the jobs: long lines, counters, empty files, merging and resuming."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import fixtures as fx
from wordloom.__main__ import main
from wordloom.functions import maps
from wordloom.operators import cooc, terms
from wordloom.plans import jobs
from wordloom.sources import lists, sinks
from wordloom.sources.text import list_files, read_lines


def lines_in(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


def job(*args):
    main([str(a) for a in args])


@pytest.fixture
def corpus(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for doc, body in fx.DOCS:
        (source / f"{doc}.txt").write_text(body)
    (tmp_path / "stop").write_text("\n".join(fx.STOPWORD_LINES))
    (tmp_path / "top").write_text("".join(f"{w}\t1\n" for w in fx.TOP_WORDS))
    return tmp_path


# -- line ends and long lines ---------------------------------------------------

@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_lines_by_their_true_bytes(spark, tmp_path, end):
    texts = ["abc", "", "abcd", "é", "abcdefgh", "ab"]
    (tmp_path / "f.txt").write_bytes("".join(t + end for t in texts).encode())
    plain = sorted(r.line for r in read_lines(spark, str(tmp_path)).collect())
    assert plain == sorted(texts)
    for limit in range(1, 14):
        skipped = Observation(f"skipped{limit}{len(end)}{ord(end[0])}")
        got = read_lines(spark, str(tmp_path), max_line=limit, skipped=skipped).collect()
        # The last line of a file counts as ended by a line feed, here behind its own end.
        size = [len((t + end).encode()) + (end == "\r" and i + 1 == len(texts)) for i, t in enumerate(texts)]
        want = [t for t, n in zip(texts, size) if n < limit]
        assert sorted(r.line for r in got) == sorted(want)
        assert skipped.get["skipped"] == len(texts) - len(want)


def test_mixed_line_ends(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes(b"a\rb\r\nc\n\r\n\rlast")
    plain = sorted(r.line for r in read_lines(spark, str(tmp_path)).collect())
    got = sorted(r.line for r in read_lines(spark, str(tmp_path), max_line=1000).collect())
    assert got == plain == ["", "", "a", "b", "c", "last"]


def test_long_lines_and_stopwords_as_written(spark, corpus):
    source, at = corpus / "lines", corpus.joinpath
    source.mkdir()
    (source / "a.txt").write_bytes(b"city time\r\ncity time\nThe The the\nbear and\n")
    (corpus / "words").write_text("The \nand\n")
    job("count-words", source, at("all"), at("words"))
    assert lines_in(at("all")) == ["bear\t1", "city\t2", "time\t2"]
    job("count-words", source, at("some"), at("words"), "--max-line", 11, "--counters", at("counters"))
    assert lines_in(at("some")) == ["bear\t1", "city\t1", "time\t1"]
    assert lines_in(at("counters")) == ["input lines\t2", "result rows\t3", "skipped lines\t2"]
    job("count-words", source, at("written"), at("words"), "--as-written")
    assert lines_in(at("written")) == ["bear\t1", "city\t2", "the\t3", "time\t2"]
    job("merge", source, at("merged"), "--max-line", 11)
    assert sorted(lines_in(at("merged"))) == ["bear and", "city time"]


# -- counters -------------------------------------------------------------------

def test_counters_of_pairs_and_stripes(spark, corpus):
    at = corpus.joinpath
    job("merge", at("in"), at("clean"))
    n_lines = len(lines_in(at("clean")))
    kept = sum(w in fx.TOP_WORDS for line in lines_in(at("clean"))
               for w in "".join(c if "a" <= c <= "z" else " " for c in line.lower()).split())
    job("pairs", at("clean"), at("pairs"), at("top"), 2, "--counters", at("counters"))
    pairs = [line.split("\t") for line in lines_in(at("pairs"))]
    want = {"input lines": n_lines, "kept words": kept, "pair records": sum(int(n) for _, n in pairs), "result rows": len(pairs)}
    assert dict(line.split("\t") for line in lines_in(at("counters"))) == {k: str(v) for k, v in want.items()}
    job("pairs", at("clean"), at("plain"), at("top"), 2)
    assert lines_in(at("plain")) == lines_in(at("pairs"))
    job("stripes", at("clean"), at("stripes"), at("top"), 2, "--keep-empty", "--min-len", 1, "--counters", at("counters"))
    want["result rows"] = len(lines_in(at("stripes")))
    assert dict(line.split("\t") for line in lines_in(at("counters"))) == {k: str(v) for k, v in want.items()}


# -- file listing ---------------------------------------------------------------

def test_listing_has_empty_files_and_opens_none(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a b+c.txt").write_text("x")
    (tmp_path / "sub" / "none.txt").write_text("")
    rows = list_files(spark, str(tmp_path), "stem")
    assert sorted((r.doc_id, r.length) for r in rows.collect()) == [("a b+c", 1), ("none", 0)]
    assert "content" not in rows._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_empty_files_count_for_tf_idf(spark, corpus):
    at = corpus.joinpath
    job("document-frequency", at("in"), at("df"), at("top8"), at("stop"), "--k", 8)
    for i in range(4 - len(fx.DOCS)):
        (at("in") / f"empty{i}.txt").write_text("")
    assert len(list(at("in").iterdir())) == 4
    for extra in ([], ["--whole-files"]):
        job("tf-idf", at("in"), at("scores"), at("top8"), *extra)
        assert sorted(lines_in(at("scores"))) == [f"{d}\t{t}\t{s:.6f}" for d, t, _, s in fx.TF_IDF]


# -- merging written results ----------------------------------------------------

def test_stripe_text_is_parsed(spark):
    texts = {"{a=1, b=20}": {"a": 1, "b": 20}, "{}": {}, "a=1": None, "{a=1, broken, =3, c=x, a=4}": {"a": 5},
             "{k=v=7,  z=-2}": {"k=v": 7, "z": -2}, "": None, None: None, "{big=9999999999, huge=99999999999999999999}": {"big": 9999999999}}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", maps.parsed_stripe(F.col("t")).alias("m"))
    assert {r.t: r.m for r in df.collect()} == texts
    made = spark.createDataFrame([({"x": 3, "y": 4},)], "m map<string,bigint>")
    assert made.select(maps.parsed_stripe(maps.stripe_text(F.col("m")))).first()[0] == {"x": 3, "y": 4}


def test_batches_add_up(spark, corpus):
    at = corpus.joinpath
    job("merge", at("in"), at("clean"))
    every = lines_in(at("clean"))
    for name, part in (("one", every[::2]), ("two", every[1::2]), ("all", every)):
        at(name).mkdir()
        (at(name) / "lines.txt").write_text("".join(line + "\n" for line in part))
        job("stripes", at(name), at(f"stripes-{name}"), at("top"), 2, "--keep-empty")
        job("pairs", at(name), at(f"pairs-{name}"), at("top"), 2)
    job("add-stripes", at("stripes-one"), at("stripes-two"), at("stripes"))
    assert lines_in(at("stripes")) == lines_in(at("stripes-all"))
    job("add-counts", at("pairs-one"), at("pairs-two"), at("pairs"))
    assert lines_in(at("pairs")) == lines_in(at("pairs-all"))


# -- resuming -------------------------------------------------------------------

def test_finished_steps_are_skipped(spark, corpus, capsys):
    at = corpus.joinpath
    how = {"k": 8, "n_docs": 4}
    run = lambda **more: jobs.score_corpus(spark, str(at("in")), str(at("work")), str(at("stop")), **how | more)
    first = run()
    assert [ran for _, _, ran in first] == [True] * 3
    scores = at("work") / first[-1][1].rsplit("/", 1)[1]
    assert sorted(lines_in(scores)) == [f"{d}\t{t}\t{s:.6f}" for d, t, _, s in fx.TF_IDF]
    assert [ran for _, _, ran in run()] == [False] * 3
    # A step that was cut off has no mark and is run again; the finished one before it is not.
    (scores / "_SUCCESS").unlink()
    assert [ran for _, _, ran in run()] == [False, False, True]
    assert [ran for _, _, ran in run(k=7)] == [False, True, True]
    assert [ran for _, _, ran in run(fresh=True)] == [True] * 3
    (at("in") / "more.txt").write_text("city city")
    assert [ran for _, _, ran in run()] == [True] * 3
    job("score-corpus", at("in"), at("work"), at("stop"), "--k", 8, "--n-docs", 4)
    assert capsys.readouterr().out.count("False") == 3


def test_rankings_of_any_length(spark, tmp_path):
    df = spark.createDataFrame([(f"w{i}", i) for i in range(20)], "word string, n int").repartition(3)
    out = tmp_path / "ranked"
    for limit in (1000, 7):
        sinks.write_ranked_tsv(df, str(out), F.desc("n"), max_rows=limit)
        assert lines_in(out) == [f"w{i}\t{i}" for i in range(19, -1, -1)]


# -- stem dictionary ------------------------------------------------------------

def test_only_unseen_words_are_stemmed(spark, tmp_path):
    path = str(tmp_path / "stems")
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "word string")
    assert {tuple(r) for r in terms.grown_dictionary(words("running", "cities", "running"), path).collect()} == {
        ("running", "run"), ("cities", "citi")}
    # A stem that the table has is believed, not worked out again.
    lists.local_table(spark, word=["odd"], stem=["kept"]).write.mode("append").parquet(path)
    grown = terms.grown_dictionary(words("odd", "times", "cities"), path)
    assert sorted(map(tuple, grown.collect())) == [("cities", "citi"), ("odd", "kept"), ("running", "run"), ("times", "time")]
    again = terms.stem_dictionary(words("odd", "fresh", "newly"), grown)
    assert sorted(map(tuple, again.collect())) == [("fresh", "fresh"), ("newly", "newli"), ("odd", "kept")]


DOCS = [(1, "the city cities cited a city"), (2, None), (3, ""), (1, "times of time and city"), (None, "city timing"),
        (4, "vivid xi ii cities The AND"), (5, "city " * 50)]


@pytest.mark.parametrize("row_per_doc", [True, False])
@pytest.mark.parametrize("counted,hot", [(False, 1), (True, 1), (True, 20_000)])
def test_the_dictionary_changes_no_count(spark, monkeypatch, row_per_doc, counted, hot):
    monkeypatch.setattr(terms, "HOT_WORDS", hot)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    stop = lists.default_stopwords(spark)
    stems = terms.stem_dictionary(terms.vocabulary(docs))
    stems = stems.join(terms.word_rows(docs), "word") if counted else stems
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    plain = terms.document_frequency(docs, stop, row_per_doc)
    assert same(plain, terms.document_frequency(docs, stop, row_per_doc, stems))
    listed = lists.local_table(spark, term=["citi", "time", "cite", "xi", "vivid"], df=[1, 2, 3, 4, 5])
    want = terms.term_frequency(docs, listed, row_per_doc)
    assert same(want, terms.term_frequency(docs, listed, row_per_doc, stems))
    assert same(want, terms.term_frequency(docs, listed, row_per_doc, terms.listed_stems(docs, listed)))
    assert same(terms.tf_idf(docs, listed, 9, row_per_doc), terms.tf_idf(docs, listed, 9, row_per_doc, stems))


# -- very long lines ------------------------------------------------------------

@pytest.mark.parametrize("size", [1, 7, 60, 5000])
def test_chunks_of_a_line_change_no_pair(spark, size):
    rng = random.Random(size)
    texts = [" ".join(rng.choices(["b", "City", "time", "filler", "x1y", "É", "age-old", "zzzzzzzzzzzzzzzz", "\n"], k=k))
             for k in (0, 1, 3, 400, 400, 90)] + [None, "", "bbbbbb" * 40]
    docs = spark.createDataFrame([(t,) for t in texts + texts[3:4]], "line string")
    top = lists.local_table(spark, word=["b", "city", "time", "age", "x", "y"])
    for distance in (1, 3):
        want = cooc.cooc_pairs(docs, top, distance)
        got = cooc.cooc_pairs_in_chunks(docs, top, distance, size=size)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_one_line_is_worked_on_by_many_tasks(spark):
    line = spark.createDataFrame([("city time " * 50_000,)], "line string")
    chunks = cooc.line_chunks(line, 1000)
    assert chunks.select(F.spark_partition_id()).distinct().count() == 8
    pairs = cooc.cooc_pairs_in_chunks(line, lists.local_table(spark, word=["city", "time"]), 1, size=1000)
    assert dict(((r.w1, r.w2), r.n) for r in pairs.collect()) == {("city", "time"): 99_999, ("time", "city"): 99_999}
    assert "Window" not in pairs._jdf.queryExecution().executedPlan().toString()
