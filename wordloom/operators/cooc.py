"""Co-occurrence of top words within a distance, as pairs and as stripes.

The distance counts positions in the sequence of *top words* of a line, not raw
token positions. Only the words that follow are looked at; as the window is
symmetric, ``n(a, b) = n(b, a)`` is the number of times the two stand within the
distance in either order, and ``n(a, a)`` is twice the number for the word itself.
So unordered pairs are counted once and mirrored after the count: one exchange,
at most ``|top|^2 / 2`` partial rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.maps import build_stripe, parsed_stripe
from wordloom.functions.text import once, raw_tokens
from wordloom.operators.lines import Counters
from wordloom.sources.lists import small_words

# The id of an input row that the long way gives it; no key of the caller's is needed.
ROW = "_row"
# Counters of a job: top words in the text, and pairs of them in both directions.
KEPT, RECORDS = "kept words", "pair records"


def top_word_lines(lines: DataFrame, top: DataFrame, min_len: int = 1) -> DataFrame:
    """Lines that have top words, with their ``seq`` of them.

    Words of a long list are joined, and each row's put back in order by a row id.
    """
    return _sequences(lines, top, min_len).where(F.size("seq") > 0)


def _sequences(lines: DataFrame, top: DataFrame, min_len: int) -> DataFrame:
    """``seq`` of the lines; with a long list those without a top word are left out."""
    keep = [c for c in lines.columns if c != "line"]
    chosen = small_words(_listed(top, min_len))
    if chosen is not None:
        return _with_seq(lines, chosen)
    found = F.sort_array(F.collect_list(F.struct("pos", "word")))
    rows = top_word_positions(lines, top, min_len, tuple(keep)).groupBy(ROW, *keep).agg(found.alias("found"))
    return rows.select(*keep, F.col("found.word").alias("seq"))


def _listed(top: DataFrame, min_len: int) -> DataFrame:
    return top.select("word").where(F.length("word") >= min_len)


def _with_seq(lines: DataFrame, chosen: list[str]) -> DataFrame:
    keep = [c for c in lines.columns if c != "line"]
    kept = F.filter(raw_tokens(F.col("line")), lambda t: t.isin(chosen))
    return lines.select(*keep, once(kept).alias("seq"))


def top_word_positions(lines: DataFrame, top: DataFrame, min_len: int = 1,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """``(_row, keep…, pos, word)`` of every top word, for lists of any length.

    A line is taken apart in one pass over its tokens. The join may split a word that very
    many lines have.
    """
    rows = lines.select(F.monotonically_increasing_id().alias(ROW), *keep,
                        once(raw_tokens(F.col("line"))).alias("tokens"))
    words = rows.select(ROW, *keep, F.posexplode("tokens").alias("pos", "word")).where("word <> ''")
    listed = words.join(_listed(top, min_len).distinct(), "word", "left_semi")
    return listed.select(ROW, *keep, "pos", "word")


def following(lines: DataFrame, top: DataFrame, distance: int, min_len: int = 1,
              counters: Counters | None = None) -> DataFrame:
    """``(w1, w2, gap)``: each top word with each one up to ``distance`` behind it.

    A word with nothing behind it gives one row with null ``w2`` and ``gap``.
    A list of up to 1,000 words is matched inside the row that holds the line, so
    nothing is shuffled. A longer one is joined, and each row put back in order by
    an id of its own; the results are the same. ``counters`` gets the kept words.
    """
    at = _sequences(lines.select("line"), top, min_len).select("seq", F.posexplode("seq").alias("i", "w1"))
    at = counters.rows(at, KEPT) if counters else at
    behind = F.slice("seq", F.col("i") + 2, distance)
    return at.select("w1", F.posexplode_outer(behind).alias("at", "w2")).select(
        "w1", "w2", (F.col("at") + 1).alias("gap"))


def _following_by_window(positions: DataFrame, distance: int) -> DataFrame:
    in_line, steps = Window.partitionBy(ROW).orderBy("pos"), range(1, distance + 1)
    ahead = positions.select(F.col("word").alias("w1"),
                             *[F.lead("word", k).over(in_line).alias(f"b{k}") for k in steps])
    behind = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"b{k}").alias("w2")) for k in steps])
    # A word with nothing behind it keeps its first, empty place.
    found = ahead.select("w1", F.inline(behind)).where("w2 is not null or k = 1")
    return found.select("w1", "w2", F.when(F.col("w2").isNotNull(), F.col("k")).alias("gap"))


# Longer lines are cut, so that many tasks can work on one.
CHUNK = 1 << 16


def line_chunks(lines: DataFrame, size: int = CHUNK) -> DataFrame:
    """``(_row, chunk, line)``: lines cut behind a word after ``size`` characters, lower-cased.

    The chunks are dealt out over the tasks. Together they have the words of the line, in
    order; only a line without a letter may have no chunk.
    """
    pieces = F.regexp_extract_all(F.lower("line"), F.lit(f"(?s).{{1,{size}}}[a-z]*+"), F.lit(0))
    # Ids first: next to the explode they would count its rows.
    rows = lines.select(F.monotonically_increasing_id().alias(ROW), "line")
    chunks = rows.select(ROW, F.posexplode(pieces).alias("chunk", "line"))
    # A fixed number of tasks: chunks are work, however few bytes they have.
    return chunks.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), ROW, "chunk")


def following_in_chunks(lines: DataFrame, top: DataFrame, distance: int, min_len: int = 1,
                        size: int = CHUNK) -> DataFrame:
    """As :func:`following`, for lines of any length.

    A line above ``size`` characters is cut into chunks. Each takes along a halo, the first
    ``distance`` top words behind it, put together from the first few of the chunks that
    follow. Only those first words of a line ever meet in one place, never its text.
    """
    short = lines.where(F.length("line") <= size)
    # The long way of the list gives rows ids of its own.
    chunks = line_chunks(lines.where(F.length("line") > size).select("line"), size).withColumnRenamed(ROW, "line_row")
    seqs = top_word_lines(chunks, top, min_len)
    # Chunks without top words are gone, so the next ``distance`` chunks have enough.
    heads = seqs.groupBy(F.col("line_row").alias(ROW)).agg(F.sort_array(F.collect_list(
        F.struct("chunk", F.slice("seq", 1, distance).alias("head")))).alias("heads"))
    halos = heads.select(F.col(ROW).alias("of_row"), "heads", F.posexplode("heads").alias("i", "at")).select(
        "of_row", F.col("at.chunk").alias("of_chunk"),
        F.slice(F.flatten(F.slice(F.col("heads.head"), F.col("i") + 2, distance)), 1, distance).alias("halo"))
    own = seqs.join(halos, (F.col("line_row") == F.col("of_row")) & (F.col("chunk") == F.col("of_chunk"))).select(
        F.posexplode("seq").alias("i", "w1"), F.concat("seq", "halo").alias("words"))
    behind = F.slice("words", F.col("i") + 2, distance)
    far = own.select("w1", F.posexplode_outer(behind).alias("at", "w2")).select(
        "w1", "w2", (F.col("at") + 1).alias("gap"))
    return following(short, top, distance, min_len).unionByName(far)


def _mirrored(counts: list[str]) -> Column:
    """Both directions of an unordered pair ``(a, b)``; a pair ``(a, a)`` counts twice."""
    def side(w1: str, w2: str, times: int) -> Column:
        return F.struct(F.col(w1).alias("w1"), F.col(w2).alias("w2"),
                        *[(F.col(c) * times).alias(c) for c in counts])

    return F.when(F.col("a").eqNullSafe(F.col("b")), F.array(side("a", "b", 2))).when(
        F.col("b").isNull(), F.array(side("a", "b", 1))).otherwise(
        F.array(side("a", "b", 1), side("b", "a", 1)))


def _unordered(pairs: DataFrame) -> DataFrame:
    # least/greatest skip nulls, so a word without a follower keeps its null.
    a = F.least("w1", "w2").alias("a")
    b = F.when(F.col("w2").isNotNull(), F.greatest("w1", "w2")).alias("b")
    return pairs.select(a, b, "gap")


def cooc_pairs(lines: DataFrame, top: DataFrame, distance: int = 1, min_len: int = 1,
               counters: Counters | None = None) -> DataFrame:
    """``(w1, w2, n)``."""
    pairs = following(lines, top, distance, min_len, counters).where("w2 is not null")
    return pair_counts(counters.rows(pairs, RECORDS, 2 * F.count(F.lit(1))) if counters else pairs)


def cooc_pairs_in_chunks(lines: DataFrame, top: DataFrame, distance: int = 1, min_len: int = 1,
                         size: int = CHUNK) -> DataFrame:
    """As :func:`cooc_pairs`; a line may be as long as it likes."""
    return pair_counts(following_in_chunks(lines, top, distance, min_len, size).where("w2 is not null"))


def cooc_pairs_by_window(lines: DataFrame, top: DataFrame, distance: int = 1,
                         min_len: int = 1) -> DataFrame:
    """As :func:`cooc_pairs`, for lists of any length, by window functions over a line's top words."""
    positions = top_word_positions(lines, top, min_len)
    return pair_counts(_following_by_window(positions, distance).where("w2 is not null"))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``(w1, w2, n)`` in both directions from one-directional pair rows."""
    counts = _unordered(pairs).groupBy("a", "b").agg(F.count("*").alias("n"))
    return counts.select(F.inline(_mirrored(["n"])))


def cooc_stripes(lines: DataFrame, top: DataFrame, distance: int = 1, min_len: int = 2,
                 keep_empty: bool = False, counters: Counters | None = None) -> DataFrame:
    """``(word, stripe)``: per word a map from neighbour to count.

    ``keep_empty`` also gives words that were seen but never had a neighbour; they
    come from the same pass, as the words with nothing behind them.
    """
    pairs = following(lines, top, distance, min_len, counters)
    pairs = counters.rows(pairs, RECORDS, 2 * F.count("w2")) if counters else pairs
    if not keep_empty:
        pairs = pairs.where("w2 is not null")
    return stripes_from_pairs(pair_counts(pairs))


def stripes_from_pairs(pairs: DataFrame) -> DataFrame:
    """``(word, stripe)`` from pair counts; rows with null ``w2`` only name the word."""
    stripe = build_stripe(F.col("w2"), F.col("n")).alias("stripe")
    return pairs.groupBy(F.col("w1").alias("word")).agg(stripe)


def pairs_from_stripes(stripes: DataFrame) -> DataFrame:
    return stripes.select(F.col("word").alias("w1"), F.explode("stripe").alias("w2", "n"))


def parse_stripes(source: DataFrame, line: str = "value") -> DataFrame:
    """``(word, stripe)`` from written ``word<TAB>{k=v, …}`` lines; other lines are dropped."""
    fields = source.select(F.split(line, "\t").alias("p")).where(F.size("p") == 2)
    return fields.select(F.col("p")[0].alias("word"), parsed_stripe(F.col("p")[1]).alias("stripe")).where(
        "stripe is not null")


def add_to_stripes(earlier: DataFrame, batch: DataFrame) -> DataFrame:
    """The stripes of an earlier run with those of a new batch added, cell by cell.

    Words that have no neighbour in either keep an empty stripe.
    """
    both = earlier.select("word", "stripe").unionByName(batch.select("word", "stripe"))
    cells = both.select(F.col("word").alias("w1"), F.explode_outer("stripe").alias("w2", "n"))
    return stripes_from_pairs(cells.groupBy("w1", "w2").agg(F.sum("n").alias("n")))


def merge_stripes(stripes: DataFrame) -> DataFrame:
    """Element-wise sum of all stripes of a word, in two aggregations.

    The cells are summed first, map-side included, so a word with very many
    stripes is never gathered in one place.
    """
    cells = pairs_from_stripes(stripes).groupBy("w1", "w2").agg(F.sum("n").alias("n"))
    return stripes_from_pairs(cells)


def cooc_sweep(lines: DataFrame, top: DataFrame, max_distance: int = 4,
               min_len: int = 1) -> DataFrame:
    """``(d, w1, w2, n)`` for every distance 1..max in one pass over the text."""
    steps = range(1, max_distance + 1)
    pairs = following(lines, top, max_distance, min_len).where("w2 is not null")
    counts = _unordered(pairs).groupBy("a", "b").agg(
        *[F.count_if(F.col("gap") <= d).alias(f"n{d}") for d in steps])
    both = counts.select(F.inline(_mirrored([f"n{d}" for d in steps])))
    rows = F.array(*[F.struct(F.lit(d).alias("d"), F.col(f"n{d}").alias("n")) for d in steps])
    swept = both.select("w1", "w2", F.inline(rows))
    return swept.where("n > 0").select("d", "w1", "w2", "n")


def compare_layouts(pairs: DataFrame, stripes: DataFrame) -> DataFrame:
    """One row: how many cells the pairs have, and how many only one layout has."""
    cells = pairs.select("w1", "w2", "n", F.lit(1).alias("side")).unionByName(
        pairs_from_stripes(stripes).withColumn("side", F.lit(-1)))
    net = cells.groupBy("w1", "w2", "n").agg(
        F.sum("side").alias("net"), F.count_if(F.col("side") == 1).alias("cells"))
    return net.agg(
        F.coalesce(F.sum("cells"), F.lit(0)).alias("n_pairs"),
        F.count_if(F.col("net") > 0).alias("only_pairs"),
        F.count_if(F.col("net") < 0).alias("only_stripes"),
    )
