"""URL filters by a path-template tree. [operator 8]

Known rules judge the URLs that they fit, and serve as labels for the rest. Per
host the paths form a tree of segments. A segment that looks like an identifier or that
occurs once in its node is generalised into a wildcard. So are the rare segments of a
node where most of them have labels and these agree; others stay literal, however many
they are, and are not judged by their neighbours. Sibling templates of one shape whose
labelled shares do not differ significantly are merged. A template is rejected when it
has labels of at least the prior's weight, and their share of good ones, smoothed
towards a half, falls below ``least_purity``.

Only built-in expressions. The tree works on counts per (host, path prefix), never
on the URLs of a host in one task; the rows that a window compares are the different
label counts of the siblings of one shape, not the siblings.

Cases: a null URL, or one without ``://``, has an empty host and path and no rule;
so has its template, which has no labels and is allowed. Repeated URLs count as
often as they occur. An empty table gives an empty result. Only the id and the URL
are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.common import join_keyed, let, saved

ALLOW, BLOCK = "allow", "block"
# The rules of the contract: (verdict, host, path).
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)
MAX_RULES = 10_000
# Below here a branch goes on only where it has several shapes and enough URLs to tell
# them apart; there its whole paths take part however deep they are.
DEPTH = 6
# The labels of rare segments agree when the commoner one's share is surely above this.
AGREED = 0.6
Z = 1.96
IDENTIFIER = "^(?=.*[0-9])[0-9A-Fa-f_-]+(\\.[a-z0-9]{1,5})?$|^[0-9A-Fa-f-]{16,}$|^.{65,}$"
# What the wildcard is called; a segment of a real path never holds a slash.
WILD = "*"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path without query and fragment."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits as ``struct(size, rule, verdict)``, else null.

    A rule fits its host and all subdomains of it where the path starts with its own.
    The rules are looked up by every suffix of the host, so their number does not
    matter to a URL; the list travels in the plan and its size is checked. Of equally
    long rules the last in code point order counts.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    by_host: dict[str, list[Column]] = {}
    for verdict, rule_host, rule_path in rules:
        rule = rule_host + rule_path
        by_host.setdefault(rule_host, []).append(F.struct(
            F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"),
            F.lit(verdict).alias("verdict"), F.lit(rule_path).alias("path")))
    if not by_host:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string,path:string>")
    table = F.create_map(*[x for h, r in by_host.items() for x in (F.lit(h), F.array(*r))])
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    fits = F.flatten(F.transform(F.array_intersect(suffixes, F.array(*map(F.lit, by_host))),
                                 lambda h: F.element_at(table, h)))
    return F.array_max(F.filter(fits, lambda r: F.startswith(path, r["path"])))


def segments(path: Column) -> Column:
    """The segments below the root."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    return F.when(path == "", F.array().cast("array<string>")).otherwise(parts)


def plain_segments(path: Column) -> Column:
    """The segments of a path with what looks like an identifier generalised at once."""
    return F.transform(segments(path), lambda x: F.when(x.rlike(IDENTIFIER), WILD).otherwise(x))


def surely(part: Column, whole: Column, z: float = Z) -> Column:
    """Lower end of the Wilson interval of ``part / whole``; null where ``whole`` is 0."""
    whole, z2 = F.nullif(whole, F.lit(0)), z * z
    share = part / whole
    spread = z * F.sqrt(share * (1 - share) / whole + z2 / (4 * whole * whole))
    return (share + z2 / (2 * whole) - spread) / (1 + z2 / whole)


def templates(shapes: DataFrame, least_count: int = 5, agreed: float = AGREED) -> DataFrame:
    """``shapes(host, segs, n, bad, …)`` with their ``template``.

    Level by level: a segment stays literal if it occurs ``least_count`` times in its
    node. One that occurs less often, but more than once, stays so too, unless at least
    half of these in its node have labels and the share of those with the commoner label
    is surely above ``agreed``: six that are all alike are enough. Identifiers have gone before, so the rows are the different shapes of paths; each
    level is one job over those that are as deep. Below ``DEPTH`` a node of one shape or
    of less than ``least_count`` URLs ends in one wildcard.
    """
    keep = shapes.columns
    rows = shapes.withColumn("template", F.lit(""))
    done = []
    for level in count():
        rows = saved(rows.withColumn("seg", F.get("segs", F.lit(level))))
        done.append(rows.where("seg is null").select(*keep, "template"))
        deeper = rows.where("seg is not null")
        if level >= DEPTH:
            ends = deeper.groupBy("host", "template").agg(
                ((F.sum("n") < least_count) | (F.min("segs") == F.max("segs"))).alias("ends"))
            deeper = saved(deeper.join(ends, ["host", "template"]))
            done.append(deeper.where("ends").select(*keep, F.concat_ws("/", "template", F.lit(WILD)).alias("template")))
            deeper = deeper.where("not ends").drop("ends")
        if deeper.isEmpty():
            break
        counts = deeper.groupBy("host", "template", "seg").agg(
            F.sum("n").alias("n_seg"), F.coalesce(F.sum(F.col("n") * (2 * F.col("bad") - 1)), F.lit(0)).alias("more_bad"),
            F.count("bad").alias("labels"))
        few = (F.col("n_seg") > 1) & (F.col("n_seg") < least_count)
        known = few & (F.col("labels") > 0)
        n_few, n_known, n_bad = F.count_if(few), F.count_if(known), F.count_if(known & (F.col("more_bad") > 0))
        alike = surely(F.greatest(n_bad, n_known - n_bad), n_known) > agreed
        nodes = counts.groupBy("host", "template").agg(
            F.coalesce((2 * n_known >= n_few) & alike, F.lit(False)).alias("alike"))
        rare = (F.col("n_seg") == 1) | few & F.col("alike")
        named = counts.join(nodes, ["host", "template"]).select(
            "host", "template", "seg", F.when(rare & (F.col("seg") != ""), WILD).otherwise(F.col("seg")).alias("step"))
        rows = deeper.join(named, ["host", "template", "seg"]).withColumn(
            "template", F.concat_ws("/", "template", "step")).select(*keep, "template")
    return reduce(DataFrame.unionByName, done)


def template_labels(urls: DataFrame, z: float = Z) -> DataFrame:
    """``(host, template, group, n_urls, n_good, n_bad)`` of ``urls(host, template, n, bad)``.

    The shape of a template has a mark for its last literal segment. Labelled siblings
    of one shape stand in order of their bad share; a new group begins where it differs
    from the one before by a two-proportion test. Siblings without labels are alone.
    """
    nodes = urls.groupBy("host", "template").agg(
        F.sum("n").alias("n_urls"), F.sum(F.when(F.col("bad") == 0, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(0)).alias("bad"))
    shape = F.regexp_replace("template", "/[^/*][^/]*((?:/\\*|/)*)$", "/?$1")
    nodes = nodes.withColumn("shape", shape).withColumn("labelled", F.col("good") + F.col("bad"))
    rate = F.col("bad") / F.col("labelled")
    # Siblings of equal counts are in one group, so they stand in the order as one row.
    known = nodes.where("labelled > 0")
    alike = known.groupBy("host", "shape", "labelled", "bad").agg(
        F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"), F.min("template").alias("first"))
    order = Window.partitionBy("host", "shape").orderBy("rate", "first")
    alike = alike.withColumn("rate", rate)
    n0, b0 = F.lag("labelled").over(order), F.lag("bad").over(order)
    pooled = (b0 + F.col("bad")) / (n0 + F.col("labelled"))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n0 + 1 / F.col("labelled")))
    differs = F.coalesce(F.abs(F.col("rate") - b0 / n0) > z * spread, F.lit(True))
    alike = alike.withColumn("new", differs.cast("int")).withColumn(
        "group", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = Window.partitionBy("host", "shape", "group")
    groups = alike.select("host", "shape", "labelled", F.col("bad").alias("own_bad"), "group",
                          F.sum("all_good").over(whole).alias("good"), F.sum("all_bad").over(whole).alias("bad"))
    merged = known.select("host", "template", "n_urls", "shape", "labelled", F.col("bad").alias("own_bad")).join(
        groups, ["host", "shape", "labelled", "own_bad"]).select(
        "host", "template", "n_urls", "shape", "group", "good", "bad")
    alone = nodes.where("labelled = 0").select("host", "template", "n_urls", "shape",
                                               F.lit(0).cast("long").alias("group"), "good", "bad")
    return merged.unionByName(alone)


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES,
          least_purity: float = 0.4, strength: float = 4.0,
          prior: float = 0.5) -> DataFrame:
    """One row per row of ``pages``: ``(page_id, host, path, rule, verdict, template, purity)``.

    The verdict is that of the longest rule, else that of the URL's template, whose
    ``purity`` is the smoothed share of its allowed URLs. ``strength`` is the weight
    of ``prior`` in labelled URLs; a template with fewer labels than that stays.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    fit = matching_rule(F.col("host"), F.col("path"), rules)
    rows = saved(rows.withColumn("fit", let(fit, lambda r: r)).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled")))
    bad = F.when(F.col("ruled") == BLOCK, 1).when(F.col("ruled") == ALLOW, 0)
    # One row per different shape of a path and label; the label is that of the rule.
    shape = plain_segments(F.col("path"))
    shapes = saved(rows.groupBy("host", shape.alias("segs"), bad.alias("bad")).agg(F.count("*").alias("n")))
    built = saved(templates(shapes))
    purity = (F.col("good") + strength * prior) / (F.col("good") + F.col("bad") + strength)
    bad_one = (purity < least_purity) & (F.col("good") + F.col("bad") >= strength)
    labels = template_labels(built).select("host", "template", purity.alias("purity"), bad_one.alias("rejected"))
    scored = saved(built.groupBy("host", "segs").agg(F.sum("n").alias("n"), F.first("template").alias("template")).join(
        labels, ["host", "template"]).select("host", "segs", "n", "template", "purity", "rejected"))
    judged = join_keyed(rows.withColumn("segs", shape), scored, ["host", "segs"], "n")
    own = F.when(F.col("rejected"), BLOCK).otherwise(ALLOW)
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", own).alias("verdict"), "template", "purity")
