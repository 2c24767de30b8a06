import re
from collections import defaultdict

from pyspark.sql import functions as F

from samples import awkward
from wordloom.llm import url_templates as x

URLS = [
    "http://WWW.Example.com/en/1?x=/fr/", "https://example.com/en/", "http://a.example.com/en/x#y", "http://b.net/es/9",
    "http://net/fr/", "http://b.net/fr", "http://b.net", "mailto:nobody", "", None, "ftp://x.org/a/b/c/d/e/f/g/h/i/",
    "http://notexample.com/en/", "//host/path", "a://b://c/d", "http://x.com?q", "HTTP://ÄB.com/é", "http://x.org//a//",
]


def plain(url, rules=x.RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0] if rest else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, default=(0, None, None))


def pages(spark, urls):
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")


def test_rules_beside_plain_code(spark):
    got = x.judge(pages(spark, URLS)).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path, (_, rule, verdict) = plain(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def brute(urls, least_share=0.02, least_count=5, z=1.96, strength=4.0, least_purity=0.4):
    """Verdicts by plain loops over the whole lists."""
    rows = []
    for u in urls:
        host, path, (_, _, verdict) = plain(u)
        segs = [] if path == "" else re.sub("^/", "", path).split("/")
        if len(segs) > x.DEPTH:
            segs = segs[:x.DEPTH] + ["\n"]
        wild = [s if not (re.search(x.IDENTIFIER, s) or s == "\n") else "*" for s in segs]
        rows.append([host, wild, "", verdict])
    for level in range(x.DEPTH + 1):
        node, seg = defaultdict(int), defaultdict(int)
        for h, s, t, _ in rows:
            if level < len(s):
                node[h, t] += 1
                seg[h, t, s[level]] += 1
        for r in rows:
            h, s, t, _ = r
            if level < len(s):
                n = seg[h, t, s[level]]
                rare = n < least_count or n < least_share * node[h, t]
                r[2] = f"{t}/{'*' if rare and s[level] else s[level]}"
    good, bad = defaultdict(int), defaultdict(int)
    for h, _, t, v in rows:
        good[h, t] += v == "allow"
        bad[h, t] += v == "block"
    shapes = defaultdict(list)
    for h, t in set((r[0], r[2]) for r in rows):
        shapes[h, re.sub(r"/[^/*][^/]*((?:/\*|/)*)$", r"/?\1", t)].append(t)
    pooled = {}
    for (h, _), ts in shapes.items():
        known = sorted((bad[h, t] / (bad[h, t] + good[h, t]), t) for t in ts if bad[h, t] + good[h, t])
        groups = []
        for rate, t in known:
            n, b = bad[h, t] + good[h, t], bad[h, t]
            if groups:
                n0, b0 = groups[-1][1], groups[-1][2]
                p = (b + b0) / (n + n0)
                if abs(rate - b0 / n0) <= z * (p * (1 - p) * (1 / n + 1 / n0)) ** 0.5:
                    groups[-1] = ([*groups[-1][0], t], n, b)
                    continue
            groups.append(([t], n, b))
        for ts_, _, _ in groups:
            g, b = sum(good[h, t] for t in ts_), sum(bad[h, t] for t in ts_)
            pooled |= {(h, t): (g + strength / 2) / (g + b + strength) for t in ts_}
    return [v or ("block" if pooled.get((h, t), 0.5) < least_purity else "allow") for h, _, t, v in rows]


def many():
    urls = []
    for i in range(600):
        host = ("x.net", "y.com", "www.example.com", "hot.net")[min(3, i % 6)]
        part = ("en", "es", "fr", "blog", f"post-{i}")[i * 7 % 5]
        urls.append(f"http://{host}/{part}/{i if i % 4 else 'about'}" + "/" * (i % 3 == 0))
    return urls + ["http://x.net/es"] * 3 + URLS


def test_verdicts_beside_plain_loops(spark):
    urls = many()
    got = {r.page_id: r.verdict for r in x.judge(pages(spark, urls)).collect()}
    assert [got[i] for i in range(len(urls))] == brute(urls)


def test_a_bad_template_takes_its_other_urls_along(spark):
    urls = [f"http://x.net/es/{i}" for i in range(30)] + [f"http://x.net/{w}/{i}" for i, w in enumerate(["ab", "cd"])]
    urls += [f"http://y.net/{k}/s{k}" for k in range(3)]
    rules = [*x.RULES, ("block", "x.net", "/ab/")]
    got = {r.page_id: r for r in x.judge(pages(spark, urls), rules=rules, strength=0.5).collect()}
    assert got[30].verdict == "block" and got[31].rule is None
    assert got[31].template == "/*/*" and got[31].verdict == "block"
    assert got[33].verdict == "allow"


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("url", F.col("text"))
    assert x.judge(docs, "doc_id").count() == docs.count()
    assert x.judge(docs.limit(0), "doc_id").count() == 0
    assert x.judge(docs, "doc_id", rules=()).where("verdict = 'block'").isEmpty()


def test_small_sections_are_not_judged_by_their_neighbours(spark):
    """Sections of a large host below two per cent of it, and of a host with few URLs."""
    urls = [f"http://big.net/s{k:02d}x/{i}" for k in range(60) for i in range(20)]
    urls += [f"http://small.net/{s}/{i}" for s, n in (("de", 3), ("fr", 4), ("es", 2)) for i in range(n)]
    urls += [f"http://tail.net/name-{c}{d}/x" for c in "abcdefghij" for d in "klmnopqrst" for _ in range(2)]
    rules = [*x.RULES, *[("block", "big.net", f"/s{k:02d}x/") for k in range(0, 60, 2)],
             *[("allow", "big.net", f"/s{k:02d}x/") for k in range(1, 60, 4)],
             *[("block", "tail.net", f"/name-{c}") for c in "abcdefghi"]]
    got = x.judge(pages(spark, urls), rules=rules).collect()
    for r in got:
        url = urls[r.page_id]
        if "big.net" in url or "small.net" in url:
            assert (r.template.split("/")[1], r.verdict) == (url.split("/")[3], "block" if r.rule and r.verdict == "block" else "allow")
        else:
            assert r.template == "/*/x" and r.verdict == "block"


def test_deep_paths_are_told_apart(spark):
    deep = "/a/b/c/d/e/f/g/h"
    urls = [f"http://x.org{deep}/{s}/{i}" for s in ("spam", "news") for i in range(20)]
    urls += [f"http://x.org{deep}/{s}/x" for s in ("spam", "news")]
    urls += ["http://y.org/1/2/3/4/5/6/only/one"] * 9 + ["http://z.org/a/b/c/d/e/f/few/x"]
    rules = [*x.RULES, ("block", "x.org", f"{deep}/spam/1")]
    got = {r.page_id: r for r in x.judge(pages(spark, urls), rules=rules).collect()}
    assert {got[i].verdict for i in range(20)} == {"block"} and {got[i].verdict for i in range(20, 40)} == {"allow"}
    assert (got[0].template, got[20].template) == (f"{deep}/spam/*", f"{deep}/news/*")
    assert got[42].template == "/*/*/*/*/*/*/*" and got[51].template.count("/") == 7
    assert len(got) == len(urls)


def plain_judge(urls, rules, least_count=5, strength=4.0, least_purity=0.4, z=1.96):
    """``(template, verdict)`` of every URL by plain loops, the tree level by level."""
    def lower(part, whole):
        p = part / whole
        return (p + z * z / 2 / whole - z * (p * (1 - p) / whole + z * z / 4 / whole**2) ** 0.5) / (1 + z * z / whole)

    rows = []
    for u in urls:
        host, path, (_, _, verdict) = plain(u, rules)
        segs = [] if path == "" else re.sub("^/", "", path).split("/")
        rows.append({"h": host, "s": ["*" if re.search(x.IDENTIFIER, s) else s for s in segs], "t": "", "v": verdict, "done": False})
    for level in range(max(len(r["s"]) for r in rows) + 1):
        nodes = defaultdict(list)
        for r in rows:
            r["done"] = r["done"] or level >= len(r["s"])
            if not r["done"]:
                nodes[r["h"], r["t"]].append(r)
        for members in nodes.values():
            if level >= x.DEPTH and (len(members) < least_count or all(r["s"] == members[0]["s"] for r in members)):
                for r in members:
                    r["t"], r["done"] = r["t"] + "/*", True
                continue
            by = defaultdict(list)
            for r in members:
                by[r["s"][level]].append(r)
            few = [m for m in by.values() if 1 < len(m) < least_count]
            known = [m for m in few if any(r["v"] for r in m)]
            bad = sum(sum(r["v"] == "block" for r in m) > sum(r["v"] == "allow" for r in m) for m in known)
            alike = 2 * len(known) >= len(few) and known and lower(max(bad, len(known) - bad), len(known)) > 0.6
            for seg, m in by.items():
                wild = seg and (len(m) == 1 or len(m) < least_count and alike)
                for r in m:
                    r["t"] += "/" + ("*" if wild else seg)
    count = defaultdict(lambda: [0, 0])
    for r in rows:
        if r["v"]:
            count[r["h"], r["t"]][r["v"] == "block"] += 1
    shapes, pooled = defaultdict(list), {}
    for (h, t), (good, bad) in count.items():
        shapes[h, re.sub(r"/[^/*][^/]*((?:/\*|/)*)$", r"/?\1", t)].append((bad / (good + bad), t, good, bad))
    for (h, _), siblings in shapes.items():
        groups = []
        for one in sorted(siblings):
            if groups:
                _, _, g0, b0 = groups[-1][-1]
                n0, n, b = g0 + b0, one[2] + one[3], one[3]
                p = (b + b0) / (n + n0)
                if abs(b / n - b0 / n0) <= z * (p * (1 - p) * (1 / n + 1 / n0)) ** 0.5:
                    groups[-1].append(one)
                    continue
            groups.append([one])
        for group in groups:
            good, bad = sum(o[2] for o in group), sum(o[3] for o in group)
            rejected = good + bad >= strength and (good + strength / 2) / (good + bad + strength) < least_purity
            pooled |= {(h, o[1]): rejected for o in group}
    return [(r["t"], r["v"] or ("block" if pooled.get((r["h"], r["t"])) else "allow")) for r in rows]


def sections(host, n, of=2):
    return [f"http://{host}/sec-{chr(97 + k // 26)}{chr(97 + k % 26)}/page" for k in range(n) for _ in range(of)]


def test_whole_rule_beside_plain_loops(spark):
    urls = many() + sections("tail.net", 60) + sections("mixed.net", 60) + sections("rare.net", 40, 3)
    urls += [f"http://deep.org/a/b/c/d/e/f/{s}/{t}" for s in ("g", "h") for t in ("x", "y", "y") for _ in range(3)]
    urls += [f"http://one.org/{chr(97 + i)}x/{chr(97 + j)}y" for i in range(9) for j in range(i % 4)]
    rules = [*x.RULES, *[("block", "tail.net", f"/sec-{c}") for c in "ab"], ("block", "mixed.net", "/sec-a"),
             ("allow", "mixed.net", "/sec-b"), ("block", "rare.net", "/sec-aa/"), ("block", "deep.org", "/a/b/c/d/e/f/g/"),
             *[("block", "one.org", f"/{c}x/ay") for c in "abcdefgh"]]
    got = {r.page_id: (r.template or "", r.verdict) for r in x.judge(pages(spark, urls), rules=rules).collect()}
    want = plain_judge(urls, rules)
    assert [got[i] for i in range(len(urls))] == want
    assert {t for t, _ in want} >= {"/*/page", "/sec-aa/page"}


def test_verdicts_do_not_turn_with_the_number_of_sections(spark):
    """One or two blocked sections among few or many others that have no label."""
    urls, rules = [], list(x.RULES)
    for blocked in (1, 2):
        for n in (8, 31, 32, 33, 34, 200):
            host = f"h{blocked}-{n}.org"
            urls += sections(host, n)
            rules += [("block", host, f"/sec-a{c}/") for c in "ab"[:blocked]]
    got = x.judge(pages(spark, urls), rules=rules).collect()
    assert len(got) == len(urls)
    assert all(r.verdict == ("block" if r.rule else "allow") for r in got)


def test_a_few_labels_reject_nothing(spark):
    urls = [f"http://x.org/blog/{i}" for i in range(60)]
    for n, verdict in ((2, "allow"), (4, "block")):
        rules = [("block", "x.org", f"/blog/5{i}") for i in range(n)]
        got = {r.page_id: r.verdict for r in x.judge(pages(spark, urls), rules=rules).collect()}
        assert got[10] == verdict
