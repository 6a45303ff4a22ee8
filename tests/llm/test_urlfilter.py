"""URL verdicts against a plain tree walk."""

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerlake.llm.urlfilter import judge_urls

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
WEIGHT, Z = 10.0, 1.96


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [(len(r), r, v) for v, r in RULES for d, _, s in [r.partition("/")]
            if (host == d or host.endswith("." + d)) and path.startswith("/" + s)]
    return max(fits)[1:] if fits else (None, None)


def shape_of(path, depth):
    raw = path[1:].split("/") if path else []
    return tuple("*" if len(s) > 64 else re.sub("[0-9]+", "#", s) for s in raw[:depth]) + (("**",) if len(raw) > depth else ())


def brute(rows, branches, depth, threshold=0.5):
    """{row number: (host, path, rule, template, purity, verdict)} by a walk down the tree of every page."""
    pages = [(*parts(u), g) for u, g in rows]
    pages = [(h, p, shape_of(p, depth), g) for h, p, g in pages]

    def counts(some):
        marked = [g for *_, g in some if g is not None]
        return sum(marked), len(marked)

    def smooth(some, parent):
        good, n = counts(some)
        return (good + WEIGHT * parent) / (n + WEIGHT)

    out = {}

    def walk(host, template, purity, members, level):
        """``members``: (row number, page)."""
        for i, m in members:
            if len(m[2]) == level:
                out[i] = (template, purity)
        kids = defaultdict(list)
        for i, m in members:
            if len(m[2]) > level:
                kids[m[2][level]].append((i, m))
        if len(kids) > branches:
            groups = [("*", [x for k in kids.values() for x in k])]
        else:
            order = []
            for name, own in kids.items():
                good, n = counts([m for _, m in own])
                order.append(((0, good / n) if n else (1, 0), name, good, n, own))
            order.sort(key=lambda o: o[:2])
            runs = []
            for k, o in enumerate(order):
                cut = False
                if k and o[3] and order[k - 1][3]:
                    g, n, g0, n0 = o[2], o[3], order[k - 1][2], order[k - 1][3]
                    p = (g + g0) / (n + n0)
                    cut = (g / n - g0 / n0) ** 2 > Z * Z * p * (1 - p) * (1 / n + 1 / n0)
                if cut or not runs:
                    runs.append([])
                runs[-1].append(o)
            groups = [("|".join(sorted(o[1] for o in r)), [x for o in r for x in o[4]]) for r in runs]
        for label, own in groups:
            walk(host, f"{template}/{label}", smooth([m for _, m in own], purity), own, level + 1)

    prior = smooth(pages, 0.5)
    hosts = defaultdict(list)
    for i, m in enumerate(pages):
        hosts[m[0]].append((i, m))
    for host, members in hosts.items():
        walk(host, "", smooth([m for _, m in members], prior), members, 0)
    result = {}
    for i, (host, path, _, _) in enumerate(pages):
        rule, verdict = rule_of(host, path)
        template, purity = out[i]
        result[i] = (host, path, rule, template, round(purity, 9), verdict or ("block" if purity < threshold else "allow"))
    return result


def judged(spark, rows, **options):
    df = (spark.createDataFrame([(i, u, g) for i, (u, g) in enumerate(rows)], "page_id long, url string, good int").repartition(3)
          .withColumn("shape", F.lit(1)).withColumn("verdict", F.lit("clash")).withColumn("template", F.lit(2)))
    found = judge_urls(df, RULES, "good", **options)
    assert found.columns == ["page_id", "url", "good", "shape", "host", "path", "rule", "template", "purity", "verdict"]
    return {r.page_id: (r.host, r.path, r.rule, r.template, round(r.purity, 9), r.verdict) for r in found.collect()}


def random_pages(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        host = rng.choice(["hot.example.com"] * 5 + ["A.example.org", "spam.example.com", "x.example.net", "example.net", "notexample.net"])
        where = rng.choice(["en", "de", "fr", "bets", "tag"])
        leaf = rng.choice([str(rng.randint(1, 999)), f"w{rng.choice('abcdefgh')}", "", "x" * 70, "p/q/r/s/t"])
        bad = 0.9 if where == "bets" or host.startswith("spam") else 0.1
        label = None if rng.random() < 0.5 else int(rng.random() > bad)
        rows.append((f"https://{host}/{where}/{leaf}{rng.choice(['', '?a=/b', '#c', '.html'])}", label))
    return rows


def test_against_a_tree_walk(spark):
    rows = random_pages(900, 1)
    rows += [(None, 1), ("", 0), ("no scheme", None), ("http://", None), ("http://example.net", 0), ("http://net/", 1), ("http://x.net?q", None),
             ("http://a/" + "9" * 5000 + "/" + "z" * 5000, None), ("http://a/" + "s/" * 3000, 0), ("http://É.Example.NET/EN/", 1)]
    rows += [rows[0]] * 3
    for options in ({"branches": 4, "depth": 3}, {"branches": 16, "depth": 8}):
        want = brute(rows, **options)
        assert judged(spark, rows, **options) == want
        assert {v[5] for v in want.values() if v[2] is None} == {"allow", "block"}


def test_rules(spark):
    rows = [(u, None) for u in ("http://example.net/en/1", "http://m.example.net/EN/1", "http://example.net/en", "http://badexample.com/de/",
                                "ftp://a.b.example.com/de/x?y", "http://example.org/fr/", "http://example.org/frx", "x://net", "x://net/")]
    got = judged(spark, rows)
    assert [(got[i][2], got[i][5]) for i in range(len(rows))] == [
        ("example.net/en/", "allow"), ("net/", "block"), ("net/", "block"), (None, "allow"), ("example.com/de/", "block"),
        ("org/fr/", "allow"), (None, "allow"), (None, "allow"), ("net/", "block")]


def test_empty_table_and_no_labels(spark):
    assert judged(spark, []) == {}
    assert judged(spark, [("http://a/b", None)])[0] == ("a", "/b", None, "/b", 0.5, "allow")
