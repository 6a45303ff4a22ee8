"""Decontamination against a plain scan."""

import random
import re

from pyspark.sql import functions as F

from ledgerlake.llm.decontam import contamination, keep_clean, proximity_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, size=13):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(size, len(w))
        if n:
            for s in range(len(w) - n + 1):
                windows.setdefault((n, *w[s : s + n]), set()).add(i)
    sizes = {k[0] for k in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (key := (n, *w[s : s + n])) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[key]
        out.append((d, len(w), len(hit), len(found), ",".join(sorted(str(f) for f in found if f is not None)),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def tables():
    rng = random.Random(8)
    vocabulary = ["the", "of", "Éa", "éa", "AB", "ab", "x9", "naïve", "日本", "end", "a", "be"] + [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(1, 45))) for i in range(25)]
    items += [(30, "the the the the"), (31, ""), (32, None), (33, "... !!"), (5, "repeated id, other words"), (None, text(15)), (34, items[0][1])]
    docs = []
    for i in range(60):
        parts = [text(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randrange(0, 5)
            parts += [", ".join(w[a : a + rng.randrange(5, 40)]).upper(), text(rng.randrange(0, 20))]
        docs.append((i, "\n".join(parts)))
    docs += [(100, None), (101, ""), (102, "?!"), (None, items[2][1]), (3, items[3][1]), (3, items[3][1]), (103, "the " * 500),
             (104, "x " * 1000 + items[4][1])]
    return docs, items


def frames(spark):
    docs, items = tables()
    d = (spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("word", F.lit("clash"))
         .withColumn("doc", F.lit(1)).withColumn("pos", F.lit(1)).withColumn("contaminated", F.lit("clash")))
    b = spark.createDataFrame(items, "item_id long, text string").repartition(2).withColumn("k", F.lit("clash")).withColumn("item", F.lit(1))
    return docs, items, d, b


def collected(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in df.collect()), key=repr)


def test_against_plain_scan(spark):
    docs, items, d, b = frames(spark)
    want = plain(docs, items)
    assert any(r[5] for r in want) and not all(r[5] for r in want)
    assert collected(contamination(d, b)) == want
    assert collected(contamination(d, b, size=5, depth=1)) == plain(docs, items, 5)


def test_keep_clean(spark):
    docs, items, d, b = frames(spark)
    kept = keep_clean(d, b)
    bad = {r[0] for r in plain(docs, items) if r[5]}
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in bad)


def test_empty_tables(spark):
    docs, items, d, b = frames(spark)
    assert contamination(d.limit(0), b).count() == 0
    none = collected(contamination(d, b.limit(0)))
    assert len(none) == len(docs) and all(r[2:] == (0, 0, "", False) for r in none)


def test_proximity(spark):
    b = spark.createDataFrame([(1, "alpha beta gamma"), (2, "the the rare")], "item_id long, text string")
    d = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "alpha beta gamma"), (3, "gamma beta alpha q q q q"), (4, "the rare the"),
                               (5, "alpha z z z z z beta gamma"), (6, None)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in proximity_matches(d, b, slop=2).collect()}
    assert (1, 1) in got and (2, 1) in got and (5, 1) not in got and (3, 1) not in got
    assert {i for i, _ in proximity_matches(d, b, slop=0, terms=3).collect()} == {2}


def test_plan_has_no_python(spark):
    _, _, d, b = frames(spark)
    plan = contamination(d, b)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("PythonUDF", "MapInArrow", "MapInPandas"))


def test_letters_that_only_lower_to_ascii(spark):
    """The Kelvin and Angstrom signs are no k and no a-ring: one row per document, no false items."""
    docs = [(1, "zz 300k"), (2, "k alpha beta"), (3, "300\u212a and more"), (4, "\u212b x"), (5, "\u212A alpha beta"), (6, "K ALPHA")]
    items = [(1, "300\u212a"), (2, "\u212a alpha beta"), (3, "k alpha"), (4, "\u00e5 x"), (5, "\u212b x")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in contamination(d, i).collect())
    assert got == plain(docs, items)


def test_words_beyond_the_broadcast_bound(spark, monkeypatch):
    from ledgerlake.llm import decontam

    docs, items = tables()
    docs.append((900, "\u65e5" * 5000 + " the"))
    items = [*items, (900, "\u65e5" * 5000)]
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 2000)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in contamination(d, i).collect()), key=repr)
    assert got == plain(docs, items)
