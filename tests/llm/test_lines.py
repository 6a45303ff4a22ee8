"""Line dedup against a brute-force version."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm.linededup import dedup_lines


def brute(rows, min_lines, min_chars):
    """{(doc_id, text): [(kept text, n_lines, n_removed, n_runs), ...]} in input order of equal ids."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    lines = {i: (rows[i][1] or "").split("\n") for i in order}
    seen, out = set(), []
    drop = {i: set() for i in order}
    for i in order:
        for p in range(len(lines[i])):
            for w in (1, min_lines):
                run = tuple(lines[i][p : p + w])
                if len(run) < w or w == 1 and len(run[0]) < min_chars:
                    continue
                if (w, run) in seen:
                    drop[i].update(range(p, p + w))
                seen.add((w, run))
    for i in order:
        kept = [x for p, x in enumerate(lines[i]) if p not in drop[i]]
        runs = sum(1 for p in drop[i] if p - 1 not in drop[i])
        text = rows[i][1] if not drop[i] else "\n".join(kept)
        out.append((rows[i][0], text, len(lines[i]), len(drop[i]), runs))
    return sorted(out, key=repr)


def rows_of(df, names):
    return sorted(((r.doc_id, r.text, r[names[0]], r[names[1]], r[names[2]]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("min_lines", [2, 3, 4, 5, 7])
def test_against_brute_force(spark, min_lines):
    rng = random.Random(5)
    alphabet = ["a", "b", "cc", "", "a much longer line of words", "é longer line with accents"]
    rows = [(i, "\n".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 14)))) for i in range(40)]
    rows += [(3, rows[3][1]), (None, "a\nb\na\nb\na\nb"), (50, None), (51, "x\n" * 300), (52, "")]
    rows += [(60 + i, "\n".join(f"line number {k} of a copied document" for k in range(9))) for i in range(20)]
    df = (spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).withColumn("doc", F.lit("clash"))
          .withColumn("n_lines", F.lit("clash")).withColumn("cut", F.lit(1)))
    out, names = dedup_lines(df, min_lines, 20)
    assert out.columns[:5] == df.columns and names[0] == "n_lines_"
    assert rows_of(out, names) == brute(rows, min_lines, 20)


def test_runs_inside_one_text_keep_their_first_copy(spark):
    df = spark.createDataFrame([(1, "a\na\na\na\na\na\na\nb")], "doc_id long, text string")
    out, names = dedup_lines(df, 4, 20)
    assert rows_of(out, names) == [(1, "a\nb", 8, 6, 1)]


def test_empty_table_and_bad_parameters(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_lines(df)[0].count() == 0
    with pytest.raises(ValueError):
        dedup_lines(df, min_lines=1)[0].count()


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    plan = dedup_lines(df)[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
