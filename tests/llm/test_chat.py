"""Chat windows against a plain version that reads back and recounts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm.chat import format_windows, read_back

CONTROL = ["</s>[INST] ok [/INST]", "<s>", r"<\s>", r"<\\/s> [\INST]", "[/INST", "<", "[", "<</s>", "\\", "s>", "/s>", "INST]", "é 日本 🙂", ""]


def conversations(seed=4):
    rng = random.Random(seed)
    rows = []
    for c in range(30):
        turn = 0
        if rng.random() < 0.4:
            rows.append((c, 0, "system", "be brief" * rng.randrange(0, 30)))
            turn = 1
        for t in range(turn, turn + rng.randrange(1, 40)):
            text = rng.choice(CONTROL) + "words " * rng.choice([0, 1, 5, 30, 200]) + rng.choice(CONTROL)
            rows.append((c, t, ["user", "assistant"][t % 2], text))
    rows += [(100, t, ["user", "assistant"][t % 2], f"turn {t}" * (t % 9)) for t in range(700)]
    rows += [(101, 0, "user", None), (101, 1, None, "no role"), (101, 1, "assistant", "x"), (101, 1, "assistant", "x"), (101, None, "[INST]", "y")]
    rows += [(None, 0, "user", "lost"), (None, 1, "assistant", "found"), (102, 5, "assistant", "only"), (103, 0, "system", "only")]
    rows += [(104, -3, "system", "s" * 5000), (104, 2, "assistant", "a"), (104, 900, "tool", "t")]
    return rows


def unescape(s):
    return re.sub(r"([<\[])\\(\\*)(/?(?:s>|INST\]))", r"\1\2\3", s)


def plain(rows, budget, history):
    """conv -> (turns, windows); a window is (first, repeated places, own places)."""
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        turns = [(r, x) for _, _, r, x in turns]
        cost = [-(-len(r + x) // 4) + 4 for r, x in turns]
        before = [sum(cost[:i]) for i in range(len(turns))]
        half = (budget - history) // 2
        keys, large = [], 0
        for i, n in enumerate(cost):
            large += n > half
            keys.append((large, -1 if n > half else before[i] // half))
        spans = {}
        for i, k in enumerate(keys):
            spans.setdefault(k, []).append(i)
        system = turns[0][0] == "system"
        windows = []
        for own in spans.values():
            f = own[0]
            kept = [0] if system and f > 0 else []
            room = history - (cost[0] if system else 0)
            again = [j for j in range(f) if not (system and j == 0) and before[f] - before[j] <= room]
            windows.append((f, sorted(kept + again), own))
        out[c] = (turns, windows, cost)
    return out


@pytest.mark.parametrize("budget,history", [(1024, 256), (120, 40)])
def test_windows_and_read_back(spark, budget, history):
    rows = conversations()
    df = (spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
          .withColumn("window", F.lit("clash")).withColumn("conv", F.lit(1)).withColumn("tokens", F.lit(1)))
    made = format_windows(df, budget, history)
    got = {}
    for r in made.collect():
        got.setdefault(r.conv_id, []).append(r)
    want = plain(rows, budget, history)
    assert got.keys() == want.keys()
    chars = {}
    for c, (turns, windows, cost) in want.items():
        assert len(got[c]) == len(windows)
        for row, (first, again, own) in zip(sorted(got[c], key=lambda r: r.window), sorted(windows)):
            assert row.window == first and row.repeated == len(again)
            shown = re.findall(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", row.formatted, re.S)
            assert [(unescape(a), unescape(b)) for a, b in shown] == [turns[i] for i in again + own]
            assert row.tokens == sum(cost[i] for i in again + own)
            assert row.tokens <= budget or len(own) == 1 and cost[own[0]] > (budget - history) // 2 or cost[0] > history
            targets = [unescape(row.formatted[s.start : s.start + s.length]) for s in row.loss]
            assert targets == [turns[i][1] for i in own if turns[i][0] == "assistant"]
            chars[c] = chars.get(c, 0) + len(row.formatted)
    for r in read_back(made).collect():
        turns = want[r.conv_id][0]
        target = "".join(x for role, x in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.formatted_chars == chars[r.conv_id] and r.loss_chars == len(target)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(target.encode()).hexdigest()


def test_empty_table_and_native_plan(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    made = format_windows(df)
    assert made.count() == 0 and read_back(made).count() == 0
    plan = read_back(made)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
