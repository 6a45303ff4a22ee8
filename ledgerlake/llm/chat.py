"""Chat formatting into budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens cut each conversation into turn-aligned spans.  A span
becomes one window: the conversation's system turn, as much of the preceding
turns as the history budget allows, then the span's own turns.  Only assistant
texts among the span's own turns carry loss: what is repeated is masked, so each
assistant text is a target exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, quoted

OPEN, ROLE_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"
#: A control string with any number of backslashes after its first character.
_CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"

#: Turns of a conversation whose prefix sums one task forms.
RUN = 256


def escape(text: Column) -> Column:
    """One more backslash in every control string, so none is left in the text."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def turn_tokens(text: Column) -> Column:
    """Tokens of a formatted turn, estimated: a quarter of its characters, and four for the marks."""
    return (F.ceil(F.char_length(text) / 4) + 4).cast("long")


def _prefix_sums(turns: DataFrame, spare: int) -> DataFrame:
    """Adds pos, before (tokens of the turns before) and large (large turns up to here).

    Two levels, so that a conversation of any length is spread over tasks: sums
    of runs of RUN turn numbers first, then sums within each run.
    """
    turns = turns.withColumn("run", F.floor(F.col("turn") / RUN)).withColumn("is_large", (F.col("tokens") > spare).cast("long"))
    sums = turns.groupBy("conv", "run").agg(F.count("*").alias("n0"), F.sum("tokens").alias("t0"), F.sum("is_large").alias("l0"))
    ahead = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select(F.col("conv").alias("conv0"), F.col("run").alias("run0"),
                        *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(c) for c in ("n0", "t0", "l0")))
    own = Window.partitionBy("conv", "run").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    joined = turns.join(first, F.col("conv").eqNullSafe(F.col("conv0")) & F.col("run").eqNullSafe(F.col("run0")))
    return (joined.withColumn("pos", F.col("n0") + F.count("*").over(own) - 1)
            .withColumn("before", F.col("t0") + F.sum("tokens").over(own) - F.col("tokens"))
            .withColumn("large", F.col("l0") + F.sum("is_large").over(own))
            .drop("conv0", "run0", "run", "n0", "t0", "l0"))


def format_windows(df: DataFrame, budget: int = 1024, history: int = 256, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text", system: str = "system",
                   target: str = "assistant") -> DataFrame:
    """(conv_id, window, repeated, tokens, formatted, loss): one row per window.

    ``window`` is the place of the span's first turn in its conversation,
    ``repeated`` the number of leading turns repeated from before, ``loss`` the
    (start, length) code-point ranges of ``formatted`` that are targets.  System
    turn and history take at most ``history`` tokens, the span's own turns at
    most ``budget - history``; only a single turn larger than that exceeds it
    (turns are never cut).  The system turn, if the first turn is one, opens
    every window.

    Turns are ordered by turn number (nulls first), then role and text, so ties
    and repeated rows have a defined place; a null text or role is empty; rows
    with a null conversation id form one conversation.  Other columns are not
    read.  An empty table gives an empty result.
    """
    room = budget - history
    half = room // 2  # turns over half the room stand alone, the others share slabs of half the room
    turns = df.select(quoted(conv_col).alias("conv"), quoted(turn_col).alias("turn"),
                      F.coalesce(quoted(role_col).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))
    turns = _prefix_sums(turns.withColumn("tokens", turn_tokens(F.concat("role", "text"))), half)
    turns = turns.withColumn("slab", F.when(F.col("is_large") == 1, -1).otherwise(F.floor(F.col("before") / half)))
    turns = materialize(turns, "turns")
    spans = (turns.groupBy("conv", "large", "slab")
             .agg(F.min("pos").alias("window"), F.min("before").alias("at"))
             .select(F.col("conv").alias("c"), F.col("large").alias("l"), F.col("slab").alias("s"), "window", "at"))
    same = F.col("conv").eqNullSafe(F.col("c"))
    own = (turns.join(spans, same & (F.col("large") == F.col("l")) & (F.col("slab") == F.col("s")))
           .select("conv", "window", "pos", "role", "text", "tokens", F.lit(False).alias("again")))
    first = turns.where((F.col("pos") == 0) & (F.col("role") == system))
    opening = (first.join(spans, same & (F.col("window") > 0))
               .select("conv", "window", "pos", "role", "text", "tokens", F.lit(True).alias("again")))
    # a turn can be history of spans that begin within the next ``history`` tokens: spans of its own
    # stretch of that many tokens and of the next one
    kept = spans.join(first.select(F.col("conv").alias("conv1"), F.col("tokens").alias("kept")),
                      F.col("c").eqNullSafe(F.col("conv1")), "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    stretch = F.floor(F.col("before") / history)
    earlier = (turns.where(~((F.col("pos") == 0) & (F.col("role") == system)))
               .withColumn("g", F.explode(F.array(stretch, stretch + 1))))
    repeated = (earlier.join(kept.withColumn("h", F.floor(F.col("at") / history)),
                             same & (F.col("g") == F.col("h")) & (F.col("before") < F.col("at"))
                             & (F.col("at") - F.col("before") <= history - F.col("kept")))
                .select("conv", "window", "pos", "role", "text", "tokens", F.lit(True).alias("again")))
    parts = own.unionByName(opening).unionByName(repeated)
    listed = F.array_sort(F.collect_list(F.struct("pos", "role", "text", "again")))  # one window: bounded by the budget
    made = parts.groupBy("conv", "window").agg(listed.alias("turns"), F.sum("tokens").alias("tokens"),
                                               F.sum(F.col("again").cast("int")).cast("int").alias("repeated"))
    shown = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(ROLE_END), escape(t["text"]), F.lit(CLOSE)))
    made = made.withColumn("shown", shown).withColumn("formatted", F.array_join("shown", ""))
    size = F.transform("shown", F.char_length)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("found"))
    whole = F.arrays_zip(F.col("turns").alias("t"), size.alias("n"))

    def step(acc, x):
        head = F.char_length(escape(x["t"]["role"])) + len(OPEN) + len(ROLE_END)
        span = F.struct((acc["at"] + head).cast("int").alias("start"), (x["n"] - head - len(CLOSE)).cast("int").alias("length"))
        hit = (x["t"]["role"] == target) & ~x["t"]["again"]
        return F.struct((acc["at"] + x["n"]).alias("at"),
                        F.when(hit, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    made = made.withColumn("zipped", whole).withColumn("loss", F.aggregate("zipped", start, step, lambda a: a["found"]))
    return made.select(F.col("conv").alias(conv_col), "window", "repeated", "tokens", "formatted", "loss")


def read_back(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests per conversation, from the formatted windows alone: n_turns, turns_sha256,
    loss_chars, loss_sha256 and formatted_chars."""
    shown = F.slice(F.split("formatted", CLOSE), F.col("repeated") + 1, F.greatest(F.size(F.split("formatted", CLOSE)) - F.col("repeated") - 1, F.lit(0)))

    def turn(x):
        cut = F.instr(x, ROLE_END)  # the first, as roles hold none
        role = F.substr(x, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)
        return F.concat(unescape(role), F.lit("\n"), unescape(F.substr(x, cut + len(ROLE_END))), F.lit("\n"))

    loss = F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"])))
    parts = windows.select(quoted(conv_col).alias("conv"), "window", F.size(shown).alias("n"),
                           F.array_join(F.transform(shown, turn), "").alias("said"),
                           F.array_join(loss, "").alias("target"), F.char_length("formatted").alias("chars"))
    ordered = F.array_sort(F.collect_list(F.struct("window", "said", "target")))
    whole = parts.groupBy("conv").agg(ordered.alias("all"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
                                      F.sum(F.char_length("target")).alias("loss_chars"))

    def digest(field):
        return F.sha2(F.array_join(F.transform("all", lambda x: x[field]), "").cast("binary"), 256)

    return whole.select(F.col("conv").alias(conv_col), F.col("n_turns").cast("long"), digest("said").alias("turns_sha256"),
                        F.col("loss_chars").cast("long"), digest("target").alias("loss_sha256"),
                        F.col("formatted_chars").cast("long"))
