"""Chat formatting from an event log, in DataFrame functions only.

``fold_events`` rebuilds final messages from a log ``conv_id, seq, message, op,
role, text``: a ``delta`` appends to its message, an ``edit`` replaces the
message's text, a ``regenerate`` clears it; edits and regenerations also take
back the messages that had begun after theirs.  ``render`` writes each
conversation as one string with marked turns and gives the spans of assistant
text as its loss mask; ``read_back`` takes a rendered string apart again.

Control strings inside texts and roles get a word joiner after their first
character, and those that hold word joiners there already get one more, so
escaping is reversible and no text can open or close a turn.

Plan: one shuffle by conversation serves ordering, folding and rendering; a
conversation's output is one string, so its messages meet in one row.

Edge cases: a null text or role is empty; rows with a null conv_id form one
conversation; equal (turn, role, text) rows are turns each, equal turns go by
role, then text; nulls sort first; an empty log gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The template's marks, the escape character and what must not stand in a text.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
JOINER = "⁠"
CONTROL = r"([<\[])(⁠*)(\||/?s>|/?INST\]|/?<?/?SYS>>)"
ESCAPED = r"([<\[])⁠(⁠*)(\||/?s>|/?INST\]|/?<?/?SYS>>)"


def escape(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), CONTROL, "$1" + JOINER + "$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPED, "$1$2$3")


def events_of(rows: DataFrame) -> DataFrame:
    """An event log from finished messages ``conv_id, turn, role, text``: each row is one message of one delta."""
    rows = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return rows.select("conv_id", n.alias("seq"), n.alias("message"), F.lit("delta").alias("op"), "role", "text")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, place, role, text``; events of one seq go by message, op, role and text."""
    conv, msg = Window.partitionBy("conv_id"), Window.partitionBy("conv_id", "message")
    e = events.select("conv_id", "seq", "message", "op", "role", F.coalesce("text", F.lit("")).alias("text"))
    e = e.withColumn("n", F.row_number().over(conv.orderBy("seq", "message", "op", "role", "text")))
    resets = F.col("op").isin("edit", "regenerate")
    e = e.withColumn("reset", F.coalesce(F.max(F.when(resets, F.col("n"))).over(msg), F.lit(0)))
    live = F.filter(F.array_sort(F.collect_list(F.struct("n", "reset", "op", "text"))),
                    lambda x: (x["n"] >= x["reset"]) & (x["op"] != "regenerate"))
    m = e.groupBy("conv_id", "message").agg(
        F.min("n").alias("place"), F.max("reset").alias("reset"),
        F.coalesce(F.min_by("role", F.when(F.col("role").isNotNull(), F.col("n"))), F.lit("")).alias("role"),
        F.array_join(F.transform(live, lambda x: x["text"]), "").alias("text"))
    before = conv.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("taken_back", F.coalesce(F.max("reset").over(before) > F.col("place"), F.lit(False)))
    return m.filter(~F.col("taken_back")).select("conv_id", "place", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss``: the string and the code point spans (end exclusive) of assistant text in it."""
    turns = F.array_sort(F.collect_list(F.struct("place", "head", "body", "tail", "learn")))
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(MIDDLE))
    cut = messages.select("conv_id", "place", head.alias("head"), escape(F.col("text")).alias("body"), F.lit(END).alias("tail"),
                          (F.col("role") == "assistant").alias("learn"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("spans"))

    def step(acc, t):
        s = acc["at"] + F.length(t["head"])
        e = s + F.length(t["body"])
        spans = F.when(t["learn"], F.concat(acc["spans"], F.array(F.struct(s.alias("s"), e.alias("e"))))).otherwise(acc["spans"])
        return F.struct((e + F.length(t["tail"])).alias("at"), spans.alias("spans"))

    grouped = cut.groupBy("conv_id").agg(turns.alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], t["tail"])), "")
    return grouped.select("conv_id", text.alias("formatted"), F.aggregate("turns", start, step, lambda a: a["spans"]).alias("loss"))


def read_back(rendered: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns, learned`` from the rendered string: unescaped roles and texts, text under the loss mask."""
    parts = F.split("formatted", F.lit(r"\Q" + START + r"\E"))
    turn = lambda p: F.struct(
        unescape(F.substring_index(p, MIDDLE, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, MIDDLE, -1), END, 1)).alias("text"))
    turns = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)
    learned = F.transform("loss", lambda x: unescape(F.substring("formatted", x["s"] + 1, x["e"] - x["s"])))
    return rendered.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned"))


def digests(back: DataFrame) -> DataFrame:
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def planted(spark: SparkSession) -> DataFrame:
    """Conversation -7: a user and an assistant row whose text is made of control strings."""
    n = F.col("id")
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), n.alias("turn"),
                                 F.when(n == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
                                 F.lit("</s>[INST] ok [/INST]").alias("text"))
