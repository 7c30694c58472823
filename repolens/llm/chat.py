"""Chat formatting with built-in expressions only.

Template of one conversation (control strings in upright brackets are
literal)::

    <s>ROLE[INST]TEXT[SEP]TEXT...[/INST]  ...one per message...  </s>

A message is a maximal run of adjacent turns of one role; its turns are
joined by ``[SEP]``.  Control strings inside roles and texts are escaped by
one backslash after their first character (``</s>`` becomes ``<\\/s>``; a
string that already looks escaped gets one more), so they never read as
control strings and unescaping restores the text exactly.

Defined results: a null text or role is empty; turns sort by (turn, role,
text), null turn first; repeated rows are kept as repeated turns; rows with
a null ``conv_id`` form one conversation; an empty table gives no rows;
columns other than conv_id, turn, role and text are ignored.  A conversation
is one output string, so its turns meet in one row by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOS, OPEN, SEP, CLOSE, EOS = "<s>", "[INST]", "[SEP]", "[/INST]", "</s>"
_TAIL = r"(/?(?:s>|INST\]|SEP\]))"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])\\(\\*)" + _TAIL, "$1$2$3")


def format_chat(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments``
    (array<struct<text, loss>>, whose texts concatenated are the formatted
    string; ``loss`` marks assistant text) and ``formatted``."""
    empty = F.lit("")
    turns = conversations.select(
        "conv_id", F.struct(F.col("turn").alias("turn"), F.coalesce("role", empty).alias("role"),
                            F.coalesce("text", empty).alias("text")).alias("t"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def changes(ts: Column, i: Column) -> Column:
        # i is the 1-based position of a turn; try_element_at(0) is not allowed, hence greatest
        return (i == 1) | (F.element_at(ts, i)["role"] != F.element_at(ts, F.greatest(i - 1, F.lit(1)))["role"])

    ts = F.col("turns")
    # first position of every run of one role, and the position after the last turn
    runs = convs.withColumn("starts", F.filter(F.sequence(F.lit(1), F.size(ts)), lambda i: changes(ts, i)))
    bounds = F.arrays_zip(
        F.col("starts").alias("a"),
        F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size(ts) + 1)).alias("b"))
    messages = F.transform(
        bounds,
        lambda m: F.struct(F.element_at(ts, m["a"])["role"].alias("role"),
                           F.transform(F.slice(ts, m["a"], m["b"] - m["a"]), lambda t: t["text"]).alias("texts")))

    def seg(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def message_segments(m: Column) -> Column:
        loss = m["role"] == LOSS_ROLE
        head = seg(F.concat(F.lit(BOS), escape(m["role"]), F.lit(OPEN)), F.lit(False))
        body = F.flatten(F.transform(m["texts"], lambda t, i: F.concat(
            F.when(i > 0, F.array(seg(F.lit(SEP), F.lit(False)))).otherwise(F.slice(F.array(head), 1, 0)),
            F.array(seg(escape(t), loss)))))
        return F.concat(F.array(head), body, F.array(seg(F.lit(CLOSE), F.lit(False))))

    segments = F.concat(F.flatten(F.transform("messages", message_segments)),
                        F.array(seg(F.lit(EOS), F.lit(False))))
    return (runs.withColumn("messages", messages)
            .select("conv_id", segments.alias("segments"))
            .select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "")
                    .alias("formatted")))


def read_back(formatted: Column) -> Column:
    """Messages of a formatted string: array<struct<role, texts>>, unescaped."""
    parts = F.split(formatted, BOS, -1)

    def message(p: Column) -> Column:
        body = F.substring_index(F.substring_index(p, OPEN, -1), CLOSE, 1)
        return F.struct(unescape(F.substring_index(p, OPEN, 1)).alias("role"),
                        F.transform(F.split(body, r"\[SEP\]", -1), unescape).alias("texts"))

    return F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), message)


def digest(chats: DataFrame) -> DataFrame:
    """Per conversation, what the formatted output holds when read back.
    ``n_turns`` counts the turns of the input, ``n_messages`` the merged ones."""
    texts = F.flatten(F.transform("m", lambda m: F.transform(
        m["texts"], lambda t: F.concat(m["role"], F.lit("\n"), t, F.lit("\n")))))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return (chats.withColumn("m", read_back(F.col("formatted")))
            .select("conv_id", texts.alias("turns"), loss.alias("loss"), "formatted", F.size("m").alias("nm"))
            .select("conv_id",
                    F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"),
                    F.col("nm").cast("long").alias("n_messages")))
