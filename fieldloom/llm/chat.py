"""Multi-party perspective rotation of dialogues, in DataFrame operations only.

For every participant of a conversation (every role but ``system``) the dialogue is rendered with that speaker
as ``assistant`` and everyone else as a named user; system messages stay system messages. The mask lists the
character ranges to learn from: the speaker's own texts with their end marks.

A dialogue is rendered in parts of ``PART`` messages, so one conversation that holds a large share of all rows is
spread over many tasks; there is one row for each (conversation, speaker, part), whatever the turn numbers are. Messages
are numbered without gathering a conversation: rows are dealt out by ranges of (conversation, turn, role, text) and
numbered in each task, and the few conversations that go on in a next task (one a task at most) add what came before.
Parts in order make up the dialogue; a part's mask counts from the part's start.

Bound: a conversation gives one row for each of its participants and parts, as every participant's view is asked for;
speakers meet parts in groups of ``PART`` parts.

Defined results: messages are ordered by (turn, role, text), null turns first; null role or text: empty, where an empty
role is a participant with an empty name; null conversation ids form one conversation; repeated rows are repeated messages;
conversations with system messages only have no participant and give no row; ``<|`` in texts and roles becomes ``< |``, so
no text can forge a mark. Other columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.llm.common import Tables

PART = 64
START, END = "<|im_start|>", "<|im_end|>"


def _head(role: Column, speaker: Column) -> Column:
    name = F.when(role == speaker, F.lit("assistant")).when(role == "system", F.lit("system")).otherwise(F.concat(F.lit("user name="), role))
    return F.concat(F.lit(START), name, F.lit("\n"))


def _rendered(messages: Column, speaker: Column) -> tuple[Column, Column]:
    """Text and mask ("start-end,start-end") of an array of messages."""
    pieces = F.transform(messages, lambda m: F.struct(_head(m["role"], speaker).alias("head"), F.concat(m["text"], F.lit(END)).alias("body"), (m["role"] == speaker).alias("own")))
    start = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.concat_ws("-", begin.cast("string"), end.cast("string"))
        return F.struct((end + 1).alias("at"), F.when(p["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    text = F.concat_ws("", F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit("\n"))))
    return text, F.concat_ws(",", F.aggregate(pieces, start, step)["spans"])


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, speaker, part, first_turn, messages, text, mask: one row for each conversation, speaker and part."""
    clean = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), clean(role).alias("role"), clean(text).alias("text"))
    # equal rows are told apart by their place, so many of them don't stay together
    dealt = rows.repartitionByRange("conv_id", "turn", "role", "text", F.monotonically_increasing_id()).withColumn("task", F.spark_partition_id())
    base = Tables(turns.sparkSession).keep(dealt, "messages")
    held = base.groupBy("conv_id", "task").agg(F.count(F.lit(1)).alias("n"))
    several = held.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("task", "n"))).alias("tasks")).where(F.size("tasks") > 1)
    before = F.aggregate(F.filter("tasks", lambda x: x["task"] < F.col("at")), F.lit(0).cast("long"), lambda s, x: s + x["n"])
    begun = several.select(F.col("conv_id").alias("c"), "tasks", F.explode("tasks.task").alias("at")).select("c", "at", before.alias("before"))  # two a task at most
    nth = F.row_number().over(Window.partitionBy("conv_id", "task").orderBy("turn", "role", "text")) - 1
    rows = base.withColumn("nth", nth).join(F.broadcast(begun), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("task") == F.col("at")), "left")
    rows = rows.withColumn("nth", F.col("nth") + F.coalesce("before", F.lit(0)))
    parts = rows.groupBy("conv_id", F.floor(F.col("nth") / PART).cast("long").alias("part")).agg(F.sort_array(F.collect_list(F.struct("nth", "turn", "role", "text"))).alias("list"))
    # speakers meet parts in groups, so a long conversation isn't one key
    speakers = base.where("role <> 'system'").select("conv_id", F.col("role").alias("speaker")).distinct()
    total = base.groupBy(F.col("conv_id").alias("d")).agg((F.count(F.lit(1)) - 1).alias("last"))
    speakers = speakers.join(total, F.col("conv_id").eqNullSafe(F.col("d")))
    speakers = speakers.select(F.col("conv_id").alias("c"), "speaker", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / (PART * PART)).cast("long"))).alias("g"))
    body, mask = _rendered(F.col("list"), F.col("speaker"))
    return (
        parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("c")) & (F.floor(F.col("part") / PART).cast("long") == F.col("g")))
        .select("conv_id", "speaker", "part", F.col("list")[0]["turn"].alias("first_turn"), F.size("list").alias("messages"), body.alias("text"), mask.alias("mask"))
    )


ROTATE_SQL = f"""
WITH r AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, replace(coalesce(role, ''), '<|', '< |') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
k AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM r),
g AS (SELECT *, CAST(floor((rn - 1) / {PART}.0) AS BIGINT) AS part FROM k),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM r WHERE role <> 'system'),
x AS (
  SELECT g.*, s.speaker,
         '{START}' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user name=' || role END || chr(10) AS head,
         text || '{END}' AS body
  FROM g JOIN s ON g.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY rn) - length(body) - 1 AS b FROM x)
SELECT conv_id, speaker, part, arg_min(turn, rn) AS first_turn, CAST(count(*) AS INTEGER) AS messages,
       string_agg(head || body || chr(10), '' ORDER BY rn) AS text,
       coalesce(string_agg(CAST(CAST(b AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(b + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY rn) FILTER (WHERE role = speaker), '') AS mask
FROM o GROUP BY conv_id, speaker, part
"""
