"""Multi-party dialogues, rendered once from the point of view of every participant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.operators.ordering import prefix_sum
from newsmill.session import cut

# Turn numbers per rendered part, and how many distinct messages a part may hold before it is split.
PART_TURNS = 64
PART_ROWS = 256
START, END = "<|start|>", "<|end|>"


def _header(speaker: Column, perspective: Column, shared: Sequence[str]) -> Column:
    """Who speaks: the assistant, a shared role such as the system, or a user by name."""
    named = F.concat(F.lit("user name="), speaker)
    who = F.when(speaker == perspective, F.lit("assistant")).when(speaker.isin(list(shared)), speaker).otherwise(F.coalesce(named, F.lit("user")))
    return F.concat(F.lit(START), who, F.lit("\n"))


def _tame(text: Column) -> Column:
    """Markers inside a message or a name lose their meaning."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    shared: Sequence[str] = ("system",), part_turns: int = PART_TURNS, part_rows: int = PART_ROWS,
) -> DataFrame:
    """``conv_id``, ``perspective``, ``part``, ``split``, ``n_turns``, ``n_own``, ``text``, ``mask``.

    For every participant of a conversation the dialogue is rendered with that one as assistant and all
    others as users with a name; roles in ``shared`` keep theirs and have no perspective of their own.
    ``mask`` lists the stretches to learn, ``start:end`` in code points of ``text``, end excluded: the
    assistant's messages with their end marker, without headers.

    A dialogue is rendered in parts by turn number (``part_turns`` numbers each), so that no row or task
    grows with its length; parts in order are the dialogue. Messages are in order of turn, role, text;
    rows equal in these are one message. If a part holds more than ``part_rows`` messages, because many
    have one turn number or none (part -1), it is divided into splits of so many in that order, and splits in
    order are the part.

    NULL texts are empty messages. NULL roles are users without a name and no participants; rows without
    a conversation id form one conversation with a NULL id. Markers in texts are broken up. A conversation
    without participants has no rows. Further columns are ignored.
    """
    rows = turns.select(col(conv_col).alias("conv_id"), col(turn_col).alias("turn"), _role(col(role_col)).alias("role"), _tame(col(text_col)).alias("text")).distinct()
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long"))
    rows = _in_splits(rows, part_rows)
    people = rows.where(F.col("role").isNotNull() & ~F.col("role").isin(list(shared))).select(F.col("conv_id").alias("c"), F.col("role").alias("perspective")).distinct()
    seen = rows.join(people, F.col("conv_id").eqNullSafe(F.col("c")))
    message = F.struct("turn", "role", "text")
    parts = seen.groupBy("conv_id", "perspective", "part", "split").agg(F.array_sort(F.collect_list(message)).alias("messages"))
    header = lambda m: _header(m["role"], F.col("perspective"), shared)
    pieces = F.transform("messages", lambda m: F.struct(header(m).alias("head"), F.concat(m["text"], F.lit(END + "\n")).alias("body"), F.coalesce(m["role"] == F.col("perspective"), F.lit(False)).alias("own")))
    shown = parts.withColumn("pieces", pieces)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + F.char_length(piece["head"])
        stop = begin + F.char_length(piece["body"])
        span = F.concat(begin.cast("string"), F.lit(":"), (stop - 1).cast("string"))
        spans = F.when(piece["own"], F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(stop.alias("at"), spans.alias("spans"))

    mask = F.array_join(F.aggregate("pieces", start, step, lambda s: s["spans"]), ",")
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "")
    own = F.size(F.filter("pieces", lambda p: p["own"]))
    return shown.select("conv_id", "perspective", "part", "split", F.size("pieces").cast("long").alias("n_turns"), own.cast("long").alias("n_own"), text.alias("text"), mask.alias("mask"))


def _in_splits(rows: DataFrame, part_rows: int) -> DataFrame:
    """Adds ``split``: 0, or in a part of more than ``part_rows`` messages the position divided by that number.
    A task sorts one range of the crowded messages; earlier ranges come from their counts."""
    crowded = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_rows)
    crowded = cut(crowded.select(F.col("conv_id").alias("c"), F.col("part").alias("p")))
    whole = F.lit(0).cast("long")
    if crowded.isEmpty():
        return rows.withColumn("split", whole)
    same, order = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), ["turn", "role", "text"]
    many = rows.join(crowded, same).drop("c", "p").repartitionByRange("conv_id", "part", *order)
    many = cut(many.withColumns({"range": F.spark_partition_id(), "crowd": F.struct("conv_id", "part")}))
    placed = prefix_sum(many, ["crowd"], F.col("range"), [F.col(c) for c in order], F.lit(1).cast("long"), "position")
    split = F.floor(F.col("position") / part_rows).cast("long")
    return rows.join(crowded, same, "left_anti").withColumn("split", whole).unionByName(placed.select(*rows.columns, split.alias("split")))


def _role(role: Column) -> Column:
    """A role as a name: line ends would end the header."""
    return F.replace(F.translate(role, "\n\r", "  "), F.lit("<|"), F.lit("< |"))


SQL = """
WITH r AS (
  SELECT DISTINCT conv_id, turn, role, replace(coalesce(text, ''), '<|', '< |') AS text, floor(turn / 64)::BIGINT AS part FROM conversations
), p AS (SELECT DISTINCT conv_id, role AS perspective FROM r WHERE role <> 'system'),
m AS (
  SELECT r.*, perspective, role = perspective AS own,
    '<|start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN role ELSE 'user name=' || role END || chr(10) AS head,
    text || '<|end|>' || chr(10) AS body
  FROM r JOIN p USING (conv_id)
), o AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM m
)
SELECT conv_id, perspective, part, 0::BIGINT AS split, count(*)::BIGINT AS n_turns, count_if(own)::BIGINT AS n_own,
  string_agg(head || body, '' ORDER BY turn, role, text) AS text,
  coalesce(string_agg((begins + length(head))::VARCHAR || ':' || (begins + length(head) + length(body) - 1)::VARCHAR, ',' ORDER BY turn, role, text) FILTER (WHERE own), '') AS mask
FROM o GROUP BY conv_id, perspective, part
"""
