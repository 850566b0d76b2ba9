"""Chat formatting by perspective rotation, in DataFrame operations only.

A conversation is rendered once for every participant: that speaker's turns become the assistant's, the others'
those of named users, and only the assistant's turns are trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The role that gives instructions: it keeps its place and is nobody's perspective.
SYSTEM = "system"
UNKNOWN = "unknown"
START, END = "<|start|>", "<|end|>"
#: Turns whose lengths are added up together before the sums are.
SPAN = 512


def _literal(text: Column) -> Column:
    """The text with the template's own markers broken up, so that no message can forge a turn."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _name(role: Column) -> Column:
    """A speaker's name in one line."""
    return F.regexp_replace(_literal(F.coalesce(role, F.lit(UNKNOWN))), r"[\r\n]", " ")


def rotate(turns: DataFrame) -> DataFrame:
    """One row per message and perspective: what it reads as there, where, and which characters are trained on.

    Needs ``conv_id``, ``turn``, ``role`` and ``text``. Columns of the result: ``conv_id``, ``perspective`` (the
    speaker who is the assistant), ``position`` (of the message, from 0), ``turn``, ``speaker``, ``segment`` (its rendering;
    the dialogue is the segments in order of position, joined by nothing), ``start`` (characters before it), and
    ``mask_start`` and ``mask_end``, the characters of the dialogue that are trained on: text and end mark of the
    assistant's messages, an empty range for others.

    Messages are in order of turn (null last), then role, then text. A null role is the participant ``unknown``,
    a null text is empty, a null conversation is one conversation; repeated rows are repeated messages. A
    conversation of system messages alone has no participant and gives no row. Other columns are not read.

    A conversation is never gathered. Equal rows are counted before the shuffle; positions and starts come
    from sums over spans of ``SPAN`` turns and then over the spans, so one that holds a third of all
    rows is spread like any other.
    """
    messages = (
        turns.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"), _name(F.col("role")).alias("speaker"), _literal(F.col("text")).alias("content"))
        .groupBy("conv_id", "turn", "speaker", "content")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    people = messages.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    label = F.when(F.col("speaker") == SYSTEM, F.lit(SYSTEM)).when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), F.col("speaker")))
    segment = F.concat(F.lit(START), label, F.lit("\n"), F.col("content"), F.lit(END + "\n"))
    rendered = (
        messages.join(people, F.col("conv_id").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("segment", segment)
        .withColumns({"long": F.length("segment").cast("long"), "span": F.floor(F.col("turn") / SPAN)})
    )
    talk = ["conv_id", "perspective"]
    spans = rendered.groupBy(*talk, "span").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.col("long")).alias("m"))
    earlier = Window.partitionBy(*talk).orderBy(F.col("span").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(
        F.col("conv_id").alias("o_conv"), F.col("perspective").alias("o_perspective"), F.col("span").alias("o_span"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("m_before"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("o_conv")) & (F.col("perspective") == F.col("o_perspective")) & F.col("span").eqNullSafe(F.col("o_span"))
    within = Window.partitionBy(*talk, "span").orderBy(F.col("turn").asc_nulls_last(), "speaker", "content").rowsBetween(Window.unboundedPreceding, -1)
    placed = rendered.join(offsets, same).withColumns(
        {
            "before": F.col("n_before") + F.coalesce(F.sum("copies").over(within), F.lit(0)),
            "ahead": F.col("m_before") + F.coalesce(F.sum(F.col("copies") * F.col("long")).over(within), F.lit(0)),
        }
    )
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))  # after the sums
    start = F.col("ahead") + F.col("copy") * F.col("long")
    end = start + F.col("long") - 1  # the line end after the end mark is not trained on
    text_start = end - F.length("content") - len(END)
    return placed.select(
        *talk,
        (F.col("before") + F.col("copy")).alias("position"),
        "turn",
        "speaker",
        "segment",
        start.alias("start"),
        F.when(own, text_start).otherwise(start).alias("mask_start"),
        F.when(own, end).otherwise(start).alias("mask_end"),
    )


#: The same in DuckDB's SQL.
ORACLE = f"""
WITH messages AS (
  SELECT conv_id, turn, regexp_replace(replace(coalesce(role, '{UNKNOWN}'), '<|', '< |'), '[\\r\\n]', ' ', 'g') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS content
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM messages WHERE speaker <> '{SYSTEM}'
), rendered AS (
  SELECT m.*, p.perspective, '{START}' || CASE WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN speaker = perspective THEN 'assistant'
         ELSE 'user name=' || speaker END || chr(10) || content || '{END}' || chr(10) AS segment
  FROM messages m JOIN people p ON m.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
  SELECT *, row_number() OVER w - 1 AS position, coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM rendered WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, content)
)
SELECT conv_id, perspective, position, turn, speaker, segment, start,
       CASE WHEN speaker = perspective THEN start + length(segment) - 1 - {len(END)} - length(content) ELSE start END AS mask_start,
       CASE WHEN speaker = perspective THEN start + length(segment) - 1 ELSE start END AS mask_end
FROM placed
"""
