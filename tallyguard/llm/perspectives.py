"""Multi-party perspective rotation: every dialogue once for each participant, with that one as the assistant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table

SYSTEM = "system"
UNKNOWN = "unknown"
TURNS_A_BUCKET = 256


def header(shown: Column, name: Column) -> Column:
    """What stands before a turn's content."""
    return F.concat(F.lit("<|"), shown, F.when(name.isNotNull(), F.concat(F.lit(":"), name)).otherwise(""), F.lit("|>\n"))


def rotate(conversations: DataFrame) -> DataFrame:
    """One row a perspective and turn: conv_id, perspective, turn, speaker, shown_as, name, content, rendered,
    trained, start, end.

    Participants are the roles of a conversation except ``system``; each gives one perspective. In it
    its own turns are the assistant's and trained, those of others are users' with their role as name,
    system turns stay; the last two are masked (trained is false). A perspective's rendering is its
    ``rendered`` in the order of turn, speaker and content; start and end place the content in it, in
    code points, so trained spans are the mask. Offsets are added up over buckets of turns first, so a
    conversation of any length is split over tasks.

    A null role is the participant ``unknown``, a null text is empty, a null turn comes first; repeated
    rows are turns of their own; conversations of system turns alone have no perspective; null conv_ids
    are one conversation. Other columns are not looked at; an empty table gives no rows.
    """
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"),
                                 F.coalesce("text", F.lit("")).alias("content"))
    people = (turns.where(F.col("speaker") != SYSTEM)
              .groupBy(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).count().drop("count"))
    own = F.col("speaker") == F.col("perspective")
    shown = F.when(own, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")
    rows = (turns.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
            .withColumn("shown_as", shown)
            .withColumn("name", F.when(F.col("shown_as") == "user", F.col("speaker")))
            .withColumn("rendered", F.concat(header(F.col("shown_as"), F.col("name")), "content", F.lit("\n")))
            .withColumn("bucket", F.floor(F.coalesce("turn", F.lit(-1)) / TURNS_A_BUCKET)))
    keys = ["conv_id", "perspective", "bucket"]
    sizes = rows.groupBy(*keys).agg(F.sum(F.length("rendered")).alias("n"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("bucket")
    before = sizes.select(*(F.col(c).alias(f"_{c}") for c in keys), (F.sum("n").over(earlier) - F.col("n")).alias("_before"))
    order = Window.partitionBy(*keys).orderBy("turn", "speaker", "content").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum(F.length("rendered")).over(order), F.lit(0)))
    joined = placed.join(before, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (
        F.col("perspective") == F.col("_perspective")) & (F.col("bucket") == F.col("_bucket")))
    start = F.col("_before") + F.col("_inside") + F.length(header(F.col("shown_as"), F.col("name")))
    return joined.select("conv_id", "perspective", "turn", "speaker", "shown_as", "name", "content", "rendered",
                         own.alias("trained"), start.alias("start"), (start + F.length("content")).alias("end"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All perspectives of all conversations."""
    return rotate(table(spark, sf_dir, "conversations")).drop("content")


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.*, perspective, CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
        ELSE 'user' END AS shown_as FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, CASE WHEN shown_as = 'user' THEN speaker END AS name,
        '<|' || shown_as || CASE WHEN shown_as = 'user' THEN ':' || speaker ELSE '' END || '|>' || chr(10) AS head FROM r),
o AS (SELECT *, head || content || chr(10) AS rendered FROM h),
s AS (SELECT *, coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective
        ORDER BY turn NULLS FIRST, speaker, content ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        + length(head) AS st FROM o)
SELECT conv_id, perspective, turn, speaker, shown_as, name, rendered, speaker = perspective AS trained,
  st::BIGINT AS start, (st + length(content))::BIGINT AS "end" FROM s"""
