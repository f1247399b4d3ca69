"""Mixing sources to target weights: capped water-filling, whole and fractional repetitions, by columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.session import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2.0
SEED = 42
BUCKETS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_order(sources: DataFrame) -> DataFrame:
    """``sources`` (source, ...) with ``place`` from 0 by code point, null last.

    Sources are numbered inside ranges and the ranges' sizes added up, so any number of them will do.
    """
    ranged = stored(sources.withColumn("unknown", F.col("source").isNull()).repartitionByRange("unknown", "source")
                    .withColumn("part", F.spark_partition_id()), "sources")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))           # one row a partition
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("unknown", "source"))
    return (ranged.join(F.broadcast(before), "part").withColumn("place", F.col("before") + inside - 1)
            .drop("part", "before", "unknown"))


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) of ``sources`` (source, source_size) by capped water-filling.

    The sources share ``share`` of all sizes by weight. Those above ``epochs`` times their size are
    clamped to it and what is left is shared by weight among the others, until none is above. A
    round is one aggregation to one row; where all sources are clamped the rest is not dealt out.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = stored(source_order(sources).withColumn("weight", weight).withColumn(
        "most", F.col("source_size") * F.lit(epochs)), "weights")
    total = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = 0.0, None
    while True:
        is_clamped = F.col("weight") * F.lit(level) > F.col("most") if clamped is not None else F.lit(False)
        most, weight_left, count = rows.agg(
            F.sum(F.when(is_clamped, F.col("most"))), F.sum(F.when(~is_clamped, F.col("weight"))),
            F.count(F.when(is_clamped, 1))).first()
        if count == clamped:
            break
        clamped = count
        if not weight_left:
            level = float("inf")
            break
        level = (total - (most or 0.0)) / weight_left
    target = F.least(F.col("weight") * F.lit(level), F.col("most")) if level != float("inf") else F.col("most")
    return rows.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: float = MOST_EPOCHS,
        seed: int = SEED, whole_rows: bool = False) -> DataFrame:
    """(doc_id, row_hash, source, size, source_size, target, taken) of every row of ``docs``, and on
    request the row itself as ``row``.

    Every document of a source is taken floor(target / source_size) times. What is still missing is
    one more repetition of the first documents in a seeded hash order; the one at the border is
    taken in part, so that a source's words come to its target rounded down. Hash buckets are added
    up first, and only the border's bucket is put in order, so a large source is no large group.
    Null and empty texts have size 0; a null source is one of its own; repeated rows count each,
    with ties in the order dealt out equally; a null doc_id stays; other columns are not looked at.
    """
    row = docs.select("doc_id", "source", words(F.col("text")).alias("size"), F.md5(F.concat_ws(
        "|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("row_hash"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_rows else []))
    row = row.withColumn("bucket", F.conv(F.substring("row_hash", 1, 4), 16, 10).cast("int") % BUCKETS)
    sizes = row.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    totals = sizes.groupBy("source").agg(F.sum("n").alias("source_size"))
    goals = stored(targets(totals, weights, share, epochs).withColumn("whole", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("extra", F.floor(F.col("target") - F.col("whole") * F.col("source_size"))), "goals")
    before = Window.partitionBy("source").orderBy("bucket")
    buckets = (sizes.withColumn("before", F.sum("n").over(before) - F.col("n"))
               .join(goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
               .select("source", "bucket", "source_size", "target", "whole", F.greatest(F.lit(0), F.least(
                   F.col("n"), F.col("extra") - F.col("before"))).alias("left"), "n"))
    place = buckets.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "source_size", "target",
                           "whole", "left", "n")
    dealt = row.join(place, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
    border = (F.col("left") > 0) & (F.col("left") < F.col("n"))
    full = dealt.where(~border).withColumn("more", F.when(F.col("left") > 0, F.col("size")).otherwise(0))
    order = Window.partitionBy("source", "bucket").orderBy("row_hash", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    cut = dealt.where(border).withColumn("more", F.greatest(F.lit(0), F.least(
        F.col("size"), F.col("left") - F.coalesce(F.sum("size").over(order), F.lit(0)))))
    return full.unionByName(cut).select("doc_id", "row_hash", "source", "size", "source_size", "target", (
        F.col("whole") * F.col("size") + F.col("more")).cast("long").alias("taken"), *(["row"] if whole_rows else []))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken; the border's part is its first words.

    Every row brings its own number of words, so equal rows and rows of one doc_id may be taken
    differently and their source still has its target. Rows without a word are not taken; all columns
    stay, whatever their names; an empty table gives no rows.
    """
    rows = mix(docs, whole_rows=True, **options).where("size > 0").select(
        "row", F.col("row.text").alias("text"), "size", "taken")
    whole, rest = F.floor(F.col("taken") / F.col("size")).cast("int"), F.col("taken") % F.col("size")
    part = F.expr(r"regexp_extract(text, concat('^(?:[ \\t-\\r]*+[^ \\t-\\r]++){', cast(taken % size as string), '}+'), 0)")
    texts = F.concat(F.array_repeat(F.col("text"), whole), F.when(rest > 0, F.array(part)).otherwise(
        F.array().cast("array<string>")))
    turned = rows.select("row", F.explode(texts).alias("text"))
    out = turned.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents repeated or left out so that the sources have their target sizes."""
    return repeated(docs)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document of the whole table."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('42|' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS z,
        [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM d GROUP BY source),
t AS (SELECT *, sum(2.0 * z) OVER o - 2.0 * z AS below, sum(w) OVER (ORDER BY z / w DESC, source DESC NULLS FIRST) AS ws,
        1.5 * sum(z) OVER () AS total FROM s WINDOW o AS (ORDER BY z / w, source NULLS LAST)),
l AS (SELECT max(CASE WHEN (total - below) / ws <= 2.0 * z / w THEN (total - below) / ws END) AS level FROM t),
g AS (SELECT source, z, CASE WHEN level IS NULL THEN 2.0 * z ELSE least(w * level, 2.0 * z) END::DOUBLE AS target
      FROM t, l),
b AS (SELECT d.*, z, target, CASE WHEN z > 0 THEN floor(target / z) ELSE 0 END AS whole,
        ('0x' || substr(h, 1, 4))::BIGINT % 1024 AS bucket
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
r AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY bucket, h, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, floor(target - whole * z) AS extra FROM b)
SELECT doc_id, size, z AS source_size, target,
  (whole * size + greatest(0, least(size, extra - before)))::BIGINT AS taken FROM r"""
