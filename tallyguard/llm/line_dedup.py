"""Line dedup: lines whose word sets are similar to an earlier line's are removed."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.rows import fresh
from tallyguard.llm.setjoin import (
    PART, ROW, candidate_sets, line_parts, possible, rarity_levels, scan_parts, shared_prefixes, similar_pairs,
    sketched)
from tallyguard.session import stored

LEAST_WORDS = 1
SIMILARITY = 0.75
PREFIX_LANES, ROUNDS = 2, 2


def later_matches(shared: DataFrame, sets: DataFrame, places: DataFrame, t: float) -> DataFrame:
    """(sig) of the line sets that are similar to a set with an earlier first line.

    Every key's rows are first compared with its earliest row, then with two others picked by hash;
    lines that this settles are compared no further, as one earlier match is enough. Those still
    open meet all earlier rows of their keys, so none is missed.
    """
    rows = stored(sketched(shared.join(places, "sig"), sets), "placed")
    row = F.struct(*[c for c in rows.columns if c != "key"])
    first = rows.groupBy("key").agg(F.array(F.min_by(row, F.struct("place", "sig"))).alias("x"))
    picked = rows.groupBy("key").agg(F.array(F.min_by(row, F.xxhash64("sig", "key")),
                                             F.max_by(row, F.xxhash64("sig", "key"))).alias("x"))
    earlier = "l.key = r.key AND (l.place < r.place OR l.place = r.place AND l.sig < r.sig)"
    tried = settled = None
    for left in (first.select("key", F.inline("x")), picked.select("key", F.inline("x")), rows):
        right = rows if settled is None else rows.join(settled, "sig", "left_anti")
        pairs = (left.alias("l").join(right.alias("r"), F.expr(earlier)).where(possible("l", "r", t))
                 .selectExpr("l.sig AS a", "r.sig AS b").distinct())
        pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        hits = stored(similar_pairs(pairs, sets, t).select(F.col("b").alias("sig")).distinct(), "settled")
        settled = hits if settled is None else settled.union(hits)
    return settled.distinct()


def line_decisions(docs: DataFrame, t: float = SIMILARITY, least: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """((doc_id, number) of removed lines, (doc_id, n_lines) of all rows).

    Lines are what ``\\n`` separates, numbered from 0, their sets the distinct words (A-Z as a-z). A
    line of ``least`` or more words is removed when a line before it, by doc_id and number, has a
    set of Jaccard similarity ``t`` or more; shorter lines and lines without a word always stay. A
    null text is one empty line. Rows with equal doc_id count as one document, a null doc_id comes first; other columns are
    not looked at; an empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = partial(line_parts, least=least)
    texts = docs.select("doc_id", "text")
    scanned = scan_parts(texts, cut, distinct=False)
    levels = spark.sparkContext.broadcast(rarity_levels(scanned))
    shared = shared_prefixes(texts, cut, levels, t, scanned, PREFIX_LANES, ROUNDS)
    lines = scanned.where(F.col("kind") == PART).select(F.col("id").alias("doc_id"), "number", "sig")
    place = F.struct("doc_id", "number")
    firsts = stored(lines.groupBy("sig").agg(F.min(place).alias("place"), F.count("*").alias("c")), "firsts")
    places = firsts.select("sig", "place")
    later = later_matches(shared, candidate_sets(texts, cut, levels, shared), places, t)
    marked = stored(firsts.join(later.withColumn("gone", F.lit(True)), "sig", "left")
                    .where("c > 1 OR gone").select("sig", "place", F.coalesce("gone", F.lit(False)).alias("gone")),
                    "marked")
    removed = (lines.join(marked, "sig").where(F.col("gone") | ~place.eqNullSafe(F.col("place")))
               .select("doc_id", "number"))
    return removed, scanned.where(F.col("kind") == ROW).select(F.col("id").alias("doc_id"), F.col("n").alias("n_lines"))


def _without(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Rows without the lines whose numbers the last column lists; rows that lose their last word go."""
    for batch in batches:
        out, keep = [], []
        for value, numbers in zip(batch.column(text).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            if numbers:
                gone = set(numbers)
                value = "\n".join(x for i, x in enumerate(value.split("\n")) if i not in gone)
            out.append(value)
            keep.append(not numbers or bool(value.strip(" \t\n\v\f\r")))
        columns = batch.columns[:-1]
        columns[text] = pa.array(out, pa.string())
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))


def dedup_lines(docs: DataFrame, t: float = SIMILARITY, least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without the removed lines; a document that loses its last word this way goes too.

    n_chars, where there is such a column, is the length of the new text. All columns of ``docs``
    stay, whatever their names; nulls, empty texts and repeated rows are as in ``line_decisions``,
    and a document that had no word before stays. An empty table gives no rows.
    """
    removed, _ = line_decisions(docs, t, least)
    own, gone = fresh(docs, "of", "gone")
    numbers = removed.distinct().groupBy(F.col("doc_id").alias(own)).agg(F.collect_list("number").alias(gone))
    joined = docs.join(numbers, F.col("doc_id").eqNullSafe(F.col(own)), "left").drop(own)
    out = joined.mapInArrow(partial(_without, text=docs.columns.index("text")), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))
    return out


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: later similar lines go, and documents that held nothing else."""
    return dedup_lines(docs)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document and those removed from it, over the whole table."""
    removed, rows = line_decisions(table(spark, sf_dir, "documents"))
    numbers = removed.groupBy(F.col("doc_id").alias("of")).agg(
        F.count("*").alias("n_removed"), F.array_sort(F.collect_list("number")).alias("removed"))
    return rows.join(numbers, F.col("doc_id").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "n_lines", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"))
