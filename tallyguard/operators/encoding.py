"""Category dictionaries, label encoding and one-hot columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.columns import to_text
from tallyguard.operators.profiling import value_counts
from tallyguard.session import stored

BROADCAST_VALUES = 100_000     # dictionaries up to this many values are broadcast
ROWS_PER_ID_BLOCK = 1 << 33    # monotonically_increasing_id: partition number above bit 33


def ordered_index(df: DataFrame, *order: str, out: str = "idx") -> DataFrame:
    """Number the rows 0..n-1 in the given order without a single-partition window.

    The rows are range-sorted and stored once with their (partition, position) id; the running
    number is the position plus the sizes of the earlier partitions, a list as short as the number
    of partitions.
    """
    run = stored(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "ordered")
    block = F.shiftright("_id", 33)
    sizes = run.groupBy(block.alias("b")).agg(F.count("*").alias("n")).orderBy("b").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["b"], total))
        total += r["n"]
    # one row per partition of the stored run, so always small enough to broadcast
    offsets = df.sparkSession.createDataFrame(starts, "_block bigint, _start bigint")
    position = F.col("_id").bitwiseAND(F.lit(ROWS_PER_ID_BLOCK - 1))
    return (run.join(F.broadcast(offsets), block == F.col("_block"))
            .withColumn(out, F.col("_start") + position).drop("_id", "_block", "_start"))


def fit_vocabulary(df: DataFrame, cols: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """Dictionary (column, value, code) of sorted distinct texts, codes from 0, and its sizes."""
    counts = stored(
        value_counts(df.select(*[to_text(c).alias(c) for c in cols]), cols), "value-counts"
    )
    sizes = {r["column"]: r["n"] for r in
             counts.groupBy("column").agg(F.count("*").alias("n")).collect()}
    indexed = ordered_index(counts.select("column", "value"), "column", "value")
    start, before = {}, 0
    for c in sorted(sizes, key=lambda s: s.encode()):
        start[c], before = before, before + sizes[c]
    first = F.coalesce(*[F.when(F.col("column") == c, n) for c, n in start.items()], F.lit(0))
    return indexed.select("column", "value", (F.col("idx") - first).cast("bigint").alias("code")), sizes


def dictionary_join(df: DataFrame, vocab: DataFrame, col: str, size: int | None = None,
                    out: str | None = None) -> DataFrame:
    """Replace a column by its code. Only dictionaries of checked size are broadcast; a larger one
    is joined by shuffle, where the adaptive planner splits hot values."""
    entry = vocab.where(F.col("column") == col).select(
        F.col("value").alias("_value"), F.col("code").alias("_code"))
    if size is not None and size <= BROADCAST_VALUES:
        entry = F.broadcast(entry)
    joined = df.join(entry, to_text(col) == F.col("_value"), "left").drop("_value")
    target = out or col
    order = [c for c in df.columns] + ([target] if target not in df.columns else [])
    return joined.withColumn(target, F.col("_code")).select(*order)


def label_encode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace text columns by the rank of their value among the sorted distinct values."""
    if not cols:
        return df
    vocab, sizes = fit_vocabulary(df, cols)
    for c in cols:
        df = dictionary_join(df, vocab, c, sizes.get(c, 0))
    return df


def fit_categories(df: DataFrame, col: str, limit: int | None = None) -> list[str]:
    """Sorted non-null categories of a column that is to become columns itself.

    The schema holds them all, so there is no bound unless ``limit`` asks for an error beyond it.
    """
    found = df.select(F.col(col).cast("string").alias("v")).where("v is not null").distinct()
    rows = (found if limit is None else found.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} categories; use label_encode")
    return sorted((r["v"] for r in rows), key=lambda s: s.encode())


def one_hot_columns(col: str, categories: list[str], prefix: str) -> dict[str, Column]:
    """Boolean expression per category; null matches none."""
    return {f"{prefix}_{v}": F.coalesce(F.col(col).cast("string") == v, F.lit(False))
            for v in categories}


def one_hot(df: DataFrame, col: str, prefix: str | None = None,
            categories: list[str] | None = None) -> DataFrame:
    """Replace a column by one boolean column per category."""
    cats = fit_categories(df, col) if categories is None else categories
    return df.withColumns(one_hot_columns(col, cats, prefix or col)).drop(col)
