"""Profiling aggregates: class counts, null shares, medians, modes, categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.session import stored

READ_OUT_VALUES = 1_000_000      # a bracket with about this many rows is counted out


def class_report(df: DataFrame, alias: str, label: str = "label") -> DataFrame:
    """Rows, fraud rows and fraud percentage (3 decimals) of one data set."""
    return df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("fraud"),
        F.round(100 * F.avg(F.col(label).cast("double")), 3).alias("fraud_pct"),
    ).select(F.lit(alias).alias("dataset"), "rows", "fraud", "fraud_pct")


def null_fraction(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row with the null share of every column, from one pass."""
    return df.agg(*[F.avg(present(df, c).isNull().cast("int")).alias(c) for c in cols or df.columns])


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns (booleans excluded) without the listed ones, as a set difference."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)
            and f.name not in exclude]


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """String columns without the listed ones."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)
            and f.name not in exclude]


def present(df: DataFrame, c: str) -> Column:
    """The column's value; NaN counts as missing."""
    value = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def column_medians(df: DataFrame, cols: list[str]) -> dict:
    """Exact medians of many columns at once, missing values ignored, midpoint between two.

    One aggregation makes a mergeable quantile sketch of every column; its grid brackets the middle
    ranks. Only the values inside the brackets are then counted, in one more pass. Where a bracket
    would still hold more than READ_OUT_VALUES rows it is sketched again, which narrows it about a
    hundredfold; where the sketch missed the middle, the bracket is widened. What is brought to the
    driver is one row.
    """
    values = {i: present(df, c).cast("double") for i, c in enumerate(cols)}
    brackets: dict[int, tuple[float, float] | None] = {i: None for i in values}      # still to be sketched
    slack = dict.fromkeys(values, 2)
    ranks: dict[int, tuple[int, int]] = {}
    found: dict[int, tuple[float, float]] = {}
    while brackets:
        few = {}
        for i, (n, below, grid) in _sketched(df, values, brackets).items():
            del brackets[i]
            if n == 0 and i not in ranks:
                continue
            ranks.setdefault(i, ((n + 1) // 2, n // 2 + 1))
            bracket = _middle(n, below, grid, ranks[i], slack[i])
            if bracket is None:
                slack[i] *= 4
                brackets[i] = None
            elif bracket[0] == bracket[1] and bracket == (grid[0], grid[-1]):
                found[i] = bracket
            elif n * (2 * slack[i] + 2) > READ_OUT_VALUES * GRID and bracket != (grid[0], grid[-1]):
                brackets[i] = bracket
            else:
                few[i] = bracket
        for i, middle in _counted_ranks(df, values, few, ranks).items():
            if middle is None:
                slack[i] *= 4
                brackets[i] = None
            else:
                found[i] = middle
    return {c: None if i not in found else sum(found[i]) / 2 for i, c in enumerate(cols)}


SKETCH_SIZE = 2_048      # rank error of about a quarter of a per cent
GRID = 400               # steps of a sketch's quantile grid


def _sketched(df: DataFrame, values: dict[int, Column], brackets: dict) -> dict[int, tuple[int, int, list[float]]]:
    """(rows inside, rows below, quantile grid) of every column's bracket, from one aggregation."""
    grid = F.array(*[F.lit(g / GRID) for g in range(GRID + 1)])
    sums, shown = [], []
    for i, bracket in brackets.items():
        v = values[i]
        inside = v if bracket is None else F.when(v.between(*bracket), v)
        below = F.lit(0) if bracket is None else F.count_if(v < bracket[0])
        sums += [F.count(inside).alias(f"n{i}"), below.alias(f"b{i}"),
                 F.kll_sketch_agg_double(inside, SKETCH_SIZE).alias(f"s{i}")]
        shown += [f"n{i}", f"b{i}", F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", grid)).alias(f"g{i}")]
    row = df.agg(*sums).select(*shown).first()
    return {i: (row[f"n{i}"], row[f"b{i}"], row[f"g{i}"]) for i in brackets}


def _middle(n: int, below: int, grid: list[float] | None, ranks: tuple[int, int], slack: int) -> tuple[float, float] | None:
    """The part of the grid around the middle ranks; None where they are not inside."""
    one, two = (k - below for k in ranks)
    if one < 1 or two > n:
        return None
    return grid[max(0, int(one / n * GRID) - slack)], grid[min(GRID, int(two / n * GRID) + 1 + slack)]


def _counted_ranks(df: DataFrame, values: dict[int, Column], ranges: dict, ranks: dict) -> dict[int, tuple | None]:
    """Both middle values of the columns whose ``ranges`` are given; None where a range misses one."""
    if not ranges:
        return {}
    seen = Observation()
    below = df.observe(seen, *[F.count_if(values[i] < low).alias(f"b{i}") for i, (low, _) in ranges.items()])
    inside = F.array_compact(F.array(*[
        F.when(values[i].between(low, high), F.struct(F.lit(i).alias("c"), values[i].alias("v")))
        for i, (low, high) in ranges.items()]))
    counts = stored(below.select(F.explode(inside).alias("p")).groupBy("p.c", "p.v").agg(F.count("*").alias("n")), "counts")
    rows = [(i, *(k - seen.get[f"b{i}"] for k in ranks[i])) for i in ranges]
    wanted = df.sparkSession.createDataFrame(rows, "c int, one long, two long")
    upto = F.sum("n").over(Window.partitionBy("c").orderBy("v"))
    middle = counts.withColumn("upto", upto).join(F.broadcast(wanted), "c").groupBy("c", "one").agg(
        F.min(F.when(F.col("upto") >= F.col("one"), F.col("v"))).alias("a"),
        F.min(F.when(F.col("upto") >= F.col("two"), F.col("v"))).alias("b")).collect()
    found = {r["c"]: (r["a"], r["b"]) for r in middle if r["one"] >= 1 and r["b"] is not None}
    return {i: found.get(i) for i in ranges}


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long table (column, value as text, rows) of several columns from one shuffle."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])
    return (df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")
            .groupBy("column", "value").agg(F.count("*").alias("rows")))


def column_modes(counts: DataFrame) -> DataFrame:
    """Most frequent non-null value per column of a ``value_counts`` table; ties: the smallest."""
    return (counts.where(F.col("value").isNotNull()).groupBy("column")
            .agg(F.min_by("value", F.struct(-F.col("rows"), F.col("value"))).alias("mode")))


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count("*").alias("rows"))


def minority_ratio(df: DataFrame, label: str = "label") -> DataFrame:
    """Minority and majority rows and their ratio."""
    return df.agg(
        F.count_if(F.col(label) == 1).alias("n_minority"),
        F.count_if(F.col(label) == 0).alias("n_majority"),
    ).withColumn("ratio", F.try_divide(F.col("n_minority").cast("double"), F.col("n_majority")))


def balanced_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """n / (classes * rows of the class), from the class counts."""
    counts = class_counts(df, label)
    totals = counts.agg(F.sum("rows").alias("n"), F.count("*").alias("k"),
                        F.collect_list(F.struct(F.col(label), "rows")).alias("classes"))
    return (totals.select("n", "k", F.explode("classes").alias("c"))
            .select(F.col(f"c.{label}").alias(label),
                    (F.col("n") / (F.col("k") * F.col("c.rows"))).alias("weight")))


def distinct_sorted(df: DataFrame, c: str) -> DataFrame:
    """Sorted category list of a column."""
    return df.select(c).distinct().orderBy(c)


def split_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows, fraud and legit per split x data set, with per-split totals (dataset null)."""
    return df.rollup("split", "dataset").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(label) == 1).alias("fraud"),
        F.count_if(F.col(label) == 0).alias("legit"),
    ).where(F.col("split").isNotNull())
