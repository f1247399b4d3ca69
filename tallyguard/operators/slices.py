"""Running sums over a long order, computed in slices.

A window over a whole group puts a hot group into one task. Here the order axis is cut at a few
quantiles; each (group, slice) is summed first, the slice totals are accumulated per group (as many
rows as slices), and rows only need their position inside their own slice. Any cut points give the
right result, they only balance the work.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_SLICES = 16
MAX_SLICES = 4_096


def slice_number(df: DataFrame) -> int:
    """Slices to cut, from the shuffle width of the session."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(MIN_SLICES, min(MAX_SLICES, width))


def fit_slices(df: DataFrame, order: str, step: float, slices: int | None = None) -> tuple[list[float], list[float]]:
    """Cut points of a numeric column, and the values that fill whole slices by themselves.

    Such a hot value gets a slice of its own, ``[value, value + step)``; ``step`` is the smallest
    difference between two values.
    """
    n = slices or slice_number(df)
    row = df.agg(F.percentile_approx(F.col(order).cast("double"), [i / n for i in range(1, n)],
                                     10_000).alias("q")).first()
    marks = row["q"] or []
    hot = sorted({a for a, b in zip(marks, marks[1:]) if a == b})
    cuts = sorted(set(marks) | {h + step for h in hot})
    return cuts, hot


def add_slice(df: DataFrame, order: str, cuts: list[float], out: str = "_slice") -> DataFrame:
    """Number of the slice a row falls into; missing values get the slice after the last."""
    if not cuts:
        return df.withColumn(out, F.when(F.col(order).isNull(), F.lit(1)).otherwise(F.lit(0)))
    numbered = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")], inputCol="_axis", outputCol="_axis_slice"
    ).transform(df.withColumn("_axis", F.coalesce(F.col(order).cast("double"), F.lit(cuts[-1]))))
    return numbered.withColumn(
        out, F.when(F.col(order).isNull(), F.lit(len(cuts) + 1))
        .otherwise(F.col("_axis_slice").cast("int"))
    ).drop("_axis", "_axis_slice")


def earlier_totals(sliced: DataFrame, group: list[str], slice_cols: list[str],
                   sums: dict[str, "F.Column"]) -> DataFrame:
    """Per (group, slice) the sums over all earlier slices of the group."""
    totals = sliced.groupBy(*group, *slice_cols).agg(*[e.alias(n) for n, e in sums.items()])
    w = (Window.partitionBy(*group).orderBy(*slice_cols)
         .rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(*group, *slice_cols, *[
        F.coalesce(F.sum(n).over(w), F.lit(0)).alias(n) for n in sums])
