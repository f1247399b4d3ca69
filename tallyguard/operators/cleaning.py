"""Column clean-up and the two equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.columns import class_code, strip_quotes
from tallyguard.operators.profiling import null_fraction, text_columns


def rename_label(df: DataFrame, col: str, label: str = "label") -> DataFrame:
    """Rename the source label column."""
    return df.withColumnRenamed(col, label)


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name and replace spaces by underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns, ignoring absent ones."""
    return df.drop(*cols)


def high_null_columns(df: DataFrame, threshold: float = 0.50) -> list[str]:
    """Columns whose null share is strictly above the threshold."""
    shares = null_fraction(df).first().asDict()
    return [c for c in df.columns if shares[c] is not None and shares[c] > threshold]


def drop_high_null(df: DataFrame, threshold: float = 0.50, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop the columns found by ``high_null_columns``, except the ones to keep."""
    return df.drop(*[c for c in high_null_columns(df, threshold) if c not in keep])


def filter_unlabelled(df: DataFrame, col: str = "class", marker: str = "unknown") -> DataFrame:
    """Keep rows with a known class; rows with a null class are dropped as well."""
    return df.where(F.col(col) != marker)


def label_from_class(df: DataFrame, col: str = "class") -> DataFrame:
    """Add the 0/1 label of a class column."""
    return df.withColumn("label", class_code(col))


def class_filter(df: DataFrame, value: int, label: str = "label") -> DataFrame:
    """Rows of one class."""
    return df.where(F.col(label) == value)


def balance_features(df: DataFrame) -> DataFrame:
    """Balance changes of both parties and the amount relative to the payer's balance."""
    return df.withColumns({
        "balance_diff_orig": F.col("newbalanceOrig") - F.col("oldbalanceOrg"),
        "balance_diff_dest": F.col("newbalanceDest") - F.col("oldbalanceDest"),
        "amount_to_balance_ratio": F.try_divide("amount", F.col("oldbalanceOrg") + F.lit(1e-9)),
    })


def copy_optional_column(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Copy a column under a second name if it exists."""
    return df.withColumn(dst, F.col(src)) if src in df.columns else df


def strip_text_columns(df: DataFrame) -> DataFrame:
    """Strip quotes from every text column."""
    return df.withColumns({c: strip_quotes(c) for c in text_columns(df)})


def left_equi_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on one key. Clashing names get ``_x`` and ``_y``; null keys never match.

    The physical strategy is left to the adaptive planner, which also splits skewed keys.
    """
    clash = (set(left.columns) & set(right.columns)) - {key}
    left = left.withColumnsRenamed({c: f"{c}_x" for c in clash})
    right = right.withColumnsRenamed({c: f"{c}_y" for c in clash})
    return left.join(right, key, "left")


def inner_equi_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on one key."""
    return left.join(right, key, "inner")
