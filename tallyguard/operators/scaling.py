"""Imputation and standard scaling: fit in one small aggregate, apply lazily."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.operators.profiling import column_medians, column_modes, present, value_counts


def fit_imputer(df: DataFrame, numeric: list[str], text: list[str]) -> dict:
    """Fill value per column: the median of numbers, the mode of texts."""
    fills = column_medians(df, numeric)
    if text:
        fills.update({r["column"]: r["mode"] for r in
                      column_modes(value_counts(df, text)).collect()})
    return fills


def impute(df: DataFrame, fills: dict) -> DataFrame:
    """Fill missing values (NaN counts as missing in floating-point columns).

    A whole-number column with a fractional median becomes double, as the fill value demands.
    """
    out = {}
    for c, v in fills.items():
        if v is None:
            continue
        dtype = df.schema[c].dataType
        value = F.col(c)
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(c), F.col(c))
        elif isinstance(dtype, T.IntegralType) and float(v).is_integer():
            v = int(v)
        fill = F.lit(v) if isinstance(v, float) else F.lit(v).cast(dtype)
        out[c] = F.coalesce(value, fill)
    return df.withColumns(out) if out else df


def fit_scaler(df: DataFrame, cols: list[str], fit_on: str = "all") -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, NaN and null left out; a zero deviation becomes 1.

    ``fit_on="train"`` uses the rows of the training split only, so nothing leaks from the
    held-out splits; the default uses all rows.
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    if not cols:
        return {}
    if fit_on == "train":
        df = df.where(F.col("split") == "train")
    row = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(present(df, c).cast("double")).alias(f"m{i}"),
        F.stddev_pop(present(df, c).cast("double")).alias(f"s{i}"))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(cols)}


def standard_scale(df: DataFrame, fitted: dict[str, tuple[float, float]],
                   names: dict[str, str] | None = None) -> DataFrame:
    """(x - mean) / deviation, in place or under the new names given."""
    names = names or {}
    return df.withColumns({
        names.get(c, c): (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
        for c, (m, s) in fitted.items() if m is not None
    }) if fitted else df
