"""Minority synthesis and the two-step resampling of a training split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.functions.draws import draw, draw_unit
from tallyguard.operators.encoding import ordered_index
from tallyguard.operators.neighbours import knn_self_join
from tallyguard.operators.profiling import present
from tallyguard.operators.sampling import ResamplePlan, random_undersample, resample_plan
from tallyguard.session import stored


def _back_to_type(value: Column, dtype: T.DataType) -> Column:
    """Interpolated number in the type of its column: whole numbers truncate, booleans are true
    unless zero."""
    if isinstance(dtype, T.BooleanType):
        return value != 0
    return value.cast(dtype)


def smote_rows(minority: DataFrame, key: Column, features: list[str], n_new: int, k: int = 5,
               seed: int | str = 42, mode: str = "exact") -> DataFrame:
    """``n_new`` synthetic rows between a drawn minority row and one of its k nearest.

    Columns: ``_n`` (0-based number), ``_base`` and ``_near`` (rank keys), the features in their
    own types. Other columns of the base row are kept as they are. A missing feature (null or NaN)
    has no distance and is an error, as is any other number of rows than asked for. ``mode`` is that of
    ``knn_self_join``.
    """
    spark = minority.sparkSession
    missing = minority.agg(*[F.count_if(present(minority, c).isNull()).alias(f"c{i}")
                             for i, c in enumerate(features)]).first() if features else []
    gaps = [c for c, n in zip(features, missing) if n]
    if gaps:
        raise ValueError(f"missing values in minority features {gaps}; impute them first")
    types = {f.name: f.dataType for f in minority.schema}
    others = [c for c in minority.columns if c not in features]
    vec = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    ranked = ordered_index(
        minority.select(key.alias("_rank_key"), vec.alias("_vec"),
                        F.struct(*others).alias("_others") if others else F.lit(0).alias("_others")),
        "_rank_key", out="_idx")
    m = ranked.count()
    if m <= k:
        raise ValueError(f"needs more than {k} minority rows, got {m}")

    number = F.col("id").cast("string")
    draws = spark.range(n_new).select(
        F.col("id").alias("_n"),
        (draw(number, "smote-base", seed) % m).alias("_idx"),
        (draw(number, "smote-near", seed) % k + 1).cast("int").alias("_rank"),
        draw_unit(number, "smote-step", seed).alias("_u"))
    based = stored(draws.join(ranked, "_idx"), "smote-bases")
    near = knn_self_join(ranked.select(F.col("_rank_key").alias("key"), F.col("_vec").alias("vec")), k,
                         queries=based.select(F.col("_rank_key").alias("key")), mode=mode)
    picked = based.join(near.select(F.col("key").alias("_rank_key"), F.col("rank").alias("_rank"),
                                    F.col("neighbour").alias("_near")), ["_rank_key", "_rank"])
    with_near = picked.join(
        ranked.select(F.col("_rank_key").alias("_near"), F.col("_vec").alias("_near_vec")), "_near")

    def value(i: int, c: str) -> Column:
        x, y = F.col("_vec")[i], F.col("_near_vec")[i]
        return _back_to_type(x + F.col("_u") * (y - x), types[c]).alias(c)

    made = {c: value(i, c) for i, c in enumerate(features)}
    made.update({c: F.col(f"_others.`{c}`").alias(c) for c in others})
    rows = stored(with_near.select("_n", F.col("_rank_key").alias("_base"), "_near",
                                   *[made[c] for c in minority.columns]), "smote-rows")
    if rows.count() != n_new:
        raise RuntimeError(f"{n_new} synthetic rows asked for, {rows.count()} made")
    return rows


def feature_columns(df: DataFrame, exclude: tuple[str, ...]) -> list[str]:
    """Columns that take part in distances: numbers and booleans."""
    return [f.name for f in df.schema if f.name not in exclude
            and isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def resample(train: DataFrame, key_col: str, label: str = "label", over: float = 0.1,
             under: float = 0.5, k: int = 5, seed: int | str = 42) -> tuple[DataFrame, ResamplePlan]:
    """Two-step resampling of a training split: synthesis up to ``over``, then undersampling down
    to ``under``; each step only where the class counts call for it."""
    counts = {r[label]: r["n"] for r in
              train.groupBy(label).agg(F.count("*").alias("n")).collect()}
    plan = resample_plan(counts.get(1, 0), counts.get(0, 0), over, under)
    out = train
    if plan.undersample:
        # synthetic rows are minority, so the majority can be thinned before they are added
        out = random_undersample(train, F.col(key_col), under, label,
                                 plan.n_minority + plan.n_synthetic)
    if plan.n_synthetic:
        minority = train.where(F.col(label) == 1)
        made = smote_rows(minority, F.col(key_col), feature_columns(train, (key_col, label)),
                          plan.n_synthetic, k, seed)
        made = made.withColumn(key_col, F.concat(F.lit("smote-"), F.col("_n").cast("string")))
        out = out.unionByName(made.select(*train.columns))
    return out, plan
