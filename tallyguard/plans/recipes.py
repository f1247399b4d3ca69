"""The six preparation recipes: raw table to labelled, split and balanced features.

A recipe has two parts. ``features_<alias>`` turns the raw table into features with a 0/1 label and
keeps the row key. ``prepare`` runs a recipe, splits 80/10/10 per class, balances the training
split and leaves validation and test at their natural ratio.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.functions.columns import age_code, gender_flag, parse_ts_or_null
from tallyguard.operators import cleaning, encoding, profiling, scaling, timewise
from tallyguard.operators.ranking import ROW_KEY, rank_key, with_row_key
from tallyguard.operators.sampling import ResamplePlan, exact_fraction_sample, stratified_split
from tallyguard.operators.smote import resample
from tallyguard.session import stored
from tallyguard.sources import schemas
from tallyguard.sources.files import csv_scan, csv_scan_named, optional_csv, path_exists
from tallyguard.fixed_values import AML_ENCODED, EXPECTED_FILES, PAYSIM_DROPPED

NO_TIME = -1      # time features of a row whose time cannot be read; distances need a number
DOT = "_dot_"     # stands for a dot in column names, which would read as struct access


def _with_key(df: DataFrame, key: str | Column | None) -> DataFrame:
    """Attach the ranking key: a hash of the given key, or a stored content key."""
    if key is None:
        return with_row_key(df)
    return df.withColumn(ROW_KEY, rank_key(key))


def features_ccf(raw: DataFrame, key: str | Column | None = None) -> DataFrame:
    """Scale amount and time under new names, drop the originals."""
    df = _with_key(raw, key)
    fitted = scaling.fit_scaler(df, ["Amount", "Time"])
    df = scaling.standard_scale(df, fitted, {"Amount": "Amount_scaled", "Time": "Time_scaled"})
    return cleaning.rename_label(cleaning.drop_columns(df, ["Amount", "Time"]), "Class")


def features_ieee_cis(txn: DataFrame, identity: DataFrame | None = None) -> DataFrame:
    """Join, drop sparse columns, impute, encode texts, scale the amount."""
    df = cleaning.left_equi_join(txn, identity, "TransactionID") if identity is not None else txn
    df = _with_key(df, "TransactionID")
    if identity is not None:
        df = stored(df, "ieee-joined")          # read by four fitting passes below
    df = cleaning.drop_high_null(df, 0.50, keep=(ROW_KEY, "isFraud"))
    df = cleaning.drop_columns(df, ["TransactionID"])
    numeric = profiling.numeric_columns(df, exclude=("isFraud",))
    text = profiling.text_columns(df, exclude=(ROW_KEY,))
    df = scaling.impute(df, scaling.fit_imputer(df, numeric, text))
    df = encoding.label_encode(df, text)
    df = scaling.standard_scale(df, scaling.fit_scaler(df, ["TransactionAmt"]))
    return cleaning.rename_label(df, "isFraud")


def features_paysim(raw: DataFrame, key: str | Column | None = None,
                    fraction: float | None = None) -> DataFrame:
    """Balance features, one-hot type, drop leaky columns, scale; an exact sample only where asked for."""
    df = cleaning.balance_features(_with_key(raw, key))
    df = encoding.one_hot(df, "type", prefix="type")
    df = cleaning.drop_columns(df, PAYSIM_DROPPED)
    df = scaling.standard_scale(df, scaling.fit_scaler(df, ["amount"]))
    df = cleaning.rename_label(df, "isFraud")
    return df if fraction is None else exact_fraction_sample(df, F.col(ROW_KEY), fraction)


def features_ibm_aml(raw: DataFrame, key: str | Column | None = None,
                     ts_format: str | tuple[str, ...] | None = None) -> DataFrame:
    """Snake case, time features, running count per account, encode, scale the amount."""
    df = cleaning.snake_case_columns(_with_key(raw, key))
    df = df.toDF(*[c.replace(".", DOT) for c in df.columns])
    df = df.withColumn("timestamp", parse_ts_or_null("timestamp", ts_format))
    times = ["hour_of_day", "day_of_week", "day_of_month"]
    df = timewise.time_features(df, "timestamp").fillna(NO_TIME, times)
    df = timewise.running_txn_count(df, "account", "timestamp", F.col(ROW_KEY))
    df = stored(df, "aml-velocity")             # the count shuffles all rows; fit passes reuse it
    encoded = [c.replace(".", DOT) for c in AML_ENCODED]
    df = encoding.label_encode(df, [c for c in encoded if c in df.columns])
    df = cleaning.drop_columns(df, ["timestamp"])
    df = scaling.standard_scale(df, scaling.fit_scaler(df, ["amount_paid"]))
    df = cleaning.copy_optional_column(df, "laundering_type", "laundering_type_label")
    return cleaning.rename_label(df, "is_laundering")


def features_elliptic(features: DataFrame, classes: DataFrame) -> DataFrame:
    """Join classes, drop unlabelled rows, map the class, scale everything but the time step."""
    known = cleaning.filter_unlabelled(classes)          # before the join, so less is shuffled
    df = _with_key(cleaning.inner_equi_join(features, known, "txId"), "txId")
    df = cleaning.label_from_class(df)
    df = stored(cleaning.drop_columns(df, ["txId", "class"]), "elliptic-joined")
    cols = [c for c in df.columns if c not in ("label", "time_step", ROW_KEY)]
    return scaling.standard_scale(df, scaling.fit_scaler(df, cols))


def features_banksim(raw: DataFrame, key: str | Column | None = None) -> DataFrame:
    """Strip quotes, code age and gender, encode merchant, category and customer, scale."""
    df = _with_key(raw, key)
    texts = profiling.text_columns(df, exclude=(ROW_KEY,))
    df = df.withColumns({c: cleaning.strip_quotes(c) for c in texts})
    df = df.withColumns({"age": age_code("age"), "gender": gender_flag("gender")})
    df = encoding.label_encode(df, ["merchant", "category", "customer"])
    df = scaling.standard_scale(df, scaling.fit_scaler(df, ["amount"]))
    return cleaning.rename_label(df, "fraud").withColumn("label", F.col("label").cast("int"))


@dataclass
class Prepared:
    """Result of a recipe: the rows with ``label`` and ``split``, and what was done to train."""

    rows: DataFrame
    plan: ResamplePlan
    class_weights: DataFrame | None = None


def prepare(features: DataFrame, weights: bool = False) -> Prepared:
    """Split features 80/10/10 per class and balance the training split."""
    features = stored(features, "features")
    split = stratified_split(features, F.col(ROW_KEY))
    train, plan = resample(split.where("split = 'train'").drop("split"), ROW_KEY)
    held_out = split.where("split <> 'train'")
    train = train.withColumn("split", F.lit("train"))
    rows = train.unionByName(held_out).drop(ROW_KEY)
    order = [c for c in rows.columns if c not in ("label", "split")]
    rows = rows.select(*[F.col(f"`{c}`").alias(c.replace(DOT, ".")) for c in order],
                       F.col("label").cast("int").alias("label"), "split")
    return Prepared(rows, plan, plan_weights(features.sparkSession, plan) if weights else None)


def plan_weights(spark: SparkSession, plan: ResamplePlan) -> DataFrame:
    """Balanced class weights of the resampled training split, from the plan's row numbers."""
    rows = {0: plan.keep_majority, 1: plan.n_minority + plan.n_synthetic}
    rows = {c: n for c, n in rows.items() if n}
    return spark.createDataFrame([(c, sum(rows.values()) / (len(rows) * n)) for c, n in rows.items()],
                                 "label int, weight double")


def _ccf(spark: SparkSession, d: str) -> DataFrame | None:
    raw = optional_csv(spark, f"{d}/{EXPECTED_FILES['ccf'][0]}", schemas.CCF, "ccf", by_header=True)
    return None if raw is None else features_ccf(raw)


def _ieee_cis(spark: SparkSession, d: str) -> DataFrame | None:
    txn_file, id_file = (f"{d}/{f}" for f in EXPECTED_FILES["ieee_cis"])
    txn = optional_csv(spark, txn_file, name="ieee_cis")
    if txn is None:
        return None
    identity = csv_scan(spark, id_file) if path_exists(spark, id_file) else None
    return features_ieee_cis(txn, identity)


def _paysim(spark: SparkSession, d: str) -> DataFrame | None:
    raw = optional_csv(spark, f"{d}/{EXPECTED_FILES['paysim'][0]}", schemas.PAYSIM, "paysim", by_header=True)
    return None if raw is None else features_paysim(raw)


def _ibm_aml(spark: SparkSession, d: str) -> DataFrame | None:
    raw = optional_csv(spark, f"{d}/{EXPECTED_FILES['ibm_aml'][0]}", schemas.IBM_AML, "ibm_aml",
                       by_header=True)
    return None if raw is None else features_ibm_aml(raw)


def _elliptic(spark: SparkSession, d: str) -> DataFrame | None:
    features_file, classes_file = (f"{d}/{f}" for f in EXPECTED_FILES["elliptic"][:2])
    if not path_exists(spark, features_file):
        print(f"[elliptic] skipped, file not found: {features_file}")
        return None
    return features_elliptic(csv_scan_named(spark, features_file, schemas.ELLIPTIC_FEATURES),
                             csv_scan(spark, classes_file, schemas.ELLIPTIC_CLASSES))


def _banksim(spark: SparkSession, d: str) -> DataFrame | None:
    raw = optional_csv(spark, f"{d}/{EXPECTED_FILES['banksim'][0]}", schemas.BANKSIM, "banksim", by_header=True)
    return None if raw is None else features_banksim(raw)


RECIPES: dict[str, Callable[[SparkSession, str], DataFrame | None]] = {
    "ccf": _ccf, "ieee_cis": _ieee_cis, "paysim": _paysim,
    "ibm_aml": _ibm_aml, "elliptic": _elliptic, "banksim": _banksim,
}
WITH_WEIGHTS = ("ccf", "ieee_cis")


def dataset_recipe(spark: SparkSession, alias: str, data_dir: str) -> Prepared | None:
    """Run the recipe of one data set on its raw files; None if they are absent."""
    features = RECIPES[alias](spark, data_dir.rstrip("/"))
    return None if features is None else prepare(features, alias in WITH_WEIGHTS)


def preprocess_all(spark: SparkSession, data_dir: str, out_dir: str) -> dict[str, dict]:
    """All recipes in sequence, each written as splits; returns the counts per data set."""
    from tallyguard.sources.sinks import save_splits

    counts = {}
    for alias in RECIPES:
        done = dataset_recipe(spark, alias, data_dir)
        if done is not None:
            counts[alias] = save_splits(done.rows, out_dir, alias)
            print(f"[{alias}] {counts[alias]}")
            if done.class_weights is not None:
                print(f"[{alias}] class weights: {done.class_weights.collect()}")
    return counts
