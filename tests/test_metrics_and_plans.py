"""Metrics on hand-computed cases, and the shape of physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from tallyguard import catalog
from tallyguard.functions import prompts as P
from tallyguard.operators import metrics as M


def cells(spark, rows):
    df = spark.createDataFrame(rows, "dataset string, y_true int, y_pred int, y_score double")
    return M.score_cells(df)


def test_hand_computed(spark):
    c = cells(spark, [("a", 1, 1, 0.9), ("a", 1, 0, 0.4), ("a", 0, 1, 0.4), ("b", 0, 0, 0.1), ("b", 0, 0, 0.1)])
    m = M.score_metrics(M.confusion_matrix(c)).first()
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (2, 1, 1, 1)
    assert (m["precision"], m["recall"], m["f1"]) == (0.5, 0.5, 0.5)
    assert m["mcc"] == pytest.approx((2 * 1 - 1 * 1) / 6)
    assert M.auroc(c).first()["auroc"] == pytest.approx((3 + 2.5) / 6)
    rows = {r["dataset"]: r for r in M.per_dataset_breakdown(c).collect()}
    assert (rows["b"]["f1"], rows["b"]["n_fraud"], rows["(all)"]["n_rows"]) == (0.0, 0, 5)


def test_one_class_only(spark):
    c = cells(spark, [("a", 0, 0, 0.2), ("a", 0, 0, 0.7)])
    m = M.score_metrics(M.confusion_matrix(c)).first()
    assert (m["tn"], m["tp"], m["f1"], m["mcc"]) == (2, 0, 0.0, 0.0)
    assert M.auroc(c).first()["auroc"] is None
    assert {r["name"]: r["support"] for r in M.classification_report(c).collect()}["Fraud"] == 0


@pytest.mark.parametrize("slices", [2, 50])
def test_auroc_in_slices(spark, slices):
    df = spark.range(500).select(F.lit("a").alias("dataset"), (F.col("id") % 3 == 0).cast("int").alias("y_true"),
                                 F.lit(0).alias("y_pred"), ((F.col("id") * 37) % 101 / 7).alias("y_score"))
    rows = df.collect()
    pos, neg = ([r["y_score"] for r in rows if r["y_true"] == t] for t in (1, 0))
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.auroc(M.score_cells(df), slices).first()["auroc"] == pytest.approx(want)


def test_completion_split(spark):
    h = P.RESPONSE_HEADER
    df = spark.createDataFrame([(f"a{h}b{h}c",), ("plain",), (h,)], "t string")
    got = [tuple(r["s"]) for r in df.select(P.completion_split("t").alias("s")).collect()]
    assert got == [(f"a{h}b{h}", "c"), ("", "plain"), (h, "")]


def test_token_count(spark):
    df = spark.createDataFrame([("",), ("  a  b\n\tc ",), ("x",)], "t string")
    assert [r[0] for r in df.select(P.token_count("t")).collect()] == [0, 3, 1]
    assert df.select(P.truncate_tokens("t", 2)).collect()[1][0] == "a b"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


FACT_QUERIES = ["w1_running_txn_count", "w2_txn_count_24h", "w4_stratified_cap", "w5_stratified_split",
                "o2_exact_fraction_sample", "o5_random_undersample", "o1_sort", "e3_label_encode",
                "m7_row_to_example", "f22_score_normalize", "a17_customer_spending_profile"]


@pytest.mark.parametrize("name", FACT_QUERIES)
def test_no_single_partition_over_facts(spark, sf_dir, name):
    assert "SinglePartition" not in plan_of(catalog.QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_join(spark, sf_dir, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan_of(catalog.QUERIES[name](spark, sf_dir)))


@pytest.mark.parametrize("name", ["w4_stratified_cap", "w5_stratified_split", "o2_exact_fraction_sample",
                                  "o5_random_undersample", "m7_row_to_example", "f22_score_normalize"])
def test_no_shuffle_and_no_python(spark, sf_dir, name):
    plan = plan_of(catalog.QUERIES[name](spark, sf_dir))
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan


def test_responses_are_parsed_once_per_row(spark, sf_dir):
    plan = plan_of(catalog.QUERIES["f22_score_normalize"](spark, sf_dir))
    assert plan.count("parse_json") + plan.count("parseJson") <= 4
