"""Nearest neighbours and synthesis against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.operators import neighbours as N
from tallyguard.operators.neighbours import best_in_block, knn_self_join
from tallyguard.operators.ranking import rank_key
from tallyguard.operators.smote import resample, smote_rows


def brute_force(keys, x, k):
    out = {}
    for i, key in enumerate(keys):
        d = ((x - x[i]) ** 2).sum(1)
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: (d[j], keys[j]))[:k]
        out[key] = [keys[j] for j in order]
    return out


@pytest.mark.parametrize("sizes", [{}, {"pivot_share": 0.4, "query_block": 16, "search_block": 32}, {"pivot_share": 0}])
@pytest.mark.parametrize("dims, copies", [(2, 0), (3, 90), (20, 0)])
def test_knn_is_exact(spark, sizes, dims, copies):
    """One cell and many, small blocks, and a third of the points being copies of one point."""
    rng = np.random.default_rng(dims)
    x = np.round(rng.normal(size=(270, dims)), 1)
    x[:copies] = x[0]
    keys = [f"k{i:03d}" for i in range(len(x))]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in zip(keys, x)], "key string, vec array<double>")
    got = {}
    for r in knn_self_join(df, 5, **sizes).collect():
        got.setdefault(r["key"], {})[r["rank"]] = r["neighbour"]
    want = brute_force(keys, x, 5)
    assert {k: [v[i] for i in range(1, 6)] for k, v in got.items()} == want


def test_best_in_block_with_fewer_points_than_asked():
    q, s, d = best_in_block(np.zeros((2, 1)), np.array([[1.0], [2.0]]), np.array(["a", "b"], dtype=object), 6)
    assert q.tolist() == [0, 0, 1, 1] and s.tolist() == [0, 1, 0, 1] and d.tolist() == [1.0, 4.0, 1.0, 4.0]


def test_synthetic_rows_lie_between_their_parents(spark):
    df = spark.range(40).select("id", (F.col("id") * 1.5).alias("a"), (F.col("id") % 7).cast("int").alias("b"),
                                (F.col("id") % 2 == 0).alias("c"), F.lit("kept").alias("note"))
    made = smote_rows(df, rank_key("id"), ["a", "b", "c"], 60)
    assert made.count() == 60
    assert made.schema["b"].dataType == T.IntegerType() and made.schema["c"].dataType == T.BooleanType()
    rows = df.select(rank_key("id").alias("k"), "a", "b", "c").collect()
    known = {r["k"]: r for r in rows}
    for r in made.collect():
        x, y = known[r["_base"]], known[r["_near"]]
        assert min(x["a"], y["a"]) - 1e-9 <= r["a"] <= max(x["a"], y["a"]) + 1e-9
        assert min(x["b"], y["b"]) <= r["b"] <= max(x["b"], y["b"])
        assert r["c"] or not (x["c"] and y["c"])
        assert r["note"] == "kept"


def test_too_few_minority_rows(spark):
    df = spark.range(5).withColumn("a", F.col("id") * 1.0)
    with pytest.raises(ValueError, match="minority"):
        smote_rows(df, rank_key("id"), ["a"], 3)


@pytest.mark.parametrize("gap", [None, float("nan")])
def test_missing_features_are_an_error(spark, gap):
    rows = [(i, float(i), None if i == 3 and gap is None else gap if i == 3 else 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    with pytest.raises(ValueError, match="b"):
        smote_rows(df, rank_key("id"), ["a", "b"], 10)


def test_resample_reaches_the_targets(spark):
    df = spark.range(1_060).select(rank_key("id").alias("k"), (F.col("id") * 1.0).alias("a"),
                                   (F.col("id") < 60).cast("int").alias("label"))
    out, plan = resample(df, "k")
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {1: 100, 0: 200} and plan.n_synthetic == 40
    assert out.select("k").distinct().count() == 300
    skipped, plan = resample(df.withColumn("label", (F.col("a") < 500).cast("int")), "k")
    assert skipped.count() == 1_060 and not plan.undersample


def recall(got, want):
    return np.mean([len(set(got[k]) & set(v)) / len(v) for k, v in want.items()])


@pytest.mark.parametrize("dims, clusters", [(6, 0), (24, 0), (24, 30)])
def test_hashed_neighbours_are_most_of_the_nearest(spark, dims, clusters):
    rng = np.random.default_rng(dims + clusters)
    x = rng.normal(size=(4000, dims))
    if clusters:
        x += 4 * rng.normal(size=(clusters, dims))[rng.integers(0, clusters, len(x))]
    x[:700] = x[0]                                          # a large group of copies
    keys = [f"k{i:04d}" for i in range(len(x))]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in zip(keys, x)], "key string, vec array<double>").repartition(6)
    asked = df.where("key LIKE '%7'")
    got = {}
    rows = knn_self_join(df, 5, queries=asked, mode="hashed", bucket=0.5).collect()
    for r in rows:
        got.setdefault(r["key"], {})[r["rank"]] = r["neighbour"]
    want = {k: v for k, v in brute_force(keys, x, 5).items() if k.endswith("7")} if dims == 6 else None
    if want is None:
        exact = {}
        for r in knn_self_join(df, 5, queries=asked).collect():
            exact.setdefault(r["key"], {})[r["rank"]] = r["neighbour"]
        want = {k: list(v.values()) for k, v in exact.items()}
    assert got.keys() == want.keys() and all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())
    assert recall({k: list(v.values()) for k, v in got.items()}, want) >= 0.9


def test_hashed_search_finds_k_even_in_empty_buckets(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    keys = [f"k{i:03d}" for i in range(len(x))]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in zip(keys, x)], "key string, vec array<double>")
    rows = knn_self_join(df, 5, mode="hashed", tables=1, probes=1, bucket=0.01).collect()
    assert len(rows) == 1500
    with pytest.raises(ValueError):
        knn_self_join(df, 5, mode="quick")


def test_probes_are_the_nearest_buckets():
    margins = np.array([[0.5, -0.1, 2.0], [-1.0, 0.2, 0.3]])
    assert N.probe_codes(margins, 4).tolist() == [[5, 7, 4, 6], [6, 4, 2, 0]]
    assert N.probe_codes(np.zeros((2, 0)), 9).tolist() == [[0], [0]]
