"""Length batches against a plain loop, and the exact regression against its own conditions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.operators import sampling
from tallyguard.operators.ranking import rank_key
from tallyguard.plans.baseline_model import predict, train_newton


@pytest.mark.parametrize("seed", [42, 7])
def test_length_batches(spark, seed):
    rng = np.random.default_rng(3)
    lengths = [int(v) for v in rng.integers(1, 400, 900)] + [5000, 0] + [77] * 300
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lengths)] + [(9999, None)], "id long, n int").repartition(5)
    rows = sampling.length_batches(df, "n", rank_key("id"), 2_000, 10, seed).collect()
    assert sorted(r.id for r in rows) == sorted([*range(len(lengths)), 9999])
    megas = {}
    for r in rows:
        megas.setdefault(r.mega, []).append(r)
    assert len(megas) == -(-sum(lengths) // 20_000)
    for own in megas.values():
        own.sort(key=lambda r: (r.batch, r.place))
        sizes = [r.n or 0 for r in own]
        assert sizes == sorted(sizes, reverse=True)
        before = 0
        for r, size in zip(own, sizes):
            assert r.batch == before // 2_000 and r.padding == r.longest - size
            before += size
        for batch in {r.batch for r in own}:
            inside = [r for r in own if r.batch == batch]
            assert [r.place for r in inside] == list(range(len(inside)))
            assert {r.longest for r in inside} == {max(r.n or 0 for r in inside)}
    report = sampling.padding_report(sampling.length_batches(df, "n", rank_key("id"), 2_000, 10, seed)).first()
    assert report.batches == len({(r.mega, r.batch) for r in rows}) and report.rows == len(rows)
    assert report.padding_share == pytest.approx(sum(r.padding for r in rows) / sum(r.longest for r in rows), abs=1e-6)


def test_batches_change_with_the_seed_and_of_nothing(spark):
    df = spark.range(500).select("id", (F.col("id") % 50).alias("n"))
    one, two = ({(r.id, r.mega) for r in sampling.length_batches(df, "n", rank_key("id"), 100, 5, s).collect()} for s in (1, 2))
    assert one != two
    assert sampling.length_batches(df.where("id < 0"), "n", rank_key("id"), 100).collect() == []


def frame(spark, x, y):
    rows = [(int(b), *map(float, a)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "label int, a double, b double, c double").repartition(4)


def test_newton_ends_where_the_gradient_is_zero(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 3)) * [1, 5, 0.1]
    y = rng.random(1500) < 1 / (1 + np.exp(-(x @ [1.0, -0.4, 3.0] - 2)))
    model = train_newton(frame(spark, x, y), ["a", "b", "c"], ridge=0.5)
    w = np.array(model.weights)
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    weight = np.where(y, len(y) / (2 * y.sum()), len(y) / (2 * (~y).sum()))
    slope = (weight * (p - y)) @ x + 0.5 * w
    assert np.abs(slope).max() < 1e-6 and abs((weight * (p - y)).sum()) < 1e-6
    scored = predict(model, frame(spark, x, y)).toPandas()
    assert (scored["y_pred"] == scored["y_true"]).mean() > 0.7


def test_newton_of_odd_rows(spark):
    x = np.array([[0.0, 1e6, 1], [1, -1e6, 1], [2, 3e6, 1], [3, -3e6, 1]])
    whole = train_newton(frame(spark, x, np.array([1, 0, 1, 0])), ["a", "b", "c"])     # separable, and a constant feature
    assert np.isfinite(whole.weights).all() and whole.weights[1] > 0
    one = train_newton(frame(spark, x, np.ones(4)), ["a", "b", "c"])
    assert one.weights == [0.0, 0.0, 0.0] and one.intercept == 0.0
    gaps = frame(spark, x, np.array([1, 0, 1, 0])).withColumn("a", F.when(F.col("a") > 1, F.col("a")))
    assert np.isfinite(train_newton(gaps, ["a", "b"]).weights).all()
    nothing = frame(spark, x, np.ones(4)).where("a < 0")
    assert train_newton(nothing, ["a"]).weights == [0.0]
