"""Fits, encoders and velocity on awkward inputs."""

import statistics

import pytest
from pyspark.sql import functions as F

from tallyguard.functions import columns as C
from tallyguard.operators import cleaning, encoding, profiling, scaling, timewise
from tallyguard.operators.ranking import rank_key


@pytest.mark.parametrize("few, sketch", [(10_000, 2_048), (20, 2_048), (1, 2_048), (50, 8)])
def test_medians(spark, few, sketch, monkeypatch):
    """Even and odd counts, missing values, a hot value, one value, no value; one and many rounds, and a
    sketch so rough that its brackets miss the middle."""
    monkeypatch.setattr(profiling, "READ_OUT_VALUES", few)
    monkeypatch.setattr(profiling, "SKETCH_SIZE", sketch)
    nan = float("nan")
    rows = [(float(i * i % 1_009), 5.0 if i % 3 else float(i), None if i % 2 else float(i), i % 4, None,
             nan if i % 5 == 0 else 1.0 * (i % 97)) for i in range(3_000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int, e double, f double")
    got = profiling.column_medians(df, ["a", "b", "c", "d", "e", "f"])
    for i, c in enumerate("abcdef"):
        values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        assert got[c] == (statistics.median(values) if values else None), c


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b", None), ("a", "z"), ("a", "y"), ("b", None)], "x string, y string")
    modes = {r["column"]: r["mode"] for r in profiling.column_modes(profiling.value_counts(df, ["x", "y"])).collect()}
    assert modes == {"x": "a", "y": "y"}


def test_impute(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (None, float("nan"), None), (4, 3.0, "a")], "i int, d double, s string")
    fills = scaling.fit_imputer(df, ["i", "d"], ["s"])
    assert fills == {"i": 2.5, "d": 2.0, "s": "a"}
    out = scaling.impute(df, fills)
    assert [tuple(r) for r in out.collect()][1] == (2.5, 2.0, "a")


def test_zero_variance_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    out = scaling.standard_scale(df, scaling.fit_scaler(df, ["x"]))
    assert [r["x"] for r in out.collect()] == [0.0, 0.0]


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert scaling.fit_scaler(df, ["x"]) == {"x": (2.0, 1.0)}
    with pytest.raises(ValueError):
        scaling.fit_scaler(df, ["x"], fit_on="test")


def test_high_null_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, None), (3, None, None), (4, 6, 7)], "a int, half int, sparse int")
    assert cleaning.drop_high_null(df).columns == ["a", "half"]


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_label_encode(spark, monkeypatch, broadcast):
    """Broadcast and shuffled dictionaries give the same codes; null counts as text."""
    monkeypatch.setattr(encoding, "BROADCAST_VALUES", broadcast)
    words = ["B", "a", "b", "é", None, "z"]
    df = spark.createDataFrame([(i, words[i % 6], f"c{i % 40}") for i in range(240)], "i int, w string, u string")
    out = {r["i"]: (r["w"], r["u"]) for r in encoding.label_encode(df, ["w", "u"]).collect()}
    order = sorted("nan" if w is None else w for w in words)
    users = sorted({f"c{i}" for i in range(40)})
    assert out == {i: (order.index(words[i % 6] or "nan"), users.index(f"c{i % 40}")) for i in range(240)}


def test_ordered_index(spark):
    df = spark.range(1_000).select((F.col("id") * 7 % 1_000).alias("x"))
    assert all(r["x"] == r["idx"] for r in encoding.ordered_index(df, "x").collect())


def test_one_hot_null_matches_nothing(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "t string")
    out = encoding.one_hot(df, "t", "type")
    assert out.columns == ["type_a", "type_b"]
    assert [tuple(r) for r in out.collect()] == [(False, True), (False, False), (True, False)]
    with pytest.raises(ValueError, match="categories"):
        encoding.fit_categories(spark.range(20), "id", limit=10)


def test_join_renames_clashing_columns(spark):
    a = spark.createDataFrame([(1, "l"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "r"), (None, "m")], "k int, v string")
    rows = {tuple(r) for r in cleaning.left_equi_join(a, b, "k").select("k", "v_x", "v_y").collect()}
    assert rows == {(1, "l", "r"), (None, "n", None)}


def test_code_maps(spark):
    df = spark.createDataFrame([("U",), ("O",), ("0",), ("3",), (None,), ("x",)], "a string")
    assert [r[0] for r in df.select(C.age_code("a")).collect()] == [0, 7, 0, 3, 0, 0]
    genders = spark.createDataFrame([("M",), ("F",), (None,)], "g string")
    assert [r[0] for r in genders.select(C.gender_flag("g")).collect()] == [1, 0, 0]
    classes = spark.createDataFrame([("1",), ("2",), ("unknown",), (None,)], "class string")
    kept = cleaning.label_from_class(cleaning.filter_unlabelled(classes))
    assert [r["label"] for r in kept.collect()] == [1, 0]


def test_strip_quotes(spark):
    df = spark.createDataFrame([("'a'",), ('"b\'',), ("c'd",)], "t string")
    assert [r[0] for r in df.select(C.strip_quotes("t")).collect()] == ["a", "b", "c'd"]


@pytest.mark.parametrize("slices", [2, 16, 200])
def test_velocity_with_hot_account_and_hot_instant(spark, slices):
    """One account has most rows, many of them at one instant, some without a time."""
    ts = (F.when(F.col("id") % 4 == 0, F.lit("2024-01-02 00:00:00").cast("timestamp"))
          .when(F.col("id") % 11 == 1, F.lit(None).cast("timestamp"))
          .otherwise(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 613 % 400_000)))
    df = spark.range(4_000).select("id", F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 7).alias("acc"), ts.alias("ts"))
    tie = rank_key("id")
    timewise.running_txn_count(df, "acc", "ts", tie, out="n", slices=slices).withColumn("t", tie).createOrReplaceTempView("v1")
    wrong = spark.sql("""
        SELECT * FROM (SELECT n, count(ts) OVER (PARTITION BY acc ORDER BY ts ASC NULLS LAST, t
                       ROWS UNBOUNDED PRECEDING) AS want FROM v1) WHERE NOT n <=> want""").count()
    assert wrong == 0 and spark.table("v1").count() == 4_000
    timewise.window_txn_count(df, "acc", "ts", out="n", slices=slices).createOrReplaceTempView("v2")
    wrong = spark.sql("""
        SELECT * FROM (SELECT n, ts, count(1) OVER (PARTITION BY acc ORDER BY ts
                       RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS want FROM v2)
        WHERE ts IS NOT NULL AND NOT n <=> want""").count()
    assert wrong == 0 and spark.table("v2").count() == 4_000


def test_time_features_of_bad_text(spark):
    df = spark.createDataFrame([("2024-01-01 13:00:00",), ("nonsense",)], "t string").withColumn(
        "ts", C.parse_ts_or_null("t"))
    rows = [tuple(r) for r in timewise.time_features(df, "ts").select("hour_of_day", "day_of_week", "day_of_month").collect()]
    assert rows == [(13, 0, 1), (None, None, None)]


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1), (nan, 2), (None, None), (3.0, 4)], "x double, i int")
    assert tuple(profiling.null_fraction(df).first()) == (0.5, 0.25)
    assert scaling.fit_scaler(df, ["x"]) == {"x": (2.0, 1.0)}


def test_times_of_several_forms(spark):
    texts = ["2022/09/01 00:20", "2022/09/01 00:20:05", "2022/09/01", "2022-09-01 00:20:00", "bad", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [str(r[0]) for r in df.orderBy("i").select(C.parse_ts_or_null("t")).collect()]
    assert got == ["2022-09-01 00:20:00", "2022-09-01 00:20:05", "2022-09-01 00:00:00", "2022-09-01 00:20:00", "None", "None"]
