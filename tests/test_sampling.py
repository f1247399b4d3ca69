"""Exact ranks, splits, caps and resampling decisions, hot copies included."""

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import ranking, sampling
from tallyguard.operators.ranking import ROW_KEY, class_cutoffs, rank_key, with_row_key, within_cutoff


def test_cutoffs_match_sorted_keys(spark, monkeypatch):
    """Every rank is exact, also when prefixes are never read out early."""
    df = spark.range(5_000).withColumn("g", (F.col("id") % 3 == 0).cast("int"))
    key = rank_key("id")
    keys = {g: sorted(r["k"] for r in df.where(F.col("g") == g).select(key.alias("k")).collect()) for g in (0, 1)}
    wanted = {0: [1, 7, 500, 3_000], 1: [0, 2, 1_600, 10_000]}
    for fetch in (2_000, 1):
        monkeypatch.setattr(ranking, "FETCH_ROWS", fetch)
        counts, cuts = class_cutoffs(df, key, lambda c: wanted, by="g")
        assert counts == {g: len(v) for g, v in keys.items()}
        for g in (0, 1):
            for slot, n in enumerate(wanted[g]):
                got = df.where((F.col("g") == g) & within_cutoff(key, cuts, "g", slot)).count()
                assert got == min(n, len(keys[g]))


def test_hot_group_of_copies(spark, monkeypatch):
    """A third of all rows are copies of one row; the cut goes through the copies."""
    monkeypatch.setattr(ranking, "FETCH_ROWS", 5)
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("x"),
                                   F.lit(0).alias("label"))
    keyed = with_row_key(df)
    assert keyed.select(ROW_KEY).distinct().count() == 3_000
    for fraction in (0.1, 0.5, 0.9):
        assert sampling.exact_fraction_sample(keyed, F.col(ROW_KEY), fraction).count() == round(fraction * 3_000)


def test_picked_rows_do_not_depend_on_partitioning(spark):
    df = spark.range(2_000).select((F.col("id") % 50).alias("x"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    picks = []
    for parts in (1, 8):
        keyed = with_row_key(df.repartition(parts))
        out = sampling.stratified_split(keyed, F.col(ROW_KEY))
        picks.append(sorted(map(tuple, out.groupBy("x", "label", "split").count().collect())))
    assert picks[0] == picks[1]


def test_duplicate_keys_are_reported(spark, monkeypatch):
    monkeypatch.setattr(ranking, "FETCH_ROWS", 5)
    df = spark.range(100).select(F.lit(1).alias("x"))
    with pytest.raises(ValueError, match="not unique"):
        sampling.exact_fraction_sample(df, rank_key("x"), 0.5).count()


@pytest.mark.parametrize("n", [1, 9, 10, 11, 99, 1_000, 284_807])
def test_split_sizes(n):
    test, val = sampling.split_sizes(n)
    assert abs(test - 0.1 * n) <= 0.5 + 1e-9
    assert abs(val - 0.1111 * (n - test)) <= 0.5 + 1e-9


def test_split_covers_all_rows_once(spark):
    df = spark.range(1_234).withColumn("label", (F.col("id") % 17 == 0).cast("int"))
    out = sampling.stratified_split(df, rank_key("id"))
    assert out.count() == 1_234 and out.select("id").distinct().count() == 1_234
    for r in out.groupBy("label").agg(*[F.count_if(F.col("split") == s).alias(s) for s in ("test", "val")]).collect():
        n = out.where(F.col("label") == r["label"]).count()
        assert (r["test"], r["val"]) == sampling.split_sizes(n)


def test_cap(spark):
    df = spark.range(1_000).withColumn("label", (F.col("id") < 37).cast("int"))
    kept = sampling.stratified_cap(df, rank_key("id"), 100)
    assert {r["label"]: r["count"] for r in kept.groupBy("label").count().collect()} == {1: 3, 0: 97}
    assert sampling.stratified_cap(df, rank_key("id"), 1_000).count() == 1_000
    assert sampling.stratified_cap(df, rank_key("id"), None).count() == 1_000


def test_balanced_head_cap_takes_first_lines(spark):
    df = spark.range(1_000).withColumn("f", F.col("id") % 100 == 99)
    kept = sampling.balanced_head_cap(df, sampling.line_key("id"), "f", 12)
    ids = sorted(r["id"] for r in kept.collect())
    assert ids == [0, 1, 2, 3, 4, 5, 99, 199, 299, 399, 499, 599]


@pytest.mark.parametrize("a, b, over, under, made, keep", [
    (50, 1_000, True, True, 50, 200),         # both steps
    (200, 1_000, False, True, 0, 400),        # synthesis skipped
    (600, 1_000, False, False, 0, 1_000),     # nothing to do
    (0, 1_000, True, True, 100, 200),
])
def test_resample_plan(a, b, over, under, made, keep):
    p = sampling.resample_plan(a, b)
    assert (p.oversample, p.undersample, p.n_synthetic, p.keep_majority) == (over, under, made, keep)


def test_group_by_length_keeps_rows(spark):
    df = spark.range(500).withColumn("n", F.col("id") % 3)
    out = sampling.group_by_length(sampling.length_buckets(df, "n", 2), "n", rank_key("id"), 4)
    assert out.count() == 500 and out.rdd.getNumPartitions() == 4
