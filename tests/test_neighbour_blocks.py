"""Neighbour search writes as much as there are points, not pairs, whatever the blocks."""

import os
import threading
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyguard.operators import neighbours as N
from tallyguard.operators.neighbours import best_in_block, knn_self_join
from tallyguard.session import scratch_root


def written(folders):
    total = 0
    for top in folders:
        for folder, _, names in os.walk(top):
            for name in names:
                try:
                    total += os.path.getsize(f"{folder}/{name}")
                except OSError:
                    pass
    return total


def points(spark, n, dims, seed=5):
    x = np.random.default_rng(seed).normal(size=(n, dims))
    return spark.createDataFrame([(f"k{i:04d}", v.tolist()) for i, v in enumerate(x)], "key string, vec array<double>")


@pytest.mark.parametrize("mode", ["exact", "hashed"])
def test_disk_grows_with_points_not_pairs(spark, mode):
    """Peak of shuffle files and stored tables while small blocks make many pairs."""
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [*local, scratch_root(spark)]
    df = points(spark, 1000, 48)
    before, most, over = written(folders), [0], threading.Event()

    def watch():
        while not over.is_set():
            most[0] = max(most[0], written(folders) - before)
            time.sleep(0.02)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        rows = knn_self_join(df, 5, mode=mode, query_block=32, search_block=32).collect()
    finally:
        over.set()
        watcher.join()
    assert len(rows) == 5_000
    assert most[0] < 12 * 1000 * 48 * 8


@pytest.mark.parametrize("mode", ["exact", "hashed"])
def test_only_what_the_result_reads_is_left(spark, mode):
    before = set(os.listdir(scratch_root(spark))) if os.path.isdir(scratch_root(spark)) else set()
    rows = knn_self_join(points(spark, 200, 4), 2, mode=mode, **({"tables": 3} if mode == "hashed" else {}))
    left = {name.rpartition("-")[0] for name in set(os.listdir(scratch_root(spark))) - before}
    assert left == {"asked", "query-blocks"} and rows.count() == 400


@pytest.mark.parametrize("mode", ["exact", "hashed"])
def test_blocks_do_not_change_what_is_found(spark, mode):
    df = points(spark, 400, 5)
    df = df.union(df.where("key < 'k0040'").select(F.concat(F.lit("z"), "key"), "vec"))
    found = [sorted(map(tuple, knn_self_join(df, 4, mode=mode, **sizes).collect()))
             for sizes in ({}, {"query_block": 70, "search_block": 50})]
    assert len(found[0]) == 440 * 4 and found[0] == found[1]


def test_single_and_double_numbers_find_the_same(spark):
    df = points(spark, 300, 8).withColumn("vec", F.col("vec").cast("array<float>"))
    one = knn_self_join(df, 3).collect()
    two = knn_self_join(df.withColumn("vec", F.col("vec").cast("array<double>")), 3).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_only_what_is_no_farther_than_the_worst_is_found():
    query, search = np.zeros((2, 1)), np.arange(1.0, 400.0)[:, None]
    q, s, d = best_in_block(query, search, np.arange(len(search)), 3, np.array([4.0, np.inf]))
    assert q.tolist() == [0, 0, 1, 1, 1] and s.tolist() == [0, 1, 0, 1, 2] and d.tolist() == [1.0, 4.0, 1.0, 4.0, 9.0]


def test_large_buckets_are_cut_and_small_ones_share():
    codes, first, cuts = N._pieces(np.array([7, 2, 9, 4]), np.array([3, 4, 5, 25]), 10)
    assert codes.tolist() == [2, 4, 7, 9] and cuts.tolist() == [1, 3, 1, 1]
    assert first.tolist() == [0, 1, 4, 4]


def asked(sq, near):
    types = {"block": pa.int64(), "cell": pa.int32(), "reach": pa.float64(), "vids": pa.list_(pa.binary()),
             "vecs": pa.binary(), "sq": pa.binary(), "near": pa.list_(pa.string())}
    row = {"block": 3, "cell": 0, "reach": 1.0, "vids": [b"a"], "vecs": None, "sq": np.array(sq).tobytes(), "near": near}
    return pa.Table.from_pydict({c: pa.array([v], types[c]) for c, v in row.items()})


@pytest.mark.parametrize("once, want", [(True, ["x", "b", "c"]), (False, ["x", "x", "b"])])
def test_a_block_that_several_tasks_took_is_one(once, want):
    parts = pa.concat_tables([asked([1.0, 4.0, np.inf], ["x", "c", ""]), asked([1.0, 4.0, 5.0], ["x", "b", "d"])])
    one = N._united("<f8", 3, once)(parts).to_pylist()
    assert len(one) == 1 and one[0]["near"] == want
