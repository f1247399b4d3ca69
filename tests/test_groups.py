"""Functions over ordered groups: equal to the window operators, and a hot group stays in batches."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tallyguard.operators.groups import transform_groups
from tallyguard.operators.ranking import rank_key
from tallyguard.operators.timewise import running_txn_count


def running():
    """A function of its own, as executors can't import this module."""
    def count(batch: pa.RecordBatch, seen: int):
        """Running number of rows with a time, as the sliced operator counts them."""
        timed = pc.is_valid(batch.column("ts")).to_numpy(zero_copy_only=False)
        counts = seen + np.cumsum(timed)
        out = pa.RecordBatch.from_arrays([batch.column("event_id"), pa.array(counts.astype(float)), pa.array([len(timed)] * len(timed))],
                                         ["event_id", "txn_count_24h", "batch_rows"])
        return out, seen + int(timed.sum())

    return count


SCHEMA = "event_id long, txn_count_24h double, batch_rows long"


def test_running_count_equals_the_sliced_one(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", F.when(F.col("event_id") % 9 != 0, F.col("ts")).alias("ts"))
    events = events.unionByName(events.limit(20).withColumn("user_id", F.lit(None).cast("long")))
    made = transform_groups(events, "user_id", [F.col("ts").asc_nulls_last(), rank_key("event_id")], running(), SCHEMA, 0)
    want = running_txn_count(events, "user_id", "ts", rank_key("event_id"))
    timed = events.where("ts IS NOT NULL AND user_id IS NOT NULL").select("event_id")
    left = sorted(tuple(r) for r in made.select("event_id", "txn_count_24h").join(timed, "event_id", "left_semi").collect())
    right = sorted(tuple(r) for r in want.where("user_id IS NOT NULL").select("event_id", "txn_count_24h").join(
        timed, "event_id", "left_semi").collect())
    assert made.count() == events.count() and {x[0] for x in left} == {x[0] for x in right}
    shared = {r.event_id for r in events.where("user_id IS NULL").select("event_id").collect()}
    assert [x for x in left if x[0] not in shared] == [x for x in right if x[0] not in shared]


def test_a_hot_group_comes_in_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    try:
        df = spark.range(50_000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("g"),
                                        F.timestamp_seconds(50_000 - F.col("id")).alias("ts")).where("g = -1")
        rows = transform_groups(df, ["g"], ["ts"], running(), SCHEMA, 0).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert max(r.batch_rows for r in rows) <= 1000
    counts = {r.event_id: r.txn_count_24h for r in rows}
    assert [counts[i] for i in sorted(counts, reverse=True)] == list(range(1, len(counts) + 1))


def test_empty_table_and_two_keys(spark):
    df = spark.createDataFrame([(1, "a", "x", None)], "event_id long, g string, h string, ts timestamp")
    assert transform_groups(df.where("event_id < 0"), ["g", "h"], ["ts"], running(), SCHEMA, 0).collect() == []
    assert [tuple(r) for r in transform_groups(df, ["g", "h"], ["ts"], running(), SCHEMA, 5).collect()] == [(1, 5.0, 1)]
