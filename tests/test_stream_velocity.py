"""Counts per transaction on a stream against the batch operators, over several batches, late rows and a restart."""

import random

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import timewise
from tallyguard.operators.ranking import rank_key
from tallyguard.session import scratch_path
from tallyguard.streaming import jobs, velocity

SCHEMA = "event_id long, user_id string, ts timestamp"
HOUR = 3600


def rows_of(seed, n=400):
    """Bursts, ties, a hot account, quiet days and rows up to half an hour out of order."""
    rng = random.Random(seed)
    times = sorted(rng.choice([rng.uniform(0, 200 * HOUR), 3 * HOUR, 60 * HOUR + rng.randint(0, 5)]) for _ in range(n))
    rows = [(i, rng.choice(["hot", "hot", "a", "b", f"u{i % 40}"]), t) for i, t in enumerate(times)]
    rows.sort(key=lambda r: r[2] + rng.uniform(0, 0.5 * HOUR))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame([(i, u, None if t is None else float(t)) for i, u, t in rows], "event_id long, user_id string, s double")
    return df.select("event_id", "user_id", F.timestamp_seconds("s").alias("ts"))


def run(spark, source, out, state, late="1 hour"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    counts = velocity.stream_txn_counts(stream, "user_id", "ts", "event_id", rank_key("event_id"), late)
    with velocity.rocksdb_state(spark):
        jobs.run_available(counts, out, state)
    return {int(r.id): (r.txn_count, r.txn_count_24h) for r in spark.read.schema(counts.schema).parquet(out).collect()}


def expected(spark, rows, until):
    df = frame(spark, [r for r in rows if r[1] is not None and r[2] is not None])
    running = timewise.running_txn_count(df, "user_id", "ts", rank_key("event_id"), out="n")
    both = timewise.window_txn_count(running, "user_id", "ts", out="w")
    return {r.event_id: (int(r.n), r.w) for r in both.collect() if r.ts.timestamp() <= until}


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_and_restart(spark, seed):
    rows = rows_of(seed)
    source, out, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    cuts = [0, 60, 61, 200, 330, len(rows)]
    for lo, hi in list(zip(cuts, cuts[1:]))[:3]:
        frame(spark, rows[lo:hi]).coalesce(1).write.mode("append").parquet(source)
    first = run(spark, source, out, state)
    for lo, hi in list(zip(cuts, cuts[1:]))[3:]:
        frame(spark, rows[lo:hi]).coalesce(1).write.mode("append").parquet(source)
    found = run(spark, source, out, state)                 # a new query goes on from the checkpoint
    assert first.items() <= found.items() and len(first) < len(found)
    assert found == expected(spark, rows, max(r[2] for r in rows) - HOUR)
    assert run(spark, source, out, state) == found


def test_late_rows_and_rows_without_time(spark):
    source, out, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    early = [(1, "a", 1000), (2, "a", 50 * HOUR), (3, None, 60), (4, "a", None)]
    late = [(5, "a", 2000), (7, "b", 200 * HOUR)]
    for part in (early, [(6, "a", 50 * HOUR + 5)], late):
        frame(spark, part).coalesce(1).write.mode("append").parquet(source)
    assert run(spark, source, out, state) == {1: (1, 1), 2: (2, 1), 6: (3, 2)}        # 5 came too late, 7 is not final


def test_setting_is_put_back(spark):
    before = spark.conf.get(velocity.PROVIDER)
    with velocity.rocksdb_state(spark):
        assert spark.conf.get(velocity.PROVIDER) == velocity.ROCKSDB
    assert spark.conf.get(velocity.PROVIDER) == before
