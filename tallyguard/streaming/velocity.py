"""Counts per transaction on a stream: the account's running number and that of its last 24 hours.

A transaction is answered when the watermark has passed its time, as only then no earlier one can
still come; the counts are exact, whatever the order of arrival within the allowed lateness. An
account's state is what waits for the watermark, its instants of the last 24 hours in hour buckets,
and two totals; a timer clears the buckets of an account that has been quiet for so long.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR = 3_600_000_000                        # microseconds
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which keyed state needs; the setting is put back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _packed(values: np.ndarray) -> bytes:
    return values.astype("<i8").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


class VelocityProcessor(StatefulProcessor):
    """State and timers of one account at a time; the rows are (account, id, at in microseconds, tie)."""

    def __init__(self, hours: int):
        self.span = hours * HOUR

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, tie string, id string")
        self.instants = handle.getMapState("instants", "hour long", "at binary, n binary")
        self.totals = handle.getValueState("totals", "seen long, gone long, last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            if len(part):
                self.waiting.appendList(list(zip(part["at"].tolist(), part["tie"].tolist(), part["id"].tolist())))
                least = int(part["at"].min())
                first = least if first is None else min(first, least)
        if first is not None:
            self._wake(first)
        return iter(())

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(self.waiting.get()) if self.waiting.exists() else []
        due = [r for r in rows if r[0] <= passed]
        seen, gone, last = self.totals.get() if self.totals.exists() else (0, 0, 0)
        if not due:
            if not rows and seen and last + self.span < passed:          # quiet for the whole window
                self.instants.clear()
                self.totals.update((seen, seen, last))
            return
        later = rows[len(due):]
        if later:
            self.waiting.put(later)
            self._wake(later[0][0])
        else:
            self.waiting.clear()
            self._wake(due[-1][0] + self.span + 1000)
        at = np.array([r[0] for r in due], np.int64)
        recent, gone = self._windowed(at, seen, gone)
        self.totals.update((seen + len(due), gone, int(at[-1])))
        yield pd.DataFrame({"account": [key[0]] * len(due), "id": [r[2] for r in due],
                            "txn_count": np.arange(seen + 1, seen + len(due) + 1), "txn_count_24h": recent})

    def _windowed(self, at: np.ndarray, seen: int, gone: int) -> tuple[np.ndarray, int]:
        """(rows of the window that ends with each of the sorted times ``at``, rows in buckets left behind).

        Only the buckets that leave the window are read, only those that stay are written.
        """
        instants, n = np.unique(at, return_counts=True)
        begin, hours = instants - self.span, instants // HOUR
        floor = int(begin[-1] // HOUR)
        leaving = sorted(k[0] for k in self.instants.keys() if k[0] <= floor)
        old = {h: [_unpacked(x) for x in self.instants.getValue((h,))] for h in leaving}
        times = np.concatenate([*(v[0] for v in old.values()), instants[hours <= floor]])
        counts = np.concatenate([*(v[1] for v in old.values()), n[hours <= floor]])
        order = np.argsort(times, kind="stable")
        before = np.r_[0, np.cumsum(counts[order])][np.searchsorted(times[order], begin)]
        recent = seen + np.cumsum(n) - gone - before
        gone += int(counts[times // HOUR < floor].sum())
        for hour in leaving:
            if hour < floor:
                self.instants.removeKey((hour,))
        for hour in np.unique(hours[hours >= floor]).tolist():
            own = hours == hour
            kept = self.instants.getValue((hour,)) if self.instants.containsKey((hour,)) else (b"", b"")
            self.instants.updateValue((hour,), (kept[0] + _packed(instants[own]), kept[1] + _packed(n[own])))
        return np.repeat(recent, n), gone

    def close(self) -> None:
        pass


def stream_txn_counts(transactions: DataFrame, account: str, ts: str, row_id: str, tie: Column,
                      late: str = "1 hour", hours: int = 24) -> DataFrame:
    """(account, id, txn_count, txn_count_24h) of every transaction of a stream, once it is final.

    txn_count is the account's running number of transactions, equal times in ``tie`` order;
    txn_count_24h counts those of the last ``hours`` hours, both ends and equal times included. Both
    are what ``running_txn_count`` and ``window_txn_count`` give for the rows that were not later than
    ``late``. Rows without a time or an account are left out; ``id`` is the row id as text. Start the
    query inside ``rocksdb_state``.
    """
    timed = (transactions.withColumn(ts, F.col(ts).cast("timestamp"))
             .where(F.col(ts).isNotNull() & F.col(account).isNotNull()).withWatermark(ts, late)
             .select(F.col(account).alias("account"), F.col(ts).alias("event_time"), F.unix_micros(ts).alias("at"),
                     tie.alias("tie"), F.col(row_id).cast("string").alias("id")))
    kind = timed.schema["account"].dataType.simpleString()
    return timed.groupBy("account").transformWithStateInPandas(
        VelocityProcessor(hours), f"account {kind}, id string, txn_count long, txn_count_24h long", "append", "eventTime")
