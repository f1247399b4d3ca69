"""A function over the ordered rows of every group, streamed: a group of any size needs the memory of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

GroupFunction = Callable[[pa.RecordBatch, Any], tuple[pa.RecordBatch, Any]]


def transform_groups(df: DataFrame, group: str | list[str], order: list[Column | str], function: GroupFunction,
                     schema: str | StructType, state: Any = None) -> DataFrame:
    """What ``function`` makes of every group's rows, read in ``order``.

    ``function(batch, state)`` gets the next rows of a group and what it returned as state for those
    before them, ``state`` for the first; it returns rows of ``schema`` and the new state. So whatever
    it carries on (a running total, the last row, a sketch) is all that is held of a group: the rows
    come sorted from Spark, which spills, and go batch by batch. A group is read by one task; the
    work of a hot group is split where the result allows it, as ``running_txn_count`` does.
    Rows with a null in the group are a group; an empty table gives no rows.
    """
    keys = [group] if isinstance(group, str) else list(group)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = state
        for batch in batches:
            out, carried = function(batch, carried)
            yield out

    placed = df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*[F.col(k) for k in keys], *order)
    return placed.groupBy(*keys).applyInArrow(own, schema)
