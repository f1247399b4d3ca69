"""Best-fit packing: a configuration linear program over the length histogram, rounded and dealt to pieces."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.textscan import give_back, slices
from tallyguard.llm.tokens import encoder
from tallyguard.session import stored

CAPACITY = 1024
END_ID = 2
RUNS = ((200, 0.02), (64, 0.1))
"""Rounds that all tokens are dealt to, and the rate at which a covered length loses weight."""
BOUND_EVERY = 8
ROUNDING = (1.0, 0.9, 0.75, 0.5, 0.25, 0.0)
LEAST = 1e-9
BUCKETS = 256
TOKEN_SLICE = 1 << 21

Plan = list[tuple[dict[int, int], int]]
"""Configurations (length: pieces of it in one sequence) and how many sequences are packed so."""


def _pieces(batches: Iterator[pa.RecordBatch], path: str | None, end: int, capacity: int) -> Iterator[pa.RecordBatch]:
    give_back()                                                # what earlier steps have left in this worker
    encode = encoder(path, end).encode
    for batch in batches:
        for lo, hi, raw, at in slices(batch.column(1), TOKEN_SLICE):
            ids, first = encode(raw, at)
            n = np.diff(first)
            count = -(-n // capacity)
            row = np.repeat(np.arange(hi - lo), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            head = (n - (count - 1) * capacity)[row]
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            length = np.where(piece == 0, head, capacity)
            at_id = first[:-1][row] + start
            data = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at_id.tolist(), (at_id + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row + lo)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    give_back()


def price(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack by dynamic programming: for every room the best value and the longest piece that reaches it."""
    capacity = len(value) - 1
    lengths = np.flatnonzero(value > 0)
    gains = value[lengths]
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        k = int(np.searchsorted(lengths, room, "right"))
        if k:
            gain = best[room - lengths[:k]] + gains[:k]
            top = gain.max()
            if top >= best[room]:
                best[room], took[room] = top, lengths[np.flatnonzero(gain >= top * (1 - 1e-12))[-1]]
    return best, took


def config_from(first: int, took: np.ndarray) -> dict[int, int]:
    """The priced configuration that begins with a piece of length ``first``."""
    config, room = {first: 1}, len(took) - 1 - first
    while room:
        k = int(took[room])
        if k:
            config[k] = config.get(k, 0) + 1
        room -= k or 1
    return config


def fractional_plan(counts: np.ndarray, rounds: int, rate: float) -> tuple[list[tuple[dict[int, int], float]], float]:
    """(columns, bound): an approximate solution of min sum x, sum a_cl x_c >= n_l by multiplicative weights.

    A length's weight, its price in the dual, begins as its share of a sequence. Each round prices
    all configurations by one knapsack table of what is left and, longest first piece first, takes
    the best ones as far as their pieces reach, until a ``rounds``-th of all tokens is dealt. Lengths
    then lose weight by the share of their demand that was covered, so what is in short supply is
    left for the sequences that nothing else fills. The columns cover every piece; ``bound`` is the
    best dual value of the weights met, which no solution can go below.
    """
    capacity = len(counts) - 1
    sizes = np.arange(capacity + 1)
    weight = np.where(counts > 0, sizes / capacity, 0)
    left = counts.astype(float)
    goal = float(counts @ sizes) / rounds
    found: dict[tuple, float] = {}
    bound, turn = 0.0, 0
    while (left > 0).any():
        if turn % BOUND_EVERY == 0:
            bound = max(bound, float(counts @ weight) / price(weight)[0][capacity])
        turn += 1
        _, took = price(np.where(left > 0, weight, 0))
        before, dealt = left.copy(), 0.0
        for first in np.flatnonzero(left)[::-1]:
            config = config_from(int(first), took)
            take = min(left[k] / a for k, a in config.items())
            if take <= 0:                                             # a piece of it has run out in this round
                continue
            key = tuple(sorted(config.items()))
            found[key] = found.get(key, 0.0) + take
            for k, a in config.items():
                left[k] = left[k] - a * take if left[k] - a * take > LEAST else 0
                dealt += k * a * take
            if dealt >= goal:
                break
        weight *= np.exp(-rate * (before - left) / np.maximum(counts, 1))
    return [(dict(k), x) for k, x in found.items()], bound


def whole_part(counts: np.ndarray, columns: list[tuple[dict[int, int], float]], part: float) -> tuple[Plan, np.ndarray]:
    """(plan, pieces left): ``part`` of every column in whole sequences; what rounding cuts off goes on to the next."""
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    plan: Plan = []
    carry = 0.0
    for config, x in sorted(columns, key=lambda c: (capacity - sum(k * a for k, a in c[0].items()), -c[1])):
        use = min(int(carry + x * part + LEAST), *(int(left[k]) // a for k, a in config.items()))
        carry = min(carry + x * part - use, 1.0)
        if use:
            plan.append((config, use))
            for k, a in config.items():
                left[k] -= a * use
    return plan, left


def best_fit(counts: np.ndarray, plan: Plan) -> Plan:
    """Best fit, long pieces first, over counts: into what is open in ``plan``, then into new sequences."""
    capacity = len(counts) - 1
    by_room: list[list[tuple[dict[int, int], int]]] = [[] for _ in range(capacity + 1)]
    for config, count in plan:
        by_room[capacity - sum(k * a for k, a in config.items())].append((config, count))
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        room = length
        while left and room <= capacity:
            if not by_room[room]:
                room += 1
                continue
            config, count = by_room[room].pop()
            each = min(room // length, left)
            use = min(count, left // each)
            if use < count:
                by_room[room].append((config, count - use))
            grown = {**config, length: config.get(length, 0) + each}
            by_room[room - each * length].append((grown, use))
            left -= each * use
        while left:
            each = min(capacity // length, left)
            use = left // each
            by_room[capacity - each * length].append(({length: each}, use))
            left -= each * use
    return [x for rows in by_room for x in rows]


def integral_plan(counts: np.ndarray, runs: tuple[tuple[int, float], ...] = RUNS) -> Plan:
    """Whole sequences: the fractional plans rounded, the rest by best fit; the shortest outcome.

    The last part is 0, best fit alone, so that the plan never needs more sequences than that.
    """
    plans = [fractional_plan(counts, rounds, rate)[0] for rounds, rate in runs]
    outcomes = []
    for part in ROUNDING:
        for columns in plans:
            plan, left = whole_part(counts, columns, part)
            outcomes.append(best_fit(left, plan))
    return min(outcomes, key=lambda plan: sum(n for _, n in plan))


def _slots(plan: Plan) -> np.ndarray:
    """Rows (length, first rank, pieces a sequence, first sequence, offset), sorted by length and rank."""
    rows, ranks, sequence = [], {}, 0
    for config, count in plan:
        offset = 0
        for length, a in sorted(config.items(), reverse=True):
            rows.append((length, ranks.get(length, 0), a, sequence, offset))
            ranks[length] = ranks.get(length, 0) + a * count
            offset += a * length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(batches: Iterator[pa.RecordBatch], slots: np.ndarray) -> Iterator[pa.RecordBatch]:
    key = (slots[:, 0] << 44) + slots[:, 1]
    for batch in batches:
        if not batch.num_rows:
            continue
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        at = slots[np.searchsorted(key, (length << 44) + rank, "right") - 1]
        turn, copy = np.divmod(rank - at[:, 1], at[:, 2])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
             pa.array(at[:, 3] + turn), pa.array(at[:, 4] + copy * length)],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row of ``docs``.

    A text is its ids and then ``end``; a null text is empty, so one piece of one id. Texts over
    ``capacity`` ids are cut into pieces of that many, the first one shorter. Every row counts, also
    repeated ones and those without a doc_id; other columns are not looked at; no rows give none.
    Only the histogram of at most ``capacity`` lengths comes to the driver.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = stored(docs.select("doc_id", "text").mapInArrow(
        partial(_pieces, path=tokenizer, end=end, capacity=capacity), schema), "pieces")
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)))
    sizes = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("length", "bucket", (F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (bucketed.withColumn("number", F.row_number().over(order))
              .join(F.broadcast(before), ["length", "bucket"])          # at most capacity * BUCKETS rows
              .withColumn("rank", F.col("number") - 1 + F.col("before")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        partial(_placed, slots=_slots(integral_plan(counts))), f"{schema}, sequence_id long, offset long")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the places of all pieces."""
    return pack(docs)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids from the whole table."""
    return pack(table(spark, sf_dir, "documents"))
