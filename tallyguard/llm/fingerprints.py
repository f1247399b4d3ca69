"""Document fingerprints: rare byte windows in chained Bloom filters, compared by normalised bit overlap.

Every WINDOW bytes of a text have an entropy, in whole numbers so that it depends on them alone. A
window is the rarer the fewer windows of the corpus have its entropy. Windows that are the rarest
among many of the ranges of RANGE neighbours are selected; their hashes fill Bloom filters, a new one
after every MOST_FEATURES.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.textscan import Scan, mix, owners, slices

WINDOW, RANGE, LEAST_POPULAR = 32, 32, 8
FILTER_BITS, FILTER_HASHES, MOST_FEATURES = 2048, 5, 160
LEVELS = 256
SLICE = 1 << 18
FILTER_BYTES = FILTER_BITS // 8

_TERM = np.array([0] + [round(1024 * j * np.log2(j)) for j in range(1, WINDOW + 1)], np.int64)
_STEP = np.diff(_TERM, prepend=0).astype(np.int32)
_MOST = int(_TERM[WINDOW])


def levels(raw: np.ndarray) -> np.ndarray:
    """Entropy level (0 to LEVELS - 1) of the window that begins at each byte, from what enters and leaves it."""
    n = len(raw)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    before, after = np.ones(n, np.uint8), np.ones(n, np.uint8)
    for k in range(1, WINDOW):
        same = (raw[k:] == raw[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    total = np.cumsum(_STEP[before], dtype=np.int64)
    gone = np.cumsum(_STEP[after], dtype=np.int64)
    total[WINDOW:] -= gone[:-WINDOW]
    return (_MOST - total[WINDOW - 1:]) * (LEVELS - 1) // _MOST


def window_starts(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of every text."""
    return at[:-1], np.maximum(np.diff(at) - WINDOW + 1, 0)


def _inside(at: np.ndarray, n: int) -> np.ndarray:
    start, count = window_starts(at)
    step = np.zeros(n + 1, np.int64)
    some = count > 0
    np.add.at(step, start[some], 1)
    np.add.at(step, start[some] + count[some], -1)
    return np.cumsum(step[:n]) > 0


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LEVELS, np.int64)
    for batch in batches:
        for _, _, raw, at in slices(batch.column(0), SLICE):
            found = levels(raw)
            total += np.bincount(found[_inside(at, len(found))], minlength=LEVELS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS)), pa.array(total)], ["level", "n"])


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of every entropy level: 255 for the level of the fewest windows of all texts."""
    rows = docs.select("text").mapInArrow(_histogram, "level long, n long").groupBy("level").agg(
        F.sum("n").alias("n")).collect()                                # LEVELS rows
    counts = np.zeros(LEVELS, np.int64)
    for level, n in rows:
        counts[level] = n
    rank = np.empty(LEVELS, np.int64)
    rank[np.lexsort((np.arange(LEVELS), -counts))] = np.arange(LEVELS)
    return rank


def selected(raw: np.ndarray, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, text) of the selected windows, in order; a text's rarest window always is one."""
    n = len(raw)
    found = levels(raw)
    start, count = window_starts(at)
    bits = max(1, int(n).bit_length())
    key = (rank[found] << bits) | ((1 << bits) - 1 - np.arange(len(found)))
    best, reach = key, 1
    while reach < RANGE:
        best = np.maximum(best[:-reach], best[reach:]) if len(best) > reach else best[:0]
        reach *= 2
    wide = count >= RANGE
    popular = np.zeros(len(found), np.int64)
    if wide.any() and len(best):
        ranges_in = np.zeros(len(best) + 1, np.int64)
        np.add.at(ranges_in, start[wide], 1)
        np.add.at(ranges_in, start[wide] + count[wide] - RANGE + 1, -1)
        winners = best[np.cumsum(ranges_in[:-1]) > 0]
        popular = np.bincount((1 << bits) - 1 - (winners & ((1 << bits) - 1)), minlength=len(found))
    some = count > 0
    cuts = np.stack([start[some], start[some] + count[some]], 1).ravel()
    rarest = np.maximum.reduceat(np.r_[key, 0], cuts)[::2] if len(cuts) else key[:0]
    rarest = (1 << bits) - 1 - (rarest & ((1 << bits) - 1))
    pick = np.union1d(np.flatnonzero(popular >= LEAST_POPULAR), rarest)
    return pick, np.searchsorted(at[1:], pick, "right")


def digests(raw: np.ndarray, at: np.ndarray, rank: np.ndarray) -> list[bytes]:
    """Chained Bloom filters of every text, FILTER_BYTES each; a short text is one feature, an empty one has none."""
    scan = Scan(raw, at)
    pick, text = selected(raw, at, rank)
    size = np.diff(at)
    short = np.flatnonzero((size > 0) & (size < WINDOW))
    pick, end = np.r_[pick, at[short]], np.r_[pick + WINDOW, at[short + 1]]
    text = np.r_[text, short]
    hashes = scan.word_hashes(pick, end)
    _, first = np.unique(mix(hashes + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    first = first[np.lexsort((pick[first], text[first]))]
    hashes, text = hashes[first], text[first]
    begin = np.searchsorted(text, np.arange(len(size) + 1))
    number = np.arange(len(text)) - begin[text]
    filters = -(-np.diff(begin) // MOST_FEATURES)
    base = np.r_[0, np.cumsum(filters)]
    bits = np.zeros(int(base[-1]) * FILTER_BYTES, np.uint8)
    where = (base[text] + number // MOST_FEATURES) * FILTER_BITS
    for j in range(FILTER_HASHES):
        bit = where + (hashes >> np.uint64(11 * j) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
        np.bitwise_or.at(bits, bit >> 3, (1 << (bit & 7)).astype(np.uint8))
    data = bits.tobytes()
    return [data[a * FILTER_BYTES:b * FILTER_BYTES] for a, b in zip(base, base[1:])]


def likeness(a: bytes, b: bytes) -> float:
    """Overlap of set bits beyond chance, 0 to 1: the shorter chain's filters against their best partners.

    Equal digests have 1; an empty one has 0 with any other.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    x, y = (np.frombuffer(v, np.uint64).reshape(-1, FILTER_BYTES // 8) for v in (a, b))
    in_x, in_y = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    total = 0.0
    for row, ones in zip(x, in_x):
        both = np.bitwise_count(y & row).sum(1, dtype=np.int64)
        chance = ones * in_y / FILTER_BITS
        total += float(((both - chance) / np.maximum(np.minimum(ones, in_y) - chance, 1e-9)).clip(0, 1).max())
    return total / len(x)


def _text_digests(texts: list[str], rank: np.ndarray) -> list[bytes]:
    return [d for _, _, raw, at in slices(pa.array(texts, pa.string()), SLICE) for d in digests(raw, at, rank)]


def edited(text: str, following: str) -> str:
    """``text`` whose last quarter of code points is replaced by as many (or all) first ones of ``following``."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def _pairs(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (part, doc_id, text, ghost) in order; a part's last row is a ghost, the first of the next part."""
    last = None
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part, ids, texts, ghost = (batch.column(i).slice(lo, 1000).to_pylist() for i in range(4))
            texts = [t or "" for t in texts]
            own = _text_digests(texts, rank)
            rows = [*([last] if last else []), *zip(part, ids, texts, ghost, own)]
            last = rows[-1]
            couples = [(x, y) for x, y in zip(rows, rows[1:]) if x[0] == y[0] and not x[3]]
            changed = [edited(x[2], y[2]) for x, y in couples]
            found = _text_digests(changed, rank)
            yield pa.RecordBatch.from_arrays([
                pa.array([x[1] for x, _ in couples], batch.schema.field(1).type),
                pa.array([len(x[2]) for x, _ in couples], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                pa.array([base64.b64encode(x[4]).decode() for x, _ in couples], pa.string()),
                pa.array([base64.b64encode(d).decode() for d in found], pa.string()),
                pa.array([likeness(x[4], d) for (x, _), d in zip(couples, found)], pa.float64()),
                pa.array([likeness(x[4], y[4]) for x, y in couples], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The next document is the one of the next higher doc_id (null lowest, equal ones by text); the last
    row's is the first row. Null and empty texts have an empty fingerprint. Rows with equal texts have
    equal fingerprints; other columns are not looked at; an empty table gives no rows. Rows are dealt
    out by ranges of doc_id; each range also gets the first row of the next one.
    """
    spark = docs.sparkSession
    rank = rarity(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text")
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = sorted(set(texts.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts)))
    place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>"),
                            lambda b: b <= F.col("doc_id")))
    dealt = texts.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(place))
    heads = sorted(tuple(r) for r in dealt.groupBy("part").agg(F.min(F.struct(
        F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("head")).select(
        "part", "head.known", "head.doc_id").collect())                 # one row a part
    ghosts = spark.createDataFrame([(heads[i - 1][0], h[2]) for i, h in enumerate(heads)],
                                   f"part int, head {kind}")
    first = texts.join(F.broadcast(ghosts), texts["doc_id"].eqNullSafe(ghosts["head"]))
    first = first.groupBy("part", "doc_id").agg(F.min("text").alias("text"), F.max(F.col("text").isNull()).alias("e"))
    first = first.select("part", "doc_id", F.when(~F.col("e"), F.col("text")).alias("text"), F.lit(True).alias("ghost"))
    rows = dealt.select("part", "doc_id", "text", F.lit(False).alias("ghost")).union(first)
    ordered = rows.repartition(parts, "part").sortWithinPartitions("part", "ghost", "doc_id", "text")
    return ordered.mapInArrow(partial(_pairs, rank=rank), (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of the whole table."""
    return fingerprints(table(spark, sf_dir, "documents"))
