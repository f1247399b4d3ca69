"""Exact set-similarity join of many texts' parts: rare-first prefixes, length, positional and parity filters.

A part (a line, a whole text) is a set of hashed elements (words, shingles). Elements are ordered by
rarity: a level from a table of ``2**BUCKET_BITS`` corpus-wide counts, then their hash. Two sets of
Jaccard similarity t or more share an element among the first n - ceil(t n) + 1 of both, so only
those are joined. Every table that grows with the corpus stays in Spark; what is broadcast is the
level table (4 MB) and a bitmap of candidates (4 MB), whatever the corpus.

Elements are compared by 46 bits of their hash and their level, parts by 64 bits.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm.textscan import Scan, chain, give_back, mix, owners, ranges, slices
from tallyguard.session import scratch_path, stored

BUCKET_BITS = 22
BLOCK_BITS = 16
CANDIDATE_BITS = 25
HASH_BITS = 46
BLOCK = 1 << 12
PAIR_BLOCK = 1 << 18
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LANES = 8
"""64-bit parity words of the sketches that pairs are sifted by."""
PACK_ROWS, BUCKET_ROWS = 1 << 19, 1 << 17
"""Prefix rows that a task sorts into buckets at a time, and rows of a bucket."""
HOT_LEVEL = 40
"""Level from which an element (a million occurrences or more) is dealt over several tasks."""


@dataclass
class Parts:
    """Parts of consecutive rows: ``elements[first[i]:first[i + 1]]`` belong to part ``number[i]`` of row ``row[i]``."""
    row: np.ndarray
    number: np.ndarray
    first: np.ndarray
    elements: np.ndarray


def line_parts(raw: np.ndarray, at: np.ndarray, least: int) -> Parts:
    """The words of every line with at least ``least`` words; A-Z count as a-z."""
    scan = Scan(raw, at, lower=True)
    start, end, _ = scan.words()
    hashes = scan.word_hashes(start, end)
    lines, _, first_line = scan.lines()
    first = np.r_[np.searchsorted(start, lines), len(start)]
    size = np.diff(first)
    keep = size >= max(1, least)
    row = owners(first_line)
    number = np.arange(len(lines)) - first_line[row]
    return Parts(row[keep], number[keep], np.r_[0, np.cumsum(size[keep])], hashes[np.repeat(keep, size)])


def shingle_parts(raw: np.ndarray, at: np.ndarray, width: int) -> Parts:
    """The word shingles of every text (all words as one where they are fewer); none for no words."""
    scan = Scan(raw, at, lower=True)
    start, end, first_word = scan.words()
    hashes = scan.word_hashes(start, end)
    words = np.diff(first_word)
    row = np.flatnonzero(words)
    count = np.maximum(words[row] - width + 1, 1)
    wide = chain(hashes, width)
    picks = ranges(first_word[row], count)
    elements = np.empty(len(picks), np.uint64)
    first = np.r_[0, np.cumsum(count)]
    short = words[row] < width
    whole = np.repeat(~short, count)
    elements[whole] = wide[picks[whole]]
    for i in np.flatnonzero(short):
        lo = first_word[row[i]]
        elements[first[i]] = chain(hashes[lo:lo + words[row[i]]], words[row[i]])[0] + np.uint64(words[row[i]])
    return Parts(row, np.zeros(len(row), np.int64), first, elements)


def signatures(parts: Parts) -> np.ndarray:
    """A hash of each part's elements in their order."""
    if not len(parts.row):
        return np.zeros(0, np.uint64)
    place = np.arange(len(parts.elements)) - np.repeat(parts.first[:-1], np.diff(parts.first))
    return mix(np.add.reduceat(mix(parts.elements + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                               parts.first[:-1]))


def chosen(parts: Parts, keep: np.ndarray) -> Parts:
    """Some of the parts."""
    size = np.diff(parts.first)
    return Parts(parts.row[keep], parts.number[keep], np.r_[0, np.cumsum(size[keep])],
                 parts.elements[np.repeat(keep, size)])


def ordered_sets(parts: Parts, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first): each part's distinct elements, rare ones first, as level and hash in one number."""
    level = levels[(parts.elements >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64)
    code = (level << np.uint64(HASH_BITS)) | (parts.elements & np.uint64((1 << HASH_BITS) - 1))
    shift = np.uint64(HASH_BITS + 6)
    out, sizes = [], []
    for lo in range(0, len(parts.row), BLOCK):
        hi = min(lo + BLOCK, len(parts.row))
        a, b = parts.first[lo], parts.first[hi]
        part = np.repeat(np.arange(hi - lo, dtype=np.uint64), np.diff(parts.first[lo:hi + 1]))
        key = np.sort((part << shift) | code[a:b])
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        key = key[new]
        out.append(key & ((np.uint64(1) << shift) - np.uint64(1)))
        sizes.append(np.bincount((key >> shift).astype(np.int64), minlength=hi - lo))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(out), np.r_[0, np.cumsum(np.concatenate(sizes))]


def fresh(signature: np.ndarray, seen: set) -> np.ndarray:
    """Which signatures are new to this task, first ones only."""
    keep = np.zeros(len(signature), bool)
    for i, x in enumerate(signature.tolist()):
        if x not in seen:
            seen.add(x)
            keep[i] = True
    return keep


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python in batches of at most 8 MB, so that long texts and sets need no more memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


SCAN_SCHEMA = "kind int, id long, number int, sig long, n long, data binary"
PART, COUNT, ROW = 0, 1, 2


def _scan(batches: Iterator[pa.RecordBatch], cut: Callable, distinct: bool) -> Iterator[pa.RecordBatch]:
    """Part rows (id, number, sig, n), a row of each text (sig: its parts, n: its lines), packed counts by block."""
    counts, seen, waiting = np.zeros(1 << BUCKET_BITS, np.uint32), set(), []

    def count() -> None:
        np.add(counts, np.bincount(np.concatenate(waiting), minlength=len(counts)), out=counts, casting="unsafe")
        waiting.clear()

    flat = np.zeros(1 << BUCKET_BITS, np.uint8)

    def rows(kind, ids, number, sig, n, data=None):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), kind, np.int32)), ids, pa.array(number.astype(np.int32)), _long(sig), _long(n),
             pa.array(data or [None] * len(n), pa.binary())], ["kind", "id", "number", "sig", "n", "data"])

    for batch in batches:
        ids = batch.column(0)
        for lo, hi, raw, at in slices(batch.column(1)):
            parts = cut(raw, at)
            sig = signatures(parts)
            n = np.diff(parts.first)
            if distinct:
                _, first = ordered_sets(parts, flat)
                n = np.diff(first)
            yield rows(PART, ids.take(pa.array(parts.row + lo)), parts.number, sig, n)
            newlines = np.r_[0, np.cumsum(raw == 10)][at]
            zero = np.zeros(hi - lo, np.int64)
            held = np.bincount(parts.row, minlength=hi - lo)
            yield rows(ROW, ids.slice(lo, hi - lo), zero, held, np.diff(newlines) + 1)
            new = chosen(parts, fresh(sig, seen))
            waiting.append((new.elements >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
            if sum(map(len, waiting)) >= len(counts):
                count()
    if waiting:
        count()
    parts_of = counts.reshape(-1, 1 << BLOCK_BITS)
    used = np.flatnonzero(parts_of.any(1))
    if len(used):
        zero = np.zeros(len(used), np.int64)
        yield rows(COUNT, _long(used), zero, zero, zero, [zlib.compress(parts_of[i].tobytes(), 1) for i in used])
    give_back()


def scan_parts(docs: DataFrame, cut: Callable, distinct: bool) -> DataFrame:
    """One pass over (doc_id, text): all parts, rows and bucket counts, stored by kind."""
    spark = docs.sparkSession
    small_batches(spark)
    path = scratch_path(spark, "parts")
    found = docs.mapInArrow(partial(_scan, cut=cut, distinct=distinct), SCAN_SCHEMA)
    found.write.partitionBy("kind").parquet(path)
    return spark.read.schema(SCAN_SCHEMA).parquet(path)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, levels): the packed counts of each block in this partition added up, one block a key."""
    blocks: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = np.frombuffer(zlib.decompress(data.as_py()), np.uint32)
            blocks[block] = blocks[block] + found if block in blocks else found.astype(np.uint64)
    for block, n in blocks.items():
        level = np.where(n > 1, np.clip(np.floor(2 * np.log2(np.maximum(n, 2))), 1, 63), 0).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([level.tobytes()], pa.binary())],
                                         ["block", "levels"])


def rarity_levels(scanned: DataFrame) -> np.ndarray:
    """Level of every bucket: 0 for at most one occurrence, else twice the count's binary logarithm."""
    packed = scanned.where(F.col("kind") == COUNT).select("id", "data")
    blocks = packed.repartition(16, "id").mapInArrow(_summed, "block long, levels binary")
    out = np.zeros(1 << BUCKET_BITS, np.uint8)
    for block, levels in blocks.collect():                   # 2**BUCKET_BITS bytes in all
        out[block << BLOCK_BITS:block + 1 << BLOCK_BITS] = np.frombuffer(levels, np.uint8)
    return out


def parities(codes: np.ndarray, first: np.ndarray, lanes: int) -> list[np.ndarray]:
    """For every set, whether each of 64 * lanes classes of elements holds an odd number: words of bits.

    Classes that differ between two sets hold an element of only one of them, so their number bounds
    the size of the symmetric difference from below. ``lanes`` is a power of two.
    """
    bit = np.uint64(1) << (codes & np.uint64(63))
    lane = codes >> np.uint64(6) & np.uint64(lanes - 1)
    return [np.bitwise_xor.reduceat(np.where(lane == i, bit, np.uint64(0)), first[:-1]) if len(codes) else codes
            for i in range(lanes)]


PREFIX_SCHEMA = "key long, sig long, n int, pos int"
PACK_SCHEMA = "bucket int, data binary"


def prefix_kind(lanes: int) -> np.dtype:
    """A prefix row on its way through the network."""
    return np.dtype([("key", "<i8"), ("sig", "<i8"), ("n", "<i4"), ("pos", "<i4"), ("parity", "<u8", (lanes,))])


def packed(rows: np.ndarray) -> bytes:
    """The rows' first bytes, then their second ones and so on, so that bytes most rows share compress."""
    return rows.view(np.uint8).reshape(len(rows), -1).T.tobytes()


def unpacked(data: pa.Buffer, kind: np.dtype) -> np.ndarray:
    """The rows that ``packed`` made."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def prefix_length(n: np.ndarray, t: float) -> np.ndarray:
    """Elements of which similar sets share one: n - ceil(t n) + 1."""
    return n - np.ceil(t * n - 1e-9).astype(n.dtype) + 1


def prefix_rows(parts: Parts, sig: np.ndarray, levels: np.ndarray, t: float, lanes: int) -> np.ndarray:
    """A row for each element of a part's prefix that is not the only one of its bucket of counts."""
    codes, first = ordered_sets(parts, levels)
    n = np.diff(first)
    part = owners(first)
    pos = np.arange(len(codes)) - first[part]
    pick = (pos < prefix_length(n, t)[part]) & (codes >> np.uint64(HASH_BITS) > 0)
    rows = np.empty(int(pick.sum()), prefix_kind(lanes))
    part = part[pick]
    rows["key"], rows["sig"], rows["n"], rows["pos"] = codes[pick], sig[part].view(np.int64), n[part], pos[pick]
    for i, x in enumerate(parities(codes, first, lanes)):
        rows["parity"][:, i] = x[part]
    return rows


def dealt(rows: np.ndarray, rounds: int, buckets: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """(round, bucket) of prefix rows: one for all rows of a key, any for those of very frequent keys."""
    frequent = rows["key"] >> HASH_BITS >= hot
    spread = mix(np.where(frequent, rows["sig"], rows["key"]).view(np.uint64))
    return spread % np.uint64(rounds), ((spread >> np.uint64(20)) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))


def _prefixes(batches: Iterator[pa.RecordBatch], cut: Callable, levels, t: float, lanes: int, turn: int, rounds: int,
              buckets: int, hot: int) -> Iterator[pa.RecordBatch]:
    """(bucket, packed prefix rows of one round): PACK_ROWS rows are sorted into their buckets at a time."""
    seen: set = set()
    waiting: list[np.ndarray] = []

    def packs() -> pa.RecordBatch:
        rows = np.concatenate(waiting)
        waiting.clear()
        bucket = dealt(rows, rounds, buckets, hot)[1]
        order = np.argsort(rows["key"])
        order = order[np.argsort(bucket[order], kind="stable")]
        rows, (ids, at) = rows[order], np.unique(bucket[order], return_index=True)
        data = [packed(rows[lo:hi]) for lo, hi in zip(at, [*at[1:], len(rows)])]
        return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(data, pa.binary())],
                                          ["bucket", "data"])

    for batch in batches:
        for _, _, raw, at in slices(batch.column(1)):
            parts = cut(raw, at)
            sig = signatures(parts)
            keep = fresh(sig, seen)
            rows = prefix_rows(chosen(parts, keep), sig[keep], levels.value, t, lanes)
            rows = rows[dealt(rows, rounds, buckets, hot)[0] == turn]
            if len(rows):
                waiting.append(rows)
            if sum(map(len, waiting)) >= PACK_ROWS:
                yield packs()
    if waiting:
        yield packs()
    give_back()


def _alive(key, sig, n, pos, parity: list[np.ndarray], t: float) -> np.ndarray:
    """Which rows (sorted by key and n) have another of their key that passes all filters."""
    size = len(key)
    alive = np.zeros(size, bool)
    group = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1

    def test(a, b):
        need = np.ceil(t / (1 + t) * (n[a] + n[b]) - 1e-9)
        most = np.minimum(n[a] - pos[a], n[b] - pos[b])
        ok = (sig[a] != sig[b]) & (most >= need) & (n[b] * t <= n[a] + 1e-9)
        a, b = a[ok], b[ok]
        apart = sum(np.bitwise_count(x[a] ^ x[b]) for x in parity)
        ok = apart <= n[a] + n[b] - 2 * need[ok]
        alive[a[ok]] = True
        alive[b[ok]] = True

    for step in (1, 2):                                       # near neighbours settle most rows
        a = np.arange(size - step)
        a = a[(group[a] == group[a + step]) & ~(alive[a] & alive[a + step])]
        test(a, a + step)
    code = (group << 32) | n
    todo = np.flatnonzero(~alive)
    at_least, at_most = np.ceil(n[todo] * t - 1e-9).astype(np.int64), np.floor(n[todo] / t + 1e-9).astype(np.int64)
    high = np.searchsorted(code, (group[todo] << 32) | at_most, "right")
    low = np.searchsorted(code, (group[todo] << 32) | at_least, "left")
    count = high - low
    at = 0
    total = np.cumsum(count)
    while at < len(todo):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIR_BLOCK, "right")))
        a = np.repeat(todo[at:end], count[at:end])
        b = ranges(low[at:end], count[at:end])
        test(np.minimum(a, b), np.maximum(a, b))
        at = end
    return alive


def _settled(rows: np.ndarray, t: float, hot: int) -> pa.RecordBatch:
    """The rows of a bucket with a possible partner; those of very frequent keys have one anyway."""
    frequent = rows["key"] >> HASH_BITS >= hot
    rest = rows[~frequent]
    order = np.argsort(rest["key"])
    key = rest["key"][order]
    same = key[1:] == key[:-1]
    if same.any():
        rest = rest[order[np.r_[False, same] | np.r_[same, False]]]
        rest = rest[np.lexsort((rest["n"], rest["key"]))]
        parity = [np.ascontiguousarray(rest["parity"][:, i]) for i in range(rest["parity"].shape[1])]
        key, sig = (np.ascontiguousarray(rest[c]) for c in ("key", "sig"))
        rest = rest[_alive(key, sig, rest["n"].astype(np.int64), rest["pos"].astype(np.int64), parity, t)]
    else:
        rest = rest[:0]
    out = np.concatenate([rows[frequent], rest])
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[c])) for c in ("key", "sig", "n", "pos")],
                                      ["key", "sig", "n", "pos"])


def _shared(batches: Iterator[pa.RecordBatch], t: float, lanes: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Prefix rows with a possible partner, from packs sorted by bucket; only a bucket's rows are held together."""
    kind, held, current = prefix_kind(lanes), [], None
    for batch in batches:
        for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if held and bucket != current:
                yield _settled(np.concatenate(held), t, hot)
                held = []
            current = bucket
            held.append(unpacked(data.as_buffer(), kind))
    if held:
        yield _settled(np.concatenate(held), t, hot)
    held = []
    give_back()


def shared_prefixes(docs: DataFrame, cut: Callable, levels, t: float, scanned: DataFrame, lanes: int,
                    rounds: int) -> DataFrame:
    """Stored rows (key, sig, n, pos): prefix elements that may join their part with another.

    ``lanes`` 64-bit parity words go with every row. The keys are dealt over ``rounds``, each with a pass over the
    texts, so that only a share of the prefix rows is on disk at a time (few rows go in one); buckets, in number as
    the rows, bound a task's memory.
    """
    spark = docs.sparkSession
    length = F.col("n") - F.ceil(F.lit(t) * F.col("n") - 1e-9) + 1
    expected = scanned.where(F.col("kind") == PART).agg(F.sum(length)).first()[0] or 0
    rounds = rounds if expected >= PACK_ROWS else 1
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-expected // (rounds * BUCKET_ROWS)))
    out = None
    for turn in range(rounds):
        packs = docs.mapInArrow(partial(_prefixes, cut=cut, levels=levels, t=t, lanes=lanes, turn=turn, rounds=rounds,
                                        buckets=buckets, hot=HOT_LEVEL), PACK_SCHEMA)
        sorted_packs = packs.repartition("bucket").sortWithinPartitions("bucket")
        with shuffles_removed(spark):
            found = stored(sorted_packs.mapInArrow(partial(_shared, t=t, lanes=lanes, hot=HOT_LEVEL), PREFIX_SCHEMA),
                           "prefixes")
        out = found if out is None else out.union(found)
        del packs, sorted_packs
        free_shuffles(spark)
    return out


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of every write when it ends, not when the driver's garbage goes."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver collect its garbage, upon which Spark deletes the shuffle files of finished steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


SKETCH = [f"s{i}" for i in range(LANES)]
SET_SCHEMA = "sig long, n int, codes binary, " + ", ".join(f"{c} long" for c in SKETCH)


def _sets(batches: Iterator[pa.RecordBatch], cut: Callable, levels, wanted) -> Iterator[pa.RecordBatch]:
    seen: set = set()
    for batch in batches:
        for _, _, raw, at in slices(batch.column(1)):
            parts = cut(raw, at)
            sig = signatures(parts)
            bit = sig & np.uint64((1 << CANDIDATE_BITS) - 1)
            asked = (wanted.value[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)
            keep = asked.astype(bool)
            keep[keep] = fresh(sig[keep], seen)
            codes, first = ordered_sets(chosen(parts, keep), levels.value)
            if len(first) > 1:
                yield pa.RecordBatch.from_arrays(
                    [_long(sig[keep]), pa.array(np.diff(first).astype(np.int32)),
                     pa.array([codes[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary()),
                     *(_long(x) for x in parities(codes, first, LANES))], ["sig", "n", "codes", *SKETCH])
    seen.clear()
    give_back()


def candidate_sets(docs: DataFrame, cut: Callable, levels, shared: DataFrame) -> DataFrame:
    """Stored sets and sketches of the parts in ``shared``, from one more pass; a bitmap keeps most others out."""
    spark = docs.sparkSession
    bit = F.col("sig").bitwiseAND((1 << CANDIDATE_BITS) - 1)
    words = shared.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("mask")).toPandas()    # at most 2**19 rows
    wanted = np.zeros(1 << CANDIDATE_BITS - 6, np.uint64)
    wanted[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    found = docs.mapInArrow(partial(_sets, cut=cut, levels=levels, wanted=spark.sparkContext.broadcast(wanted)),
                            SET_SCHEMA)
    return stored(found.dropDuplicates(["sig"]), "sets")


def sketched(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """Prefix rows with the sketch of their part."""
    return shared.join(sets.select("sig", *SKETCH), "sig")


def possible(left: str, right: str, t: float) -> str:
    """SQL of the length, positional and parity filters between two sketched prefix rows."""
    a, b = left, right
    need = f"ceil({t / (1 + t)!r}D * ({a}.n + {b}.n) - 1e-9)"
    apart = " + ".join(f"bit_count({a}.{c} ^ {b}.{c})" for c in SKETCH)
    return (f"least({a}.n, {b}.n) >= greatest({a}.n, {b}.n) * {t!r}D - 1e-9"
            f" AND least({a}.n - {a}.pos, {b}.n - {b}.pos) >= {need} AND {apart} <= {a}.n + {b}.n - 2 * {need}")


def _similar(batches: Iterator[pa.RecordBatch], t: float) -> Iterator[pa.RecordBatch]:
    shift = np.uint64(HASH_BITS + 6)
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            some = batch.slice(lo, 256)
            k = some.num_rows
            keys, sizes = [], []
            for name in ("codes_a", "codes_b"):
                raw, at = _binary(some.column(name))
                size = np.diff(at) // 8
                keys.append((np.repeat(np.arange(k, dtype=np.uint64), size) << shift) | raw.view(np.uint64))
                sizes.append(size)
            both = np.sort(np.concatenate(keys))
            same = np.bincount((both[1:][both[1:] == both[:-1]] >> shift).astype(np.int64), minlength=k)
            ok = same >= t * (sizes[0] + sizes[1] - same) - 1e-9
            if ok.any():
                yield pa.RecordBatch.from_arrays([some.column("a"), some.column("b")], ["a", "b"]).filter(pa.array(ok))


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].copy(), at - at[0]


def similar_pairs(pairs: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """The pairs (a, b) of signatures whose sets have Jaccard similarity t or more; each is verified once."""
    codes = sets.select("sig", "codes")
    both = (pairs.join(codes.select(F.col("sig").alias("a"), F.col("codes").alias("codes_a")), "a")
            .join(codes.select(F.col("sig").alias("b"), F.col("codes").alias("codes_b")), "b")
            .select("a", "b", "codes_a", "codes_b"))
    return both.mapInArrow(partial(_similar, t=t), "a long, b long")
