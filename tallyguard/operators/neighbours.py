"""Nearest neighbours among the rows of one class, exact or through a random-projection index.

Copies of a vector are folded first, so a hot group of copies costs no more than a handful of rows.
The distinct vectors are assigned to pivots; the triangle inequality tells which cells can hold a
neighbour of a cell's points, and only those are compared (the pivot-based kNN join known from
the literature). Points are packed into blocks of bounded size, once for each side. A task takes a
query block through the search blocks one after the other, as it reads them from the stored table,
and carries the best so far of every query: no block is shuffled for a pair, and what is written
grows with the points, not with the pairs. By default nothing is approximated and no candidate is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.session import release_table, settings, stored

PIVOT_SHARE = 1 / 16          # cells for every square root of the points, at every size
QUERY_BLOCK = 1_024
SEARCH_BLOCK = 8_192
SUB_BLOCK = 256               # query rows per distance matrix
SENT_ROWS = 2_048             # rows that a map to cells holds and sends at once
BLOCK_BYTES = 4 << 20         # numbers of a block, so that wide vectors come in blocks of fewer rows
FILE_BLOCKS = 4               # search blocks to a file, which a task holds at once
CLOSE = 64                    # candidates a query may have in a block before the block's n-th nearest is looked for
PAIRS = 65_536                # candidates whose differences are held at once
HELD_BLOCKS = 8               # query blocks a task carries at once

def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype("float64") if len(vectors) else np.empty((0, 0))


def _parts(batches):
    """Batches cut to at most SENT_ROWS rows, so that what is computed for each row stays small."""
    for b in batches:
        for lo in range(0, len(b), SENT_ROWS):
            yield b.iloc[lo:lo + SENT_ROWS]


def _sent(rows: pd.DataFrame, row: np.ndarray, cell: np.ndarray):
    """``rows`` with their cells, a row for each, SENT_ROWS at a time."""
    for lo in range(0, len(row), SENT_ROWS):
        yield rows.iloc[row[lo:lo + SENT_ROWS]].assign(cell=cell[lo:lo + SENT_ROWS])


def _pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    sq = ((vectors ** 2).sum(1)[:, None] + (pivots ** 2).sum(1)[None, :] - 2 * vectors @ pivots.T)
    return np.sqrt(np.maximum(sq, 0.0))


def best_in_block(query: np.ndarray, search: np.ndarray, keys: np.ndarray, n: int, worst: np.ndarray | None = None):
    """The n nearest search rows of every query row, ties in key order: (query, search, squared
    distance) index arrays. A matrix product finds the candidates, plain differences decide.
    ``worst`` has the squared distance of every query row beyond which nothing is wanted."""
    n = min(n, len(search))
    worst = np.full(len(query), np.inf) if worst is None else worst
    q_out, s_out, d_out = [], [], []
    s_sq, turned = (search ** 2).sum(1), -2 * search.T
    for start in range(0, len(query), SUB_BLOCK):
        part, most = query[start:start + SUB_BLOCK], worst[start:start + SUB_BLOCK]
        p_sq = (part ** 2).sum(1)
        rough = part @ turned
        rough += s_sq                            # less p_sq, which the limits leave out too
        slack = 1e-9 * (p_sq + s_sq.max() + 1.0)
        near = np.flatnonzero(rough <= (most - p_sq + slack)[:, None])
        if len(near) > CLOSE * len(part):
            least = np.partition(rough, n - 1, axis=1)[:, n - 1]
            near = np.flatnonzero(rough <= (np.minimum(most - p_sq, least) + slack)[:, None])
        qi, si = np.divmod(near, len(search))
        exact = np.empty(len(qi))
        for lo in range(0, len(qi), PAIRS):
            diff = part[qi[lo:lo + PAIRS]] - search[si[lo:lo + PAIRS]]
            exact[lo:lo + PAIRS] = (diff * diff).sum(1)
        wanted = exact <= most[qi]
        qi, si, exact = qi[wanted], si[wanted], exact[wanted]
        order = np.lexsort((keys[si], exact, qi))
        qi, si, exact = qi[order], si[order], exact[order]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left")
        keep = place < n
        q_out.append(qi[keep] + start)
        s_out.append(si[keep])
        d_out.append(exact[keep])
    return np.concatenate(q_out), np.concatenate(s_out), np.concatenate(d_out)


# --- blocks -------------------------------------------------------------------------------------

QUERIES = "block long, cell int, reach double, vids array<binary>, vecs binary, sq binary, near array<string>"
"""A block of query rows: vectors, and the squared distances and keys of the n best so far."""
SEARCHED = "keys array<string>, vecs binary, codes binary, low array<double>"
"""A block of search rows in the order of their code and key; ``low``: the least distance to every pivot."""
ANSWERS = "vid binary, near array<struct<neighbour: string, sq: double>>"


def _block_rows(rows: int, dims: int) -> int:
    return max(1, min(rows, BLOCK_BYTES // (8 * max(1, dims))))


def _pack_queries(kind: str, reach: np.ndarray) -> Callable:
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        cell = int(rows["cell"].iloc[0])
        vecs = np.stack(rows["vec"].to_numpy()).astype(kind).tobytes()
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "cell": [cell], "reach": [reach[cell]],
                             "vids": [list(rows["vid"])], "vecs": [vecs], "sq": [None], "near": [None]})
    return pack


def _pack_searched(kind: str, pivots: np.ndarray | None) -> Callable:
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["code", "key"])
        vecs = np.stack(rows["vec"].to_numpy()).astype(kind)
        low = [0.0] if pivots is None else _pivot_distances(vecs.astype("float64"), pivots).min(0).tolist()
        return pd.DataFrame({"keys": [list(rows["key"])], "vecs": [vecs.tobytes()],
                             "codes": [rows["code"].to_numpy("int64").tobytes()], "low": [low]})
    return pack


def _numbers(value: pa.Scalar, kind: str, rows: int) -> np.ndarray:
    x = np.frombuffer(value.as_buffer(), kind)
    return x.reshape(rows, len(x) // rows)


class _Asked:
    """A query block that meets search blocks: the n best of every row, by distance and key."""

    def __init__(self, row: dict, kind: str, n: int):
        self.row, self.n = row, n
        self.size = size = len(row["vids"].values)
        self.x = _numbers(row["vecs"], kind, size).astype("float64") if row["vecs"].is_valid else None
        self.sq, self.near = np.full((size, n), np.inf), np.full((size, n), "", dtype=object)
        self.visits = None
        if row["sq"].is_valid:
            self.sq = _numbers(row["sq"], "<f8", size).copy()
            self.near = row["near"].values.to_numpy(zero_copy_only=False).reshape(size, n)

    def add(self, q: np.ndarray, sq: np.ndarray, near: np.ndarray, once: bool) -> None:
        """Take in what was found; ``once``: the same key at the same distance counts once."""
        if not len(q):
            return
        rows = np.unique(q)
        q = np.concatenate([q, np.repeat(rows, self.n)])
        sq = np.concatenate([sq, self.sq[rows].ravel()])
        near = np.concatenate([near, self.near[rows].ravel()])
        real = sq < np.inf
        q, sq, near = q[real], sq[real], near[real]
        order = np.lexsort((near, sq, q))
        q, sq, near = q[order], sq[order], near[order]
        if once:
            new = np.r_[True, (q[1:] != q[:-1]) | (sq[1:] != sq[:-1]) | (near[1:] != near[:-1])]
            q, sq, near = q[new], sq[new], near[new]
        place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        keep = place < self.n
        self.sq[rows], self.near[rows] = np.inf, ""
        self.sq[q[keep], place[keep]] = sq[keep]
        self.near[q[keep], place[keep]] = near[keep]

    def batch(self, vectors: bool) -> pa.RecordBatch:
        """The block as a row again, with its vectors or without."""
        near = pa.ListArray.from_arrays(pa.array([0, self.size * self.n], pa.int32()), pa.array(self.near.ravel(), pa.string()))
        kept = [pa.array([self.row[c].as_py()], t) for c, t in (
            ("block", pa.int64()), ("cell", pa.int32()), ("reach", pa.float64()), ("vids", pa.list_(pa.binary())))]
        vecs = pa.array([self.row["vecs"].as_py() if vectors else None], pa.binary())
        return pa.RecordBatch.from_arrays([*kept, vecs, pa.array([self.sq.tobytes()], pa.binary()), near],
                                          ["block", "cell", "reach", "vids", "vecs", "sq", "near"])


def _through(visit: Callable, kind: str, n: int, once: bool, vectors: bool) -> Callable:
    """Pairs of blocks to query blocks with their best; the pairs of a query block come together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Asked] = {}
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(j)[i] for j, c in enumerate(b.schema.names)}
                number = row["block"].as_py()
                if number not in held:
                    if len(held) == HELD_BLOCKS:
                        yield held.pop(next(iter(held))).batch(vectors)
                    held[number] = _Asked(row, kind, n)
                block, keys = held[number], row["s_keys"].values
                q, s, sq = visit(block, _numbers(row["s_vecs"], kind, len(keys)).astype("float64"), row)
                block.add(q, sq, keys.take(pa.array(s)).to_numpy(zero_copy_only=False), once)
        for block in held.values():
            yield block.batch(vectors)
    return run


def _united(kind: str, n: int, once: bool) -> Callable:
    """The rows of a query block that several tasks took, as one."""
    def unite(rows: pa.Table) -> pa.Table:
        one = None
        for b in rows.combine_chunks().to_batches():
            for i in range(b.num_rows):
                block = _Asked({c: b.column(j)[i] for j, c in enumerate(b.schema.names)}, kind, n)
                if one is None:
                    one = block
                else:
                    one.add(np.repeat(np.arange(one.size), n), block.sq.ravel(), block.near.ravel(), once)
        return pa.Table.from_batches([one.batch(True)])
    return unite


def _answers(n: int) -> Callable:
    """What query blocks have found, a row for each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                vids = b.column("vids")[i].values
                sq = _numbers(b.column("sq")[i], "<f8", len(vids))
                found = sq < np.inf
                ends = pa.array(np.r_[0, np.cumsum(found.sum(1))].astype("int32"))
                keys = b.column("near")[i].values.filter(pa.array(found.ravel()))
                pairs = pa.StructArray.from_arrays([keys, pa.array(sq[found])], ["neighbour", "sq"])
                yield pa.RecordBatch.from_arrays([vids, pa.ListArray.from_arrays(ends, pairs)], ["vid", "near"])
    return run


def _shuffles_go() -> dict[str, str]:
    return {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _meet(asked: DataFrame, searched: DataFrame, visit: Callable, kind: str, n: int, once: bool, vectors: bool) -> DataFrame:
    """Query blocks after every search block that may hold a neighbour (``low`` within ``reach``), with their
    ``vectors`` or without. Both tables are released.

    Each file is a partition, a pair of partitions reads both from the stored tables, and the pairs
    of a query partition run one after the other in one task. Were a block nevertheless taken by
    several tasks, its rows are united.
    """
    spark = asked.sparkSession
    whole = {"spark.sql.files.maxPartitionBytes": "1t", "spark.sql.files.openCostInBytes": "1t",
             "spark.sql.execution.arrow.maxBytesPerBatch": "8m", **_shuffles_go()}
    with settings(spark, whole):
        asked, searched = asked.select("*"), searched.select("*")     # planned anew, with these settings
        tasks = max(1, asked._jdf.queryExecution().toRdd().getNumPartitions())
        other = searched.select(*[F.col(c).alias(f"s_{c}") for c in searched.columns]).hint("shuffle_replicate_nl")
        pairs = asked.join(other, F.col("s_low")[F.col("cell")] <= F.col("reach"))
        met = stored(pairs.drop("s_low").coalesce(tasks).mapInArrow(_through(visit, kind, n, once, vectors), QUERIES), "query-blocks", 1)
    release_table(asked)
    release_table(searched)
    if met.count() > met.select("block").distinct().count():
        with settings(spark, _shuffles_go()):
            united = stored(met.groupBy("block").applyInArrow(_united(kind, n, once), QUERIES), "query-blocks", 1)
        release_table(met)
        return united
    return met


def knn_self_join(points: DataFrame, k: int, queries: DataFrame | None = None,
                  key: str = "key", vec: str = "vec", mode: str = "exact", pivot_share: float = PIVOT_SHARE,
                  query_block: int = QUERY_BLOCK, search_block: int = SEARCH_BLOCK, **index) -> DataFrame:
    """The k nearest other points of each point: (key, neighbour, rank, distance).

    ``queries`` restricts the points asked for (column ``key``); the searched points are always
    all. Equal distances are ordered by the key as text. ``mode="hashed"`` looks only into the
    buckets of a random-projection index (``index`` are the options of ``hashed_blocks``): most of
    the nearest, with comparisons that do not grow with the square of the points. Points for which it
    meets fewer than k others are searched exactly.
    """
    if mode not in ("exact", "hashed"):
        raise ValueError("mode must be 'exact' or 'hashed'")
    n = k + 1                                    # one more, a point may find itself
    spark = points.sparkSession
    single = points.schema[vec].dataType == T.ArrayType(T.FloatType(), points.schema[vec].dataType.containsNull)
    kind, vecs = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    folded = points.select(
        F.col(key).cast("string").alias("key"), F.col(vec).cast(vecs).alias("vec"),
        F.unhex(F.md5(F.col(vec).cast("array<double>").cast("string"))).alias("vid"))
    copies = Window.partitionBy("vid").orderBy("key")
    folded = folded.withColumn("copy", F.row_number().over(copies))
    with settings(spark, _shuffles_go()):
        held = stored(folded.withColumn("vec", F.when(F.col("copy") <= n, F.col("vec"))), "points")
        asked = held.select("key", "vid") if queries is None else held.select("key", "vid").join(
            queries.select(F.col(key).cast("string").alias("key")).distinct(), "key", "left_semi")
        asked = stored(asked, "asked")
    search = held.where(F.col("copy") <= n).select("key", "vid", "vec", "copy")
    # a vector's first copy speaks for all its copies
    wanted = search.where("copy = 1").select("vid", "vec")
    if queries is not None:
        wanted = wanted.join(asked.select("vid").distinct(), "vid", "left_semi")

    def exactly(wanted: DataFrame) -> DataFrame:
        return exact_blocks(wanted, search, n, kind, pivot_share, query_block, search_block).mapInArrow(_answers(n), ANSWERS)

    if mode == "hashed":
        near = hashed_blocks(wanted, search, n, kind, query_block, search_block, **index).mapInArrow(_answers(n), ANSWERS)
        few = near.where(F.size("near") < n).select("vid")
        if not few.isEmpty():
            short = stored(wanted.join(few, "vid", "left_semi"), "short-queries")
            near = near.where(F.size("near") >= n).unionByName(exactly(short))
            release_table(short)
    else:
        near = exactly(wanted)
    release_table(held)
    # at most k + 1 entries per vector; every copy drops itself and keeps k
    others = F.slice(F.filter("near", lambda e: e["neighbour"] != F.col("key")), 1, k)
    return (asked.join(near, "vid")
            .select("key", F.posexplode(others).alias("p", "e"))
            .select("key", F.col("e.neighbour").alias("neighbour"),
                    (F.col("p") + 1).alias("rank"), F.sqrt("e.sq").alias("distance")))


# --- the random-projection index ----------------------------------------------------------------

BUCKET = 1.25                 # points a bucket is meant to hold, for every square root of the points
TABLES = 8
PROBES = 16
FIT_ROWS = 20_000             # distinct points the projections' medians are taken from
MOST_BITS = 30
NEAR_BITS = 8                 # bits with the least margins that probes turn over


def probe_codes(margins: np.ndarray, probes: int) -> np.ndarray:
    """Codes of the ``probes`` buckets nearest to every row of projections less their medians.

    The first is the row's own. The others turn over sets of its NEAR_BITS bits of least margin, in
    the order of the sum of the squared margins.
    """
    bits = margins.shape[1]
    own = (margins > 0) @ (1 << np.arange(bits, dtype=np.int64))
    near = min(bits, NEAR_BITS)
    order = np.argsort(np.abs(margins), axis=1)[:, :near]
    least = np.take_along_axis(margins ** 2, order, 1)
    sets = (np.arange(1 << near)[:, None] >> np.arange(near)) & 1
    best = np.argsort(least @ sets.T, axis=1, kind="stable")[:, :probes]
    flips = (sets[best] * (1 << order)[:, None, :]).sum(2)
    return own[:, None] ^ flips


def _index(search: DataFrame, tables: int, bucket: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and medians of the projections, by table.

    In every table a point's bucket is the signs of random projections less their medians, as many
    as leave ``bucket`` points for every square root of all to a bucket; the medians are those of at most FIT_ROWS
    points, all points are in the index.
    """
    n_search = search.count()
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1.0, math.sqrt(n_search) / bucket)))))
    sample = _matrix(search.where("copy = 1").orderBy("vid").limit(FIT_ROWS).toPandas()["vec"])
    dims = sample.shape[1] if len(sample) else 0
    directions = np.random.default_rng(seed).normal(size=(tables, dims, bits))
    medians = np.stack([np.median(sample @ d, axis=0) for d in directions]) if len(sample) else np.zeros((tables, bits))
    return directions, medians


def _pieces(codes: np.ndarray, counts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes in order, their first piece and the number of their pieces: buckets share a piece up to ``rows`` points,
    a larger bucket is cut, so none is capped."""
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    first, cuts = np.zeros(len(codes), "int64"), np.maximum(1, -(-counts // rows))
    piece, filled = 0, 0
    for i, (c, k) in enumerate(zip(counts.tolist(), cuts.tolist())):
        if filled and (k > 1 or filled + c > rows):
            piece, filled = piece + 1, 0
        first[i] = piece
        filled += c
        if k > 1:
            piece, filled = piece + k, 0
    return codes, first, cuts


def _bucket_visits(direction: np.ndarray, median: np.ndarray, probes: int, n: int) -> Callable:
    """Compares the queries of a block with the points of the buckets they visit."""
    def visit(block: _Asked, x: np.ndarray, row: dict):
        if block.visits is None:
            codes = np.concatenate([probe_codes(block.x[lo:lo + SENT_ROWS] @ direction - median, probes)
                                    for lo in range(0, len(block.x), SENT_ROWS)])
            order = np.argsort(codes, axis=None, kind="stable")
            block.visits = codes.ravel()[order], order // codes.shape[1]
        visited, who = block.visits
        codes, start = np.unique(np.frombuffer(row["s_codes"].as_buffer(), "<i8"), return_index=True)
        lo, hi = np.searchsorted(visited, codes, "left"), np.searchsorted(visited, codes, "right")
        found = [(np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0))]
        for i, end in enumerate(np.r_[start[1:], len(x)]):
            if lo[i] < hi[i]:
                rows, at = who[lo[i]:hi[i]], start[i]
                q, s, sq = best_in_block(block.x[rows], x[at:end], np.arange(end - at), n, block.sq[rows, -1])
                found.append((rows[q], s + at, sq))
        return tuple(np.concatenate(f) for f in zip(*found))
    return visit


def hashed_blocks(wanted: DataFrame, search: DataFrame, n: int, kind: str, query_block: int, search_block: int,
            tables: int = TABLES, probes: int = PROBES, bucket: float = BUCKET, seed: int = 42) -> DataFrame:
    """Query blocks with the best of a multi-probe index of random projections.

    A query visits ``probes`` buckets of each table. Tables come one after the other, so that the
    points are there once more than stored, whatever the number of tables.
    """
    spark = search.sparkSession
    directions, medians = _index(search, tables, bucket, seed)
    rows = _block_rows(search_block, directions.shape[1])

    def code_of(x: np.ndarray, t: int) -> np.ndarray:
        return probe_codes(x @ directions[t] - medians[t], 1)[:, 0]

    def counted(batches):
        for b in _parts(batches):
            x = _matrix(b["vec"])
            for t in range(tables):
                codes, count = np.unique(code_of(x, t), return_counts=True)
                yield pd.DataFrame({"t": t, "code": codes, "n": count})

    # a row for each bucket, of which there are a share of the square root of the points
    buckets = (search.select("vec").mapInPandas(counted, "t int, code long, n long")
               .groupBy("t", "code").agg(F.sum("n").alias("n")).toPandas())
    n_wanted = wanted.count()
    size = _block_rows(min(max(query_block, n_wanted // 16), 16 * query_block), directions.shape[1] // 4)
    n_blocks = max(1, math.ceil(n_wanted / size))
    with settings(spark, _shuffles_go()):
        blocks = stored(wanted.select("vid", "vec", F.lit(0).alias("cell"),
                                      F.pmod(F.xxhash64("vid"), F.lit(n_blocks)).alias("block"))
                        .groupBy("block").applyInPandas(_pack_queries(kind, np.array([np.inf])), QUERIES), "query-blocks", 1)
    for t in range(tables):
        of = buckets[buckets["t"] == t]
        codes, first, cuts = _pieces(of["code"].to_numpy("int64"), of["n"].to_numpy("int64"), rows)

        def to_pieces(batches, t=t, codes=codes, first=first, cuts=cuts):
            for b in _parts(batches):
                code = code_of(_matrix(b["vec"]), t)
                at = np.searchsorted(codes, code)
                yield b[["key", "vec"]].assign(code=code, block=first[at] + b["h"].to_numpy() % cuts[at])

        with settings(spark, _shuffles_go()):
            pieces = stored(search.select("key", "vec", F.pmod(F.xxhash64("key"), F.lit(1 << 40)).alias("h"))
                            .mapInPandas(to_pieces, f"key string, vec {search.schema['vec'].dataType.simpleString()}, "
                                                    "code long, block long")
                            .groupBy("block").applyInPandas(_pack_searched(kind, None), SEARCHED), "buckets", FILE_BLOCKS)
        visit = _bucket_visits(directions[t], medians[t], probes, n)
        blocks = _meet(blocks, pieces, visit, kind, n, once=True, vectors=t < tables - 1)
    return blocks


def exact_blocks(wanted: DataFrame, search: DataFrame, n: int, kind: str, pivot_share: float,
           query_block: int, search_block: int) -> DataFrame:
    """Query blocks with the nearest of all search rows."""
    spark = search.sparkSession
    n_search = search.count()
    n_pivots = max(1, round(pivot_share * math.sqrt(n_search)))
    pivots = _matrix(search.where("copy = 1").orderBy("vid").limit(n_pivots).toPandas()["vec"])
    if not len(pivots):
        pivots = np.zeros((1, 1))
    n_pivots = len(pivots)
    vec = search.schema["vec"].dataType.simpleString()

    def nearest_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = _pivot_distances(x, pivots)
        return d.argmin(1).astype("int32"), d.min(1)

    def distances(batches):
        for b in _parts(batches):
            cell, d = nearest_of(_matrix(b["vec"]))
            yield pd.DataFrame({"cell": cell, "d": d})

    if n_pivots == 1:
        reach = np.array([np.inf])
        in_q, in_s = np.array([wanted.count()]), np.array([n_search])
    else:
        near_pivot = stored(search.select("vec").mapInPandas(distances, "cell int, d double"), "pivot-distances")
        closest = Window.partitionBy("cell").orderBy("d")
        inner = (near_pivot.withColumn("r", F.row_number().over(closest)).where(F.col("r") <= n).toPandas())
        spread = (wanted.select("vec").mapInPandas(distances, "cell int, d double")
                  .groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("far")).toPandas())
        reach = _reach(pivots, inner, spread, n)
        in_q, in_s = np.zeros(n_pivots, "int64"), np.zeros(n_pivots, "int64")
        in_q[spread["cell"]] = spread["n"]
        for r in near_pivot.groupBy("cell").agg(F.count("*").alias("n")).collect():
            in_s[r["cell"]] = r["n"]
        release_table(near_pivot)

    def to_blocks(counts: np.ndarray, size: int, columns: list[str]):
        """Rows with the block they go to: a cell is cut into blocks by the rows' hash."""
        cuts = np.maximum(1, -(-counts // size))
        first = np.r_[0, np.cumsum(cuts)[:-1]]

        def run(batches):
            for b in _parts(batches):
                cell = np.zeros(len(b), "int32") if n_pivots == 1 else nearest_of(_matrix(b["vec"]))[0]
                yield b[columns].assign(cell=cell, code=0, block=first[cell] + b["h"].to_numpy() % cuts[cell])
        return run

    def hashed(column: str):
        return F.pmod(F.xxhash64(column), F.lit(1 << 40)).alias("h")

    dims = pivots.shape[1]
    with settings(spark, _shuffles_go()):
        asked = stored(wanted.select("vid", "vec", hashed("vid"))
                       .mapInPandas(to_blocks(in_q, _block_rows(query_block, dims), ["vid", "vec"]),
                                    f"vid binary, vec {vec}, cell int, code long, block long")
                       .groupBy("block").applyInPandas(_pack_queries(kind, reach), QUERIES), "query-blocks", 1)
        searched = stored(search.select("key", "vec", hashed("key"))
                          .mapInPandas(to_blocks(in_s, _block_rows(search_block, dims), ["key", "vec"]),
                                       f"key string, vec {vec}, cell int, code long, block long")
                          .groupBy("block").applyInPandas(_pack_searched(kind, pivots if n_pivots > 1 else None), SEARCHED),
                          "search-blocks", FILE_BLOCKS)

    def visit(block: _Asked, x: np.ndarray, row: dict):
        reach, cell = row["reach"].as_py(), row["cell"].as_py()
        at = np.arange(len(x))
        if reach < np.inf:
            at = np.flatnonzero(_pivot_distances(x, pivots[cell:cell + 1])[:, 0] <= reach)
            if not len(at):
                return at, at, np.empty(0)
        q, s, sq = best_in_block(block.x, x[at], at, n, block.sq[:, -1])
        return q, at[s], sq

    return _meet(asked, searched, visit, kind, n, once=False, vectors=False)


def _reach(pivots: np.ndarray, inner: pd.DataFrame, spread: pd.DataFrame, n: int) -> np.ndarray:
    """Per cell the largest distance to its pivot at which a point can still matter.

    For any query within ``far`` of pivot i, a point at distance d of pivot j is at most
    far + |p_i p_j| + d away; the n-th smallest of these bounds every query's n-th neighbour.
    """
    between = _pivot_distances(pivots, pivots)
    reach = np.full(len(pivots), -1.0)
    cell, d = inner["cell"].to_numpy(), inner["d"].to_numpy()
    for i, far in zip(spread["cell"], spread["far"]):
        bounds = np.sort(far + between[i, cell] + d)
        bound = bounds[n - 1] if len(bounds) >= n else np.inf
        reach[i] = (far + bound) * (1 + 1e-9) + 1e-9
    return reach
