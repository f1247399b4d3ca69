"""Exact seeded ranks without sorting or shuffling the ranked rows.

Every order-dependent operator (split, cap, sample, undersample) takes "the first n rows of a
class" in the order of a seeded hash of the row key. Instead of numbering rows, ``class_cutoffs``
finds the hash text of the n-th row, so the operator itself becomes a plain filter on that text.
Finding it costs a few small aggregations over the label and key columns only: count rows by hash
prefix, step into the prefix that holds the wanted rank, repeat until few rows are left.
"""

from __future__ import annotations

import os.path
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.session import stored

DEFAULT_SEED = 42
FIRST_DIGITS = 3      # 4,096 prefixes per class in the first pass
NEXT_DIGITS = 4       # 65,536 prefixes in each later pass, over one prefix only
FETCH_ROWS = 2_000    # a prefix with at most this many rows is read out
ABOVE_ALL = "g"       # sorts after every hexadecimal text
ROW_KEY = "_row_key"


def rank_key(*keys: str | Column, seed: int | str = DEFAULT_SEED) -> Column:
    """Seeded hash of the key columns as lower-case hexadecimal text."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def _content_hash(df: DataFrame, seed: int | str) -> Column:
    # a null is marked by its place, as the hash itself skips it
    marks = F.concat(F.lit(str(seed)), *[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in df.columns])
    return _hex16(F.xxhash64(marks, *[F.col(f"`{c}`") for c in df.columns]))


def _hex16(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def with_row_key(df: DataFrame, seed: int | str = DEFAULT_SEED) -> DataFrame:
    """Give a table without a natural key a stored unique ``_row_key``.

    The key is the content hash followed by a number among identical rows, so the same rows have the
    same keys in whatever files and partitions they come. Identical rows are numbered inside the
    partitions of a stored table and the partitions' counts added up; only they are shuffled.
    """
    hashed = stored(df.withColumn("_hash", _content_hash(df, seed)).withColumn(
        "_place", F.monotonically_increasing_id()), "row-key")
    block = F.shiftright("_place", 33)
    sizes = hashed.groupBy("_hash", block.alias("_block")).agg(F.count("*").alias("n"))
    several = sizes.groupBy("_hash").agg(F.sum("n").alias("all")).where("all > 1").select("_hash")
    before = sizes.join(several, "_hash", "left_semi").withColumn(
        "_before", F.sum("n").over(Window.partitionBy("_hash").orderBy("_block")) - F.col("n"))
    inside = F.row_number().over(Window.partitionBy("_hash", "_block").orderBy("_place")) - 1
    copies = (hashed.select("_hash", "_place").join(several, "_hash", "left_semi").withColumn("_block", block)
              .withColumn("_inside", inside).join(before, ["_hash", "_block"])
              .select("_place", (F.col("_before") + F.col("_inside")).alias("_number")))
    numbered = hashed.join(copies, "_place", "left")
    return stored(numbered.withColumn(ROW_KEY, F.concat("_hash", _hex16(F.coalesce("_number", F.lit(0)))))
                  .select(*[F.col(f"`{c}`") for c in df.columns], ROW_KEY), "row-key")


def class_cutoffs(
    df: DataFrame,
    key: Column,
    sizes: Callable[[dict], dict],
    by: str | Column | None = None,
) -> tuple[dict, dict]:
    """Row counts per class and the rank texts at the wanted sizes.

    ``sizes`` maps ``{class: rows}`` to ``{class: [n1, n2, ...]}``. The result is
    ``({class: rows}, {class: [text1, text2, ...]})``: exactly n rows of the class satisfy
    ``key <= text``. Keys must be unique within a class.
    """
    group = F.lit("all") if by is None else (F.col(by) if isinstance(by, str) else by)
    keyed = df.select(group.alias("g"), key.alias("k")).where(F.col("g").isNotNull())

    histogram = _prefix_counts(keyed, F.substring("k", 1, FIRST_DIGITS))
    counts: dict = {}
    for g, _, n, _, _ in histogram:
        counts[g] = counts.get(g, 0) + n
    wanted = sizes(counts)
    found: dict[tuple, str] = {}
    open_ranks = []
    for g, ks in wanted.items():
        for k in set(ks):
            if k <= 0:
                found[(g, k)] = ""
            elif k >= counts.get(g, 0):
                found[(g, k)] = ABOVE_ALL
            else:
                open_ranks.append((g, k, "", k))

    while open_ranks:
        narrowed = [_step_into(histogram, *rank) for rank in open_ranks]
        open_ranks, fetch = [], []
        for g, k, low, high, prefix, rest, n in narrowed:
            if rest == n:                       # the rank ends exactly at this prefix
                found[(g, k)] = high
            elif low == high:
                raise ValueError(f"rank keys are not unique in class {g!r}")
            elif n <= FETCH_ROWS:
                fetch.append((g, k, low, high, rest))
            else:                               # skip digits shared by all keys of the prefix
                shared = os.path.commonprefix([low, high])
                open_ranks.append((g, k, max(prefix, shared, key=len), rest))
        if fetch:
            found.update(_read_out(keyed, fetch))
        if open_ranks:
            deeper = F.coalesce(*[
                F.when((F.col("g") == F.lit(g)) & F.col("k").startswith(p),
                       F.substring("k", 1, len(p) + NEXT_DIGITS))
                for g, p in sorted({(g, p) for g, _, p, _ in open_ranks}, key=str)
            ])
            histogram = _prefix_counts(keyed.where(deeper.isNotNull()), deeper)

    return counts, {g: [found[(g, k)] for k in ks] for g, ks in wanted.items()}


def _prefix_counts(keyed: DataFrame, prefix: Column) -> list[tuple]:
    rows = (
        keyed.groupBy("g", prefix.alias("p"))
        .agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"))
        .toPandas()
        .sort_values("p")
    )
    return list(zip(rows.g.tolist(), rows.p, rows.n.tolist(), rows.low, rows.high))


def _step_into(histogram, g, k, inside, rest):
    for hg, prefix, n, low, high in histogram:
        if hg != g or not prefix.startswith(inside):
            continue
        if rest <= n:
            return g, k, low, high, prefix, rest, n
        rest -= n
    raise ValueError(f"class {g!r} changed between passes; store the input first")


def _read_out(keyed: DataFrame, fetch: list[tuple]) -> dict:
    inside = reduce(
        lambda a, b: a | b,
        [(F.col("g") == F.lit(g)) & F.col("k").between(low, high) for g, _, low, high, _ in fetch],
    )
    rows = keyed.where(inside).toPandas()
    out = {}
    for g, k, low, high, rest in fetch:
        keys = sorted(rows.k[(rows.g == g) & (rows.k >= low) & (rows.k <= high)])
        if keys[rest - 1] == keys[rest]:
            raise ValueError(f"rank keys are not unique in class {g!r}")
        out[(g, k)] = keys[rest - 1]
    return out


def within_cutoff(key: Column, cutoffs: dict, by: str | Column | None = None, slot: int = 0) -> Column:
    """Filter: the row is among the first n of its class (n chosen by ``class_cutoffs``)."""
    if by is None:
        return key <= F.lit(cutoffs["all"][slot]) if "all" in cutoffs else F.lit(False)
    group = F.col(by) if isinstance(by, str) else by
    tests = [(group == F.lit(g)) & (key <= F.lit(texts[slot])) for g, texts in cutoffs.items()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))
