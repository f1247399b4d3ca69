"""Splits, caps, samples and class balancing, all as filters on exact rank cutoffs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.operators.ranking import DEFAULT_SEED, class_cutoffs, within_cutoff

TEST_SHARE = 0.10
VAL_SHARE = 0.1111


def _half_up(x: float) -> int:
    return int(x + 0.5)


def split_sizes(n: int) -> tuple[int, int]:
    """Test rows and validation rows of a class with ``n`` rows (80/10/10)."""
    test = _half_up(TEST_SHARE * n)
    return test, _half_up(VAL_SHARE * (n - test))


def stratified_split(df: DataFrame, key: Column, label: str = "label") -> DataFrame:
    """Add ``split``: first 10 % of each class by rank is test, the next 11.11 % of the rest is
    val, the remainder is train."""
    def sizes(counts):
        return {g: [split_sizes(n)[0], sum(split_sizes(n))] for g, n in counts.items()}

    _, cuts = class_cutoffs(df, key, sizes, by=label)
    # as a column of its own the hash is computed once per row
    ranked = F.col("_rank_key")
    split = (
        F.when(within_cutoff(ranked, cuts, label, 0), "test")
        .when(within_cutoff(ranked, cuts, label, 1), "val")
        .otherwise("train")
    )
    return df.withColumn("_rank_key", key).withColumn("split", split).drop("_rank_key")


def exact_fraction_sample(df: DataFrame, key: Column, fraction: float) -> DataFrame:
    """Exactly round(fraction * n) rows."""
    _, cuts = class_cutoffs(df, key, lambda c: {g: [round(fraction * n)] for g, n in c.items()})
    return df.where(within_cutoff(key, cuts))


def cap_sizes(n_fraud: int, n_legit: int, max_rows: int) -> tuple[int, int]:
    """Fraud and legit rows kept by the class-share preserving cap."""
    total = n_fraud + n_legit
    if not max_rows or total <= max_rows:
        return n_fraud, n_legit
    keep_fraud = int(max_rows * (n_fraud / total))
    return min(keep_fraud, n_fraud), min(max_rows - keep_fraud, n_legit)


def stratified_cap(df: DataFrame, key: Column, max_rows: int | None = None,
                   label: str = "label") -> DataFrame:
    """At most ``max_rows`` rows at the original class share; smaller inputs pass unchanged."""
    if not max_rows:
        return df

    def sizes(counts):
        fraud, legit = cap_sizes(counts.get(1, 0), counts.get(0, 0), max_rows)
        return {1: [fraud], 0: [legit]}

    counts, cuts = class_cutoffs(df, key, sizes, by=F.col(label).cast("int"))
    if sum(counts.values()) <= max_rows:
        return df
    return df.where(within_cutoff(key, cuts, F.col(label).cast("int")))


def balanced_sizes(n_fraud: int, n_legit: int, max_samples: int) -> tuple[int, int]:
    """Fraud and legit rows kept by the class-balanced head cap."""
    fraud = min(max_samples // 2, n_fraud)
    return fraud, min(max_samples - fraud, n_legit)


def balanced_head_cap(df: DataFrame, line_key: Column, is_fraud: str | Column,
                      max_samples: int | None = None) -> DataFrame:
    """The first half-cap of fraud rows and the rest of the cap in legit rows, in line order.

    ``line_key`` must sort as text in line order (pad numbers with zeros) in hexadecimal digits.
    """
    if not max_samples:
        return df
    fraud_flag = F.col(is_fraud) if isinstance(is_fraud, str) else is_fraud
    flag = F.coalesce(fraud_flag.cast("int"), F.lit(0))

    def sizes(counts):
        fraud, legit = balanced_sizes(counts.get(1, 0), counts.get(0, 0), max_samples)
        return {1: [fraud], 0: [legit]}

    _, cuts = class_cutoffs(df, line_key, sizes, by=flag)
    return df.where(within_cutoff(line_key, cuts, flag))


def line_key(position: str | Column) -> Column:
    """A number as fixed-width hexadecimal text that sorts like the number."""
    c = F.col(position) if isinstance(position, str) else position
    return F.lpad(F.lower(F.hex(c.cast("bigint"))), 16, "0")


def seeded_shuffle(df: DataFrame, key: Column) -> DataFrame:
    """Order rows by their seeded hash (a distributed range sort)."""
    return df.orderBy(key)


def random_undersample(df: DataFrame, key: Column, ratio: float = 0.5, label: str = "label",
                       n_minority: int | None = None) -> DataFrame:
    """Keep all minority rows and int(n_minority / ratio) majority rows."""
    def sizes(counts):
        minority = counts.get(1, 0) if n_minority is None else n_minority
        return {0: [int(minority / ratio)]}

    _, cuts = class_cutoffs(df, key, sizes, by=label)
    return df.where((F.col(label) == 1) | within_cutoff(key, cuts, label))


@dataclass(frozen=True)
class ResamplePlan:
    """Which resampling steps run, and the row numbers they produce."""

    n_minority: int
    n_majority: int
    oversample: bool
    undersample: bool
    n_synthetic: int
    keep_majority: int


def resample_plan(n_minority: int, n_majority: int, over: float = 0.1,
                  under: float = 0.5) -> ResamplePlan:
    """Decide the two resampling steps from the class counts alone."""
    if n_majority <= 0:
        raise ValueError("resampling needs majority rows")
    oversample = n_minority / n_majority < over
    expected = max(n_minority, int(n_majority * over))
    undersample = expected / n_majority < under
    n_synthetic = max(int(n_majority * over - n_minority), 0) if oversample else 0
    keep = min(int((n_minority + n_synthetic) / under), n_majority) if undersample else n_majority
    return ResamplePlan(n_minority, n_majority, oversample, undersample, n_synthetic, keep)


def length_buckets(df: DataFrame, length: str, width: int = 64, out: str = "length_bucket") -> DataFrame:
    """Number examples by length class, for export in groups of similar length."""
    return df.withColumn(out, F.floor(F.col(length) / F.lit(width)).cast("bigint"))


def group_by_length(df: DataFrame, length: str, key: Column, partitions: int | None = None) -> DataFrame:
    """Range-partition by (length, key) and sort inside, so neighbours have similar length.

    The key is part of the range, so one very common length still spreads over partitions.
    """
    ranged = df.withColumn("_k", key)
    ranged = (ranged.repartitionByRange(partitions, length, "_k") if partitions
              else ranged.repartitionByRange(length, "_k"))
    return ranged.sortWithinPartitions(length, "_k").drop("_k")


def length_batches(df: DataFrame, length: str, key: Column, budget: int, mega: int = 50, seed: int | str = 42) -> DataFrame:
    """Training batches of similar lengths in random order: columns mega, batch, place, longest and padding.

    Rows are dealt by a seeded hash of their key into mega-batches of about ``mega`` batches, so what
    is trained together changes with the seed; inside one they are sorted from the longest, and a new
    batch begins where the lengths so far pass a multiple of ``budget``. ``place`` counts from 0 in a
    batch, ``longest`` is the length its rows are padded to, ``padding`` what the row needs for that.
    The mega-batches are even whatever the lengths are, and each is one window; a null length is 0.
    """
    size = F.coalesce(F.col(length), F.lit(0)).cast("bigint")
    hashed = F.md5(F.concat(F.lit(f"{seed}|length-batches|"), key))
    rows = df.withColumns({"_size": size, "_hash": hashed})
    total = df.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-total // (mega * budget)))
    dealt = rows.withColumn("mega", F.conv(F.substring("_hash", 1, 12), 16, 10).cast("bigint") % count)
    order = Window.partitionBy("mega").orderBy(F.desc("_size"), "_hash")
    before = F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_size")
    cut = dealt.withColumn("batch", F.floor(before / F.lit(budget)).cast("bigint"))
    own = Window.partitionBy("mega", "batch")
    place = F.row_number().over(own.orderBy(F.desc("_size"), "_hash")) - 1
    return (cut.withColumns({"place": place, "longest": F.max("_size").over(own)})
            .withColumn("padding", F.col("longest") - F.col("_size")).drop("_size", "_hash"))


def padding_report(batches: DataFrame) -> DataFrame:
    """Batches, rows, and the share of padding in all that ``length_batches`` lays out."""
    return batches.agg(
        F.count_if(F.col("place") == 0).alias("batches"), F.count("*").alias("rows"),
        F.round(F.sum("padding") / F.sum("longest"), 6).alias("padding_share"))
