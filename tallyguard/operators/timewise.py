"""Time features and per-account velocity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.functions.columns import day_of_month, day_of_week, hour_of_day
from tallyguard.operators.slices import add_slice, earlier_totals, fit_slices

MICROS_PER_HOUR = 3_600_000_000
TIE_DIGITS = 3    # rows of one hot instant, or without a time, spread over 4,096 sub-slices


def time_features(df: DataFrame, ts: str) -> DataFrame:
    """Hour of day, day of week (Monday 0) and day of month; null where the time is missing."""
    return df.withColumns({
        "hour_of_day": hour_of_day(ts), "day_of_week": day_of_week(ts),
        "day_of_month": day_of_month(ts),
    })


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of either timestamp type."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def running_txn_count(df: DataFrame, account: str, ts: str, tie: Column,
                      out: str = "txn_count_24h", slices: int | None = None) -> DataFrame:
    """Running number of timed rows per account in time order, equal times in ``tie`` order.

    Rows without a time come last and repeat the account's total. ``tie`` is hexadecimal text,
    unique per row. No account, time span or single instant is ever sorted in one task.
    """
    timed = df.withColumns({"_at": micros(ts), "_tie": tie})
    cuts, hot = fit_slices(timed, "_at", 1.0, slices)
    spread = F.col("_at").isNull()
    if hot:
        spread = spread | F.col("_at").isin([int(h) for h in hot])
    sliced = add_slice(timed, "_at", cuts).withColumn(
        "_sub", F.when(spread, F.substring("_tie", 1, TIE_DIGITS)).otherwise(F.lit("")))
    place = ["_slice", "_sub"]
    before = earlier_totals(sliced, [account], place, {"_before": F.count("_at")})
    w = Window.partitionBy(account, *place).orderBy("_at", "_tie")
    inside = F.when(F.col("_at").isNotNull(), F.row_number().over(w)).otherwise(F.lit(0))
    return (sliced.withColumn("_inside", inside)
            .join(before, [account, *place], "left")
            .withColumn(out, (F.col("_before") + F.col("_inside")).cast("double"))
            .select(*[c for c in df.columns if c != out], out))


def window_txn_count(df: DataFrame, account: str, ts: str, hours: int = 24,
                     out: str = "txn_count_24h", slices: int | None = None) -> DataFrame:
    """Rows of the account in the last ``hours`` hours, both ends and equal times included.

    Each (account, instant) adds its rows when they happen and takes them away when they leave the
    window, so the count is a running sum and can be sliced; the plain range window would keep a
    hot account in one task.
    """
    timed = df.withColumn("_at", micros(ts))
    instants = (timed.where(F.col("_at").isNotNull() & F.col(account).isNotNull())
                .groupBy(account, "_at").agg(F.count("*").alias("_n")))
    # the readings and arrivals of an instant come before the departures due at that instant
    moves = F.array(
        F.struct(F.col("_at").alias("at"), F.lit(0).alias("leaves"), F.col("_n").alias("delta")),
        F.struct((F.col("_at") + F.lit(hours * MICROS_PER_HOUR)).alias("at"),
                 F.lit(1).alias("leaves"), (-F.col("_n")).alias("delta")),
    )
    events = instants.select(account, F.explode(moves).alias("m")).select(
        account, F.col("m.at").alias("_at"), F.col("m.leaves").alias("_leaves"),
        F.col("m.delta").alias("_delta"))
    cuts, _ = fit_slices(timed, "_at", 1.0, slices)
    sliced = add_slice(events, "_at", cuts)
    before = earlier_totals(sliced, [account], ["_slice"], {"_before": F.sum("_delta")})
    w = (Window.partitionBy(account, "_slice").orderBy("_at", "_leaves")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = (sliced.withColumn("_inside", F.sum("_delta").over(w))
              .where(F.col("_leaves") == 0)
              .join(before, [account, "_slice"])
              .select(account, "_at", (F.col("_before") + F.col("_inside")).alias("_count")))
    return (timed.join(counts, [account, "_at"], "left").withColumn(out, F.col("_count"))
            .select(*[c for c in df.columns if c != out], out))


def account_totals(df: DataFrame, sender: str, receiver: str, amount: str | Column) -> DataFrame:
    """Sent and received totals of every account that sent or received anything.

    One pass: each row contributes to two accounts, and both sums are combined before the shuffle.
    """
    value = F.col(amount) if isinstance(amount, str) else amount
    zero = F.when(F.lit(True), F.lit(0)).otherwise(value)     # zero in the type of the amount
    sides = F.array(
        F.struct(F.col(sender).alias("account"), value.alias("sent"), zero.alias("received")),
        F.struct(F.col(receiver).alias("account"), zero.alias("sent"), value.alias("received")),
    )
    return (df.select(F.explode(sides).alias("s"))
            .groupBy(F.col("s.account").alias("account"))
            .agg(F.sum("s.sent").alias("total_sent"), F.sum("s.received").alias("total_received")))


def spending_profile(df: DataFrame, customer: str, amount: str | Column) -> DataFrame:
    """Number, mean, population deviation and maximum of the spending per customer."""
    value = F.col(amount) if isinstance(amount, str) else amount
    return df.groupBy(customer).agg(
        F.count(value).alias("txn_count"), F.avg(value).alias("spend_mean"),
        F.stddev_pop(value).alias("spend_std"), F.max(value).alias("spend_max"))


def with_spending_profile(df: DataFrame, customer: str, amount: str | Column) -> DataFrame:
    """Rows with their customer's spending profile as context columns."""
    return df.join(spending_profile(df, customer, amount), customer, "left")


def grouped_transform(df: DataFrame, group: str | list[str], values: dict[str, Column]) -> DataFrame:
    """Rows with aggregates of their group as new columns; the rows stay as they are.

    The aggregates are combined before the shuffle and joined back, so a hot group is never held
    by one task, as it would be with a function over whole groups. Order-dependent transforms of a
    group are ``running_txn_count`` and ``window_txn_count``.
    """
    keys = [group] if isinstance(group, str) else group
    return df.join(df.groupBy(*keys).agg(*[c.alias(n) for n, c in values.items()]), keys, "left")
