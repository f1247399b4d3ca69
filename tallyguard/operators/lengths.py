"""Length audit over all examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.prompts import token_count

MAX_SEQ_LENGTH = 2_048    # fixed value: length limit of a training example


def length_audit(df: DataFrame, text: str, limit: int = MAX_SEQ_LENGTH, counter=token_count) -> DataFrame:
    """Rows, rows over the limit, tokens and length percentiles, from a histogram of lengths."""
    lengths = df.groupBy(counter(text).cast("bigint").alias("tokens")).agg(F.count("*").alias("rows"))
    def weighted(p):
        return F.expr(f"percentile(tokens, {p}, rows)")
    return lengths.agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("tokens") > limit, F.col("rows"))), F.lit(0)).alias("over_limit"),
        F.sum(F.col("tokens") * F.col("rows")).alias("tokens"),
        F.max("tokens").alias("longest"),
        F.round(weighted(0.5), 4).alias("p50"), F.round(weighted(0.95), 4).alias("p95"))


def throughput_summary(df: DataFrame, prompt: str, response: str, elapsed_seconds: float | None = None,
                       counter=token_count) -> DataFrame:
    """Requests and token totals; with a measured time also the rates."""
    out = df.agg(
        F.count("*").alias("requests"),
        F.coalesce(F.sum(counter(prompt).cast("bigint")), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum(counter(response).cast("bigint")), F.lit(0)).alias("output_tokens"))
    if elapsed_seconds is None:
        return out
    t = F.lit(float(elapsed_seconds))
    return out.withColumns({
        "elapsed": t, "requests_per_sec": F.try_divide("requests", t),
        "output_tokens_per_sec": F.try_divide("output_tokens", t)})
