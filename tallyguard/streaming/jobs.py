"""Structured Streaming jobs: scoring and per-account velocity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyguard.functions import prompts as P
from tallyguard.operators.scoring import score_batch
from tallyguard.plans.evaluation import parsed_responses


def stream_score(transactions: DataFrame, cols: list[str], scorer_factory,
                 context: str | Column | None = None) -> DataFrame:
    """Transactions in, verdict rows out. Works on streaming and on batch tables."""
    asked = transactions.withColumn(
        "prompt", P.inference_chat(P.inference_prompt(P.feature_pairs(cols), context)))
    return parsed_responses(score_batch(asked, "prompt", scorer_factory)).drop("prompt")


def stream_velocity(transactions: DataFrame, account: str, ts: str, window: str = "24 hours",
                    slide: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Transactions per account and sliding event-time window, with a bound on lateness."""
    timed = transactions.withColumn(ts, F.col(ts).cast("timestamp"))
    return (timed.withWatermark(ts, late)
            .groupBy(F.window(ts, window, slide).alias("w"), account)
            .agg(F.count("*").alias("txn_count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    account, "txn_count"))


def run_available(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                  fmt: str = "parquet") -> StreamingQuery:
    """Process everything available now into files, then stop."""
    query = (stream.writeStream.format(fmt).outputMode(output_mode)
             .option("checkpointLocation", checkpoint).option("path", path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
