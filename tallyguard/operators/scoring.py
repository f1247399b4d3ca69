"""Batch scoring through a pluggable scorer, and the general map surfaces."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.draws import draw, draw_unit

MAP_ROWS = 1_024             # rows whose result is held and sent at once
Scorer = Callable[[list[str]], list[str]]


def score_batch(df: DataFrame, prompt: str, scorer_factory: Callable[[], Scorer],
                out: str = "response") -> DataFrame:
    """Add the scorer's response to every row.

    ``scorer_factory`` is called once per task, so a model is loaded once and then sees Arrow
    batches of prompts. Only the prompt column crosses to Python.
    """
    def respond(batches):
        scorer = scorer_factory()
        for batch in batches:
            yield pa.array(scorer(batch.to_pylist()), pa.string())

    respond.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return df.withColumn(out, F.arrow_udf(respond, "string")(F.col(prompt)))


def rule_scorer(marker: str = "event_type: error", fraud_score: int = 5,
                legit_score: int = 1) -> Callable[[], Scorer]:
    """A deterministic scorer: fraud if the prompt holds the marker. Stands in for a model."""
    def factory() -> Scorer:
        def score(prompts: list[str]) -> list[str]:
            return [
                f'{{"verdict": "FRAUD", "risk_score": {fraud_score}}}' if marker in p
                else f'{{"verdict": "LEGITIMATE", "risk_score": {legit_score}}}' for p in prompts]
        return score
    return factory


def batched_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """A pandas function over column batches of at most MAP_ROWS rows; its result replaces the old columns."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, max(1, len(batch)), MAP_ROWS):
                yield fn(batch.iloc[lo:lo + MAP_ROWS].reset_index(drop=True))
    return df.mapInPandas(each, schema)


def synthetic_transactions(ids: DataFrame, key: str | Column, seed: int | str = 42) -> DataFrame:
    """One drawn transaction of six fields per row of ``ids``."""
    k = F.col(key) if isinstance(key, str) else key

    def gauss(slot: str, scale: float = 1.0) -> Column:
        # two uniform draws give one normal draw
        u = (draw(k, f"{slot}-a", seed) + 1) / F.lit(float(16 ** 8))
        v = draw_unit(k, f"{slot}-b", seed)
        return F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v) * F.lit(scale)

    return ids.select(
        k.alias("key"),
        F.round(gauss("amount"), 3).alias("amount_scaled"),
        (draw(k, "transfer", seed) % 2).cast("int").alias("type_TRANSFER"),
        F.round(gauss("balance"), 3).alias("balance_diff_orig"),
        F.round(F.abs(gauss("ratio", 0.5)), 3).alias("amount_to_balance_ratio"),
        (draw(k, "step", seed) % 743 + 1).cast("int").alias("step"),
        (draw(k, "count", seed) % 50 + 1).cast("int").alias("txn_count_24h"))
