"""Writers: processed splits, JSONL, metrics, scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyguard.sources.files import dataset_path


def save_splits(df: DataFrame, out_dir: str, alias: str, label: str = "label") -> dict:
    """Write one data set as Parquet, one folder per split, the label as last column.

    Rows and fraud rows per split are observed while writing, not by further passes.
    """
    features = [c for c in df.columns if c not in (label, "split")]
    seen = Observation(f"save-{alias}")
    counts = [e for s in ("train", "val", "test") for e in (
        F.count_if(F.col("split") == s).alias(f"{s}_rows"),
        F.count_if((F.col("split") == s) & (F.col(label) == 1)).alias(f"{s}_fraud"))]
    (df.select(*[F.col(f"`{c}`") for c in features], label, "split").observe(seen, *counts)
     .write.mode("overwrite").partitionBy("split").parquet(dataset_path(out_dir, alias)))
    return seen.get


def write_jsonl(examples: DataFrame, path: str, order: Column | None = None) -> None:
    """Write examples as JSONL, one folder per ``split`` if there is such a column.

    ``order`` shuffles: in every folder the files in name order hold the examples in that order.
    Nulls are kept.
    """
    # the writer of split folders keeps an order only if it begins with the split
    ahead = ["split"] if "split" in examples.columns else []
    out = examples if order is None else examples.orderBy(*ahead, order)
    writer = out.write.mode("overwrite").option("ignoreNullFields", False)
    if "split" in out.columns:
        writer = writer.partitionBy("split")
    writer.json(path)


def metrics_record(metrics: DataFrame) -> DataFrame:
    """Metrics row as saved: five scores and the 2x2 matrix as a nested array."""
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp"))
    return metrics.select("f1", "precision", "recall", "mcc", "auroc", matrix.alias("confusion_matrix"))


def write_metrics_json(metrics: DataFrame, out_dir: str, prefix: str = "") -> str:
    """Write the one-row metrics record; returns the folder."""
    path = f"{out_dir.rstrip('/')}/{prefix}metrics.json"
    metrics_record(metrics).coalesce(1).write.mode("overwrite").option(
        "ignoreNullFields", False).json(path)
    return path


def scored_record(scored: DataFrame, transaction: Column, context: Column, result: str = "result") -> DataFrame:
    """Rows of shape {transaction, context, result}."""
    return scored.select(transaction.alias("transaction"), context.alias("context"),
                         F.col(result).alias("result"))


def write_scored(records: DataFrame, path: str) -> None:
    """Write scored rows as JSON lines."""
    records.write.mode("overwrite").json(path)
