"""The data set registry as a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.fixed_values import REGISTRY, REGISTRY_FIELDS

EXPORT_FIELDS = ["alias", "name", "label_column", "source_url", "fraud_ratio"]


def registry_table(spark: SparkSession) -> DataFrame:
    """Six records with twelve fields."""
    schema = ", ".join(f"`{f}` {'array<string>' if f == 'use_case' else 'string'}"
                       for f in REGISTRY_FIELDS)
    return spark.createDataFrame([tuple(r[f] for f in REGISTRY_FIELDS) for r in REGISTRY], schema)


def registry_summary(spark: SparkSession) -> DataFrame:
    """Registry for reading: use cases joined to one text."""
    return registry_table(spark).withColumn("use_case", F.concat_ws(", ", "use_case"))


def registry_json(spark: SparkSession) -> DataFrame:
    """The exported five fields of all records as one JSON array text."""
    rows = F.collect_list(F.struct(*EXPORT_FIELDS))      # six records
    return registry_table(spark).agg(F.to_json(rows).alias("registry"))


def export_registry_json(spark: SparkSession, path: str) -> None:
    """Write the exported registry as text."""
    registry_json(spark).coalesce(1).write.mode("overwrite").text(path)
