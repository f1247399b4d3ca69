"""Corpus pipeline: toxicity, line dedup, near duplicates, mixing, packing; each stage reads what the last one wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyguard.catalog.registry import table
from tallyguard.llm import line_dedup, mixing, ngram_join, packing, toxicity
from tallyguard.session import stored

STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", line_dedup.stage),
    ("ngram_jaccard_join", ngram_join.keep_first),
    ("mixing", mixing.stage),
    ("best_fit_packing", packing.stage),
]

ORACLE_SQL = None
"""SQL can express neither the classifier nor the tokenizer; tests hold every stage against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
