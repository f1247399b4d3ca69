"""Labelled rows for training, all of them or a bounded sample, and the fold rule of the label queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_ROWS = 8_000
"""Labelled rows that a model is fitted on; with more, those with the smallest hash of doc_id."""


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id has none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def known_labels(labels: DataFrame, label: str, keep: Column) -> DataFrame:
    """(doc_id, label) of the ids for which ``keep`` holds; null labels and ids are left out, of repeated labels the largest counts."""
    return (labels.select("doc_id", F.col(label).cast("int").alias("label")).where(keep)
            .where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label")))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, most: int = MOST_ROWS) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled rows of ``docs`` for which ``keep`` (on doc_id) holds.

    Null labels and ids are left out; of repeated labels the largest counts. The ids are few enough
    to be broadcast.
    """
    chosen = known_labels(labels, label, keep).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
