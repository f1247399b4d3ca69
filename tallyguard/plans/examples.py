"""Training examples from processed splits, as one projection per data set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.fixed_values import DATASETS, TRAIN_SYSTEM_PROMPT
from tallyguard.functions import prompts as P
from tallyguard.operators.ranking import ROW_KEY, rank_key, with_row_key
from tallyguard.operators.sampling import stratified_cap
from tallyguard.sources.files import dataset_path, parquet_scan, path_exists
from tallyguard.sources.sinks import write_jsonl

SPLITS = ("train", "val", "test")


def row_to_example(df: DataFrame, alias: str, split: str | Column, key: Column,
                   label: str = "label", seed: int | str = 42) -> DataFrame:
    """One example {system, user, assistant, metadata} per row, built from expressions only.

    Columns named in ``label`` or starting with an underscore, and ``split``, are no features.
    """
    features = df.select(*[F.col(f"`{c}`") for c in df.columns
                           if c != "split" and not c.startswith("_")])
    answer = P.answer_fields(features, alias, F.col(label) == 1, F.col("_key"), seed)
    # the score feeds three fields; as a column of its own it is drawn once
    staged = df.withColumns({"_key": key, "_meta": P.example_metadata(alias, split, label)}).withColumns({
        "_lines": P.feature_lines(features, label=label), "_risk_score": answer["risk_score"]})
    answer = P.fields_of_score(answer, F.col("_risk_score"))
    return staged.select(
        F.lit(TRAIN_SYSTEM_PROMPT).alias("system"),
        P.train_user_prompt(alias, F.col("_lines")).alias("user"),
        P.assistant_json(answer).alias("assistant"),
        F.col("_meta").alias("metadata"), "_key")


def build_examples(spark: SparkSession, processed_dir: str, alias: str, split: str,
                   max_rows: int | None = None, seed: int | str = 42) -> DataFrame | None:
    """Examples of one processed data set and split.

    ``max_rows`` bounds the training rows at the class share; validation and test are never cut.
    """
    if not path_exists(spark, dataset_path(processed_dir, alias)):
        print(f"[skip] {alias}/{split}: not found")
        return None
    rows = with_row_key(parquet_scan(spark, processed_dir, alias, split).drop("split"), seed)
    capped = stratified_cap(rows, F.col(ROW_KEY), max_rows if split == "train" else None)
    return row_to_example(capped, alias, split, F.col(ROW_KEY), seed=seed)


def combine_datasets(parts: list[DataFrame]) -> DataFrame:
    """All data sets as one table; the text form makes their schemas equal."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def build_and_save(spark: SparkSession, processed_dir: str, out_dir: str, output_format: str = "chat",
                   max_rows: int | None = None, seed: int | str = 42,
                   datasets: list[str] = DATASETS) -> None:
    """Shuffled JSONL of all data sets, one folder per split."""
    if output_format not in P.FORMATS:
        raise ValueError(f"output_format must be one of {sorted(P.FORMATS)}")
    for split in SPLITS:
        parts = [build_examples(spark, processed_dir, a, split, max_rows, seed) for a in datasets]
        parts = [p for p in parts if p is not None]
        if not parts:
            continue
        combined = combine_datasets(parts)
        # sort first: the shuffle key is not part of the written shape
        shuffled = combined.orderBy(rank_key(F.col("metadata.dataset"), "_key", seed=seed))
        write_jsonl(P.format_switch(shuffled, output_format), f"{out_dir.rstrip('/')}/{split}.jsonl")
