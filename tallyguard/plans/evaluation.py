"""From responses to metrics: parse in the JVM, reduce once, derive every report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.functions import prompts as P
from tallyguard.functions import responses as R
from tallyguard.operators import metrics as M
from tallyguard.operators.sampling import balanced_head_cap
from tallyguard.operators.scoring import Scorer, score_batch
from tallyguard.session import stored


def parsed_responses(df: DataFrame, response: str = "response") -> DataFrame:
    """Add y_pred, y_score and the parse state; each text is read as JSON once."""
    obj = R.json_object(response)
    read = df.withColumn("_obj", obj).withColumns({
        "verdict": R.verdict_from(F.col("_obj"), response),
        "risk_score": R.risk_score_from(F.col("_obj"), response)})
    return read.drop("_obj").withColumns({
        "y_pred": R.prediction_default("verdict"),
        "y_score": R.score_normalize("risk_score"),
        "unparsed": F.col("verdict").isNull().cast("int")})


def score_examples(chat: DataFrame, scorer_factory, max_samples: int | None = None,
                   line: Column | None = None) -> DataFrame:
    """Run the scorer over chat examples: dataset, y_true, response and the parsed columns.

    All examples are scored unless ``max_samples`` asks for the balanced head in ``line`` order.
    """
    meta = P.metadata_or_default("metadata")
    if max_samples:
        if line is None:
            raise ValueError("max_samples needs the line order")
        chat = balanced_head_cap(chat, line, F.col("metadata.is_fraud"), max_samples)
    asked = chat.select(
        meta["dataset"].alias("dataset"), meta["is_fraud"].alias("y_true"),
        P.inference_chat(P.first_user_content("messages")).alias("prompt"))
    return parsed_responses(score_batch(asked, "prompt", scorer_factory))


@dataclass
class Evaluation:
    """Reports over one set of scored rows."""

    cells: DataFrame
    metrics: DataFrame
    report: DataFrame
    breakdown: DataFrame


def evaluate(scored: DataFrame) -> Evaluation:
    """All reports of scored rows (dataset, y_true, y_pred, y_score), from one pass over them."""
    cells = stored(M.score_cells(scored), "cells")
    area = M.auroc(cells).first()["auroc"]
    overall = M.score_metrics(M.confusion_matrix(cells)).withColumn("auroc", F.lit(area).cast("double"))
    return Evaluation(cells, overall, M.classification_report(cells), M.per_dataset_breakdown(cells))
