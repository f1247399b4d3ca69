"""A supervised baseline on processed splits."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MOST_HALVINGS = 12


@dataclass(frozen=True)
class BaselineModel:
    """Features with their weights, and the intercept."""

    features: list[str]
    weights: list[float]
    intercept: float


def train_baseline(train: DataFrame, features: list[str], label: str = "label",
                   max_iter: int = 20) -> BaselineModel:
    """Logistic regression with balanced class weights, fitted by MLlib."""
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    weight = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, F.lit(total / (len(counts) * n))).otherwise(weight)
    assembled = VectorAssembler(inputCols=features, outputCol="_features").transform(
        train.withColumn("_weight", weight))
    fitted = LogisticRegression(featuresCol="_features", labelCol=label, weightCol="_weight",
                                maxIter=max_iter).fit(assembled)
    return BaselineModel(list(features), [float(w) for w in fitted.coefficients], float(fitted.intercept))


def train_newton(train: DataFrame, features: list[str], label: str = "label", ridge: float = 1.0,
                 max_steps: int = 30, tolerance: float = 1e-8) -> BaselineModel:
    """The same regression by Newton steps, one aggregation a step.

    Minimised is the loss with balanced class weights plus half of ``ridge`` times the squared
    weights (not the intercept), which has one least point. A step sums the gradient and the Gram
    matrix of features weighted by p(1 - p) inside the tasks; a number for every pair of features
    comes to the driver. A step that does not lower the loss is halved. A missing feature counts as
    0, rows without a label are left out; with one class only the weights stay 0.
    """
    x = [F.lit(1.0), *(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features)]
    rows = train.where(F.col(label).isNotNull())
    counts = {r["y"]: r["n"] for r in rows.groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    if set(counts) != {0, 1}:
        return BaselineModel(list(features), [0.0] * len(features), 0.0)
    y = F.col(label).cast("double")
    total = sum(counts.values())
    weight = F.when(y == 1, total / (2 * counts[1])).otherwise(total / (2 * counts[0]))
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    penalty = np.r_[0.0, np.full(len(features), ridge)]

    def sums(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        margin = reduce(lambda a, b: a + b, [v * F.lit(float(k)) for v, k in zip(x, w)])
        small = F.least(margin, -margin)                      # exp of it never overflows
        share = F.exp(small) / (1 + F.exp(small))
        p = F.when(margin > 0, 1 - share).otherwise(share)
        loss = weight * (F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(small)) - y * margin)
        row = rows.select(loss.alias("l"), (weight * (p - y)).alias("d"), (weight * p * (1 - p)).alias("h"),
                          *[v.alias(f"x{i}") for i, v in enumerate(x)]).agg(
            F.sum("l").alias("loss"), *[F.sum(F.col("d") * F.col(f"x{i}")).alias(f"g{i}") for i in range(len(x))],
            *[F.sum(F.col("h") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i, j in pairs]).first()
        gram = np.zeros((len(x), len(x)))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = row[f"h{i}_{j}"]
        slope = np.array([row[f"g{i}"] for i in range(len(x))]) + penalty * w
        return row["loss"] + float(penalty @ w ** 2) / 2, slope, gram + np.diag(penalty)

    w = np.zeros(len(x))
    best, slope, gram = sums(w)
    for _ in range(max_steps):
        step = np.linalg.lstsq(gram, slope, rcond=None)[0]
        if slope @ step < tolerance * tolerance * (1 + abs(best)):       # twice what the step is about to gain
            break
        for _ in range(MOST_HALVINGS):
            loss, new_slope, new_gram = sums(w - step)
            if loss <= best:
                break
            step /= 2
        else:                                                            # no step lowers the loss any more
            break
        w, best, slope, gram = w - step, loss, new_slope, new_gram
    return BaselineModel(list(features), [float(v) for v in w[1:]], float(w[0]))


def predict(model: BaselineModel, rows: DataFrame, label: str = "label") -> DataFrame:
    """Add y_true, y_pred and y_score, as one expression inside the scan's code generation."""
    terms = [F.col(f"`{c}`").cast("double") * F.lit(w) for c, w in zip(model.features, model.weights)]
    margin = reduce(lambda a, b: a + b, terms, F.lit(model.intercept))
    return rows.withColumn("y_score", 1 / (1 + F.exp(-margin))).withColumns({
        "y_true": F.col(label).cast("int"), "y_pred": (F.col("y_score") > 0.5).cast("int")})
