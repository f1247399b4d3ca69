"""Classification metrics derived from pre-aggregated cells.

``score_cells`` reduces scored rows to one row per (data set, truth, prediction, score); everything
else is arithmetic on that small table, so the scored rows are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.operators.slices import add_slice, earlier_totals, fit_slices
from tallyguard.session import stored

CLASS_NAMES = ("Legitimate", "Fraud")


def score_cells(scored: DataFrame, dataset: str = "dataset", y_true: str = "y_true",
                y_pred: str = "y_pred", y_score: str = "y_score") -> DataFrame:
    """Rows per (dataset, y_true, y_pred, y_score)."""
    return (scored.select(F.col(dataset).alias("dataset"), F.col(y_true).alias("y_true"),
                          F.col(y_pred).alias("y_pred"), F.col(y_score).alias("y_score"))
            .groupBy("dataset", "y_true", "y_pred", "y_score")
            .agg(F.count("*").alias("rows")))


def _cell(truth: int, pred: int) -> Column:
    hit = (F.col("y_true") == truth) & (F.col("y_pred") == pred)
    return F.coalesce(F.sum(F.when(hit, F.col("rows"))), F.lit(0))


CONFUSION = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}


def confusion_matrix(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """TN, FP, FN and TP, always all four, over everything or per group."""
    aggs = [_cell(*v).alias(k) for k, v in CONFUSION.items()]
    return cells.groupBy(*by).agg(*aggs) if by else cells.agg(*aggs)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def precision(tp="tp", fp="fp") -> Column:
    """TP / (TP + FP), 0 without predictions."""
    return _ratio(F.col(tp), F.col(tp) + F.col(fp))


def recall(tp="tp", fn="fn") -> Column:
    """TP / (TP + FN), 0 without positives."""
    return _ratio(F.col(tp), F.col(tp) + F.col(fn))


def f1(tp="tp", fp="fp", fn="fn") -> Column:
    """2 TP / (2 TP + FP + FN), 0 if undefined."""
    return _ratio(2 * F.col(tp), 2 * F.col(tp) + F.col(fp) + F.col(fn))


def mcc() -> Column:
    """Matthews correlation in double arithmetic, 0 if undefined."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    root = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return F.coalesce(F.try_divide(tp * tn - fp * fn, root), F.lit(0.0))


def score_metrics(matrix: DataFrame) -> DataFrame:
    """Add f1, precision, recall and mcc to a confusion matrix."""
    return matrix.withColumns({"f1": f1(), "precision": precision(), "recall": recall(),
                               "mcc": mcc()})


def auroc(cells: DataFrame, slices: int | None = None) -> DataFrame:
    """Area under the ROC curve over all cells, ties half-counted; null if one class is missing.

    Rows without a score (null or NaN) are left out.

    Works on distinct scores, cut into slices, so neither rows nor scores meet in one task.
    """
    scores = stored(
        cells.where(F.col("y_score").isNotNull() & ~F.isnan("y_score")).groupBy("y_score").agg(
            F.coalesce(F.sum(F.when(F.col("y_true") == 1, F.col("rows"))), F.lit(0)).alias("pos"),
            F.coalesce(F.sum(F.when(F.col("y_true") == 0, F.col("rows"))), F.lit(0)).alias("neg"),
        ), "scores")
    cuts, _ = fit_slices(scores, "y_score", 0.0, slices)
    sliced = add_slice(scores, "y_score", cuts).withColumn("_all", F.lit(0))
    before = earlier_totals(sliced, ["_all"], ["_slice"], {"_before": F.sum("neg")})
    w = (Window.partitionBy("_slice").orderBy("y_score")
         .rowsBetween(Window.unboundedPreceding, -1))
    below = F.col("_before") + F.coalesce(F.sum("neg").over(w), F.lit(0))
    ranked = (sliced.join(before.drop("_all"), "_slice")
              .select("pos", "neg", below.alias("below")))
    area = F.sum(F.col("pos").cast("double") * (F.col("below") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(area, pairs).alias("auroc"))


def classification_report(cells: DataFrame) -> DataFrame:
    """Long report: both classes, accuracy, macro and weighted averages, 4 decimals."""
    m = confusion_matrix(cells)
    legit = F.struct(
        F.lit(CLASS_NAMES[0]).alias("name"),
        precision("tn", "fn").alias("precision"), recall("tn", "fp").alias("recall"),
        f1("tn", "fn", "fp").alias("f1"), (F.col("tn") + F.col("fp")).alias("support"))
    fraud = F.struct(
        F.lit(CLASS_NAMES[1]).alias("name"),
        precision().alias("precision"), recall().alias("recall"),
        f1().alias("f1"), (F.col("tp") + F.col("fn")).alias("support"))
    both = m.select("tn", "fp", "fn", "tp", legit.alias("a"), fraud.alias("b"))
    total = F.col("a.support") + F.col("b.support")
    hit_share = _ratio(F.col("tn") + F.col("tp"), total)
    nothing = F.lit(None).cast("double")

    def macro(field):
        return (F.col(f"a.{field}") + F.col(f"b.{field}")) / 2

    def weighted(field):
        return _ratio(F.col(f"a.{field}") * F.col("a.support")
                      + F.col(f"b.{field}") * F.col("b.support"), total)

    def line(name, fields):
        return F.struct(F.lit(name).alias("name"), *fields, total.alias("support"))

    kinds = ("precision", "recall", "f1")
    lines = F.array(
        F.col("a"), F.col("b"),
        line("accuracy", [nothing.alias("precision"), nothing.alias("recall"), hit_share.alias("f1")]),
        line("macro avg", [macro(k).alias(k) for k in kinds]),
        line("weighted avg", [weighted(k).alias(k) for k in kinds]),
    )
    return both.select(F.explode(lines).alias("r")).select(
        "r.name", *[F.round(F.col(f"r.{k}"), 4).alias(k) for k in kinds], "r.support")


def per_dataset_breakdown(cells: DataFrame) -> DataFrame:
    """F1, recall and fraud/total per data set, with the overall line under a null name."""
    grouped = cells.groupingSets([["dataset"], []], "dataset").agg(
        F.grouping_id().alias("level"), *[_cell(*v).alias(k) for k, v in CONFUSION.items()])
    return grouped.select(
        F.when(F.col("level") == 0, F.col("dataset")).otherwise(F.lit("(all)")).alias("dataset"),
        f1().alias("f1"), recall().alias("recall"),
        (F.col("tp") + F.col("fn")).alias("n_fraud"),
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n_rows"))
