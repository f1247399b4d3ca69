"""Profiling aggregates and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyguard.catalog.registry import (EVENT_KEY, LABELLED, RESPONSES, labelled, query, responses,
                                         sql_parsed, sql_split, table)
from tallyguard.catalog.source_queries import METRICS_SQL
from tallyguard.functions.tokens import token_counter
from tallyguard.operators import lengths, metrics, profiling, timewise
from tallyguard.operators.ranking import rank_key
from tallyguard.operators.sampling import stratified_split
from tallyguard.plans.evaluation import evaluate, parsed_responses

MONEY = "decimal(18,2)"


def _fit_frame(spark, df, values: dict, schema: str):
    """Fitted values (one per column) as rows."""
    return spark.createDataFrame(list(values.items()), schema)


@query("a1_class_report", f"""
SELECT 'events' AS dataset, count(*) AS rows, CAST(sum(label) AS BIGINT) AS fraud,
       round(100 * avg(CAST(label AS DOUBLE)), 3) AS fraud_pct FROM {LABELLED}""")
def a1_class_report(spark, sf_dir):
    return profiling.class_report(labelled(spark, sf_dir), "events")


@query("a2_null_fraction", """
SELECT round(avg(CAST(doc_id IS NULL AS INTEGER)), 6) AS doc_id, round(avg(CAST(lang IS NULL AS INTEGER)), 6) AS lang,
       round(avg(CAST(quality IS NULL AS INTEGER)), 6) AS quality, round(avg(CAST(toxic IS NULL AS INTEGER)), 6) AS toxic
FROM documents LEFT JOIN labels USING (doc_id)""")
def a2_null_fraction(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "lang").join(
        table(spark, sf_dir, "labels"), "doc_id", "left")
    shares = profiling.null_fraction(df)
    return shares.select(*[F.round(c, 6).alias(c) for c in shares.columns])


URGENT = f"""(SELECT c_custkey, c_acctbal, c_mktsegment, urgent FROM customer LEFT JOIN
  (SELECT o_custkey, CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS urgent
   FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"""


def urgent_customers(spark, sf_dir):
    """Customers with the sum of their urgent orders, null where there is none."""
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice").cast(MONEY))
    urgent = (table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
              .agg(F.sum(price).cast("double").alias("urgent")))
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
            .join(urgent, "c_custkey", "left"))


@query("a3_column_median", f"""
SELECT 'c_acctbal' AS column_name, round(median(c_acctbal), 4) AS median FROM {URGENT}
UNION ALL SELECT 'urgent', round(median(urgent), 4) FROM {URGENT}""")
def a3_column_median(spark, sf_dir):
    df = urgent_customers(spark, sf_dir)
    medians = profiling.column_medians(df, ["c_acctbal", "urgent"])
    return _fit_frame(spark, df, {c: round(m, 4) for c, m in medians.items()},
                      "column_name string, median double")


@query("a3_column_median_narrowed", """
SELECT 'l_extendedprice' AS column_name, round(median(l_extendedprice), 4) AS median FROM lineitem
UNION ALL SELECT 'l_quantity', round(median(l_quantity), 4) FROM lineitem
UNION ALL SELECT 'l_discount', round(median(l_discount), 4) FROM lineitem""")
def a3_column_median_narrowed(spark, sf_dir):
    """Three columns share one search over a large table."""
    df = table(spark, sf_dir, "lineitem")
    medians = profiling.column_medians(df, ["l_extendedprice", "l_quantity", "l_discount"])
    return _fit_frame(spark, df, {c: round(m, 4) for c, m in medians.items()},
                      "column_name string, median double")


@query("a4_column_mode", """
SELECT column_name, value AS mode FROM (
  SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS r FROM (
    SELECT 'p_brand' AS column_name, p_brand AS value, count(*) AS n FROM part GROUP BY p_brand
    UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY p_type
    UNION ALL SELECT 'p_name', p_name, count(*) FROM part GROUP BY p_name))
WHERE r = 1""")
def a4_column_mode(spark, sf_dir):
    counts = profiling.value_counts(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"])
    return profiling.column_modes(counts).withColumnRenamed("column", "column_name")


@query("a5_scaler_fit", """
SELECT round(avg(l_quantity), 6) AS mean_quantity, round(stddev_pop(l_quantity), 6) AS std_quantity,
       round(avg(l_extendedprice), 4) AS mean_price, round(stddev_pop(l_extendedprice), 4) AS std_price
FROM lineitem""")
def a5_scaler_fit(spark, sf_dir):
    from tallyguard.operators.scaling import fit_scaler
    fitted = fit_scaler(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])
    (mq, sq), (mp, sp) = fitted["l_quantity"], fitted["l_extendedprice"]
    return spark.createDataFrame(
        [(round(mq, 6), round(sq, 6), round(mp, 4), round(sp, 4))],
        "mean_quantity double, std_quantity double, mean_price double, std_price double")


@query("a6_class_counts", f"""
SELECT CAST(sum(label) AS BIGINT) AS n_minority, CAST(sum(1 - label) AS BIGINT) AS n_majority,
       round(sum(label) / CAST(sum(1 - label) AS DOUBLE), 6) AS ratio FROM {LABELLED}""")
def a6_class_counts(spark, sf_dir):
    return profiling.minority_ratio(labelled(spark, sf_dir)).withColumn("ratio", F.round("ratio", 6))


@query("a7_balanced_class_weights", f"""
SELECT label, round(CAST(n AS DOUBLE) / (2 * c), 6) AS weight
FROM (SELECT label, count(*) AS c, sum(count(*)) OVER () AS n FROM {LABELLED} GROUP BY label)""")
def a7_balanced_class_weights(spark, sf_dir):
    return profiling.balanced_class_weights(labelled(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@query("a8_distinct_sorted", "SELECT DISTINCT o_orderpriority FROM orders ORDER BY 1")
def a8_distinct_sorted(spark, sf_dir):
    return profiling.distinct_sorted(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("a9_split_counts", f"""
SELECT split, event_type AS dataset, count(*) AS rows, CAST(sum(label) AS BIGINT) AS fraud,
       CAST(sum(1 - label) AS BIGINT) AS legit
FROM {sql_split(LABELLED, EVENT_KEY)} GROUP BY GROUPING SETS ((split, event_type), (split))""")
def a9_split_counts(spark, sf_dir):
    rows = stratified_split(labelled(spark, sf_dir), rank_key("event_id"))
    return profiling.split_counts(rows.withColumnRenamed("event_type", "dataset"))


def _cells(spark, sf_dir):
    return metrics.score_cells(parsed_responses(responses(spark, sf_dir)))


@query("a10_confusion_matrix", f"SELECT tn, fp, fn, tp FROM ({METRICS_SQL})")
def a10_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_cells(spark, sf_dir))


@query("a11_f1_precision_recall", f"SELECT f1, precision, recall FROM ({METRICS_SQL})")
def a11_f1_precision_recall(spark, sf_dir):
    m = metrics.score_metrics(metrics.confusion_matrix(_cells(spark, sf_dir)))
    return m.select(*[F.round(c, 6).alias(c) for c in ("f1", "precision", "recall")])


@query("a12_mcc", f"SELECT mcc FROM ({METRICS_SQL})")
def a12_mcc(spark, sf_dir):
    m = metrics.score_metrics(metrics.confusion_matrix(_cells(spark, sf_dir)))
    return m.select(F.round("mcc", 6).alias("mcc"))


@query("a13_auroc", f"""
SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)), 6) AS auroc
FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT value, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
            FROM {LABELLED} GROUP BY value))""")
def a13_auroc(spark, sf_dir):
    """Event value as a continuous score: thousands of distinct scores, computed in slices."""
    scored = labelled(spark, sf_dir).select(
        F.lit("events").alias("dataset"), F.col("label").alias("y_true"), F.lit(0).alias("y_pred"),
        F.col("value").alias("y_score"))
    return metrics.auroc(metrics.score_cells(scored)).select(F.round("auroc", 6).alias("auroc"))


@query("a14_classification_report", f"""
WITH m AS (SELECT tn, fp, fn, tp, tn + fp + fn + tp AS n FROM ({METRICS_SQL})),
r AS (SELECT 'Legitimate' AS name, tn / CAST(tn + fn AS DOUBLE) AS p, tn / CAST(tn + fp AS DOUBLE) AS r,
             2 * tn / CAST(2 * tn + fp + fn AS DOUBLE) AS f, tn + fp AS s, n, tn + tp AS hit FROM m
      UNION ALL SELECT 'Fraud', tp / CAST(tp + fp AS DOUBLE), tp / CAST(tp + fn AS DOUBLE),
             2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), tp + fn, n, tn + tp FROM m)
SELECT name, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, s AS support FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, round(max(hit) / CAST(max(n) AS DOUBLE), 4), max(n) FROM r
UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), max(n) FROM r
UNION ALL SELECT 'weighted avg', round(sum(p * s) / max(n), 4), round(sum(r * s) / max(n), 4),
                 round(sum(f * s) / max(n), 4), max(n) FROM r""")
def a14_classification_report(spark, sf_dir):
    return metrics.classification_report(_cells(spark, sf_dir))


BREAKDOWN_SQL = f"""
SELECT coalesce(dataset, '(all)') AS dataset,
       round(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0), 6) AS f1,
       round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall, tp + fn AS n_fraud, n AS n_rows
FROM (SELECT dataset, count(*) AS n, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp,
             count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp, count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn
      FROM {sql_parsed(RESPONSES)} GROUP BY GROUPING SETS ((dataset), ()))"""


def breakdown(spark, sf_dir):
    out = metrics.per_dataset_breakdown(_cells(spark, sf_dir))
    return out.withColumns({"f1": F.round("f1", 6), "recall": F.round("recall", 6)})


@query("a15_per_dataset_breakdown", BREAKDOWN_SQL)
def a15_per_dataset_breakdown(spark, sf_dir):
    return breakdown(spark, sf_dir)


@query("a16_account_totals", """
SELECT account, CAST(sum(sent) AS DOUBLE) AS total_sent, CAST(sum(received) AS DOUBLE) AS total_received FROM (
  SELECT user_id AS account, CAST(value AS DECIMAL(18,2)) AS sent, 0 AS received FROM events
  UNION ALL SELECT CAST(json_extract_string(props, '$.k') AS BIGINT), 0, CAST(value AS DECIMAL(18,2)) FROM events)
GROUP BY account""")
def a16_account_totals(spark, sf_dir):
    transfers = table(spark, sf_dir, "events").select(
        "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("receiver"),
        F.col("value").cast(MONEY).alias("amount"))
    totals = timewise.account_totals(transfers, "user_id", "receiver", "amount")
    return totals.select("account", F.col("total_sent").cast("double").alias("total_sent"),
                         F.col("total_received").cast("double").alias("total_received"))


@query("a17_customer_spending_profile", """
SELECT o_orderkey, txn_count, round(spend_mean * txn_count, 2) AS spend_total, round(spend_std, 4) AS spend_std, spend_max
FROM orders JOIN (SELECT o_custkey, count(o_totalprice) AS txn_count, avg(o_totalprice) AS spend_mean,
                         stddev_pop(o_totalprice) AS spend_std, max(o_totalprice) AS spend_max
                  FROM orders GROUP BY o_custkey) USING (o_custkey)""")
def a17_customer_spending_profile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = timewise.with_spending_profile(orders, "o_custkey", "o_totalprice")
    return out.select("o_orderkey", "txn_count", F.round(F.col("spend_mean") * F.col("txn_count"), 2).alias("spend_total"),
                      F.round("spend_std", 4).alias("spend_std"), "spend_max")


def sql_tokens(text: str) -> str:
    """SQL text of ``token_count``."""
    clean = f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"
    return f"CASE WHEN {clean} = '' THEN 0 ELSE len(string_split({clean}, ' ')) END"


@query("a18_throughput_summary", f"""
SELECT count(*) AS requests, CAST(sum({sql_tokens('text')}) AS BIGINT) AS input_tokens,
       CAST(sum({sql_tokens('source')}) AS BIGINT) AS output_tokens FROM documents""")
def a18_throughput_summary(spark, sf_dir):
    return lengths.throughput_summary(table(spark, sf_dir, "documents"), "text", "source")


@query("a18_token_throughput")
def a18_token_throughput(spark, sf_dir):
    """Requests, prompt and answer tokens of all conversations' turns: the user's ask, the assistant's answer."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.select(F.when(F.col("role") != "assistant", F.col("text")).alias("prompt"),
                         F.when(F.col("role") == "assistant", F.col("text")).alias("response"))
    return lengths.throughput_summary(asked, "prompt", "response", counter=token_counter())


@query("m2_evaluate", METRICS_SQL)
def m2_evaluate(spark, sf_dir):
    m = evaluate(parsed_responses(responses(spark, sf_dir))).metrics
    return m.select(*[F.round(c, 6).alias(c) for c in ("f1", "precision", "recall", "mcc", "auroc")],
                    "tn", "fp", "fn", "tp")
