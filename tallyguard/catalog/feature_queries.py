"""Imputation, scaling, encoding, time features and the six preparation recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyguard.catalog.aggregate_queries import URGENT, urgent_customers
from tallyguard.catalog.registry import EVENT_KEY, LABELLED, labelled, query, sql_rank_key, sql_split, table
from tallyguard.functions import columns as C
from tallyguard.operators import encoding, scaling, timewise
from tallyguard.operators.ranking import rank_key
from tallyguard.operators.sampling import stratified_split
from tallyguard.plans import recipes


@query("e1_impute", f"""
WITH u AS (SELECT c_custkey, urgent, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment FROM {URGENT})
SELECT c_custkey, round(coalesce(urgent, (SELECT median(urgent) FROM u)), 3) AS urgent,
       coalesce(segment, (SELECT segment FROM u WHERE segment IS NOT NULL GROUP BY segment
                          ORDER BY count(*) DESC, segment LIMIT 1)) AS segment
FROM u""")
def e1_impute(spark, sf_dir):
    df = urgent_customers(spark, sf_dir).select(
        "c_custkey", "urgent", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("segment"))
    fills = scaling.fit_imputer(df, ["urgent"], ["segment"])
    return scaling.impute(df, fills).withColumn("urgent", F.round("urgent", 3))


@query("e2_standard_scale", """
SELECT event_id, round((value - m) / s, 6) AS value_scaled
FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)""")
def e2_standard_scale(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "value")
    scaled = scaling.standard_scale(df, scaling.fit_scaler(df, ["value"]), {"value": "value_scaled"})
    return scaled.select("event_id", F.round("value_scaled", 6).alias("value_scaled"))


@query("e2_standard_scale_train", f"""
WITH s AS (SELECT * FROM {sql_split(LABELLED, EVENT_KEY)})
SELECT event_id, split, round((value - m) / d, 6) AS value
FROM s, (SELECT avg(value) AS m, stddev_pop(value) AS d FROM s WHERE split = 'train')""")
def e2_standard_scale_train(spark, sf_dir):
    """Fitted on the training split only."""
    df = stratified_split(labelled(spark, sf_dir), rank_key("event_id"))
    scaled = scaling.standard_scale(df, scaling.fit_scaler(df, ["value"], fit_on="train"))
    return scaled.select("event_id", "split", F.round("value", 6).alias("value"))


@query("e3_label_encode", """
SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type,
       dense_rank() OVER (ORDER BY p_name) - 1 AS p_name FROM part""")
def e3_label_encode(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return encoding.label_encode(part, ["p_brand", "p_type", "p_name"])


@query("e4_one_hot", """
SELECT o_orderkey, o_orderpriority = '1-URGENT' AS "pri_1-URGENT", o_orderpriority = '2-HIGH' AS "pri_2-HIGH",
       o_orderpriority = '3-MEDIUM' AS "pri_3-MEDIUM", o_orderpriority = '4-NOT SPECIFIED' AS "pri_4-NOT SPECIFIED",
       o_orderpriority = '5-LOW' AS "pri_5-LOW" FROM orders""")
def e4_one_hot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return encoding.one_hot(orders, "o_orderpriority", prefix="pri")


@query("e5_time_features", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CAST(day(ts) AS INTEGER) AS day_of_month FROM events""")
def e5_time_features(spark, sf_dir):
    out = timewise.time_features(table(spark, sf_dir, "events"), "ts")
    return out.select("event_id", "hour_of_day", "day_of_week", "day_of_month")


@query("e6_week_feature", "SELECT l_orderkey, l_linenumber, CAST(weekofyear(l_shipdate) AS INTEGER) AS week FROM lineitem")
def e6_week_feature(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", C.week_of_year("l_shipdate").alias("week"))


@query("e7_age_brackets", """
SELECT p_partkey, CASE WHEN p_size < 19 THEN 0 WHEN p_size < 26 THEN 1 WHEN p_size < 36 THEN 2
  WHEN p_size < 46 THEN 3 WHEN p_size < 56 THEN 4 WHEN p_size < 66 THEN 5 ELSE 6 END AS bracket FROM part""")
def e7_age_brackets(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.age_bracket("p_size").alias("bracket"))


# --- recipes: the raw shapes are cut from the given tables; held-out rows are compared in full,
# --- the balanced training split by its class sizes

def _summary(features, drop, shown):
    """Rows per split and label, and the sum of some features over the held-out splits."""
    done = recipes.prepare(features.drop(*drop))
    held_out = F.col("split") != "train"
    return done.rows.groupBy("split", "label").agg(
        F.count("*").alias("rows"),
        *[F.round(F.sum(F.when(held_out, F.col(f"`{c}`").cast("double"))), 4).alias(name)
          for name, c in shown.items()])


def _summary_sql(features_sql: str, shown: list[str]) -> str:
    """SQL of ``_summary``: ``features_sql`` gives k (key text), label and the shown features."""
    split = sql_split(f"({features_sql})", "k")
    sums = ", ".join(f"round(sum({c}) FILTER (split <> 'train'), 4) AS {c}" for c in shown)
    return f"""
WITH f AS MATERIALIZED (SELECT * FROM {split}),
g AS (SELECT split, label, count(*) AS n, {sums} FROM f GROUP BY split, label),
c AS (SELECT max(n) FILTER (label = 1) AS a, max(n) FILTER (label = 0) AS b FROM g WHERE split = 'train'),
p AS (SELECT a, b, CASE WHEN a / CAST(b AS DOUBLE) < 0.1
                        THEN CAST(trunc(b * CAST(0.1 AS DOUBLE) - a) AS BIGINT) ELSE 0 END AS made FROM c)
SELECT split, label, CAST(CASE WHEN split <> 'train' THEN n WHEN label = 1 THEN n + made
       WHEN greatest(a, trunc(b * CAST(0.1 AS DOUBLE))) / CAST(b AS DOUBLE) < 0.5
         THEN least(trunc((a + made) / CAST(0.5 AS DOUBLE)), n) ELSE n END AS BIGINT) AS rows,
       {', '.join(shown)}
FROM g, p"""


def _z(expr: str, name: str) -> str:
    return f"({expr} - avg({expr}) OVER ()) / stddev_pop({expr}) OVER () AS {name}"


@query("e8_recipe_ccf", _summary_sql(f"""
SELECT {EVENT_KEY} AS k, label, {_z('value', 'amount_sum')}, {_z('epoch(date_trunc($$hour$$, ts))', 'time_sum')},
       CAST(user_id AS DOUBLE) AS v1_sum FROM {LABELLED}""", ["amount_sum", "time_sum", "v1_sum"]))
def e8_recipe_ccf(spark, sf_dir):
    hour = F.unix_timestamp(F.date_trunc("hour", F.col("ts").cast("timestamp")))
    raw = labelled(spark, sf_dir).select(
        "event_id", hour.cast("double").alias("Time"), F.col("user_id").cast("double").alias("V1"),
        F.col("value").alias("Amount"), F.col("label").alias("Class"))
    return _summary(recipes.features_ccf(raw, "event_id"), ["event_id"],
                    {"amount_sum": "Amount_scaled", "time_sum": "Time_scaled", "v1_sum": "V1"})


_IEEE = f"""
SELECT event_id, label, value, event_type AS kind, CASE WHEN event_id % 3 <> 0 THEN value * 2 END AS num,
       CASE WHEN user_id % 5 <> 0 THEN 'device' || CAST(user_id % 7 AS VARCHAR) END AS device
FROM {LABELLED}"""


@query("e8_recipe_ieee_cis", _summary_sql(f"""
WITH t AS ({_IEEE}),
x AS (SELECT *, coalesce(num, (SELECT median(num) FROM t)) AS num_i,
             coalesce(device, (SELECT device FROM t WHERE device IS NOT NULL GROUP BY device
                               ORDER BY count(*) DESC, device LIMIT 1)) AS dev FROM t)
SELECT {EVENT_KEY} AS k, label, {_z('value', 'amount_sum')}, num_i AS num_sum,
       CAST(dense_rank() OVER (ORDER BY kind) - 1 AS DOUBLE) AS kind_sum,
       CAST(dense_rank() OVER (ORDER BY dev) - 1 AS DOUBLE) AS device_sum FROM x""",
    ["amount_sum", "num_sum", "kind_sum", "device_sum"]))
def e8_recipe_ieee_cis(spark, sf_dir):
    """An identity table for about half of the transactions, with one column dropped as too sparse."""
    df = labelled(spark, sf_dir)
    txn = df.select(F.col("event_id").alias("TransactionID"), F.col("label").alias("isFraud"),
                    F.col("value").alias("TransactionAmt"), F.col("event_type").alias("kind"),
                    F.when(F.col("event_id") % 3 != 0, F.col("value") * 2).alias("num"),
                    F.when(F.col("user_id") % 5 != 0, F.concat(
                        F.lit("device"), (F.col("user_id") % 7).cast("string"))).alias("device"))
    identity = df.where("event_id % 4 = 0").select(
        F.col("event_id").alias("TransactionID"), F.col("value").alias("id_01"))
    return _summary(recipes.features_ieee_cis(txn, identity), [], {"amount_sum": "TransactionAmt", "num_sum": "num",
                                   "kind_sum": "kind", "device_sum": "device"})


@query("e8_recipe_paysim", _summary_sql(f"""
SELECT {EVENT_KEY} AS k, CAST(event_type = 'error' AS INTEGER) AS label, {_z('value', 'amount_sum')},
       value / (100 + 1e-9) AS ratio_sum, CAST(event_type = 'click' AS DOUBLE) AS click_sum FROM events""", ["amount_sum", "ratio_sum", "click_sum"]))
def e8_recipe_paysim(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    raw = df.select(
        "event_id", F.col("user_id").alias("step"), F.col("event_type").alias("type"),
        F.col("value").alias("amount"), F.lit("a").alias("nameOrig"), F.lit(100.0).alias("oldbalanceOrg"),
        (F.lit(100.0) - F.col("value")).alias("newbalanceOrig"), F.lit("b").alias("nameDest"),
        F.lit(5.0).alias("oldbalanceDest"), (F.lit(5.0) + F.col("value")).alias("newbalanceDest"),
        (F.col("event_type") == "error").cast("int").alias("isFraud"), F.lit(0).alias("isFlaggedFraud"))
    return _summary(recipes.features_paysim(raw, "event_id"), ["event_id"],
                    {"amount_sum": "amount", "ratio_sum": "amount_to_balance_ratio", "click_sum": "type_click"})


@query("e8_recipe_ibm_aml", _summary_sql(f"""
SELECT {EVENT_KEY} AS k, label, {_z('value', 'amount_sum')}, CAST(hour(ts) AS DOUBLE) AS hour_sum,
       CAST(count(*) OVER (PARTITION BY user_id ORDER BY date_trunc('minute', ts), {EVENT_KEY}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS count_sum,
       CAST(dense_rank() OVER (ORDER BY CAST(user_id AS VARCHAR)) - 1 AS DOUBLE) AS account_sum,
       CAST(dense_rank() OVER (ORDER BY props) - 1 AS DOUBLE) AS account_1_sum FROM {LABELLED}""",
    ["amount_sum", "hour_sum", "count_sum", "account_sum", "account_1_sum"]))
def e8_recipe_ibm_aml(spark, sf_dir):
    raw = labelled(spark, sf_dir).select(
        "event_id", F.date_format("ts", "yyyy/MM/dd HH:mm").alias("Timestamp"),
        F.col("user_id").cast("string").alias("Account"), F.col("props").alias("Account.1"),
        F.lit("Euro").alias("Payment Currency"), F.lit("Euro").alias("Receiving Currency"),
        F.col("event_type").alias("Payment Format"), F.col("value").alias("Amount Paid"),
        F.col("label").alias("Is Laundering"))
    return _summary(recipes.features_ibm_aml(raw, "event_id"), ["event_id"],
                    {"amount_sum": "amount_paid", "hour_sum": "hour_of_day", "count_sum": "txn_count_24h",
                     "account_sum": "account", "account_1_sum": "account.1"})



@query("e8_recipe_elliptic", _summary_sql(f"""
SELECT {sql_rank_key('vec_id')} AS k, CASE WHEN label < 2 THEN 1 ELSE 0 END AS label,
       {_z('CAST(embedding[1] AS DOUBLE)', 'f1_sum')}, {_z('CAST(embedding[64] AS DOUBLE)', 'f64_sum')},
       CAST(vec_id % 49 AS DOUBLE) AS step_sum
FROM embeddings WHERE label < 8""", ["f1_sum", "f64_sum", "step_sum"]))
def e8_recipe_elliptic(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    features = emb.select(
        F.col("vec_id").alias("txId"), (F.col("vec_id") % 49).cast("int").alias("time_step"),
        *[F.col("embedding")[i].cast("double").alias(f"f{i + 1}") for i in range(64)])
    classes = emb.select(F.col("vec_id").alias("txId"), F.when(F.col("label") < 2, "1")
                         .when(F.col("label") < 8, "2").otherwise("unknown").alias("class"))
    return _summary(recipes.features_elliptic(features, classes), [],
                    {"f1_sum": "f1", "f64_sum": "f64", "step_sum": "time_step"})


@query("e8_recipe_banksim", _summary_sql(f"""
SELECT {EVENT_KEY} AS k, label, {_z('value', 'amount_sum')},
       CAST(CASE WHEN user_id % 8 BETWEEN 1 AND 6 THEN user_id % 8 WHEN user_id % 8 = 7 THEN 7 ELSE 0 END AS DOUBLE) AS age_sum,
       CAST(user_id % 2 = 0 AS DOUBLE) AS gender_sum,
       CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS DOUBLE) AS category_sum,
       CAST(dense_rank() OVER (ORDER BY CAST(user_id AS VARCHAR)) - 1 AS DOUBLE) AS customer_sum
FROM {LABELLED}""", ["amount_sum", "age_sum", "gender_sum", "category_sum", "customer_sum"]))
def e8_recipe_banksim(spark, sf_dir):
    def quoted(c):
        return F.concat(F.lit("'"), c, F.lit("'"))
    u = F.col("user_id")
    raw = labelled(spark, sf_dir).select(
        "event_id", (F.col("event_id") % 180).cast("int").alias("step"),
        quoted(u.cast("string")).alias("customer"),
        quoted(F.substring(F.lit("U123456O"), (u % 8 + 1).cast("int"), F.lit(1))).alias("age"),
        quoted(F.when(u % 2 == 0, "M").otherwise("F")).alias("gender"),
        quoted(F.col("props")).alias("merchant"), quoted(F.col("event_type")).alias("category"),
        F.col("value").alias("amount"), F.col("label").alias("fraud"))
    return _summary(recipes.features_banksim(raw, "event_id"), ["event_id"],
                    {"amount_sum": "amount", "age_sum": "age", "gender_sum": "gender",
                     "category_sum": "category", "customer_sum": "customer"})
