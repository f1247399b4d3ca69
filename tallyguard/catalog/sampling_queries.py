"""Sorts, limits, splits, caps, samples, class balancing, unions and windows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from tallyguard.catalog.registry import (EVENT_KEY, LABELLED, labelled, query, sql_draw,
                                         sql_split, table)
from tallyguard.functions import prompts as P
from tallyguard.operators import encoding, sampling, timewise
from tallyguard.operators.groups import transform_groups
from tallyguard.operators.profiling import numeric_columns
from tallyguard.operators.ranking import class_cutoffs, rank_key, within_cutoff
from tallyguard.operators.smote import resample, smote_rows
from tallyguard.plans.examples import combine_datasets


def event_key():
    """Rank key of an event."""
    return rank_key("event_id")


@query("w1_running_txn_count", """
SELECT event_id, CAST(count(t) OVER (PARTITION BY user_id ORDER BY t ASC NULLS LAST, md5('42|' || CAST(event_id AS VARCHAR))
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS txn_count_24h
FROM (SELECT event_id, user_id, CASE WHEN event_id % 9 <> 0 THEN ts END AS t FROM events)""")
def w1_running_txn_count(spark, sf_dir):
    """Every ninth event has no time, as after a failed parse."""
    df = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.when(F.col("event_id") % 9 != 0, F.col("ts")).alias("ts"))
    return timewise.running_txn_count(df, "user_id", "ts", event_key()).select("event_id", "txn_count_24h")


def _running(batch, seen):
    """Numbers the rows of an account from ``seen`` on."""
    n = batch.num_rows
    numbers = pa.array(range(seen + 1, seen + n + 1), pa.int64())
    return pa.RecordBatch.from_arrays([batch.column("event_id"), numbers], ["event_id", "txn_count"]), seen + n


@query("m6_group_function", """
SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, md5('42|' || CAST(event_id AS VARCHAR))) AS txn_count
FROM events""")
def m6_group_function(spark, sf_dir):
    """A running count by a function over the ordered rows of every account, a batch at a time."""
    df = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return transform_groups(df, "user_id", ["ts", event_key()], _running, "event_id long, txn_count long", 0)


@query("w2_txn_count_24h", """
SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS txn_count_24h FROM events""")
def w2_txn_count_24h(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return timewise.window_txn_count(df, "user_id", "ts").select("event_id", "txn_count_24h")


@query("w3_balanced_head_cap", f"""
SELECT event_id, label FROM (
  SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY event_id) AS r,
         sum(label) OVER () AS n_fraud FROM {LABELLED})
WHERE r <= CASE label WHEN 1 THEN least(250, n_fraud) ELSE 500 - least(250, n_fraud) END""")
def w3_balanced_head_cap(spark, sf_dir):
    df = labelled(spark, sf_dir).select("event_id", "label")
    return sampling.balanced_head_cap(df, sampling.line_key("event_id"), "label", 500)


@query("w4_stratified_cap", f"""
SELECT event_id, label FROM (
  SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY {EVENT_KEY}) AS r,
         CAST(trunc(3000 * (sum(label) OVER () / CAST(count(*) OVER () AS DOUBLE))) AS BIGINT) AS keep_fraud,
         count(*) OVER () AS n FROM {LABELLED})
WHERE n <= 3000 OR r <= CASE label WHEN 1 THEN keep_fraud ELSE 3000 - keep_fraud END""")
def w4_stratified_cap(spark, sf_dir):
    return sampling.stratified_cap(labelled(spark, sf_dir).select("event_id", "label"), event_key(), 3000)


@query("w5_stratified_split", f"SELECT event_id, label, split FROM {sql_split(LABELLED, EVENT_KEY)}")
def w5_stratified_split(spark, sf_dir):
    return sampling.stratified_split(labelled(spark, sf_dir).select("event_id", "label"), event_key())


@query("o1_sort", """
SELECT event_id, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS position FROM events""")
def o1_sort(spark, sf_dir):
    """The position in (account, time) order, numbered without a single-partition window."""
    df = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return encoding.ordered_index(df, "user_id", "ts", "event_id", out="position").select("event_id", "position")


@query("o2_exact_fraction_sample", f"""
SELECT event_id, value FROM (
  SELECT event_id, value, row_number() OVER (ORDER BY {EVENT_KEY}) AS r, count(*) OVER () AS n FROM events)
WHERE r <= round_even(0.10::DOUBLE * n, 0)""")
def o2_exact_fraction_sample(spark, sf_dir):
    return sampling.exact_fraction_sample(table(spark, sf_dir, "events").select("event_id", "value"), event_key(), 0.10)


@query("o3_seeded_shuffle", f"""
SELECT event_id, row_number() OVER (ORDER BY {EVENT_KEY}) - 1 AS position FROM events""")
def o3_seeded_shuffle(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", event_key().alias("k"))
    return encoding.ordered_index(df, "k", out="position").select("event_id", "position")


@query("o4_limit", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def o4_limit(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "value").orderBy(F.desc("value"), "event_id").limit(25)


UNDERSAMPLE_SQL = f"""
SELECT event_id, label FROM (
  SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY {EVENT_KEY}) AS r,
         sum(label) OVER () AS n_min FROM {LABELLED})
WHERE label = 1 OR r <= CAST(trunc(n_min / 0.5::DOUBLE) AS BIGINT)"""


@query("o5_random_undersample", UNDERSAMPLE_SQL)
def o5_random_undersample(spark, sf_dir):
    return sampling.random_undersample(labelled(spark, sf_dir).select("event_id", "label"), event_key())


_DIST = "(a.value - b.value) * (a.value - b.value) + (a.hour - b.hour) * (a.hour - b.hour)"
SMOTE_SQL = f"""
WITH m AS (
  SELECT k, value, hour, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n
  FROM (SELECT {EVENT_KEY} AS k, value, hour(ts) AS hour FROM {LABELLED} WHERE label = 1)),
c AS (SELECT CAST(trunc(sum(1 - label) * CAST(0.1 AS DOUBLE) - sum(label)) AS BIGINT) AS n_new FROM {LABELLED}),
d AS (
  SELECT j AS n, {sql_draw('j', 'smote-base')} % (SELECT max(n) FROM m) AS i,
         {sql_draw('j', 'smote-near')} % 5 + 1 AS r,
         {sql_draw('j', 'smote-step')} / CAST(4294967296 AS DOUBLE) AS u
  FROM (SELECT unnest(range(n_new)) AS j FROM c)),
near AS (
  SELECT a.k AS base, b.k AS near, b.value AS near_value, b.hour AS near_hour,
         row_number() OVER (PARTITION BY a.k ORDER BY {_DIST}, b.k) AS r
  FROM m a, m b WHERE a.k <> b.k)
SELECT d.n AS _n, m.k AS _base, near AS _near, round(m.value + u * (near_value - m.value), 6) AS value,
       CAST(trunc(m.hour + u * (near_hour - m.hour)) AS INTEGER) AS hour
FROM d JOIN m ON d.i = m.i JOIN near ON near.base = m.k AND near.r = d.r"""


@query("o6_smote", SMOTE_SQL)
def o6_smote(spark, sf_dir):
    """Synthetic minority rows up to a tenth of the majority, on two features."""
    df = labelled(spark, sf_dir).select("event_id", "value", F.hour("ts").alias("hour"), "label")
    counts = {r["label"]: r["n"] for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}
    plan = sampling.resample_plan(counts[1], counts[0])
    made = smote_rows(df.where("label = 1").drop("label"), event_key(), ["value", "hour"], plan.n_synthetic)
    return made.select("_n", "_base", "_near", F.round("value", 6).alias("value"), "hour")


PLAN_SQL = """
SELECT n_minority, n_majority, n_minority / CAST(n_majority AS DOUBLE) < 0.1 AS oversample,
       greatest(n_minority, trunc(n_majority * CAST(0.1 AS DOUBLE))) / CAST(n_majority AS DOUBLE) < 0.5 AS undersample,
       CASE WHEN n_minority / CAST(n_majority AS DOUBLE) < 0.1
            THEN CAST(trunc(n_majority * CAST(0.1 AS DOUBLE) - n_minority) AS BIGINT) ELSE 0 END AS n_synthetic
FROM (SELECT CAST(sum(label) AS BIGINT) AS n_minority, CAST(sum(1 - label) AS BIGINT) AS n_majority FROM {source})"""
ERRORS = "(SELECT event_id, value, CAST(event_type = 'error' AS INTEGER) AS label FROM events)"


@query("o7_resample_plan", f"""
SELECT 'rare' AS kind, * FROM ({PLAN_SQL.format(source=LABELLED)})
UNION ALL SELECT 'errors', * FROM ({PLAN_SQL.format(source=ERRORS)})""")
def o7_resample_plan(spark, sf_dir):
    """The decisions for a rare label (both steps run) and a less rare one (synthesis is skipped)."""
    rare = labelled(spark, sf_dir).select(F.lit("rare").alias("kind"), "label")
    errors = table(spark, sf_dir, "events").select(
        F.lit("errors").alias("kind"), (F.col("event_type") == "error").cast("int").alias("label"))
    counts = rare.unionByName(errors).groupBy("kind").agg(
        F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b")).collect()
    plans = [(r["kind"], sampling.resample_plan(r["a"], r["b"])) for r in counts]
    return spark.createDataFrame(
        [(k, p.n_minority, p.n_majority, p.oversample, p.undersample, p.n_synthetic) for k, p in plans],
        "kind string, n_minority bigint, n_majority bigint, oversample boolean, undersample boolean, "
        "n_synthetic bigint")


@query("o6_o5_resample", f"""
WITH c AS (SELECT sum(label) AS a, sum(1 - label) AS b FROM {sql_split(LABELLED, EVENT_KEY)} WHERE split = 'train')
SELECT 1 AS label, CAST(trunc(b * CAST(0.1 AS DOUBLE) - a) + a AS BIGINT) AS rows FROM c
UNION ALL SELECT 0, CAST(trunc((trunc(b * CAST(0.1 AS DOUBLE) - a) + a) / CAST(0.5 AS DOUBLE)) AS BIGINT) FROM c""")
def o6_o5_resample(spark, sf_dir):
    """Both resampling steps on the training split: the class sizes they leave."""
    df = labelled(spark, sf_dir).select("event_id", "value", F.hour("ts").alias("hour"), "label")
    train = sampling.stratified_split(df, event_key()).where("split = 'train'")
    out, _ = resample(train.select(event_key().alias("_k"), "value", "hour", "label"), "_k")
    return out.groupBy("label").agg(F.count("*").alias("rows"))


@query("o8_length_bucketing", """
SELECT doc_id, n_chars // 512 AS length_bucket FROM documents""")
def o8_length_bucketing(spark, sf_dir):
    docs = sampling.length_buckets(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", 512)
    return sampling.group_by_length(docs, "n_chars", rank_key("doc_id")).select("doc_id", "length_bucket")


BATCHES_SQL = """
WITH h AS (SELECT doc_id, CAST(n_chars AS BIGINT) AS n, md5('42|length-batches|' || md5('42|' || CAST(doc_id AS VARCHAR))) AS h
           FROM documents),
m AS (SELECT *, CAST('0x' || substr(h, 1, 12) AS BIGINT) %
        (SELECT greatest(1, CAST(ceil(sum(n) / (20 * 16384.0::DOUBLE)) AS BIGINT)) FROM h) AS mega FROM h),
b AS (SELECT *, CAST(floor((sum(n) OVER (PARTITION BY mega ORDER BY n DESC, h ROWS UNBOUNDED PRECEDING) - n) / 16384) AS BIGINT)
        AS batch FROM m),
p AS (SELECT doc_id, mega, batch, row_number() OVER (PARTITION BY mega, batch ORDER BY n DESC, h) - 1 AS place,
        max(n) OVER (PARTITION BY mega, batch) AS longest, max(n) OVER (PARTITION BY mega, batch) - n AS padding FROM b)"""


def _batches(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return sampling.length_batches(docs, "n_chars", rank_key("doc_id"), 16_384, 20)


@query("o8_length_batches", f"{BATCHES_SQL} SELECT doc_id, mega, batch, CAST(place AS INTEGER) AS place, longest, padding FROM p")
def o8_length_batches(spark, sf_dir):
    """Every document's batch and place, in mega-batches of about 20 batches of 16,384 characters."""
    return _batches(spark, sf_dir).drop("n_chars")


@query("o8_padding_report", f"""{BATCHES_SQL}
SELECT count(*) FILTER (place = 0) AS batches, count(*) AS rows, round(sum(padding) / sum(longest)::DOUBLE, 6) AS padding_share FROM p""")
def o8_padding_report(spark, sf_dir):
    return sampling.padding_report(_batches(spark, sf_dir))


@query("u1_concat", UNDERSAMPLE_SQL)
def u1_concat(spark, sf_dir):
    """All fraud rows and an equally seeded legit sample, put together by union."""
    df = labelled(spark, sf_dir).select("event_id", "label")
    _, cuts = class_cutoffs(df, event_key(), lambda c: {0: [int(c[1] / 0.5)]}, by="label")
    return df.where("label = 1").unionByName(df.where(within_cutoff(event_key(), cuts, "label")))


@query("u2_combine_datasets", """
SELECT dataset, count(*) AS rows, CAST(sum(fraud) AS BIGINT) AS fraud FROM (
  SELECT 'events' AS dataset, CAST(event_type = 'error' AND value > 60 AS INTEGER) AS fraud FROM events
  UNION ALL SELECT 'documents', coalesce(toxic, 0) FROM documents LEFT JOIN labels USING (doc_id)
  UNION ALL SELECT 'orders', CAST(o_orderstatus = 'F' AS INTEGER) FROM orders)
GROUP BY dataset""")
def u2_combine_datasets(spark, sf_dir):
    """Examples of three differently shaped tables as one example table."""
    def examples(df, name, text, label):
        return df.select(F.lit("s").alias("system"), text.cast("string").alias("user"),
                         P.example_metadata(name, "train", label).alias("metadata"))
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").fillna(0, ["toxic"])
    orders = table(spark, sf_dir, "orders")
    combined = combine_datasets([
        examples(labelled(spark, sf_dir), "events", F.col("event_type"), "label"),
        examples(docs, "documents", F.col("lang"), "toxic"),
        examples(orders, "orders", F.col("o_totalprice"), (F.col("o_orderstatus") == "F").cast("int"))])
    return combined.groupBy("metadata.dataset").agg(
        F.count("*").alias("rows"), F.sum("metadata.label").alias("fraud"))


@query("u3_column_set_difference", f"""
SELECT event_id, user_id, value FROM {LABELLED}""")
def u3_column_set_difference(spark, sf_dir):
    df = labelled(spark, sf_dir)
    return df.select(*numeric_columns(df, exclude=("label",)))
