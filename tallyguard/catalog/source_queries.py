"""Scans and sinks: each query writes whole given tables in the raw form and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.catalog.registry import (EVENT_KEY, LABELLED, RESPONSES, labelled, query, responses,
                                         sql_parsed, sql_split, table)
from tallyguard.functions import prompts as P
from tallyguard.functions import responses as R
from tallyguard.operators.ranking import rank_key
from tallyguard.operators.sampling import stratified_split
from tallyguard.plans.evaluation import evaluate, parsed_responses
from tallyguard.session import scratch_path
from tallyguard.sources import files, sinks

CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


def _csv(spark, df, header=True):
    path = scratch_path(spark, "csv")
    df.write.option("header", header).csv(path)
    return path


@query("s1_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s1_csv_scan(spark, sf_dir):
    path = _csv(spark, table(spark, sf_dir, "customer").select(*CUSTOMER.names))
    return files.csv_scan(spark, path, CUSTOMER)


@query("s2_csv_scan_named",
       "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS price FROM orders")
def s2_csv_scan_named(spark, sf_dir):
    path = _csv(spark, table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                header=False)
    names = T.StructType([T.StructField("order_id", T.LongType()),
                          T.StructField("customer_id", T.LongType()),
                          T.StructField("price", T.DoubleType())])
    return files.csv_scan_named(spark, path, names)


def _saved_splits(spark, sf_dir):
    out = scratch_path(spark, "processed")
    rows = stratified_split(labelled(spark, sf_dir).select("event_id", "value", "label"),
                            rank_key("event_id"))
    counts = sinks.save_splits(rows, out, "events")
    return out, counts


@query("s3_parquet_scan",
       f"SELECT event_id, value, label FROM {sql_split(LABELLED, EVENT_KEY)} WHERE split = 'test'")
def s3_parquet_scan(spark, sf_dir):
    out, _ = _saved_splits(spark, sf_dir)
    return files.parquet_scan(spark, out, "events", "test").select("event_id", "value", "label")


def _document_chat(spark, sf_dir):
    """All documents as chat lines: the text as user message, toxicity as label, 0 where there is none."""
    df = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").fillna(0, ["toxic"])
    meta = P.example_metadata(F.col("lang"), F.lit("test"), F.col("toxic"))
    return df.select(
        F.array(P.message("system", F.lit("s")), P.message("user", "text")).alias("messages"),
        meta.alias("metadata"))


@query("s4_jsonl_scan", """
SELECT lang AS dataset, coalesce(toxic, 0) AS label, coalesce(toxic, 0) = 1 AS is_fraud, md5(text) AS user_md5
FROM documents LEFT JOIN labels USING (doc_id)""")
def s4_jsonl_scan(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    sinks.write_jsonl(_document_chat(spark, sf_dir), path)
    return files.jsonl_scan(spark, path).select(
        "metadata.dataset", "metadata.label", "metadata.is_fraud",
        F.md5(P.first_user_content("messages")).alias("user_md5"))


@query("s4_jsonl_pair", """
SELECT CASE WHEN lang = 'en' THEN 'train' ELSE 'validation' END AS split,
       CAST(sum(coalesce(toxic, 0)) AS BIGINT) AS fraud, count(*) AS rows
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def s4_jsonl_pair(spark, sf_dir):
    chat = _document_chat(spark, sf_dir)
    train, val = scratch_path(spark, "train-jsonl"), scratch_path(spark, "val-jsonl")
    sinks.write_jsonl(chat.where("metadata.dataset = 'en'"), train)
    sinks.write_jsonl(chat.where("metadata.dataset <> 'en'"), val)
    return files.jsonl_pair(spark, train, val).groupBy("split").agg(
        F.sum("metadata.label").alias("fraud"), F.count("*").alias("rows"))


@query("s5_optional_source", """
SELECT c_custkey, n_name AS side_name, CAST(NULL AS VARCHAR) AS absent_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def s5_optional_source(spark, sf_dir):
    """One side file is there and joined, the other is absent and its join is left out."""
    main = files.csv_scan(spark, _csv(spark, table(spark, sf_dir, "customer").select(*CUSTOMER.names)),
                          CUSTOMER)
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sides = {"side_name": _csv(spark, nation), "absent_name": scratch_path(spark, "absent")}
    out = main
    for name, path in sides.items():
        side = files.optional_csv(spark, path, T.StructType([
            T.StructField("c_nationkey", T.IntegerType()), T.StructField(name, T.StringType())]))
        out = (out.withColumn(name, F.lit(None).cast("string")) if side is None
               else out.join(side, "c_nationkey", "left"))
    return out.select("c_custkey", "side_name", "absent_name")


@query("s6_save_splits", f"""
SELECT split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS fraud, count(*) AS seen_rows,
       CAST(sum(label) AS BIGINT) AS seen_fraud, 'label' AS last_column
FROM {sql_split(LABELLED, EVENT_KEY)} GROUP BY split""")
def s6_save_splits(spark, sf_dir):
    """Counts read back per split next to the counts observed while writing."""
    out, counts = _saved_splits(spark, sf_dir)
    back = files.parquet_scan(spark, out, "events")
    last = [c for c in back.columns if c != "split"][-1]

    def seen(kind):
        return F.coalesce(*[F.when(F.col("split") == s, F.lit(counts[f"{s}_{kind}"]).cast("bigint"))
                            for s in ("train", "val", "test")])
    return (back.groupBy("split").agg(F.count("*").alias("rows"), F.sum("label").alias("fraud"))
            .select("split", "rows", "fraud", seen("rows").alias("seen_rows"),
                    seen("fraud").alias("seen_fraud"), F.lit(last).alias("last_column")))


@query("s7_write_jsonl", f"""
SELECT split, CAST(event_id AS VARCHAR) AS event, label, row_number() OVER (PARTITION BY split ORDER BY {EVENT_KEY}) AS position
FROM {sql_split(LABELLED, EVENT_KEY)}""")
def s7_write_jsonl(spark, sf_dir):
    """Shuffled examples, one folder per split, read back with their positions in the files."""
    rows = stratified_split(labelled(spark, sf_dir), rank_key("event_id"))
    meta = P.example_metadata("events", F.col("split"), "label")
    chat = rows.select(F.array(P.message("user", F.col("event_id").cast("string"))).alias("messages"),
                       meta.alias("metadata"), "split")
    path = scratch_path(spark, "jsonl")
    sinks.write_jsonl(chat, path, rank_key(F.col("messages")[0]["content"]))
    read = files.jsonl_scan(spark, path).select(
        "metadata.split", "metadata.label", P.first_user_content("messages").alias("event"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"))
    return files.numbered_lines(read, "split", "file", "start", "line", "position").select(
        "split", "event", "label", "position")


METRICS_SQL = f"""
WITH c AS (
  SELECT CAST(count(*) FILTER (y_true = 0 AND y_pred = 0) AS BIGINT) AS tn,
         CAST(count(*) FILTER (y_true = 0 AND y_pred = 1) AS BIGINT) AS fp,
         CAST(count(*) FILTER (y_true = 1 AND y_pred = 0) AS BIGINT) AS fn,
         CAST(count(*) FILTER (y_true = 1 AND y_pred = 1) AS BIGINT) AS tp
  FROM {sql_parsed(RESPONSES)}),
s AS (SELECT y_score, count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true = 0) AS neg
      FROM {sql_parsed(RESPONSES)} GROUP BY y_score),
a AS (SELECT sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) AS auroc
      FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY y_score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s))
SELECT round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) AS f1, round(tp::DOUBLE / (tp + fp), 6) AS precision,
       round(tp::DOUBLE / (tp + fn), 6) AS recall,
       round((tp::DOUBLE * tn - fp::DOUBLE * fn) / (sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp) * sqrt(tn + fn)), 6) AS mcc,
       round(auroc, 6) AS auroc, tn, fp, fn, tp
FROM c, a"""


@query("s8_write_metrics_json", METRICS_SQL)
def s8_write_metrics_json(spark, sf_dir):
    result = evaluate(parsed_responses(responses(spark, sf_dir)))
    path = sinks.write_metrics_json(result.metrics, scratch_path(spark, "results"), "events_")
    schema = ("f1 double, precision double, recall double, mcc double, auroc double, "
              "confusion_matrix array<array<bigint>>")
    back = spark.read.schema(schema).json(path)
    m = F.col("confusion_matrix")
    return back.select(*[F.round(c, 6).alias(c) for c in ("f1", "precision", "recall", "mcc", "auroc")],
                       m[0][0].alias("tn"), m[0][1].alias("fp"), m[1][0].alias("fn"), m[1][1].alias("tp"))


@query("s10_manifest_audit")
def s10_manifest_audit(spark, sf_dir):
    """The table files of the folder against a manifest with one absent name."""
    expected = {
        "retail": [f"{t}.parquet" for t in ("customer", "orders", "lineitem", "part", "supplier", "nation", "region")],
        "texts": [f"{t}.parquet" for t in ("documents", "labels", "pages", "benchmark", "conversations")],
        "streams": ["events.parquet", "embeddings.parquet", "absent.parquet"]}
    audit = files.manifest_audit(spark, sf_dir, expected)
    return audit.select("alias", F.array_join("found", "; ").alias("found"),
                        F.array_join("missing", "; ").alias("missing"))


@query("s12_write_scored", f"""
SELECT event_id, 'Card payment' AS context, verdict AS parsed_verdict,
       CASE WHEN event_id % 4 = 0 THEN json_extract_string(response, '$.verdict') ELSE 'PARSE_ERROR' END AS verdict,
       event_id % 4 <> 0 AS parse_error,
       CASE WHEN event_id % 4 <> 0 THEN response END AS raw_response
FROM {sql_parsed(RESPONSES)}""")
def s12_write_scored(spark, sf_dir):
    df = responses(spark, sf_dir).withColumn("result", R.parse_response_or_error("response"))
    df = df.withColumn("parsed_verdict", R.parse_verdict("response"))
    transaction = F.struct("event_id", "dataset", "parsed_verdict")
    path = scratch_path(spark, "scored")
    sinks.write_scored(sinks.scored_record(df, transaction, F.lit("Card payment")), path)
    schema = ("transaction struct<event_id bigint, dataset string, parsed_verdict int>, context string, "
              "result struct<verdict string, raw_response string, parse_error boolean>")
    back = spark.read.schema(schema).json(path)
    return back.select("transaction.event_id", "context", "transaction.parsed_verdict",
                       "result.verdict", "result.parse_error", "result.raw_response")


@query("s13_preview_examples", """
SELECT doc_id AS example, tag, CASE WHEN length(content) > 500 THEN substr(content, 1, 500) || '...' ELSE content END AS shown
FROM (SELECT doc_id, '[USER]' AS tag, text AS content FROM documents
      UNION ALL SELECT doc_id, '[ASSISTANT]', source FROM documents)
WHERE doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 20)""")
def s13_preview_examples(spark, sf_dir):
    chat = table(spark, sf_dir, "documents").select(
        "doc_id", F.array(P.message("user", "text"), P.message("assistant", "source")).alias("messages"))
    return P.preview(chat, 20, "doc_id")
