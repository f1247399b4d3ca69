"""Projections, filters, joins and small scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyguard.catalog.registry import LABELLED, labelled, query, table
from tallyguard.fixed_values import AGE_CODES
from tallyguard.functions import columns as C
from tallyguard.functions import prompts as P
from tallyguard.operators import cleaning, encoding, profiling
from tallyguard.operators.neighbours import knn_self_join

LINE_ITEMS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query("p1_rename_label", f"SELECT event_id, label AS is_error FROM {LABELLED}")
def p1_rename_label(spark, sf_dir):
    return cleaning.rename_label(labelled(spark, sf_dir), "label", "is_error").select("event_id", "is_error")


@query("p2_snake_case_columns",
       "SELECT p_partkey AS part_key, p_name AS part_name, p_retailprice AS retail_price FROM part")
def p2_snake_case_columns(spark, sf_dir):
    raw = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("Part Name"),
        F.col("p_retailprice").alias("Retail Price"))
    return cleaning.snake_case_columns(raw)


@query("p3_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def p3_drop_columns(spark, sf_dir):
    return cleaning.drop_columns(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderpriority", "absent"])


@query("p4_drop_high_null", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def p4_drop_high_null(spark, sf_dir):
    joined = cleaning.left_equi_join(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    return cleaning.drop_high_null(joined)


@query("p5_select_by_type", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount
FROM lineitem""")
def p5_select_by_type(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return df.select(*profiling.numeric_columns(df, exclude=("l_tax",)))


CLASSED = """(SELECT doc_id, CASE toxic WHEN 1 THEN '1' WHEN 0 THEN '2' ELSE 'unknown' END AS class
  FROM documents LEFT JOIN labels USING (doc_id))"""


def _classed(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select("doc_id", F.when(F.col("toxic") == 1, "1").when(F.col("toxic") == 0, "2")
                         .otherwise("unknown").alias("class"))


@query("p6_filter_unlabelled", f"SELECT doc_id, class FROM {CLASSED} WHERE class <> 'unknown'")
def p6_filter_unlabelled(spark, sf_dir):
    return cleaning.filter_unlabelled(_classed(spark, sf_dir))


@query("p7_class_filter", f"SELECT event_id, user_id, value FROM {LABELLED} WHERE label = 1")
def p7_class_filter(spark, sf_dir):
    return cleaning.class_filter(labelled(spark, sf_dir), 1).select("event_id", "user_id", "value")


_AGE_CASE = " ".join(f"WHEN '{k}' THEN {v}" for k, v in AGE_CODES.items())


@query("p8_map_values", f"""
SELECT event_id, CASE age {_AGE_CASE} ELSE 0 END AS age_code,
       CAST(coalesce(gender = 'M', FALSE) AS INTEGER) AS gender_flag
FROM (SELECT event_id, CASE WHEN event_id % 11 <> 10 THEN substr('U123456O0X', user_id % 10 + 1, 1) END AS age,
             CASE user_id % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender FROM events)""")
def p8_map_values(spark, sf_dir):
    u = F.col("user_id")
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 11 != 10,
               F.substring(F.lit("U123456O0X"), (u % 10 + 1).cast("int"), F.lit(1))).alias("age"),
        F.when(u % 3 == 0, "M").when(u % 3 == 1, "F").alias("gender"))
    return raw.select("event_id", C.age_code("age").alias("age_code"), C.gender_flag("gender").alias("gender_flag"))


@query("p9_balance_features", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * 0.5 - l_quantity, 6) AS balance_diff_orig,
       round(l_extendedprice - l_tax, 6) AS balance_diff_dest,
       round(l_extendedprice / (l_quantity + 1e-9), 6) AS amount_to_balance_ratio FROM lineitem""")
def p9_balance_features(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("oldbalanceOrg"), (F.col("l_extendedprice") * 0.5).alias("newbalanceOrig"),
        F.col("l_tax").alias("oldbalanceDest"), F.col("l_extendedprice").alias("newbalanceDest"))
    out = cleaning.balance_features(raw)
    return out.select("l_orderkey", "l_linenumber", *[
        F.round(c, 6).alias(c) for c in ("balance_diff_orig", "balance_diff_dest", "amount_to_balance_ratio")])


@query("p10_example_metadata", f"""
SELECT event_id, 'ccf' AS dataset, 'train' AS split, label, label = 1 AS is_fraud FROM {LABELLED}""")
def p10_example_metadata(spark, sf_dir):
    df = labelled(spark, sf_dir).select("event_id", P.example_metadata("ccf", "train", "label").alias("m"))
    return df.select("event_id", "m.dataset", "m.split", "m.label", "m.is_fraud")


@query("p11_copy_optional_column",
       "SELECT event_id, event_type AS laundering_type, event_type AS laundering_type_label FROM events")
def p11_copy_optional_column(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("laundering_type"))
    df = cleaning.copy_optional_column(df, "absent", "absent_label")
    return cleaning.copy_optional_column(df, "laundering_type", "laundering_type_label")


@query("j1_left_equi_join", """
SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)""")
def j1_left_equi_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return cleaning.left_equi_join(docs, table(spark, sf_dir, "labels"), "doc_id")


@query("j2_inner_equi_join", f"""
SELECT doc_id, n_chars, CAST(class AS INTEGER) % 2 AS label
FROM documents JOIN (SELECT * FROM {CLASSED} WHERE class <> 'unknown') USING (doc_id)""")
def j2_inner_equi_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    joined = cleaning.inner_equi_join(docs, cleaning.filter_unlabelled(_classed(spark, sf_dir)), "doc_id")
    return cleaning.label_from_class(joined).select("doc_id", "n_chars", "label")


@query("j3_dictionary_join", """
SELECT p_partkey, p_brand, d.code FROM part
JOIN (SELECT b, row_number() OVER (ORDER BY b) - 1 AS code FROM (SELECT DISTINCT p_brand AS b FROM part)) d
  ON d.b = p_brand""")
def j3_dictionary_join(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    vocab, sizes = encoding.fit_vocabulary(part, ["p_brand"])
    return encoding.dictionary_join(part, vocab, "p_brand", sizes["p_brand"], out="code")


@query("j4_knn_self_join", """
SELECT key, neighbour, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM (
  SELECT CAST(a.vec_id AS VARCHAR) AS key, CAST(b.vec_id AS VARCHAR) AS neighbour,
         list_distance(a.v, b.v) AS distance,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), CAST(b.vec_id AS VARCHAR)) AS rank
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) a,
       (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) b
  WHERE a.vec_id <> b.vec_id)
WHERE rank <= 5""")
def j4_knn_self_join(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"), F.col("embedding").alias("vec"))
    near = knn_self_join(points, 5)
    return near.select("key", "neighbour", "rank", F.round("distance", 6).alias("distance"))


@query("j4_hashed_knn_join")
def j4_hashed_knn_join(spark, sf_dir):
    """Neighbours by the random-projection index, of all points."""
    points = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"), F.col("embedding").alias("vec"))
    near = knn_self_join(points, 5, mode="hashed")
    return near.select("key", "neighbour", "rank", F.round("distance", 6).alias("distance"))


@query("f1_parse_ts_or_null", """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed FROM events""")
def f1_parse_ts_or_null(spark, sf_dir):
    text = F.when(F.col("event_id") % 7 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    df = table(spark, sf_dir, "events").select("event_id", text.alias("t"))
    return df.select("event_id", F.date_format(C.parse_ts_or_null("t"), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("f2_strip_quotes", "SELECT p_partkey, p_type FROM part")
def f2_strip_quotes(spark, sf_dir):
    quoted = F.concat(F.lit("'\""), F.col("p_type"), F.lit("''"))
    return table(spark, sf_dir, "part").select("p_partkey", C.strip_quotes(quoted).alias("p_type"))


@query("f3_to_text", """
SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'nan') AS quality_text
FROM documents LEFT JOIN labels USING (doc_id)""")
def f3_to_text(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return df.select("doc_id", C.to_text("quality").alias("quality_text"))
