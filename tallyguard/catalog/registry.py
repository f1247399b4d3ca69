"""Registered queries with their SQL counterparts, and the table expressions they share."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function (spark, sf_dir) and the SQL that gives the same rows."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- labelled transactions: events with a 0/1 label, about 6 % positive -----------------------

def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events labelled fraud where an error has a value above 60."""
    is_fraud = (F.col("event_type") == "error") & (F.col("value") > 60)
    return table(spark, sf_dir, "events").withColumn("label", is_fraud.cast("int"))


LABELLED = ("(SELECT *, CAST(event_type = 'error' AND value > 60 AS INTEGER) AS label "
            "FROM events)")


def sql_rank_key(key: str, seed: int = 42) -> str:
    """SQL text of ``rank_key``."""
    return f"md5('{seed}|' || CAST({key} AS VARCHAR))"


EVENT_KEY = sql_rank_key("event_id")


def sql_split(source: str, key: str) -> str:
    """SQL of the 80/10/10 split of ``source`` (with a label), as a parenthesised query."""
    return f"""(
  SELECT * EXCLUDE (rk, n, t), CASE WHEN rk <= t THEN 'test'
    WHEN rk <= t + CAST(floor(CAST(0.1111 AS DOUBLE) * (n - t) + 0.5) AS BIGINT) THEN 'val'
    ELSE 'train' END AS split
  FROM (SELECT *, CAST(floor(CAST(0.10 AS DOUBLE) * n + 0.5) AS BIGINT) AS t
        FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {key}) AS rk,
                     count(*) OVER (PARTITION BY label) AS n FROM {source})))"""


# --- seeded draws in SQL ----------------------------------------------------------------------

def sql_draw(key: str, slot: str, seed: int = 42) -> str:
    """SQL text of ``draw``."""
    return f"CAST('0x' || substr(md5('{seed}|{slot}|' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


def sql_list(values: list) -> str:
    """SQL list literal."""
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def sql_choice(values: list, key: str, slot: str, seed: int = 42) -> str:
    """SQL text of ``choice``."""
    return f"({sql_list(values)})[CAST({sql_draw(key, slot, seed)} % {len(values)} AS BIGINT) + 1]"


def sql_sample(values: list[str], n: int, key: str, slot: str, seed: int = 42) -> str:
    """SQL text of ``sample_without_replacement``: the drawn number read as n shrinking picks.

    The orders are listed lexicographically, so the drawn number's leading part picks the first
    value, and so on among the values left.
    """
    number = f"({sql_draw(key, slot, seed)} % {math.perm(len(values), n)})"
    picks, rest, size = [], sql_list(values), len(values)
    for i in range(n):
        later = math.perm(size - 1, n - 1 - i)
        pick = f"({rest})[CAST({number} // {later} % {size} AS BIGINT) + 1]"
        picks.append(pick)
        rest, size = f"list_filter({rest}, lambda v{i}: v{i} <> {pick})", size - 1
    return f"[{', '.join(picks)}]"


# --- model responses: valid, truncated, free text and empty, by turns -------------------------

def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses derived from events: dataset, y_true, response."""
    df = labelled(spark, sf_dir)
    verdict = F.when(F.col("value") > 50, "FRAUD").otherwise("LEGITIMATE")
    risk = F.least(F.floor(F.col("value") / 25) + 1, F.lit(5)).cast("string")
    turn = F.col("event_id") % 4
    text = (
        F.when(turn == 0, F.concat(F.lit('{"verdict": "'), verdict, F.lit('", "risk_score": '), risk, F.lit("}")))
        .when(turn == 1, F.concat(F.lit('Answer: {"verdict" : "'), F.lower(verdict),
                                  F.lit('", "risk_score": '), risk))
        .when(turn == 2, F.when(F.col("value") > 50, "this looks like fraud")
              .otherwise("not fraud, legitimate"))
        .otherwise(""))
    return df.select("event_id", F.col("event_type").alias("dataset"),
                     F.col("label").alias("y_true"), text.alias("response"))


RESPONSES = f"""(
  SELECT event_id, event_type AS dataset, label AS y_true,
    CASE event_id % 4
      WHEN 0 THEN '{{"verdict": "' || v || '", "risk_score": ' || r || '}}'
      WHEN 1 THEN 'Answer: {{"verdict" : "' || lower(v) || '", "risk_score": ' || r
      WHEN 2 THEN CASE WHEN value > 50 THEN 'this looks like fraud' ELSE 'not fraud, legitimate' END
      ELSE '' END AS response
  FROM (SELECT *, CASE WHEN value > 50 THEN 'FRAUD' ELSE 'LEGITIMATE' END AS v,
               CAST(least(CAST(floor(value / 25) AS BIGINT) + 1, 5) AS VARCHAR) AS r
        FROM {LABELLED}))"""


def sql_parsed(source: str) -> str:
    """SQL that adds verdict, risk_score, y_pred and y_score to a source with ``response``."""
    return f"""(
  SELECT *, coalesce(verdict, 0) AS y_pred,
         (coalesce(nullif(risk_score, 0), 2) - 1) / 4.0::DOUBLE AS y_score
  FROM (
    SELECT * EXCLUDE (j, vk, rk, vp, rp),
      CASE WHEN j IS NOT NULL AND vk IS NULL THEN 0
           WHEN j IS NOT NULL AND vk = 'VARCHAR'
             THEN CAST(upper(json_extract_string(j, '$.verdict')) = 'FRAUD' AS INTEGER)
           WHEN vp <> '' THEN CAST(upper(vp) = 'FRAUD' AS INTEGER)
           WHEN contains(upper(response), 'LEGITIMATE') THEN 0
           WHEN contains(upper(response), 'FRAUD') THEN 1 END AS verdict,
      CASE WHEN j IS NOT NULL AND rk IS NULL THEN CAST(-1 AS BIGINT)
           WHEN rk = 'VARCHAR' AND regexp_full_match(trim(json_extract_string(j, '$.risk_score')), '[+-]?[0-9]+')
             THEN CAST(trim(json_extract_string(j, '$.risk_score')) AS BIGINT)
           WHEN rk IN ('UBIGINT', 'BIGINT', 'DOUBLE')
             THEN CAST(trunc(CAST(json_extract_string(j, '$.risk_score') AS DOUBLE)) AS BIGINT)
           WHEN rp <> '' THEN CAST(rp AS BIGINT) END AS risk_score
    FROM (
      SELECT *, json_type(j, '$.verdict') AS vk, json_type(j, '$.risk_score') AS rk,
        regexp_extract(response, '(?i)"verdict"\\s*:\\s*"(FRAUD|LEGITIMATE)"', 1) AS vp,
        regexp_extract(response, '"risk_score"\\s*:\\s*([1-5])', 1) AS rp
      FROM (SELECT *, CASE WHEN json_type(TRY_CAST(response AS JSON)) = 'OBJECT'
                           THEN TRY_CAST(response AS JSON) END AS j FROM {source}))))"""
