"""Prompts, answers, chat texts, length audit, response parsing, scoring and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyguard import fixed_values as fv
from tallyguard.catalog.aggregate_queries import sql_tokens
from tallyguard.catalog.registry import (LABELLED, RESPONSES, labelled, query, responses, sql_choice,
                                         sql_draw, sql_parsed, sql_sample, table)
from tallyguard.functions import draws as D
from tallyguard.functions import prompts as P
from tallyguard.functions import responses as R
from tallyguard.functions import tokens as K
from tallyguard.operators import lengths, metrics, scoring, timewise
from tallyguard.operators.ranking import rank_key
from tallyguard.operators.sampling import line_key, stratified_split
from tallyguard.plans.baseline_model import predict, train_baseline, train_newton
from tallyguard.plans.evaluation import parsed_responses, score_examples
from tallyguard.plans.examples import row_to_example
from tallyguard.session import scratch_path
from tallyguard.streaming import jobs, velocity


def quoted(text: str) -> str:
    """SQL text literal."""
    return "'" + text.replace("'", "''") + "'"


# --- feature lines and prompts ----------------------------------------------------------------

MIXED_LINES = """'  - user_id: ' || CAST(user_id AS VARCHAR) || chr(10) || '  - event_type: ' || event_type || chr(10)
  || '  - amount: ' || printf('%.4f', value) || chr(10) || '  - large: ' || CASE WHEN value > 50 THEN 'True' ELSE 'False' END"""


def _mixed(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        "event_id", "user_id", "event_type", F.col("value").alias("amount"),
        (F.col("value") > 50).alias("large"), "label")


FEATURES = ["user_id", "event_type", "amount", "large", "label"]


@query("f4_feature_lines", f"""
SELECT event_id, {MIXED_LINES} AS mixed,
       '  - user_id: ' || printf('%.4f', CAST(user_id AS DOUBLE)) || chr(10) || '  - amount: ' || printf('%.4f', value) AS numeric
FROM {LABELLED}""")
def f4_feature_lines(spark, sf_dir):
    """A row with text keeps whole numbers, an all-numeric row prints them as floats."""
    df = _mixed(spark, sf_dir)
    return df.select("event_id", P.feature_lines(df.select(*FEATURES)).alias("mixed"),
                     P.feature_lines(df.select("user_id", "amount", "label")).alias("numeric"))


def sql_user_prompt(alias: str, lines: str) -> str:
    """SQL text of ``train_user_prompt``."""
    head = f"{fv.TRAIN_USER_OPENING}\n\nDataset Context: {fv.DATASET_CONTEXT.get(alias, fv.DEFAULT_CONTEXT)}\n\nTransaction Features:\n"
    tail = "\n\n" + fv.TRAIN_USER_CLOSING
    return f"{quoted(head)} || {lines} || {quoted(tail)}"


@query("f5_user_prompt", f"""
SELECT event_id, {sql_user_prompt('paysim', MIXED_LINES)} AS known, {sql_user_prompt('other', MIXED_LINES)} AS unknown
FROM {LABELLED}""")
def f5_user_prompt(spark, sf_dir):
    df = _mixed(spark, sf_dir)
    lines = P.feature_lines(df.select(*FEATURES))
    return df.select("event_id", P.train_user_prompt("paysim", lines).alias("known"),
                     P.train_user_prompt("other", lines).alias("unknown"))


SCORED_COLS = ["event_type", "user_id", "value"]
INFER_SQL = f"""{quoted(fv.INFER_USER_OPENING + chr(10) * 2 + 'Context: ')} || 'Card payment' ||
  {quoted(chr(10) * 2 + 'Transaction Features:' + chr(10))} || '  - event_type: ' || event_type || chr(10) ||
  '  - user_id: ' || CAST(user_id AS VARCHAR) || chr(10) || '  - value: ' || CAST(value AS VARCHAR) ||
  {quoted(chr(10) * 2 + fv.INFER_USER_CLOSING)}"""


@query("f6_inference_prompt", f"SELECT event_id, {INFER_SQL} AS prompt FROM events")
def f6_inference_prompt(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", P.inference_prompt(P.feature_pairs(SCORED_COLS), F.lit("Card payment")).alias("prompt"))


# --- answers ----------------------------------------------------------------------------------

INDICATORS_SQL = f"""CASE WHEN label = 1 THEN
    list_concat(CASE WHEN abs(value) > 1.5 THEN [{quoted(fv.HIGH_AMOUNT_INDICATOR)}] ELSE [] END,
                {sql_sample(fv.FRAUD_INDICATORS, 3, 'event_id', 'fraud-indicators')})
  ELSE {sql_sample(fv.LEGIT_INDICATORS, 2, 'event_id', 'legit-indicators')} END"""
KEY_TEXT = "event_id"


@query("f7_risk_indicators", f"""
SELECT event_id, array_to_string({INDICATORS_SQL}, '; ') AS indicators FROM {LABELLED}""")
def f7_risk_indicators(spark, sf_dir):
    df = _mixed(spark, sf_dir)
    return df.select("event_id", F.array_join(P.risk_indicators(
        df.select(*FEATURES), F.col("label") == 1, F.col(KEY_TEXT)), "; ").alias("indicators"))


@query("f8_seeded_choice", f"""
SELECT event_id, {sql_choice(fv.FRAUD_TYPES['ibm_aml'], 'event_id', 'fraud-type')} AS fraud_type,
       {sql_choice(fv.AML_TYPOLOGIES['ibm_aml'], 'event_id', 'typology')} AS typology,
       CASE WHEN {sql_draw('event_id', 'confidence')} / CAST(4294967296 AS DOUBLE) > 0.3 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence
FROM events""")
def f8_seeded_choice(spark, sf_dir):
    k = F.col(KEY_TEXT)
    return table(spark, sf_dir, "events").select(
        "event_id", D.choice(fv.FRAUD_TYPES["ibm_aml"], k, "fraud-type").alias("fraud_type"),
        D.choice(fv.AML_TYPOLOGIES["ibm_aml"], k, "typology").alias("typology"),
        F.when(D.draw_unit(k, "confidence") > P.HIGH_CONFIDENCE_ABOVE, "HIGH").otherwise("MEDIUM").alias("confidence"))


@query("f9_seeded_sample_without_replacement", f"""
SELECT event_id, array_to_string({sql_sample(fv.LEGIT_INDICATORS, 2, 'event_id', 'legit-indicators')}, '; ') AS picked
FROM events""")
def f9_seeded_sample_without_replacement(spark, sf_dir):
    picked = D.sample_without_replacement(fv.LEGIT_INDICATORS, 2, F.col(KEY_TEXT), "legit-indicators")
    return table(spark, sf_dir, "events").select("event_id", F.array_join(picked, "; ").alias("picked"))


_ACTION_CASE = " ".join(f"WHEN {k} THEN {quoted(v)}" for k, v in fv.RECOMMENDED_ACTIONS.items())


def sql_action(score: str) -> str:
    """SQL text of ``recommended_action``."""
    return f"CASE {score} {_ACTION_CASE} ELSE {quoted(fv.DEFAULT_ACTION)} END"


@query("f10_risk_level_and_action", f"""
SELECT event_id, CASE WHEN s >= 4 THEN 'HIGH' WHEN s = 3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       {sql_action('s')} AS action FROM (SELECT event_id, event_id % 5 + 1 AS s FROM events)""")
def f10_risk_level_and_action(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 5 + 1).alias("s"))
    return df.select("event_id", P.risk_level("s").alias("risk_level"), P.recommended_action("s").alias("action"))


def sql_answer(alias: str) -> str:
    """SQL of ``assistant_json`` over the labelled events."""
    score = (f"CASE WHEN label = 1 THEN {sql_choice([4, 5], 'event_id', 'fraud-score')} "
             f"ELSE {sql_choice([1, 2], 'event_id', 'legit-score')} END")
    types = fv.FRAUD_TYPES.get(alias, fv.DEFAULT_FRAUD_TYPES)
    fraud_type = (f"CASE WHEN label = 1 THEN '\"' || {sql_choice(types, 'event_id', 'fraud-type')} || '\"' ELSE 'null' END")
    typology = "'null'"
    if alias in fv.AML_TYPOLOGIES:
        typology = (f"CASE WHEN label = 1 THEN '\"' || "
                    f"{sql_choice(fv.AML_TYPOLOGIES[alias], 'event_id', 'typology')} || '\"' ELSE 'null' END")
    confidence = (f"CASE WHEN {sql_draw('event_id', 'confidence')} / CAST(4294967296 AS DOUBLE) > 0.3 "
                  "THEN 'HIGH' ELSE 'MEDIUM' END")
    nl = "chr(10)"
    items = f"array_to_string(list_transform({INDICATORS_SQL}, lambda v: '    \"' || v || '\"'), ',' || {nl})"
    return f"""(SELECT *, '{{' || {nl} ||
  '  "verdict": "' || CASE WHEN label = 1 THEN 'FRAUD' ELSE 'LEGITIMATE' END || '",' || {nl} ||
  '  "risk_score": ' || CAST(score AS VARCHAR) || ',' || {nl} ||
  '  "risk_level": "' || CASE WHEN score >= 4 THEN 'HIGH' WHEN score = 3 THEN 'MEDIUM' ELSE 'LOW' END || '",' || {nl} ||
  '  "fraud_type": ' || {fraud_type} || ',' || {nl} ||
  '  "aml_typology": ' || {typology} || ',' || {nl} ||
  '  "risk_indicators": [' || {nl} || {items} || {nl} || '  ],' || {nl} ||
  '  "recommended_action": "' || {sql_action('score')} || '",' || {nl} ||
  '  "confidence": "' || {confidence} || '"' || {nl} || '}}' AS answer
FROM (SELECT *, {score} AS score FROM {LABELLED}))"""


@query("f11_assistant_json", f"SELECT event_id, answer FROM {sql_answer('ibm_aml')}")
def f11_assistant_json(spark, sf_dir):
    df = _mixed(spark, sf_dir)
    fields = P.answer_fields(df.select(*FEATURES), "ibm_aml", F.col("label") == 1, F.col(KEY_TEXT))
    return df.select("event_id", P.assistant_json(fields).alias("answer"))


def _examples(spark, sf_dir, alias="paysim"):
    """Examples of the labelled events; the key stays for comparison."""
    df = _mixed(spark, sf_dir).withColumnRenamed("event_id", "_id")
    return row_to_example(df, alias, "train", F.col("_id"))


_USER = sql_user_prompt("paysim", MIXED_LINES)
EXAMPLES_SQL = f"""(SELECT event_id, label, event_type, {quoted(fv.TRAIN_SYSTEM_PROMPT)} AS system, {_USER} AS "user", answer AS assistant
FROM {sql_answer('paysim')})"""


@query("f12_to_chat_messages", f"""
SELECT 3 AS n, 'system,user,assistant' AS roles, md5(system || "user" || assistant) AS contents, label FROM {EXAMPLES_SQL}""")
def f12_to_chat_messages(spark, sf_dir):
    chat = P.to_chat_messages(_examples(spark, sf_dir))
    return chat.select(
        F.size("messages").alias("n"), F.array_join("messages.role", ",").alias("roles"),
        F.md5(F.array_join("messages.content", "")).alias("contents"), "metadata.label")


@query("f13_to_alpaca", f"""
SELECT md5(system || chr(10) || chr(10) || "user") AS instruction, md5(assistant) AS output, 'paysim' AS dataset, label = 1 AS is_fraud
FROM {EXAMPLES_SQL}""")
def f13_to_alpaca(spark, sf_dir):
    out = P.to_alpaca(_examples(spark, sf_dir))
    return out.select(F.md5("instruction").alias("instruction"), F.md5("output").alias("output"),
                      "metadata.dataset", "metadata.is_fraud")


@query("f14_format_switch", f"""
SELECT 'chat' AS format, count(*) AS rows, CAST(sum(length("user")) AS BIGINT) AS length FROM {EXAMPLES_SQL}
UNION ALL SELECT 'alpaca', count(*), CAST(sum(length(system) + 2 + length("user")) AS BIGINT) FROM {EXAMPLES_SQL}""")
def f14_format_switch(spark, sf_dir):
    examples = _examples(spark, sf_dir)
    chat = P.format_switch(examples, "chat").select(
        F.lit("chat").alias("format"), F.length(F.col("messages")[1]["content"]).alias("n"))
    alpaca = P.format_switch(examples, "alpaca").select(
        F.lit("alpaca").alias("format"), F.length("instruction").alias("n"))
    return chat.unionByName(alpaca).groupBy("format").agg(
        F.count("*").alias("rows"), F.sum("n").alias("length"))


# --- chat text --------------------------------------------------------------------------------

def sql_turn(role: str, content: str) -> str:
    """SQL of one rendered turn."""
    return f"{quoted(fv.HEADER_START + role + fv.HEADER_END + chr(10) * 2)} || {content} || {quoted(fv.TURN_END)}"


RENDERED_SQL = (f"""(SELECT *, {sql_turn('system', 'system')} || {sql_turn('user', '"user"')} || """
                f"""{sql_turn('assistant', 'assistant')} AS text FROM {EXAMPLES_SQL})""")
OPEN_TURN = quoted(fv.HEADER_START + "assistant" + fv.HEADER_END + "\n\n")


def _rendered(spark, sf_dir):
    return P.to_chat_messages(_examples(spark, sf_dir)).withColumn("text", P.render_chat("messages"))


@query("f15_render_chat", f"""
SELECT md5(text) AS training_text, md5(text || {OPEN_TURN}) AS open_text FROM {RENDERED_SQL}""")
def f15_render_chat(spark, sf_dir):
    return _rendered(spark, sf_dir).select(
        F.md5("text").alias("training_text"),
        F.md5(P.render_chat("messages", add_generation_prompt=True)).alias("open_text"))


_HEADER = quoted(P.RESPONSE_HEADER)


@query("f16_completion_split", f"""
SELECT md5(substr(text, 1, cut)) AS prompt, md5(substr(text, cut + 1)) AS completion FROM (
  SELECT text, instr(text, {_HEADER}) + length({_HEADER}) - 1 AS cut FROM {RENDERED_SQL})
UNION ALL SELECT md5(''), md5(text) FROM documents""")
def f16_completion_split(spark, sf_dir):
    """Rendered examples, and whole documents, which have no header."""
    texts = _rendered(spark, sf_dir).select("text").unionByName(table(spark, sf_dir, "documents").select("text"))
    parts = texts.select(P.completion_split("text").alias("s"))
    return parts.select(F.md5("s.prompt").alias("prompt"), F.md5("s.completion").alias("completion"))


@query("f17_length_audit", f"""
SELECT count(*) AS rows, count(*) FILTER (t > 2048) AS over_limit, CAST(sum(t) AS BIGINT) AS tokens, max(t) AS longest,
       round(quantile_cont(t, 0.5), 4) AS p50, round(quantile_cont(t, 0.95), 4) AS p95
FROM (SELECT CAST({sql_tokens('text')} AS BIGINT) AS t FROM documents)""")
def f17_length_audit(spark, sf_dir):
    return lengths.length_audit(table(spark, sf_dir, "documents"), "text")


@query("f17_token_length_audit")
def f17_token_length_audit(spark, sf_dir):
    """Lengths of all documents in tokens of the public vocabulary."""
    return lengths.length_audit(table(spark, sf_dir, "documents"), "text", counter=K.token_counter())


@query("f17_token_truncate")
def f17_token_truncate(spark, sf_dir):
    """What a training example of at most 2,048 tokens keeps of every document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length("text").alias("n_chars"), K.token_head("text", lengths.MAX_SEQ_LENGTH).alias("head")).select(
        "doc_id", "n_chars", F.length("head").alias("kept_chars"), F.md5("head").alias("head"))


@query("f16_completion_tokens")
def f16_completion_tokens(spark, sf_dir):
    """Tokens without and with loss in every rendered example."""
    rows = _rendered(spark, sf_dir).select(K.completion_tokens("text", P.RESPONSE_HEADER).alias("n"), "text")
    return rows.select(F.md5("text").alias("training_text"), "n.prompt_ids", "n.completion_ids")


_CLEAN = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


@query("f17_truncate", f"""
SELECT doc_id, array_to_string(string_split({_CLEAN}, ' ')[1:128], ' ') AS head FROM documents""")
def f17_truncate(spark, sf_dir):
    """The truncation operator: cutting is its result, the count before it sees the whole text."""
    return table(spark, sf_dir, "documents").select("doc_id", P.truncate_tokens("text", 128).alias("head"))


@query("f18_first_user_content", """
SELECT conv_id, turn, CASE WHEN role = 'user' THEN text ELSE '' END AS user_text FROM conversations""")
def f18_first_user_content(spark, sf_dir):
    messages = F.array(P.message("system", F.lit("s")), F.struct("role", F.col("text").alias("content")),
                       F.struct("role", F.lit("later").alias("content")))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", P.first_user_content(messages).alias("user_text"))


@query("f19_metadata_or_default", """
SELECT doc_id, coalesce(CAST(toxic = 1 AS INTEGER), 0) AS is_fraud, CASE WHEN toxic IS NULL THEN 'unknown' ELSE lang END AS dataset
FROM documents LEFT JOIN labels USING (doc_id)""")
def f19_metadata_or_default(spark, sf_dir):
    df = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    meta = F.when(F.col("toxic").isNotNull(), P.example_metadata(F.col("lang"), "test", "toxic"))
    out = df.select("doc_id", P.metadata_or_default(meta).alias("m"))
    return out.select("doc_id", "m.is_fraud", "m.dataset")


# --- responses --------------------------------------------------------------------------------

@query("f20_parse_verdict", f"SELECT event_id, verdict FROM {sql_parsed(RESPONSES)}")
def f20_parse_verdict(spark, sf_dir):
    return responses(spark, sf_dir).select("event_id", R.parse_verdict("response").alias("verdict"))


@query("f21_parse_risk_score", f"SELECT event_id, risk_score FROM {sql_parsed(RESPONSES)}")
def f21_parse_risk_score(spark, sf_dir):
    return responses(spark, sf_dir).select("event_id", R.parse_risk_score("response").alias("risk_score"))


@query("f22_score_normalize", f"SELECT event_id, y_score FROM {sql_parsed(RESPONSES)}")
def f22_score_normalize(spark, sf_dir):
    return parsed_responses(responses(spark, sf_dir)).select("event_id", "y_score")


@query("f23_prediction_default", f"""
SELECT event_id, y_pred, CAST(verdict IS NULL AS INTEGER) AS unparsed FROM {sql_parsed(RESPONSES)}""")
def f23_prediction_default(spark, sf_dir):
    return parsed_responses(responses(spark, sf_dir)).select("event_id", "y_pred", "unparsed")


@query("f24_parse_response_or_error", f"""
SELECT event_id, coalesce(json_extract_string(j, '$.verdict'), 'PARSE_ERROR') AS verdict,
       CAST(json_extract_string(j, '$.risk_score') AS INTEGER) AS risk_score,
       CASE WHEN j IS NULL THEN response END AS raw_response,
       CASE WHEN j IS NULL THEN {quoted(fv.PARSE_ERROR_NOTE)} END AS note, j IS NULL AS parse_error
FROM (SELECT *, TRY_CAST(response AS JSON) AS j FROM {RESPONSES})""")
def f24_parse_response_or_error(spark, sf_dir):
    df = responses(spark, sf_dir).select("event_id", R.parse_response_or_error("response").alias("r"))
    return df.select("event_id", "r.verdict", "r.risk_score", "r.raw_response", "r.note", "r.parse_error")


# --- scoring ----------------------------------------------------------------------------------

RULE = scoring.rule_scorer()
SCORED_SQL = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y_pred,
       CAST(event_type = 'error' AS DOUBLE) AS y_score FROM events"""


@query("m1_score_batch", SCORED_SQL)
def m1_score_batch(spark, sf_dir):
    """A rule as the pluggable scorer, over the scoring prompts of all events."""
    scored = jobs.stream_score(table(spark, sf_dir, "events"), SCORED_COLS, RULE)
    return scored.select("event_id", "y_pred", "y_score")


@query("m1_score_examples", f"""
SELECT label AS y_true, CAST(event_type = 'error' AS INTEGER) AS y_pred, count(*) AS rows
FROM {LABELLED} GROUP BY 1, 2""")
def m1_score_examples(spark, sf_dir):
    """All chat examples through scorer and parser."""
    df = _mixed(spark, sf_dir).withColumnRenamed("event_id", "_id")
    examples = row_to_example(df, "paysim", "test", F.col("_id"))
    chat = P.to_chat_messages(examples, "_key")
    scored = score_examples(chat, RULE)
    return scored.groupBy("y_true", "y_pred").agg(F.count("*").alias("rows"))


@query("m3_train_baseline")
def m3_train_baseline(spark, sf_dir):
    """Weighted logistic regression on the training split, metrics on the test split."""
    df = timewise.time_features(labelled(spark, sf_dir), "ts").withColumn(
        "is_error", (F.col("event_type") == "error").cast("int"))
    rows = stratified_split(df, rank_key("event_id"))
    features = ["value", "is_error", "hour_of_day", "day_of_week"]
    model = train_baseline(rows.where("split = 'train'"), features)
    scored = predict(model, rows.where("split = 'test'")).withColumn("dataset", F.lit("events"))
    m = metrics.score_metrics(metrics.confusion_matrix(metrics.score_cells(scored)))
    return m.select("tn", "fp", "fn", "tp", *[F.round(c, 4).alias(c) for c in ("f1", "precision", "recall", "mcc")])


def _newton_step(b0: str, b1: str, b2: str) -> str:
    """SQL of one Newton step of three weights, by the rule of determinants."""
    a = [["a00", "a01", "a02"], ["a01", "a11", "a12"], ["a02", "a12", "a22"]]

    def det(m):
        return (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - "
                f"{m[1][2]} * {m[2][0]}) + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")

    swapped = [[[f"g{i}" if j == k else a[i][j] for j in range(3)] for i in range(3)] for k in range(3)]
    return ", ".join(f"{b} - {det(m)} / {det(a)}" for b, m in zip((b0, b1, b2), swapped))


NEWTON_SQL = f"""
WITH RECURSIVE e AS (SELECT label AS y, value / 100 AS x1, CAST(event_type = 'error' AS DOUBLE) AS x2 FROM {LABELLED}),
e2 AS (SELECT *, (SELECT count(*) FROM e) / (2.0::DOUBLE * (SELECT count(*) FROM e o WHERE o.y = e.y)) AS w FROM e),
t AS (SELECT 0 AS i, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 UNION ALL
  SELECT i + 1, {_newton_step('b0', 'b1', 'b2')} FROM (
    SELECT i, b0, b1, b2, sum(d) AS g0, sum(d * x1) + b1 AS g1, sum(d * x2) + b2 AS g2, sum(h) AS a00, sum(h * x1) AS a01,
      sum(h * x2) AS a02, sum(h * x1 * x1) + 1 AS a11, sum(h * x1 * x2) AS a12, sum(h * x2 * x2) + 1 AS a22
    FROM (SELECT *, w * (p - y) AS d, w * p * (1 - p) AS h FROM (
      SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM t, e2 WHERE i < 20))
    GROUP BY i, b0, b1, b2))
SELECT unnest(['intercept', 'value', 'is_error']) AS term, round(unnest([b0, b1, b2]), 6) AS weight FROM t WHERE i = 20"""


@query("m3_newton_baseline", NEWTON_SQL)
def m3_newton_baseline(spark, sf_dir):
    """Weights of the regression on two features, from all events."""
    df = labelled(spark, sf_dir).select("label", (F.col("value") / 100).alias("value"),
                                        (F.col("event_type") == "error").cast("int").alias("is_error"))
    model = train_newton(df, ["value", "is_error"])
    return spark.createDataFrame([("intercept", model.intercept), *zip(model.features, model.weights)],
                                 "term string, weight double").select("term", F.round("weight", 6).alias("weight"))


@query("m4_synthetic_transactions", f"""
SELECT event_id AS key,
  round(sqrt(-2 * ln((a1 + 1) / 4294967296.0::DOUBLE)) * cos(2 * pi() * (b1 / 4294967296.0::DOUBLE)), 3) + 0.0::DOUBLE AS amount_scaled,
  round(sqrt(-2 * ln((a2 + 1) / 4294967296.0::DOUBLE)) * cos(2 * pi() * (b2 / 4294967296.0::DOUBLE)), 3) + 0.0::DOUBLE AS balance_diff_orig,
  round(abs(sqrt(-2 * ln((a3 + 1) / 4294967296.0::DOUBLE)) * cos(2 * pi() * (b3 / 4294967296.0::DOUBLE)) * 0.5::DOUBLE), 3) AS amount_to_balance_ratio,
  CAST(t % 2 AS INTEGER) AS type_TRANSFER, CAST(s % 743 + 1 AS INTEGER) AS step, CAST(c % 50 + 1 AS INTEGER) AS txn_count_24h
FROM (SELECT event_id, {sql_draw('event_id', 'amount-a')} AS a1, {sql_draw('event_id', 'amount-b')} AS b1,
             {sql_draw('event_id', 'balance-a')} AS a2, {sql_draw('event_id', 'balance-b')} AS b2,
             {sql_draw('event_id', 'ratio-a')} AS a3, {sql_draw('event_id', 'ratio-b')} AS b3,
             {sql_draw('event_id', 'transfer')} AS t, {sql_draw('event_id', 'step')} AS s, {sql_draw('event_id', 'count')} AS c FROM events)""")
def m4_synthetic_transactions(spark, sf_dir):
    """One drawn transaction per event."""
    return scoring.synthetic_transactions(table(spark, sf_dir, "events"), "event_id")


@query("m5_batched_map", f"SELECT md5(text) AS text_md5, length(text) AS n FROM {RENDERED_SQL}")
def m5_batched_map(spark, sf_dir):
    """A pandas function over batches: rendered text in, its length out, other columns removed."""
    def measure(batch):
        return batch.assign(n=batch["text"].str.len())[["text", "n"]]
    out = scoring.batched_map(_rendered(spark, sf_dir).select("text"), measure, "text string, n bigint")
    return out.select(F.md5("text").alias("text_md5"), "n")


@query("m6_grouped_transform", """
SELECT event_id, count(*) OVER (PARTITION BY user_id) AS user_rows,
       max(value) OVER (PARTITION BY user_id) AS user_max FROM events""")
def m6_grouped_transform(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    out = timewise.grouped_transform(df, "user_id", {"user_rows": F.count("*"), "user_max": F.max("value")})
    return out.select("event_id", "user_rows", "user_max")


@query("m7_row_to_example", f"""
SELECT system, "user", assistant, 'paysim' AS dataset, 'train' AS split, label, label = 1 AS is_fraud FROM {EXAMPLES_SQL}""")
def m7_row_to_example(spark, sf_dir):
    return _examples(spark, sf_dir).select(
        "system", "user", "assistant", "metadata.dataset", "metadata.split", "metadata.label", "metadata.is_fraud")


# --- streaming --------------------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir))


@query("st1_stream_score", SCORED_SQL)
def st1_stream_score(spark, sf_dir):
    """The scoring job on a file stream; the sink is read back."""
    out = scratch_path(spark, "stream-scored")
    scored = jobs.stream_score(_event_stream(spark, sf_dir), SCORED_COLS, RULE).select("event_id", "y_pred", "y_score")
    jobs.run_available(scored, out, scratch_path(spark, "stream-state"))
    return spark.read.schema(scored.schema).parquet(out)


@query("st2_stream_velocity", """
WITH w AS (
  SELECT user_id, date_trunc('hour', ts) - INTERVAL 1 HOUR * (i - 1) AS start_at
  FROM events, (SELECT unnest(range(1, 25)) AS i)),
c AS (SELECT user_id, start_at, count(*) AS txn_count FROM w GROUP BY 1, 2)
SELECT strftime(start_at, '%Y-%m-%d %H:%M') AS window_start, user_id, txn_count FROM c
WHERE start_at + INTERVAL 24 HOURS <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def st2_stream_velocity(spark, sf_dir):
    """Closed 24-hour windows, sliding by the hour, from a file stream; the sink is read back."""
    out = scratch_path(spark, "stream-velocity")
    counts = jobs.stream_velocity(_event_stream(spark, sf_dir), "user_id", "ts")
    jobs.run_available(counts, out, scratch_path(spark, "stream-state"))
    back = spark.read.schema(counts.schema).parquet(out)
    return back.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "user_id", "txn_count")


@query("st2_stream_txn_counts", """
SELECT event_id, txn_count, txn_count_24h FROM (
  SELECT event_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts, md5('42|' || CAST(event_id AS VARCHAR))
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS txn_count,
    count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS txn_count_24h
  FROM events) WHERE date_trunc('milliseconds', ts) <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 1 HOUR""")
def st2_stream_txn_counts(spark, sf_dir):
    """Both counts of every event that is final an hour behind the last one; the sink is read back."""
    out = scratch_path(spark, "stream-counts")
    counts = velocity.stream_txn_counts(_event_stream(spark, sf_dir), "user_id", "ts", "event_id", rank_key("event_id"))
    with velocity.rocksdb_state(spark):
        jobs.run_available(counts, out, scratch_path(spark, "stream-state"))
    back = spark.read.schema(counts.schema).parquet(out)
    return back.select(F.col("id").cast("bigint").alias("event_id"), "txn_count", "txn_count_24h")
