"""Response parsing: fifteen listed cases and some awkward ones."""

import pytest
from pyspark.sql import functions as F

from tallyguard.functions import responses as R
from tallyguard.plans.evaluation import parsed_responses

CASES = [
    ('{"verdict":"FRAUD","risk_score":5}', 1, 5, 1.0),
    ('{"verdict":"legitimate","risk_score":1}', 0, 1, 0.0),
    ('{"verdict":"fraud","risk_score":"4"}', 1, 4, 0.75),
    ('{"risk_score":3}', 0, 3, 0.5),
    ('{"verdict":"FRAUD"}', 1, -1, -0.5),
    ('{"verdict":"FRAUD","risk_score":4.7}', 1, 4, 0.75),
    ('{"verdict":"FRAUD","risk_score":"4.5"}', 1, None, 0.25),
    ('{"verdict":"FRAUD","risk_score":0}', 1, 0, 0.25),
    ('{"verdict":"SUSPICIOUS","risk_score":9}', 0, 9, 2.0),
    ('Sure: {"verdict" : "Fraud", "risk_score": 4', 1, 4, 0.75),
    ('{"verdict":"LEGITIMATE","risk_score":2} FRAUD', 0, 2, 0.25),
    ("this looks like fraud", 1, None, 0.25),
    ("not fraud, legitimate", 0, None, 0.25),
    ("", None, None, 0.25),
    ("[1]", None, None, 0.25),
    ('{"verdict":null}', None, -1, -0.5),
    # text after the object makes it no JSON, so the pattern for 1-5 decides
    ('{"verdict":"FRAUD","risk_score":9} ]', 1, None, 0.25),
    ('{"verdict":"FRAUD","risk_score":9}] }', 1, None, 0.25),
    ('{"verdict":"FRAUD","risk_score":9}, {"a":1}', 1, None, 0.25),
    (' {"verdict":"FRAUD","risk_score":4}\n', 1, 4, 0.75),
    ('{"verdict":"FRAUD","risk_score":true}', 1, 1, 0.0),
    ('{"verdict":"FRAUD","risk_score":null}', 1, None, 0.25),
    ('{"verdict":"FRAUD","risk_score":[4]}', 1, None, 0.25),
    ('{"verdict":5}', None, -1, -0.5),
    ("null", None, None, 0.25),
    ("3", None, None, 0.25),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, response string")
    single = df.withColumns({"v": R.parse_verdict("response"), "r": R.parse_risk_score("response")})
    return {row["i"]: row for row in parsed_responses(single).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(parsed, i):
    text, verdict, risk, score = CASES[i]
    row = parsed[i]
    assert (row["v"], row["r"]) == (verdict, risk), text
    assert (row["verdict"], row["risk_score"]) == (verdict, risk), text
    assert row["y_score"] == score, text
    assert row["y_pred"] == (verdict or 0)


def test_response_or_error(spark):
    df = spark.createDataFrame(
        [('{"verdict":"FRAUD","risk_score":"4","risk_indicators":["a","b"]}',), ("broken {",)], "t string")
    good, bad = [r["p"] for r in df.select(R.parse_response_or_error("t").alias("p")).collect()]
    assert (good["verdict"], good["risk_score"], good["risk_indicators"]) == ("FRAUD", 4, ["a", "b"])
    assert good["raw_response"] is None and not good["parse_error"]
    assert (bad["verdict"], bad["raw_response"], bad["parse_error"]) == ("PARSE_ERROR", "broken {", True)


def test_null_text(spark):
    df = spark.createDataFrame([(None,)], "t string")
    row = df.select(R.parse_verdict("t").alias("v"), R.parse_risk_score("t").alias("r"),
                    R.prediction_default(R.parse_verdict("t")).alias("p")).first()
    assert (row["v"], row["r"], row["p"]) == (None, None, 0)


def test_score_normalize(spark):
    out = spark.range(0, 6).select(R.score_normalize(F.col("id")).alias("s")).collect()
    assert [r["s"] for r in out] == [0.25, 0.0, 0.25, 0.5, 0.75, 1.0]
