"""Raw CSV files through recipes, examples, scoring and evaluation."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyguard.fixed_values import EXPECTED_FILES
from tallyguard.operators.sampling import line_key
from tallyguard.operators.scoring import rule_scorer
from tallyguard.plans import examples, recipes
from tallyguard.plans.evaluation import evaluate, score_examples
from tallyguard.sources import files, registry, sinks
from tallyguard.sources.schemas import ALPACA

ROWS = 400


def write_csv(path, header, rows):
    lines = ([",".join(header)] if header else []) + [",".join("" if v is None else str(v) for v in r) for r in rows]
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    """Small raw files of ibm_aml, banksim and ieee_cis; the other data sets are absent."""
    rnd = random.Random(1)
    d = tmp_path_factory.mktemp("raw")
    fraud = [1 if i % 25 == 0 else 0 for i in range(ROWS)]
    write_csv(d / EXPECTED_FILES["ibm_aml"][0],
              ["Timestamp", "From Bank", "Account", "To Bank", "Account", "Amount Received", "Receiving Currency",
               "Amount Paid", "Payment Currency", "Payment Format", "Is Laundering"],
              [["bad" if i % 50 in (0, 3) else f"2022/09/0{1 + i % 9} 0{i % 10}:15", 1, f"A{i % 12}", 2, f"B{i % 30}",
                10 + i, "Euro", round(rnd.uniform(1, 900), 2), rnd.choice(["Euro", "Yen"]), "Wire", fraud[i]]
               for i in range(ROWS)])
    write_csv(d / EXPECTED_FILES["banksim"][0],
              ["step", "customer", "age", "gender", "zipcodeOri", "merchant", "zipMerchant", "category", "amount", "fraud"],
              [[i, f"'C{i % 40}'", f"'{'U123456O'[i % 8]}'", f"'{'MFE'[i % 3]}'", "'28007'", f"'M{i % 5}'", "'28007'",
                f"'es_{i % 4}'", round(rnd.uniform(1, 300), 2), fraud[i]] for i in range(ROWS)])
    write_csv(d / EXPECTED_FILES["ieee_cis"][0],
              ["TransactionID", "isFraud", "TransactionAmt", "card4", "C1", "sparse"],
              [[1000 + i, fraud[i], round(rnd.uniform(1, 99), 2), "NA" if i % 7 == 0 else f"v{i % 3}",
                "N/A" if i % 6 == 0 else i, 5 if i % 4 == 0 else None] for i in range(ROWS)])
    return str(d)


@pytest.fixture(scope="module")
def processed(spark, raw_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("processed"))
    return out, recipes.preprocess_all(spark, raw_dir, out)


def test_only_present_datasets_are_processed(processed):
    assert sorted(processed[1]) == ["banksim", "ibm_aml", "ieee_cis"]


def test_split_and_balance(processed):
    for counts in processed[1].values():
        assert (counts["test_rows"], counts["test_fraud"]) == (40, 2)
        assert (counts["val_rows"], counts["val_fraud"]) == (40, 2)
        assert counts["train_fraud"] == 30                           # a tenth of 308 legit rows
        assert counts["train_rows"] == 30 + 60


def test_processed_columns(spark, processed):
    aml = files.parquet_scan(spark, processed[0], "ibm_aml", "test")
    assert {"account", "account.1", "hour_of_day", "txn_count_24h", "amount_paid", "label"} <= set(aml.columns)
    assert "timestamp" not in aml.columns
    whole = files.parquet_scan(spark, processed[0], "ibm_aml")
    assert whole.where("hour_of_day = -1").count() > 0 and whole.where("hour_of_day >= 0").count() > 120
    assert whole.where("hour_of_day is null or txn_count_24h is null").count() == 0
    assert whole.agg(F.max("txn_count_24h")).first()[0] > 10
    ieee = files.parquet_scan(spark, processed[0], "ieee_cis")
    assert set(ieee.columns) == {"TransactionAmt", "card4", "C1", "label", "split"}
    assert ieee.where("card4 is null or C1 is null").count() == 0


@pytest.mark.parametrize("output_format", ["chat", "alpaca"])
def test_examples_and_evaluation(spark, processed, tmp_path, output_format):
    out = str(tmp_path)
    examples.build_and_save(spark, processed[0], out, output_format, max_rows=50)
    if output_format == "alpaca":
        rows = files.jsonl_scan(spark, f"{out}/test.jsonl", ALPACA).collect()
        assert len(rows) == 120 and all(r["instruction"].startswith("You are a financial") for r in rows)
        return
    chat = files.jsonl_scan(spark, f"{out}/train.jsonl")
    per_set = {r["dataset"]: (r["n"], r["f"]) for r in chat.groupBy("metadata.dataset").agg(
        F.count("*").alias("n"), F.sum("metadata.label").alias("f")).collect()}
    assert per_set == {a: (50, 16) for a in ("banksim", "ibm_aml", "ieee_cis")}
    for r in chat.collect():
        answer = json.loads(r["messages"][2]["content"])
        assert list(answer) == ["verdict", "risk_score", "risk_level", "fraud_type", "aml_typology",
                                "risk_indicators", "recommended_action", "confidence"]
        assert json.dumps(answer, indent=2) == r["messages"][2]["content"]
        n = len(answer["risk_indicators"])
        assert len(set(answer["risk_indicators"])) == n
        if r["metadata"]["label"] == 1:
            assert 3 <= n <= 5 and answer["risk_score"] in (4, 5) and answer["verdict"] == "FRAUD"
            assert (answer["aml_typology"] is not None) == (r["metadata"]["dataset"] == "ibm_aml")
        else:
            assert n == 2 and answer["risk_score"] in (1, 2) and answer["fraud_type"] is None
    test = files.jsonl_scan(spark, f"{out}/test.jsonl").withColumn("line", F.lit(0))
    scored = score_examples(test.drop("line"), rule_scorer("Dataset Context"), None)
    result = evaluate(scored)
    m = result.metrics.first()
    assert (m["tp"], m["fn"], m["fp"], m["tn"]) == (6, 0, 114, 0)
    assert m["recall"] == 1.0 and m["mcc"] == 0.0 and m["auroc"] == 0.5
    path = sinks.write_metrics_json(result.metrics, out, "x_")
    assert spark.read.json(path).first()["confusion_matrix"] == [[0, 114], [0, 6]]


def test_answers_do_not_depend_on_files(spark, processed, tmp_path):
    """The same rows written in other files and partitions give the same examples, copies included."""
    rows = files.parquet_scan(spark, processed[0], "banksim").drop("dataset")
    twice = rows.union(rows.where("label = 1"))
    for name, parts in (("one", 1), ("many", 7)):
        sinks.save_splits(twice.repartition(parts), str(tmp_path / name), "banksim")
    first, second = (sorted(tuple(r) for r in examples.build_examples(spark, str(tmp_path / n), "banksim", "train").select(
        "user", "assistant", "_key").collect()) for n in ("one", "many"))
    assert first == second and len({r[2] for r in first}) == len(first)


def test_head_cap_needs_an_order(spark):
    with pytest.raises(ValueError, match="line"):
        score_examples(spark.range(1), rule_scorer("x"), 5)


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="output_format"):
        examples.build_and_save(spark, str(tmp_path), str(tmp_path), "xml")


def test_line_key_sorts_like_numbers(spark):
    keys = [r[0] for r in spark.range(0, 5_000, 37).select(line_key("id")).collect()]
    assert keys == sorted(keys)


def test_manifest_audit(spark, raw_dir):
    audit = {r["alias"]: (r["found"], r["missing"]) for r in files.manifest_audit(spark, raw_dir).collect()}
    assert audit["ccf"] == ([], ["creditcard.csv"])
    assert audit["ieee_cis"] == (["train_transaction.csv (0.0 MB)"], ["train_identity.csv"])
    assert len(audit["elliptic"][1]) == 3


def test_registry(spark, tmp_path):
    table = registry.registry_table(spark)
    assert table.count() == 6 and len(table.columns) == 12
    registry.export_registry_json(spark, str(tmp_path / "r"))
    records = json.loads(spark.read.text(str(tmp_path / "r")).first()["value"])
    assert [r["alias"] for r in records] == ["ccf", "ieee_cis", "paysim", "ibm_aml", "elliptic", "banksim"]
    assert list(records[0]) == ["alias", "name", "label_column", "source_url", "fraud_ratio"]
    assert ", " in registry.registry_summary(spark).first()["use_case"]
