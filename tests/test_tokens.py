"""Token counts, ids and cuts against the tokenizer library, and JSON texts against the json module."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyguard.functions import prompts as P
from tallyguard.functions import tokens as K
from tallyguard.operators import lengths


def texts():
    rng = random.Random(4)
    out = [None, "", " ", "a", "don't we'll  go\n\n\tnow ", "<|endoftext|> is text", "中文字 한국어", "😀😀", "\x00\x01", "x" * 3000,
           " " * 2000, "1234567890" * 300, "word " * 3000, "é" * 999, "a  \n b", "it's'", "'s 's", " ", "a​b"]
    return out + ["".join(rng.choice("ab  'stre\n.,éü12 -中😀") for _ in range(rng.randint(0, 1500))) for _ in range(60)]


def library(values):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(K.default_vocabulary())
    own.encode_special_tokens = True
    return own, [own.encode(v or "", add_special_tokens=False).ids for v in values]


@pytest.mark.parametrize("window", [K.WINDOW, 7])
def test_ids_are_the_library_s(window, monkeypatch):
    monkeypatch.setattr(K, "WINDOW", window)
    own = K.Encoder(K.default_vocabulary())
    values = texts()
    _, want = library(values)
    assert [own.ids(v) for v in values] == want
    assert [own.count(v) for v in values] == [len(w) for w in want]
    for value, ids in zip(values, want):
        for limit in (0, 1, 5, 64):
            head = own.head(value, limit)
            raw = (value or "").encode()
            assert (value or "").startswith(head)
            size = own.bytes_of(ids[:limit])
            assert head == raw[:size].decode("utf-8", "ignore") and own.ids(value, limit) == ids[:limit]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(K, "MOST_KNOWN", 3)
    own = K.Encoder(K.default_vocabulary())
    values = texts()[-20:]
    assert [own.ids(v) for v in values] == library(values)[1] and len(own) <= 3


def test_columns(spark):
    values = texts()
    _, want = library(values)
    df = spark.createDataFrame(list(enumerate(values)), "i int, text string").repartition(4)
    rows = df.select("i", K.token_counter()("text").alias("n"), K.token_ids("text", limit=9).alias("ids"),
                     K.token_head("text", 12).alias("head")).collect()
    assert all(r.n == len(want[r.i]) and r.ids == want[r.i][:9] for r in rows)
    assert all((r.head is None) == (values[r.i] is None) for r in rows)
    audit = lengths.length_audit(df, "text", limit=500, counter=K.token_counter()).first()
    sizes = sorted(map(len, want))
    assert (audit.rows, audit.over_limit, audit.tokens, audit.longest) == (
        len(values), sum(n > 500 for n in sizes), sum(sizes), sizes[-1])
    summary = lengths.throughput_summary(df, "text", "text", 2.0, counter=K.token_counter()).first()
    assert summary.output_tokens == sum(sizes) and summary.output_tokens_per_sec == sum(sizes) / 2


def test_completion_parts(spark):
    header = P.RESPONSE_HEADER
    values = [f"ask{header}\n\nanswer one", f"{header}\n\na{header}\n\nb", "no header at all", "", None]
    df = spark.createDataFrame(list(enumerate(values)), "i int, text string")
    rows = sorted(df.select("i", K.completion_tokens("text", header).alias("n")).collect())
    _, whole = library(values)
    assert all(r.n.prompt_ids + r.n.completion_ids == len(w) for r, w in zip(rows, whole))
    assert [r.n.prompt_ids > 0 for r in rows] == [True, True, False, False, False]


def test_json_texts(spark):
    every = "".join(map(chr, range(0, 128))) + 'é"\\中😀'
    items = ["plain", 'a "quoted" \\ one\n', every, "", "tab\there", "\x01"]
    df = spark.createDataFrame([(v, items[:k + 1]) for k, v in enumerate(items)] + [(None, ["x"])], "t string, l array<string>")
    for r in df.select("*", P.json_text(F.col("t")).alias("j"), P.json_list(F.col("l")).alias("k")).collect():
        assert json.loads(r.j) == r.t and json.loads(r.k) == r.l
