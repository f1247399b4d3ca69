"""Prefix rows of the set joins: every one goes over once, in packs, and those with a partner come out."""

import random
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyguard.llm import setjoin
from tallyguard.llm.textscan import slices

T = 0.75


class Levels:
    value = np.ones(1 << setjoin.BUCKET_BITS, np.uint8)


def lines(n=600):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(80)]
    out = [" ".join(rng.choices(words, k=rng.randint(3, 24))) for _ in range(n)]
    return out + [x + " more" for x in out[:40]] + [None, ""]


def prefix_rows(texts):
    (_, _, raw, at), = slices(pa.array(texts, pa.string()))
    parts = setjoin.line_parts(raw, at, 1)
    sig = setjoin.signatures(parts)
    keep = setjoin.fresh(sig, set())
    return setjoin.prefix_rows(setjoin.chosen(parts, keep), sig[keep], Levels.value, T, 2)


def sent(texts, rounds, buckets, hot=setjoin.HOT_LEVEL):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    cut = partial(setjoin.line_parts, least=1)
    return [list(setjoin._prefixes(iter([batch]), cut, Levels, T, 2, turn, rounds, buckets, hot)) for turn in range(rounds)]


@pytest.mark.parametrize("hot", [setjoin.HOT_LEVEL, 0])
def test_every_prefix_row_is_sent_once(hot):
    expected = prefix_rows(lines())
    kind, found, places = setjoin.prefix_kind(2), [], {}
    for turn, batches in enumerate(sent(lines(), 3, 5, hot)):
        for batch in batches:
            assert batch.num_rows <= 5                         # a row for every bucket, not for every element
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = setjoin.unpacked(data.as_buffer(), kind)
                found.append(rows)
                for key in rows["key"].tolist():
                    places.setdefault(key, set()).add((turn, bucket))
    found = np.concatenate(found)
    assert sorted(map(bytes, found)) == sorted(map(bytes, expected))
    spread = [len(p) for p in places.values()]
    assert max(spread) > 1 if hot == 0 else max(spread) == 1   # only very frequent keys are in several places


def test_a_round_holds_a_share_of_the_rows():
    sizes = [sum(len(x.as_py()) for b in turn for x in b.column(1)) for turn in sent(lines(), 2, 4)]
    assert max(sizes) < 0.75 * sum(sizes)


def partners(rows):
    """(key, sig, pos) of the rows that some other row of their key may match, by trying all pairs."""
    out = set()
    for a in rows:
        for b in rows[rows["key"] == a["key"]]:
            need = -(-T / (1 + T) * (int(a["n"]) + int(b["n"])) // 1)
            apart = int(np.bitwise_count(a["parity"] ^ b["parity"]).sum())
            if (a["sig"] != b["sig"] and min(a["n"], b["n"]) >= T * max(a["n"], b["n"])
                    and min(a["n"] - a["pos"], b["n"] - b["pos"]) >= need
                    and apart <= int(a["n"]) + int(b["n"]) - 2 * need):
                out.add((int(a["key"]), int(a["sig"]), int(a["pos"])))
    return out


@pytest.mark.parametrize("pack_rows", [1, 1 << 19])
def test_rows_with_a_partner_come_out(spark, monkeypatch, pack_rows):
    """In one round and in three; buckets, packs and partitions make no difference."""
    monkeypatch.setattr(setjoin, "PACK_ROWS", pack_rows)
    monkeypatch.setattr(setjoin, "BUCKET_ROWS", 100)
    docs = spark.createDataFrame(list(enumerate(lines())), "doc_id long, text string").repartition(3)
    cut = partial(setjoin.line_parts, least=1)
    scanned = setjoin.scan_parts(docs, cut, distinct=False)
    levels = spark.sparkContext.broadcast(Levels.value)
    shared = setjoin.shared_prefixes(docs, cut, levels, T, scanned, 2, 3)
    found = [(r.key, r.sig, r.pos) for r in shared.select("key", "sig", "pos").distinct().collect()]
    assert len(found) > 40 and set(found) == partners(prefix_rows(lines()))


def test_no_texts(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    cut = partial(setjoin.line_parts, least=1)
    scanned = setjoin.scan_parts(docs, cut, distinct=False)
    levels = spark.sparkContext.broadcast(Levels.value)
    assert setjoin.shared_prefixes(docs, cut, levels, T, scanned, 2, 3).agg(F.count("*")).first()[0] == 0


def test_cleanup_setting_is_put_back(spark):
    before = spark.conf.get(setjoin.CLEANUP)
    with pytest.raises(ValueError), setjoin.shuffles_removed(spark):
        assert spark.conf.get(setjoin.CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(setjoin.CLEANUP) == before
