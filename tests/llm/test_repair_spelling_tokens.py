"""Conversation repair, spelling variants and token counts against brute force and the tokenizer itself."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyguard.llm import repair, spelling, token_counts

# --- conversation repair ------------------------------------------------------------------------

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else
                   "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by trying every edit at every place, layer by layer."""
    layer = {"": (0, "", ())}

    def offer(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value

    def inserted(values):
        for _ in range(3):
            for state, (c, a, r) in list(values.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if (state, initial) in NEXT:
                        offer(values, NEXT[state, initial], (c + 3, a + "I", (*r, f"{role}:")))
        return values

    for (role, text), fault in zip(rows, faults(rows)):
        after = {}
        for state, (c, a, r) in inserted(layer).items():
            offer(after, state, (c + 4, a + "D", r))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                for letter, cost, name in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                    if (state, name[:1]) in NEXT:
                        offer(after, NEXT[state, name[:1]], (c + cost + more, a + letter, (*r, f"{name}:{text}")))
        layer = after
    return min(inserted(layer)[s] for s in ("", "a") if s in layer)


def conversation(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "ursa"]
    texts = ["Yes.", "No!", "cut", " ", "", "Well?", "x. \n", "é."]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < .5 else f"t{i}.") for i in range(n)]


def repaired_of(spark, conversations):
    rows = [(c, t, role, text, False) for c, turns in enumerate(conversations) for t, (role, text) in enumerate(turns)]
    rows += [(c, None, "x", "x", True) for c in range(len(conversations))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, dropped boolean").repartition(5)
    return {r.conv_id: r for r in repair.repair(df).collect()}


@pytest.mark.parametrize("block", [256, 3])
def test_repair_against_all_edits(spark, block, monkeypatch):
    rng = random.Random(block)
    conversations = [conversation(rng, rng.randint(0, 9)) for _ in range(120)]
    if block == 3:
        monkeypatch.setattr(repair, "BLOCK", 3)
        found = {}
        for i, rows in enumerate(conversations):
            whole = repair._Conversation()
            for turn, ((role, text), fault) in enumerate(zip(rows, faults(rows))):
                whole.add(turn, role, text, fault)
            found[i] = dict(zip(repair.COLUMNS, whole.result()))
    else:
        found = {i: r.asDict() for i, r in repaired_of(spark, conversations).items()}
    for i, rows in enumerate(conversations):
        cost, audit, kept = cheapest(rows)
        own = found[i]
        assert (own["cost"], own["audit"]) == (cost, audit)
        assert own["repaired_sha256"] == hashlib.sha256("\n".join(kept).encode()).hexdigest()
        kinds = Counter(faults(rows))
        assert [own[k] for k in ("blank", "duplicate", "truncated")] == [kinds[k] for k in ("blank", "duplicate", "truncated")]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
        assert own["illegal"] == sum(p not in ("su", "ua", "au") for p in pairs) and own["gaps"] == 0


def test_repair_of_long_conversations(spark):
    rng = random.Random(1)
    conversations = [conversation(rng, 1500), [("user", "same.")] * 2000, [("assistant", f"{i}.") for i in range(700)]]
    found = repaired_of(spark, conversations)
    for i, rows in enumerate(conversations):
        cost, audit, kept = cheapest(rows)
        assert (found[i].cost, found[i].audit) == (cost, audit)
        assert found[i].repaired_sha256 == hashlib.sha256("\n".join(kept).encode()).hexdigest()


def test_repair_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, "user", "a."), (1, 3, "user", "a."), (1, 3, "user", "a."), (1, 7, "", "b."),
            (None, 1, "user", "c"), (None, 2, "assistant", "d. "), (2, None, "user", "."), (3, 5, "system", "s."),
            (4, 1, "user", "z." * 50_000), (4, 2, "assistant", "\t\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("fault", "dropped", "kind", "copy", "cost"):
        df = df.withColumn(name, F.lit(1))
    got = repair.repair(repair.damaged(df)).orderBy("conv_id").collect()
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    order = ", ".join(got[0].__fields__)
    assert [tuple(r) for r in got] == con.execute(f"SELECT {order} FROM ({repair.ORACLE}) ORDER BY conv_id NULLS FIRST").fetchall()
    assert repair.repair(repair.damaged(df.where("conv_id < 0"))).collect() == []


def test_ranks_sort_like_audits():
    audits = {0: "DD", 1: "KDI", 2: "KD", 3: "KDII"}
    short = repair.ranks(audits)
    for x in ("", "D", "I", "K", "RI"):
        for y in ("", "D", "I", "K", "RI"):
            for a in audits:
                for b in audits:
                    assert (audits[a] + x < audits[b] + y) == (short[a] + x < short[b] + y)


# --- spelling variants --------------------------------------------------------------------------

LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def variants(docs, slip):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 5}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]

    out = {}
    for w, n in words.items():
        around = [v for v in words if near(w, v)]
        best = min(around, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 5 * n else None
        out[w] = [form, n, len(around), words[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row.append(root)
    return {w: tuple(r) for w, r in out.items()}


def found_variants(df, **options):
    return {r.word: (r.form, r.n, r.n_near, r.form_n, r.root) for r in spelling.spelling_variants(df, **options).collect()}


@pytest.mark.parametrize("slip", [None, 2, 7])
def test_variants_against_all_pairs(spark, slip):
    rng = random.Random(5)
    base = ["colour", "abcdefgh", "éàüßöçñ", "aaaaaaa", "x" * 40, "straße" * 9, "ab" * 70]
    words = []
    for w in base:
        words += [w] * 60
        for k in range(6):
            i = rng.randrange(len(w))
            words += [w[:i] + w[i + 1:]] * (5 + k) + [w[:i] + "q" + w[i + 1:]] * 11 + [w[:i] + "é" + w[i:]] * 5
    words += ["a" * n for n in range(5, 15) for _ in range(6 ** (n % 4))]
    rng.shuffle(words)
    docs = [(i, " ".join(w.upper() if rng.random() < .3 and w.isascii() else w for w in words[i::50])) for i in range(50)]
    docs += [(None, "COLOUR colour-abcdefgh1abcdefgh"), (None, None), (99, ""), docs[0], docs[0]]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for name in ("word", "run", "h", "n", "id", "side"):
        df = df.withColumn(name, F.lit("x"))
    assert found_variants(df, slip=slip) == variants(docs, slip)


def test_variants_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "short"), (3, "single words")], "doc_id long, text string")
    assert found_variants(df) == {} and found_variants(df.where("doc_id < 0")) == {}


# --- token counts -------------------------------------------------------------------------------

def odd_texts():
    rng = random.Random(3)
    texts = [None, "", " ", "  ", "a", " a", "a  b", "<s> x </s>", "<0x0A>", "中文字", "\x00a", "😀😀x", "a▁b", "\n\n\t", "﻿x",
             "\r\n", "word " * 900, "é" * 5000, "=" * 4000, " " * 3000, "aab" * 2000, "한국어 텍스트" * 300, "0123456789" * 300]
    pieces = list(token_counts.transducer(None).words.score)
    texts += ["".join(rng.choice("ab e  thinr\n.,éü=-_▁中͸") for _ in range(rng.randint(0, 900))) for _ in range(60)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 300))) for _ in range(60)]
    return texts


def library_counts(texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_model())
    return [len(x) for x in model.encode([t or "" for t in texts])]


@pytest.mark.parametrize("chunk", [256, 1, 7])
def test_counts_are_the_library_s(chunk, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    texts = odd_texts() if chunk > 1 else [t[:200] if t else t for t in odd_texts()]
    assert token_counts.transducer(None).counts(pa.array(texts)).tolist() == library_counts(texts)


def test_long_texts_in_windows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_counts, "SLICE_BYTES", 1000)
    monkeypatch.setattr("tallyguard.llm.textscan.SLICE_BYTES", 1000)
    texts = ["".join(t for t in odd_texts() if t)[:60_000], "é" * 9999]
    machine = token_counts.transducer(None)
    assert [machine.counts(pa.array([t]))[0] for t in texts] == library_counts(texts)
    assert len(list(token_counts.windows(pa.array(texts[1:]).buffers()[2].to_pybytes()))) == 20


def test_counts_after_forgetting(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_counts, "MOST_TRANSITIONS", 100)
    texts = odd_texts()[-40:]
    machine = token_counts.transducer(None)
    assert [machine.counts(pa.array([t]))[0] for t in texts] == library_counts(texts)


def test_counts_of_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(-1, None), (None, "x"), (7, ""), (7, "word " * 5000)]
    docs = docs.union(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("n_tokens", F.lit(1))
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    got = {}
    for r in token_counts.token_counts(docs).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_tokens, r.over_limit))
    for doc_id, own in texts.items():
        want = [(len((t or "").encode()), n, n > 4096) for t, n in zip(own, library_counts(own))]
        assert sorted(got[doc_id]) == sorted(want)
    assert token_counts.token_counts(docs.where("doc_id < -5")).collect() == []
