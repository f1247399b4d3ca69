"""Every operator that SQL cannot express against a plain version on small fixtures."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyguard.llm import (
    fingerprints, line_dedup, mixing, ngram_join, packing, quality, repetition, sanitise, toxicity)
from tallyguard.llm.textscan import slices
from tallyguard.llm.tokens import default_tokenizer

SPLIT = re.compile("[\x20\x09-\x0d]+")


def words(text):
    return [w for w in SPLIT.split(text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def near_texts(seed=3, groups=25, size=60):
    """Clusters of texts some words apart, exact copies, short ones and odd white space."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = ["", None, "one", "one", "one two", " one\ttwo ", "a b c d e", "A b C d e"]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, size))]
        for _ in range(rng.randint(1, 7)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            out.append(rng.choice([" ", "  ", "\n"]).join(text))
    return out


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


def test_near_duplicates(spark):
    texts = near_texts()
    sets = []
    for t in texts:
        w = words(lower(t))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    expected = [(i, len(s), find(i)) for i, s in enumerate(sets)]
    got = sorted(map(tuple, ngram_join.near_duplicates(docs_of(spark, texts)).collect()))
    assert got == expected
    assert len({r[2] for r in got}) < len(got)


def test_hot_elements_are_dealt_out(spark, monkeypatch):
    texts = near_texts(seed=5, groups=12)
    plain = sorted(map(tuple, ngram_join.near_duplicates(docs_of(spark, texts)).collect()))
    monkeypatch.setattr("tallyguard.llm.setjoin.HOT_LEVEL", 2)
    assert sorted(map(tuple, ngram_join.near_duplicates(docs_of(spark, texts)).collect())) == plain


def test_line_dedup(spark):
    rng = random.Random(8)
    lines = [t.replace("\n", " ") for t in near_texts(seed=4, size=25) if t]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6))) for _ in range(60)] + [None, "", "\n\n"]
    seen, expected = [], []
    for i, t in enumerate(texts):
        gone = []
        for k, line in enumerate((t or "").split("\n")):
            w = words(lower(line))
            if len(w) >= line_dedup.LEAST_WORDS:
                s = set(w)
                if any(4 * len(s & x) >= 3 * len(s | x) for x in seen):
                    gone.append(k)
                seen.append(s)
        expected.append((i, gone))
    removed, rows = line_dedup.line_decisions(docs_of(spark, texts))
    got = defaultdict(list)
    for doc_id, number in removed.collect():
        got[doc_id].append(number)
    assert [(i, sorted(got[i])) for i in range(len(texts))] == expected
    assert {r[0]: r[1] for r in rows.collect()} == {i: (t or "").count("\n") + 1 for i, t in enumerate(texts)}
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
    for i, gone in expected:
        rest = "\n".join(x for k, x in enumerate((texts[i] or "").split("\n")) if k not in gone)
        assert kept.get(i, "gone") == (texts[i] if not gone else rest if words(rest) else "gone")


def test_short_lines_are_deduplicated(spark):
    texts = ["Share this\n\nHome\none two three four", "home\n\nshare this\nfour three two one\nother", "Home", "this share\nHome page"]
    removed, _ = line_dedup.line_decisions(docs_of(spark, texts))
    assert sorted(map(tuple, removed.collect())) == [(1, 0), (1, 2), (1, 3), (2, 0), (3, 0)]
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
    assert kept == {0: texts[0], 1: "\nother", 3: "Home page"}


def plain_spans(text):
    """Base spans by the patterns as they are given."""
    out = []
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            odd = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1]))
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and odd % 10 == 0
                    or kind == "phone" and 8 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans(spark):
    rng = random.Random(1)
    signs = ["1", "2", "5", "0", "4111111111111111", " ", "-", ".", "@", "a", "b.c", "+1", "+", "(", ")", "é", "😀", "_",
             "255", "x@y.z", "4111 1111 1111 1111", "00012", "%"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "1" * 20000, "a" * 20000 + "@b.c", "1.2.3.4." * 500, "+" + "1 " * 5000]
    df = docs_of(spark, texts).select("doc_id", sanitise.listed(sanitise.base_spans(F.coalesce("text", F.lit("")))))
    got = dict(map(tuple, df.collect()))
    assert [got[i] for i in range(len(texts))] == [plain_spans(t) for t in texts]


def test_disclosing_terms(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(12)) for _ in range(200)]
    for i in range(20):
        filler = rng.choices(["alpha", "beta", "gamma"], k=4)
        texts.append(f"{filler[0]} {filler[1]} hotline +1 555 000 {1000 + i} {filler[2]} {filler[3]} tail{'abcdefghij'[i % 10]}")
    rows = {r.doc_id: r for r in sanitise.personal_data(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert rows[i].base_sha256 == hashlib.sha256(plain_spans(t).encode()).hexdigest()
        added = [x for x in rows[i].spans.split(",") if x.split(":")[0] in sanitise.ACTIONS]
        assert [t[int(a):int(b)] for _, a, b in (x.split(":") for x in added)] == (["hotline"] if i >= 200 else [])
    clean = {r.doc_id: r.text for r in sanitise.sanitised(docs_of(spark, texts)).collect()}
    assert clean[0] == texts[0] and "hotline" not in clean[205] and "[phone]" in clean[205] and "555" not in clean[205]


def test_copies_do_not_hide_terms(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(12)) for _ in range(200)]
    near = [f"{rng.choice(['alpha', 'beta'])} hotline +1 555 000 {1000 + i} gamma" for i in range(6)]
    texts += near + [near[0]] * 300
    rows = sanitise.personal_data(docs_of(spark, texts)).collect()
    assert all(("remove:" in r.spans) == (r.doc_id >= 200) for r in rows)


def test_terms_far_off_and_rare_values(spark):
    rng = random.Random(6)
    fill = [f"{a}{b}" for a in ["mor", "tel", "sun", "rik"] for b in ["an", "os", "ek", "ul"]]
    texts = [" ".join(rng.choices(fill, k=40)) for _ in range(300)]
    for i in range(3):
        texts.append(" ".join([*rng.choices(fill, k=20), "Quillon", *rng.choices(fill, k=30), "q.smith@mail.example.com"]))
        texts.append(" ".join([*rng.choices(fill, k=5), "张伟,", *rng.choices(fill, k=30), "IP 10.20.30.40"]))
    texts.append(" ".join([*rng.choices(fill, k=40), "quillon", *rng.choices(fill, k=5), "张伟"]))
    rows = {r.doc_id: r for r in sanitise.personal_data(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert rows[i].base_sha256 == hashlib.sha256(plain_spans(t).encode()).hexdigest()
        added = [x.split(":") for x in rows[i].spans.split(",") if x.split(":")[0] in sanitise.ACTIONS]
        names = {t[int(a):int(b)].lower() for _, a, b in added}
        assert names == {w for w in ("quillon", "张伟", "ip") if w in words(lower(t.replace(",", "")))}
    clean = {r.doc_id: r.text for r in sanitise.sanitised(docs_of(spark, texts)).collect()}
    assert clean[0] == texts[0] and not any(w in t.lower() for t in clean.values() for w in ("quillon", "张伟", "smith"))


def test_copied_texts_disclose_nothing(spark):
    rng = random.Random(8)
    fill = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(60)]
    rare = [f"{a}{b}{c}" for a in ("wo", "zu", "ky", "vi", "xa", "pe") for b in ("rn", "st", "ll", "mp", "tt", "ng")
            for c in ("ix", "om", "ut", "aw", "yl")]
    texts = [" ".join(rng.choices(fill, k=40)) for _ in range(300)]
    for i in range(8):                                   # near copies of one text, and a passage in unlike texts
        texts.append(" ".join([*rare[:90], rng.choice(fill), "Mail copied.one@mail.example.com"]))
        texts.append(" ".join([*rng.choices(fill, k=40), *rare[90:150], "+1 555 000 9876", *rng.choices(fill, k=40)]))
    named = len(texts)
    for i in range(4):
        texts.append(" ".join([*rng.choices(fill, k=20), "Ottoline", "o.line@mail.example.com", *rng.choices(fill, k=9)]))
    rows = {r.doc_id: r for r in sanitise.personal_data(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        added = [x.split(":") for x in rows[i].spans.split(",") if x.split(":")[0] in sanitise.ACTIONS]
        assert {t[int(a):int(b)] for _, a, b in added} == ({"Ottoline"} if i >= named else set())


def test_sanitised_keeps_columns_of_any_name(spark):
    texts = ["x a.b@c.de y", None, "", "plain"]
    df = docs_of(spark, texts).withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in ("_row", "row_key", "_key", "key", "marks")})
    rows = {r.doc_id: r for r in sanitise.sanitised(df).collect()}
    assert [rows[i].text for i in range(4)] == ["x [email] y", None, "", "plain"]
    assert all(r[c] == f"{c}{i}" for i, r in rows.items() for c in ("_row", "row_key", "_key", "key", "marks"))


def test_term_places(spark):
    texts = ["é bc " * 700, "", "a", "xy", " xy1zz ", "10.0.0.1 ab c.d@e.fg hi +1 555 000 1234 jk"]
    text = F.col("text")
    outside = sanitise.without_spans(text, sanitise.base_spans(text))
    df = docs_of(spark, texts).select("doc_id", sanitise.term_places(
        outside, F.array_distinct(sanitise.terms_of(outside))).alias("found"))
    got = {r.doc_id: [tuple(x) for x in r.found] for r in df.collect()}
    expected = [[(m[0], *m.span()) for m in re.finditer(r"[^\W\d_]{2,}", t)] for t in texts[:5]]
    assert [got[i] for i in range(5)] == expected
    assert [x[0] for x in got[5]] == ["ab", "hi", "jk"] and all(texts[5][a:b] == w for w, a, b in got[5])


def plain_repetition(text, least):
    w = words(text)

    def cover(k):
        seen = Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        return {j for i in range(len(w) - k + 1) if seen[tuple(w[i:i + k])] > 1 for j in range(i, i + k)}

    longest = 0
    while len(w) > longest and (cover(longest + 1)):
        longest += 1
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in lines
            lines.add(line)
    return [len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(cover(3)),
            len(cover(least)), longest if longest >= least else 0]


def test_repetition():
    rng = np.random.default_rng(0)
    texts = [None, "", " \n\n a\n a\na", "x", "é é\té # *"]
    texts += [" ".join(rng.choice(["a", "b", "c"], rng.integers(1, 70)).tolist()) for _ in range(60)]
    texts += [" ".join([*(f"u{i}" for i in range(30)), *("p q r s t u v w x y z" .split()), *(f"v{i}" for i in range(9)),
                        *("p q r s t u v w x y z".split())])]
    got = []
    for _, _, raw, at in slices(pa.array(texts), 700):
        found = repetition.measure(raw, at, 10)
        got += np.stack([found[c] for c in repetition.COUNTS], 1).tolist()
    assert got == [plain_repetition(t, 10) for t in texts]


def test_repeats_that_pass_the_base_rule(spark):
    def fresh(name, n):
        return [f"{name}{i}" for i in range(n)]

    passage, paragraph, sentence = fresh("p", 240), fresh("q", 60), fresh("s", 15)
    scattered = [w for k in range(8) for w in (*paragraph, *fresh(f"v{k}x", 65))]
    texts = {
        "plain": fresh("u", 1000), "passage": passage + fresh("u", 520) + passage, "scattered": scattered,
        "longest only": paragraph + fresh("u", 880) + paragraph,
        "covered only": [w for k in range(4) for w in (*sentence, *fresh(f"v{k}x", 25))],
        "sentence twice": sentence + fresh("u", 300) + sentence}
    rows = {r.doc_id: r for r in repetition.repetition_rules(docs_of(spark, [" ".join(t) for t in texts.values()])).collect()}
    got = {name: rows[i] for i, name in enumerate(texts)}
    assert not any(r.base_failed for r in got.values())
    assert {name for name, r in got.items() if r.kept} == {"plain", "sentence twice"}
    only = got["longest only"]
    assert only.longest_repeat > repetition.LONGEST_REPEAT and only.covered_words <= repetition.MOST_COVERED * only.n_words
    only = got["covered only"]
    assert only.longest_repeat <= repetition.LONGEST_REPEAT and only.covered_words > repetition.MOST_COVERED * only.n_words


def test_fingerprints(spark):
    texts = [f"{' '.join(words(t))} {i % 7}" if t else t for i, t in enumerate(near_texts(seed=6))]
    rows = sorted(fingerprints.fingerprints(docs_of(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert len(rows) == len(texts)
    by_text = {}
    for i, r in enumerate(rows):
        text, following = texts[i] or "", texts[(i + 1) % len(texts)] or ""
        k = len(text) // 4
        changed = text[:len(text) - k] + following[:k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        own, edited, later = (base64.b64decode(x) for x in (
            r.fingerprint, r.edited_fingerprint, rows[(i + 1) % len(rows)].fingerprint))
        assert r.near_edited == fingerprints.likeness(own, edited)
        assert r.near_next == fingerprints.likeness(own, later)
        if changed == text:
            assert r.near_edited == 1.0
    long = [r for r in rows if r.n_chars > 150]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.2


def test_window_levels():
    raw = np.frombuffer(bytes(np.random.default_rng(0).choice(list(b"abcdeeee  \n"), 300).tolist()), np.uint8)
    w, term, most = fingerprints.WINDOW, fingerprints._TERM, fingerprints._MOST
    expected = [(most - sum(int(term[c]) for c in Counter(raw[i:i + w].tolist()).values())) * 255 // most
                for i in range(len(raw) - w + 1)]
    assert fingerprints.levels(raw).tolist() == expected


def test_packing(spark):
    from tokenizers import Tokenizer

    rng = random.Random(7)
    texts = ["a b", "", None, "  x  y ", "é à b, c. d", "don't 's  \n\n x\t y", "a 　b", "1 2 3é 中 文", "×, ÷.",
             "x" * 3000 + " y'll <|endoftext|> z", "ab, cd", " c", "word " * 2500]
    texts += [" ".join(rng.choice(["the", "Tion,", "hé.", "éa", "12", "\n"]) for _ in range(rng.randint(1, 900))) for _ in range(60)]
    tokenizer = Tokenizer.from_file(default_tokenizer())
    tokenizer.encode_special_tokens = True
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    rows = packing.pack(docs_of(spark, texts)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
    for i, own in ids.items():
        at = 0
        for n, (piece, start, length) in enumerate(sorted(pieces[i])):
            assert (piece, start) == (n, at) and (length == 1024 or n == 0)
            at += length
        assert at == len(own) and len(pieces[i]) == -(-at // 1024)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(map(len, ids.values())) // 1024) + 3


def test_program_carries_the_plan():
    rng = np.random.default_rng(4)
    size = np.arange(257)
    text_like = np.bincount(np.minimum(rng.lognormal(4.2, 0.9, 6000).astype(int) + 1, 256), minlength=257)
    halves = np.bincount(rng.integers(70, 257, 5000), minlength=257)
    few = np.bincount(rng.integers(1, 257, 40), minlength=257) * 100
    for counts, near in ((text_like, 1.005), (halves, 1.2), (few, None)):     # few lengths: volume is no tight bound
        alone = sum(n for _, n in packing.best_fit(counts, []))
        assert sum(n for _, n in packing.integral_plan(counts)) <= alone
        for rounds, rate in packing.RUNS:
            columns, bound = packing.fractional_plan(counts, rounds, rate)
            made = np.zeros(257)
            for config, x in columns:
                assert x > 0 and sum(k * a for k, a in config.items()) <= 256
                for k, a in config.items():
                    made[k] += a * x
            assert np.allclose(made, counts)
            value = sum(x for _, x in columns)
            assert bound <= value + 1e-6 and value <= (near * bound if near else 1.02 * alone)
            assert bound <= alone + 1e-6
            _, left = packing.whole_part(counts, columns, 1.0)
            assert left @ size <= 0.1 * (counts @ size)


def test_knapsack_prices():
    rng = np.random.default_rng(5)
    for _ in range(20):
        value = np.where(rng.random(13) < 0.5, rng.random(13), 0.0)
        value[0] = 0
        best, took = packing.price(value)
        plain = [0.0] * 13
        for room in range(1, 13):
            plain[room] = max([plain[room - 1], *(plain[room - k] + value[k] for k in range(1, room + 1) if value[k])])
        assert np.allclose(best, plain)
        for first in np.flatnonzero(value):
            config = packing.config_from(int(first), took)
            assert sum(k * a for k, a in config.items()) <= 12
            assert np.isclose(sum(value[k] * a for k, a in config.items()), value[first] + plain[12 - first])


def test_plan_covers_every_piece():
    rng = np.random.default_rng(3)
    for counts in (np.bincount(rng.integers(1, 65, 5000), minlength=65), np.bincount([64, 1], minlength=65),
                   np.zeros(65, np.int64)):
        made = np.zeros(65, np.int64)
        total = 0
        for config, use in packing.integral_plan(counts):
            assert sum(k * a for k, a in config.items()) <= 64 and use > 0
            total += use
            for k, a in config.items():
                made[k] += a * use
        assert made.tolist() == counts.tolist()
        assert total <= 1.02 * (counts * np.arange(65)).sum() / 64 + 2


def test_mix_reaches_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs).collect()
    taken = defaultdict(int)
    for r in rows:
        taken[r.source, r.source_size, r.target] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert all(int(t) == n for (_, _, t), n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(r.size for r in rows), rel=1e-3)
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(5)).collect())
    made = mixing.repeated(docs).select(F.sum(mixing.words(F.col("text")))).first()[0]
    assert made == sum(taken.values())


@pytest.mark.parametrize("module, label, fraction", [(toxicity.toxic_scores, "toxic", 0.9), (quality.quality_scores, "quality", 0.9)])
def test_held_out_accuracy(spark, module, label, fraction):
    """The larger tables have enough labels for a judgement on rows that were not learned from."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = module(docs, labels).join(labels, "doc_id").toPandas()
    assert scored["score"].between(0, 1).all()
    held = scored[scored["held_out"]]
    assert (held["predicted"] == held[label]).mean() >= fraction
