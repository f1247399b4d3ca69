"""Classifiers learn from all labelled rows, however many."""

import numpy as np
from pyspark.sql import functions as F

from tallyguard.llm import toxicity

WORDS = ["amber", "birch", "cedar", "dune", "ember", "flint", "grove", "heath", "iris", "jade",
         "kelp", "larch", "maple", "nettle", "opal", "pine", "quartz", "reed", "sage", "thorn"]


def test_toxicity_learns_from_rows_beyond_the_first_batch(spark, monkeypatch):
    """Each word is in 20 of 400 labelled texts, which four shards of about 100 rows train on."""
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 50)
    rows = [(i, f"{WORDS[i % 20]} some words and more text {i}", int(i % 20 < 5)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.col("doc_id") >= 0, 50)
    raw = np.frombuffer(" ".join(WORDS).encode(), np.uint8)
    words = toxicity.words_of(raw, np.array([0, len(raw)]))
    assert model.words[words.word[:20]].any(1).all()                # each was seen in three training texts or more
    again = toxicity.fit(docs.repartition(7), labels.repartition(3), F.col("doc_id") >= 0, 50)
    assert np.array_equal(model.words, again.words) and np.array_equal(model.thresholds, again.thresholds)
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((scored[i] >= 0.5) == (y == 1) for i, _, y in rows)


def test_coded_words_come_back(spark):
    texts = ["", "Two words", "...", "één wörd, the of the"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    words = toxicity.words_of(raw, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    for i, codes in enumerate(toxicity.coded(words)):
        back, end = toxicity.decoded(codes.as_py(), words.language[i]), words.end[i] + toxicity.PAD
        assert np.array_equal(back.word, words.word[words.start[i]:end]) and np.array_equal(back.stem, words.stem[words.start[i]:end])
