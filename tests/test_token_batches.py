"""Token columns hold few texts and few pre-tokens at once."""

from tallyguard.functions import tokens as K


def test_long_pre_tokens_are_not_remembered(monkeypatch):
    own = K.Encoder(K.default_vocabulary())
    monkeypatch.setattr(K, "MOST_KNOWN", 10)
    text = " ".join(f"word{'abcdefghijkl'[i % 12] * (1 + i // 12)}" for i in range(60)) + " " + "x" * 5000
    whole = own.tokenizer.encode(text, add_special_tokens=False).ids
    assert own.count(text) == len(whole) and own.ids(text) == whole
    assert len(own) <= 10 and max(map(len, own)) <= K.LONGEST_KNOWN


def test_token_columns_of_many_texts(spark):
    texts = [None, ""] + ["some words " * (i % 7) for i in range(3 * K.PART)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").coalesce(1)
    own = K.encoder()
    rows = df.select("i", K.token_counter()("text").alias("n"), K.token_head("text", 3).alias("head")).orderBy("i").collect()
    assert [r.n for r in rows] == [own.count(t) for t in texts]
    assert [r.head for r in rows] == [None if t is None else own.head(t, 3) for t in texts]
