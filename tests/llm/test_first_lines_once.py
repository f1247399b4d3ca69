"""The first lines of all line sets are found by one aggregation over the lines, which both later steps read."""

from tallyguard.llm import line_dedup


def test_first_lines_are_stored_once(spark, monkeypatch):
    names = []
    real = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: (names.append(name), real(df, name))[1])
    docs = spark.createDataFrame([(1, "a b c d\nx y"), (2, "x Y\na b c d e"), (None, "x y"), (2, None)],
                                 "doc_id long, text string")
    removed, _ = line_dedup.line_decisions(docs)
    assert sorted(map(tuple, removed.collect())) == [(1, 1), (2, 0), (2, 1)]
    assert names.count("firsts") == 1
