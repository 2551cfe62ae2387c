"""Vocabulary encoding: the tokens do not move for a vocabulary that fits a broadcast."""

from wikisift.operators import corpus as C


def test_tokens_are_not_shuffled(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0, 0, ["a", "b", "a"]), (2, 0, 0, ["a", "c"])], "doc_id long, par_no int, sent_no int, tokens array<string>")
    vocab = C.vocabulary_with_ids(C.vocabulary(df, 2))

    def got():
        e = C.vocab_encode(df, vocab)
        return e._jdf.queryExecution().optimizedPlan().toString(), sorted((r["doc_id"], r["pos"], r["word"], r["word_id"]) for r in e.collect())

    plan, rows = got()
    assert rows == [(1, 0, "a", 0), (1, 2, "a", 0), (2, 0, "a", 0)] and plan.count("strategy=broadcast") == 2  # the offsets of the numbering and the words
    monkeypatch.setattr(C, "BROADCAST_WORDS", 0)
    assert got()[1] == rows
