"""Operator 2: WAND against scoring every item, hits against planted passages."""

from llm_helpers import rows_of, words

from wikisift.llm import decontaminate as dc


def made_index(rng, n=40):
    vocabulary = [f"t{k}".encode() for k in range(80)]
    rows = [(k, b"x", [(t, rng.random()) for t in rng.sample(vocabulary, rng.randrange(1, 20))]) for k in range(n)]
    return dc.build_index(rows, 64)


def test_wand_finds_all_above(rng):
    for _ in range(30):
        index = made_index(rng)
        query = rng.sample(range(len(index.terms)), 25)
        scores = {}
        for t in query:
            for item, w in zip(index.lists[t][0], index.lists[t][1]):
                scores[item] = scores.get(item, 0) + w
        for least in (0.3, 2.0, 5.0):
            got = dict(dc.block_max_wand(index, query, least))
            want = {i: s for i, s in scores.items() if s >= least}
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_question_and_answer():
    assert dc.question_answer(b"Who is it? It is me.") == ([b"who", b"is", b"it"], [b"it", b"is", b"me"])
    assert dc.question_answer(b"a b c") == ([b"a", b"b"], [b"c"])
    assert dc.question_answer(b"?? !") == ([], [])
    assert dc.overlap([b"a", b"b"], [b"x", b"a", b"b"]) == 1.0 and dc.overlap([b"a", b"b", b"c"], [b"a", b"x", b"b"]) == 0.0 and dc.overlap([b"a", b"b", b"c"], [b"a", b"b"]) == 0.5


def planted(rng):
    items = [(k, words(rng, rng.randrange(12, 60), 400)) for k in range(30)] + [(100, words(rng, 300, 900)), (None, "null item " + words(rng, 20, 400)), (7, None), (8, "")]
    docs, want = [], set()
    for d in range(60):
        text = words(rng, 300)
        if d % 3 == 0:
            item, passage = items[rng.randrange(32)]
            text = words(rng, rng.randrange(200)) + " \n" + "".join(c if c == "ß" else c.upper() for c in passage) + " " + text
            want.add((d, item))
        docs.append((d, text))
    half = items[0][1].split()
    docs.append((500, words(rng, 50) + " " + " ".join(half[: len(half) // 2]) + " " + words(rng, 50)))  # the question alone
    docs += [(501, None), (502, ""), (None, items[3][1]), (503, "x" * 100_000), (503, "y")]
    return items, docs, want | {(None, 3)}


def test_planted(spark, rng, empty, clash):
    items, docs, want = planted(rng)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contamination(clash(d), b)
    assert set(rows_of(got, "doc_id", "item_id")) == want
    assert all(s >= dc.THRESHOLD and q >= dc.OVERLAP and a >= dc.OVERLAP for s, q, a in rows_of(got, "score", "question_overlap", "answer_overlap"))
    clean = dc.drop_contaminated(clash(d), b)
    assert clean.columns == clash(d).columns
    dirty = {x for x, _ in want}
    assert rows_of(clean, "doc_id", "text") == sorted(((x, t) for x, t in docs if x not in dirty), key=repr)
    assert dc.contamination(empty, b).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contamination(d, none).count() == 0 and dc.drop_contaminated(d, none).count() == len(docs)


def test_shards_give_the_same(spark, rng, monkeypatch):
    items, docs, want = planted(rng)
    monkeypatch.setattr(dc, "SHARD_POSTINGS", 200)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(dc.shards(b))) > 4
    assert set(rows_of(dc.contamination(spark.createDataFrame(docs, "doc_id long, text string"), b), "doc_id", "item_id")) == want
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert {x for x, in rows_of(dc.drop_contaminated(d, b), "doc_id")} == {x for x, _ in docs} - {x for x, _ in want}


def test_one_row_a_document_and_item(spark, rng):
    """Rows of one item of unlike length lie in different classes and shards."""
    short, long = words(rng, 30, 400), words(rng, 300, 900)
    b = spark.createDataFrame([(1, short), (1, long), (2, words(rng, 40, 400))], "item_id long, text string")
    d = spark.createDataFrame([(5, f"{words(rng, 60)} {short} {words(rng, 60)} {long}"), (6, short), (6, short)], "doc_id long, text string")
    assert rows_of(dc.contamination(d, b), "doc_id", "item_id") == [(5, 1), (6, 1)]


def test_every_window_and_item_by_brute_force(spark, rng):
    """Windows, bounds and index against scoring each item with each window."""
    items, docs, _ = planted(rng)
    b = spark.createDataFrame(items, "item_id long, text string")
    for k in range(len(docs) // 2):  # partly edited passages, so that scores lie on both sides of the threshold
        passage = items[rng.randrange(30)][1].split()
        docs.append((1000 + k, " ".join(x if rng.random() < 0.6 else "edited" for x in passage) + " " + words(rng, 80)))
    near = 0
    for index in dc.shards(b):
        weights = [{} for _ in index.item_ids]
        for term, t in index.terms.items():
            for place, w in zip(*index.lists[t][:2]):
                weights[place][term] = w
        for _, text in docs:
            w = dc.words_of((text or "").encode())
            want = {}
            for at in range(max(1, -(-len(w) // index.step) - 1)):
                window = w[at * index.step : (at + 2) * index.step]
                for place, own in enumerate(weights):
                    score = sum(own[t] for t in set(window) & set(own))
                    near += 0.4 < score < 0.6
                    q, a = dc.overlap(index.questions[place], window), dc.overlap(index.answers[place], window)
                    if score >= dc.THRESHOLD and min(q, a) >= dc.OVERLAP:
                        want[index.item_ids[place]] = max(want.get(index.item_ids[place], 0), score)
            got = {i: h[0] for i, h in dc.text_hits(index, (text or "").encode()).items()}
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)
    assert near > 5


def test_recall_of_edited_passages(spark, rng):
    """At least nine in ten items are found with a fifth of their words replaced."""
    b = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in b.collect()]
    indexes, common = list(dc.shards(b)), [w for _, t in items for w in t.split()]
    found = {}
    for share in (0.0, 0.1, 0.2):
        hits = [any(i in dc.text_hits(x, (words(rng, 150) + " " + " ".join(rng.choice(common) if rng.random() < share else w for w in t.split()) + " " + words(rng, 150)).encode()) for x in indexes)
                for i, t in items for _ in range(5)]
        found[share] = sum(hits) / len(hits)
    assert found[0.0] == 1 and found[0.1] >= 0.97 and found[0.2] >= 0.9, found
    other = [words(rng, 400, 3000) for _ in range(200)]
    assert not any(dc.text_hits(x, t.encode()) for x in indexes for t in other)
