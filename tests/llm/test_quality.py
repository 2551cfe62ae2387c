"""Operators 8 and 10: base statistics by brute force, estimates and trees on
data whose answer is known."""

import re
import zlib
from collections import Counter

import numpy as np
from llm_helpers import DOCS, rows_of, words

from wikisift.llm import quality_model as qm
from wikisift.llm import quality_rules as qr


def base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    count, held = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if count[tuple(w[i : i + 3])] >= 2:
            held |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(held), len(w) < 50 or 100 * len(held) > 50 * len(w)


def test_base_statistics(edge, empty, clash):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    got = qr.quality_rules(clash(edge))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(got, *cols) == sorted(((d, *base(t)) for d, t in rows), key=repr)
    assert all(not k for f, k in rows_of(got, "base_failed", "kept") if f)
    assert qr.quality_rules(empty).count() == 0 and qr.keep_good(empty).count() == 0


def test_repeated_words(rng):
    for n in (0, 2, 3, 4, 30, 200):
        w = [rng.choice("ab cde f g h".split()) for _ in range(n)]
        assert qr.repeated_words([x.encode() for x in w]) == base(" ".join(w))[4]


def corpus(rng, n=900):
    """Clean prose in two sources, and one row in seven that is junk."""
    rows, junk = [], set()
    for k in range(n):
        t = words(rng, rng.randrange(60, 200), 400)
        if k % 7 == 0:
            t = [t.upper().replace(" ", "!! "), t.replace(" ", " | "), t.replace(" ", "### ")][k % 3]
            junk.add(k)
        rows.append((k, t, "en", ("big", "big", "small")[k % 3] if k % 100 else None, len(t)))
    return rows, junk


def test_outliers(spark, rng, clash):
    rows, junk = corpus(rng)
    df = spark.createDataFrame(rows, DOCS)
    kept = {d for d, k in rows_of(qr.quality_rules(df), "doc_id", "kept") if k}
    good = {k for k, t, *_ in rows if not base(t)[5]} - junk
    assert len(good - kept) <= 0.01 * len(good) and not kept & junk
    stage = qr.keep_good(clash(df))
    assert stage.columns == clash(df).columns and {d for d, in rows_of(stage, "doc_id")} == kept
    assert rows_of(stage, "doc_id", "text") == sorted(((k, t) for k, t, *_ in rows if k in kept), key=repr)


def test_salted_join_gives_the_same(spark, rng, monkeypatch):
    rows, _ = corpus(rng, 300)
    df = spark.createDataFrame(rows, DOCS)
    want = rows_of(qr.quality_rules(df), "doc_id", "kept")
    monkeypatch.setattr(qr, "BROADCAST_GROUPS", 0)
    assert rows_of(qr.quality_rules(df), "doc_id", "kept") == want


def test_estimate_resists_outliers(spark):
    """A quarter of far rows leaves location and scatter nearly those of the rest."""
    gen = np.random.Generator(np.random.PCG64(3))
    x = gen.normal(0.5, 0.3, (4000, qr.P))
    x[:900] += 5
    data = [("en", "s", False, *map(float, r)) for r in x]
    stats = spark.createDataFrame(data, "lang string, source string, base_failed boolean, " + ", ".join(f"{n} double" for n in qr.NAMES))
    _, params = qr.fit(stats)
    p = params.first()
    assert all(abs(p[f"mu_{i}"] - 0.5) < 0.05 for i in range(qr.P))
    floor = list(qr.FLOORS.values())
    assert all(0.6 < 1 / p[f"q_{i}_{i}"] / (0.09 + floor[i] ** 2) < 1.5 for i in range(qr.P))


def test_consistency_factor():
    gen = np.random.Generator(np.random.PCG64(4))
    d2 = np.square(gen.normal(size=(200_000, 6))).sum(1)
    near = d2 <= np.quantile(d2, 0.75)
    assert abs(qr.consistency(0.75, 6) * d2[near].mean() / 6 - 1) < 0.01


def test_trees_learn_and_walk(rng):
    gen = np.random.Generator(np.random.PCG64(5))
    x = gen.normal(size=(3000, len(qm.FEATURES))).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = qm.grow(x[:2000], y[:2000])
    assert ((forest.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95

    def walk(tree, row):  # one row, one tree at a time
        at = int(forest.roots[tree])
        while forest.left[at] != at:
            at = int(forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at])
        return forest.value[at]

    direct = [forest.prior + sum(walk(t, r) for t in range(len(forest.roots))) for r in x[2000:2040]]
    assert np.allclose(forest.margin(x[2000:2040]), direct)
    assert len(forest.feature) == len(forest.value) == len(forest.left)


def test_one_class_and_no_labels(spark, edge, empty):
    for rows in ([], [(4, 1, 0), (7, 1, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        got = qm.classify(edge, labels).collect()
        assert len(got) == edge.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert qm.classify(empty, labels).count() == 0


def test_sample_is_bounded_and_takes_the_smallest_hashes(spark):
    features = spark.range(5000).selectExpr("id AS doc_id", "array(CAST(id AS float)) AS x")
    labels = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality", "0 AS toxic")
    whole = [r["x"] for r in qm.training_rows(features, labels, 10_000).collect()]
    assert len(whole) == sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in range(5000))
    assert [r["x"] for r in qm.training_rows(features, labels, 200).collect()] == whole[:200]


def test_classifier(spark, rng, clash):
    rows, junk = corpus(rng)
    df = spark.createDataFrame(rows, DOCS)
    labels = [(k, int(k not in junk), 0) for k in range(900) if k % 2] + [(3, None, None), (None, 1, 0)]
    flip = [(k, q if q is None or k is None or zlib.crc32(str(k).encode()) % 4 != 2 else 1 - q, t) for k, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    got = qm.classify(clash(df), spark.createDataFrame(labels, schema)).collect()
    other = qm.classify(df, spark.createDataFrame(flip, schema)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, other))  # held-out labels have no say
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == int(r["doc_id"] not in junk) for r in held) > 0.97 * len(held)
