"""Operator 13 against scoring every item with every document."""
import math
import re
from collections import Counter

import pytest
from llm_helpers import DOCS, words

from wikisift.llm import reversed_search as RS
from wikisift.llm.reversed_search import search

ITEMS = "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def direct(docs, items, k=10):
    own = [(d, Counter(t), len(t)) for d, text in docs if (t := terms(text))]
    n_docs, length = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for i, wanted in asked.items():
        scored = []
        for d, c, n in own:
            m = 10 + 90 * n * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.fixture()
def corpus(spark, rng):
    docs = [(k, words(rng, rng.randrange(1, 90), 30), "en", "a", 1) for k in range(150)]
    docs += [(k + 500, docs[7][1], "en", "a", 1) for k in range(30)] + [(9, docs[7][1], None, None, None)] * 3
    items = [(k, words(rng, rng.randrange(1, 30), 30)) for k in range(20)] + [(3, words(rng, 15)), (None, docs[7][1]), (90, ""), (91, None), (92, "unheardof"), (93, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("shard_terms", [200_000, 25, 12])
def test_against_every_pair(spark, corpus, shard_terms):
    docs, items = corpus
    out = search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), shard_terms=shard_terms)
    assert found(out) == direct([d[:2] for d in docs], items)


def test_small_cells(spark, corpus, monkeypatch):
    docs, items = corpus
    shard = RS.build_shard(sorted({(i, t.encode()) for i, text in items for t in terms(text)}, key=repr))
    texts = [(d[1] or "").encode() for d in docs]
    sizes, _, term, _ = RS.batch_counts(shard.terms.get, texts)
    shard.n_docs, shard.n_terms = int((sizes > 0).sum()), int(sizes.sum())
    df = Counter(term.tolist())
    import numpy as np
    shard.weights = np.array([RS.weight(shard.n_docs, df[t]) for t in range(len(shard.terms))], np.int64)
    got = []
    for cells in (4_000_000, 60, 1):
        monkeypatch.setattr(RS, "CELLS", cells)
        heaps = RS.Heaps(len(shard.item_ids), 4)
        for a in range(0, len(texts), 50):
            ids = np.array([d[0] for d in docs[a : a + 50]], np.int64)
            RS.score_batch(shard, texts[a : a + 50], ids, np.zeros(len(ids), bool), heaps)
        got.append((heaps.item.tolist(), heaps.doc.tolist(), heaps.score.tolist()))
    assert got[0] == got[1] == got[2]
    want = [w for w in direct([d[:2] for d in docs], items, 4)]
    assert sorted(((shard.item_ids[i], d, s) for i, d, s in zip(*got[0])), key=repr) == sorted(((i, d, s) for i, _, d, s in want), key=repr)


def test_edges(spark, edge, empty, clash):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    items = [(1, "one line that REPEATS w1 w2"), (2, "x" * 200_000), (3, "ßé One")]
    asked = spark.createDataFrame(items, ITEMS)
    assert found(search(edge, asked)) == direct(rows, items)
    assert found(search(clash(edge), clash(asked))) == direct(rows, items)
    assert found(search(clash(edge), clash(asked), shard_terms=1)) == direct(rows, items)
    assert found(search(edge, asked, k=2)) == direct(rows, items, 2)
    assert search(empty, asked).count() == 0
    assert search(edge, spark.createDataFrame([], ITEMS)).count() == 0
    assert search(spark.createDataFrame([(1, None, "en", "a", 1)], DOCS), asked).count() == 0
