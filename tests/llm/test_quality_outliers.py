"""Operator 10: every statistic can reject, and the estimate is the determinant's minimum."""

import itertools

import numpy as np
from llm_helpers import DOCS

from wikisift.llm import quality_rules as qr


def plain(rng, n):
    """Clean prose without symbols, digits, capitals, marks or repeats."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 8))) for _ in range(n)]


def test_each_statistic_rejects_alone(spark, rng):
    """In a group that never varies, a text that departs in one statistic goes."""
    def lines(words, k=7):
        return "\n".join(" ".join(words[a : a + k]) for a in range(0, len(words), k))

    good = [lines(plain(rng, 210)) for _ in range(200)]
    w = plain(rng, 210)
    one_word_lines = plain(rng, 60) + ["same"] * 80
    planted = {
        "f_wordlen": lines(["".join(plain(rng, 6)) for _ in range(210)]),
        "f_symbols": lines([x + "#" * 3 for x in w]),
        "f_duplines": "\n".join(" ".join(plain(rng, 20)) for _ in range(60)) + "\n" + "\n".join(one_word_lines * 2),
        "f_repeat": lines(plain(rng, 110) + (plain(rng, 10) * 10)[:100]),
        "f_upper": lines([x.upper() for x in w]),
        "f_digits": lines(["".join(str(rng.randrange(10)) for _ in range(6)) for _ in range(210)]),
        "f_marks": lines([x + "!?;" for x in w]),
    }
    rows = [(k, t, "en", "a", len(t)) for k, t in enumerate(good)] + [(1000 + k, t, "en", "a", len(t)) for k, t in enumerate(planted.values())]
    got = {r["doc_id"]: r for r in qr.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert list(planted) == qr.NAMES
    for k, name in enumerate(planted):
        assert not got[1000 + k]["base_failed"] and not got[1000 + k]["kept"], (name, got[1000 + k])
    assert all(got[k]["kept"] for k in range(len(good)))


def test_direct_minimum_on_a_small_group(spark, monkeypatch):
    """Against the best subset of many random starts, each followed until it stands still."""
    monkeypatch.setattr(qr, "MIN_GROUP", 10)
    gen = np.random.Generator(np.random.PCG64(11))
    n, p = 160, qr.P
    x = gen.normal(0.4, 0.1, (n, p)) @ (np.eye(p) + 0.3)
    x[:30] += gen.normal(1.5, 0.1, (30, p))
    floor = np.diag(np.square(list(qr.FLOORS.values())))
    h, factor = int(np.ceil(qr.H_SHARE * n)), qr.consistency(qr.H_SHARE)

    def estimate(subset):
        mu, cov = x[subset].mean(0), factor * np.cov(x[subset].T, bias=True) + floor
        d = x - mu
        return np.linalg.slogdet(cov)[1], mu, np.argsort(np.einsum("ni,ij,nj->n", d, np.linalg.inv(cov), d), kind="stable")[:h]

    def follow(subset):
        best, mu, subset = estimate(estimate(subset)[2])
        while (again := estimate(subset))[0] < best - 1e-9:
            best, mu, subset = again
        return best, mu

    det, mu = min((follow(gen.choice(n, p + 1, replace=False)) for _ in range(200)), key=lambda r: r[0])
    data = [("en", "s", False, *map(float, r)) for r in x]
    stats = spark.createDataFrame(data, "lang string, source string, base_failed boolean, " + ", ".join(f"{c} double" for c in qr.NAMES))
    _, params = qr.fit(stats)
    row = params.first()
    q = np.zeros((p, p))
    for i, j in itertools.product(range(p), range(p)):
        q[i, j] = row[f"q_{max(i, j)}_{min(i, j)}"]
    assert abs(-np.linalg.slogdet(q)[1] - det) < 0.15
    assert all(abs(row[f"mu_{i}"] - mu[i]) < 0.03 for i in range(p))
