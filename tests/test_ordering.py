"""Greedy groups by a plain walk."""

import random

import pytest

from wikisift.operators.ordering import greedy_groups


def walk(sizes, cap):
    out, held, number = [], 0, 0
    for s in sizes:
        if held + s > cap:
            number, held = number + 1, 0
        out.append(number)
        held += s
    return out


@pytest.mark.parametrize("seed,n,parts,top,cap", [(0, 400, 7, 40, 100), (2, 200, 16, 300, 100), (3, 1, 3, 5, 100), (5, 60, 30, 50, 120)])
def test_against_a_walk(spark, seed, n, parts, top, cap):
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, rnd.randrange(top), top]) for _ in range(n)]
    if seed == 2:
        sizes[0] = 500
    rows = list(enumerate(sizes))
    rnd.shuffle(rows)
    out = greedy_groups(spark.createDataFrame(rows, "k long, s long"), ["k"], "s", cap, "g", parts)
    assert [r["g"] for r in sorted(out.collect())] == walk(sizes, cap) and out.columns == ["k", "s", "g"]


def test_empty(spark):
    assert greedy_groups(spark.createDataFrame([], "k long, s long"), ["k"], "s", 5, "g").count() == 0
