"""Operator 1 against all pairs."""

import re

import numpy as np
import xxhash
from llm_helpers import DOCS, rows_of, words  # noqa: F401

from wikisift.llm.graph import connected_components
from wikisift.llm.simhash import block_links, fingerprint, fingerprint_links, keep_one, near_duplicates, segment_counts, unary


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """[(doc_id, fp)] -> component of each place."""
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(pairs))]


def test_fingerprint(rng):
    for t in ["", "  \n", "One", "a B", "a b c", words(rng, 50), words(rng, 400), " x y z \x1fq", None]:
        assert fingerprint((t or "").encode()) % 2**64 == brute_fingerprint(t)
    from wikisift.llm import simhash

    chunk, simhash._CHUNK = simhash._CHUNK, 16  # many blocks give the same sums
    assert fingerprint(words(rng, 100).encode()) is not None
    t = words(rng, 333)
    assert fingerprint(t.encode()) % 2**64 == brute_fingerprint(t)
    simhash._CHUNK = chunk


def test_manhattan_is_a_lower_bound(rng):
    a = np.array([rng.getrandbits(64) for _ in range(500)], np.uint64)
    flips = np.array([sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in a], np.uint64)
    b = a ^ flips
    counts = lambda v: np.array([(v >> np.uint64(s)) & np.uint64(1) for s in range(64)]).reshape(32, 2, -1).sum(1).astype(int)
    direct = np.abs(counts(a) - counts(b)).sum(0)
    code = np.bitwise_count(unary(segment_counts(a)) ^ unary(segment_counts(b)))
    assert (code == direct).all() and (direct <= np.bitwise_count(flips)).all()


def test_links_keep_components(spark, rng):
    fps = set()
    for _ in range(60):
        seed = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 25)):
            fps.add(seed)
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                seed ^= 1 << b
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    for block in (8, 2048):  # cells cut into many blocks, and whole
        links = fingerprint_links(table, block=block)
        assert all((a ^ b).bit_count() <= 3 or ((a % 2**64) ^ (b % 2**64)).bit_count() <= 3 for a, b in rows_of(links, "a", "b"))
        root = {r["node"]: r["root"] for r in connected_components(links).collect()}
        want = brute_components([(x, x % 2**64) for x in fps])
        assert [root.get(x, x) for x in fps] == want


def test_block_pairs_of_visitors_do_not_meet():
    fp = np.array([0, 1, 3], np.int64)
    none = np.zeros(3, bool)
    assert block_links(fp, none, None, None, 3) == []
    assert len(block_links(fp, ~none, None, None, 3)) == 2  # a spanning forest


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    root = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert root == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}
    assert connected_components(edges.where("false")).count() == 0


def test_edges_cases_and_one_of_each_group(spark, edge, empty, clash):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    prints = [(d, brute_fingerprint(t)) for d, t in rows]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(prints, brute_components(prints))), key=repr)
    for df in (edge, clash(edge)):
        assert rows_of(near_duplicates(df), "doc_id", "fingerprint", "component_id") == want
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0
    kept = keep_one(clash(edge))
    assert kept.columns == clash(edge).columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    ids = [(d, c) for d, _, c in want]
    assert len(got) == len({c if c is not None else "none" for _, c in ids} | set()) + sum(1 for d, t in got if d == 4) - 1
    assert [t for d, t in got if d == 2] == [] and [d for d, t in got if not (t or "").strip()] == [1]
    assert len(got) == len(set(got))


def test_nulls_only(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "quite other words here")], "doc_id long, text string")
    assert rows_of(keep_one(df), "text") == [("a b c d",), ("quite other words here",)]
    assert rows_of(near_duplicates(df), "component_id") == [(None,)] * 3
