"""Operator 11 against a plain recursive tree."""
import hashlib
import zlib

import pytest
from llm_helpers import DOCS, rows_of

from wikisift.llm.manifest import audit, fold, manifest


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def shown(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, fanout):
    """Root, and the sibling segments of every node."""
    proofs, spot = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + fanout] for k in range(0, len(nodes), fanout)]
        for p, s in zip(proofs, spot):
            run, at = runs[s // fanout], s % fanout
            p.append(("".join(run[:at]), "".join(run[at + 1 :])))
        nodes, spot = [sha("".join(r)) for r in runs], [s // fanout for s in spot]
    return nodes[0], proofs


def direct(rows, fanout=2):
    """Sorted (doc_id, leaf, subroot, root, proof) of rows in DOCS order."""
    by_lang = {}
    for doc_id, text, lang, source, n_chars in rows:
        by_lang.setdefault(lang, []).append((doc_id, sha("".join(map(shown, (doc_id, source, lang, n_chars, text))))))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    subs = []
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        subs.append(climb([r[1] for r in by_lang[lang]], fanout))
    root, upper = climb([s[0] for s in subs], fanout) if subs else (None, [])
    return sorted(((d, leaf, sub, root, tuple(p + up)) for lang, (sub, proofs), up in zip(langs, subs, upper) for (d, leaf), p in zip(by_lang[lang], proofs)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n,fanout,levels", [(1, 2, 8), (2, 2, 2), (37, 2, 2), (37, 3, 1), (60, 2, 8)])
def test_tree_of_any_size_and_blocks(spark, n, fanout, levels):
    rows = [(k * 7 % 101, f"text {k}", ["en", "de", None, "é", "ab"][min(k % 9, 4)], "s", k) for k in range(n)]
    assert found(manifest(spark.createDataFrame(rows, DOCS), fanout=fanout, levels=levels)) == direct(rows, fanout)


def test_edges(spark, edge, clash, empty):
    rows = [tuple(r) for r in edge.collect()]
    assert found(manifest(edge, levels=2)) == direct(rows)
    assert found(manifest(clash(edge))) == direct(rows)
    assert manifest(empty).count() == 0 and audit(empty).count() == 0


def test_hot_key_and_equal_rows(spark):
    rows = [(3, "same", "en", "a", 4)] * 40 + [(3, f"other {k}", "en", "a", 4) for k in range(20)]
    assert found(manifest(spark.createDataFrame(rows, DOCS), levels=2)) == direct(rows)


def test_audit(spark, edge):
    rows = [tuple(r) for r in edge.collect()] + [(k, "x", "en", "a", None if k % 2 else k) for k in range(100, 160)] + [(0, "top", "en", "a", 2**63 - 1)]
    out = audit(spark.createDataFrame(rows, DOCS)).collect()
    want = {(d, leaf): (sub, root, p) for d, leaf, sub, root, p in direct(rows)}
    twice = {leaf for _, leaf in want if sum(leaf == r.leaf for r in out) > 1}
    tampered = 0
    leaves = {sha("".join(map(shown, (d, s, lang, n, t)))): (d, t, lang, s, n) for d, t, lang, s, n in rows}
    for r in out:
        sub, root, proof = want[r.doc_id, r.leaf]
        assert (r.subroot, r.root) == (sub, root)
        if r.leaf in twice:
            continue
        assert r.proof_sha256 == sha("".join(a + b for a, b in proof))
        d, t, lang, s, n = leaves[r.leaf]
        hit = d is not None and zlib.crc32(str(d).encode()) % 7 == 0
        at = sha("".join(map(shown, (d, s, lang, n if n is None or not hit else n + 1, t))))
        for a, b in proof:
            at = sha(a + at + b)
        assert r.folded_root == at and r.verified == (not hit or n is None)
        tampered += not r.verified
    assert tampered > 3


def test_fold_is_the_proofs_check(spark, edge):
    rows = manifest(edge)
    assert rows.where(fold(rows["leaf"], rows["proof"]) != rows["root"]).count() == 0
    assert rows_of(rows, "doc_id") == rows_of(edge, "doc_id")
