"""Operator 5: exact cover, little padding, the curve."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import words

from wikisift.llm.packing import cut_pieces, hilbert_key, pack, tail_cuts
from wikisift.llm.tokens import encoder


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_encoder_equals_the_tokenizer_file(rng, tokenizer):
    texts = ["", " ", "a  b\n\n c\t", "it's I'll we'd 123 4567 ...!?", "<|endoftext|> x", "é😀漢字 ﬁ", "x" * 9000, " " * 3000 + "y", "\n" * 500, words(rng, 500), "   z", "a\x00b\x7f"]
    for t in texts:
        assert encoder().ids(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids
        assert encoder().text(encoder().ids(t)) == t


def test_hilbert_curve_visits_neighbours():
    side = np.arange(8)
    points = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    key = hilbert_key(points, 3)
    assert sorted(key.tolist()) == list(range(512))
    path = points[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_cuts():
    assert tail_cuts(2048 + 13) == [2056, 2060, 2061] and tail_cuts(4096) == []
    assert cut_pieces(2000, 61, 2061) == [(0, 48, 0, 2000), (48, 8, 1, 0), (56, 4, 2, 0), (60, 1, 3, 0)]


def check(rows, docs, tokenizer):
    want = sorted((d, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])) for d, t in docs if d is not None)
    sequences, seen = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        ids = struct.unpack(f"<{r['length']}I", r["ids"])
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
        seen.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
    for (d, n), parts in seen.items():
        assert sum(len(x) for _, x in parts) % n == 0
    for d, ids in want:
        for start, piece in seen[(d, len(ids))]:
            if want.count((d, ids)) == 1 and sum(1 for e, x in want if e == d and len(x) == len(ids)) == 1:
                assert ids[start : start + len(piece)] == piece
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == 2048 or at & (at - 1) == 0 and at < 2048
    assert sum(r["length"] for r in rows) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)


def test_pack(spark, rng, edge, empty, clash, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    check(pack(clash(edge), with_ids=True).collect(), docs, tokenizer)
    assert pack(empty).count() == 0
    many = [(k, words(rng, rng.randrange(300))) for k in range(200)] + [(1000 + k, "the same copy " * 30) for k in range(100)]
    df = spark.createDataFrame(many, "doc_id long, text string")
    whole, ranges = pack(df, with_ids=True).collect(), pack(df, range_tokens=3000, with_ids=True).collect()
    check(whole, many, tokenizer)
    check(ranges, many, tokenizer)
    place = lambda rows: sorted((r["doc_id"], r["start"], r["sequence_id"], r["offset"]) for r in rows)
    assert place(whole) == place(ranges)  # the number of ranges doesn't change the result


def test_neighbours_are_alike(spark):
    kinds = {k: f"{'alpha beta gamma delta' if k % 2 else 'uno dos tres cuatro'} " * 40 for k in range(60)}
    rows = pack(spark.createDataFrame(list(kinds.items()), "doc_id long, text string")).orderBy("sequence_id", "offset").collect()
    order = [r["doc_id"] % 2 for r in rows if r["start"] == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) == 1
