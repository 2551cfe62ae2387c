"""Operator 12 against the tokenizer library itself."""
import json

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import rows_of, words
from tokenizers import Tokenizer, models

from wikisift.llm import token_counts as TC

PATH = public_tokenizers.path(TC.TOKENIZER_FILE)
LIBRARY = Tokenizer.from_file(PATH)


def direct(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_documents(spark, edge, empty, clash):
    out = TC.token_counts(edge)
    want = sorted(((r.doc_id, len((r.text or "").encode()), direct(r.text), direct(r.text) > 2048) for r in edge.collect()), key=repr)
    assert rows_of(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert rows_of(TC.token_counts(clash(edge)), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert any(w[3] for w in want)
    assert TC.token_counts(empty).count() == 0


SPECIAL = "<|endoftext|>"
TEXTS = ["", " ", "I'll they've 'S 'RE", f"a{SPECIAL}b <|startoftext|>{SPECIAL} <|ENDOFTEXT|>", "ÀÉ İSTANBUL ΣΑΣ ς ß ﬁ é Å", "中文没有空格的长句子。日本語テキスト", "naïve x y​z\x1cq\x85r﻿",
         "1234567890 ½ Ⅷ ٣٤", "!!!??? --- ...,,, $$$ @#%^&*", "🙂🙃👩‍👩‍👧 flags 🇩🇪", "tabs\t\tand\r\nlines\x0b\x0c", "a" * 5000, "ab" * 3000 + " " + "xyz" * 2000, "é" * 1000, "the" * 400, "\x00\x01nul",
         "ஃதமிழ் हिन्दी ไทยไม่มีช่องว่าง", "Ǆ ǅ ǆ ﷺ"]


@pytest.mark.parametrize("text", TEXTS)
def test_texts(text):
    assert TC.counter(PATH).count([text]) == [direct(text)]


@given(st.lists(st.text(max_size=60), max_size=6))
@settings(max_examples=150, deadline=None)
def test_any_text(texts):
    assert TC.Counter.count(TC.counter(PATH), texts) == list(map(direct, texts))


def test_long_sequences_by_both_ways(rng, monkeypatch):
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(3000))
    prose = words(rng, 3000, 4000)
    assert TC.Counter(PATH).count([text, prose]) == [direct(text), direct(prose)]
    monkeypatch.setattr(TC, "LONG", 10**9)
    assert TC.Counter(PATH).count([text, prose]) == [direct(text), direct(prose)]
    monkeypatch.setattr(TC, "LONG", 2)
    assert TC.Counter(PATH).count([text, prose]) == [direct(text), direct(prose)]


@pytest.mark.parametrize("long", [1, 10**9])
def test_merges_that_must_be_applied_singly(rng, long, monkeypatch):
    """A product that begins a pair of lower rank than its own."""
    monkeypatch.setattr(TC, "LONG", long)
    merges = [("b", "c"), ("abc", "a"), ("d", "d"), ("a", "bc"), ("abca", "bc"), ("dd", "a"), ("c", "abc")]
    vocab = {t: k for k, t in enumerate(sorted({"a", "b", "c", "d", *(x + y for x, y in merges)}))}
    library = Tokenizer(models.BPE(vocab, merges))
    model = json.loads(library.to_str())["model"]
    run = TC.Merges(model)
    assert not run.at_once.all()
    texts = ["abcabc", "abcabcabc", "ddddd", "", "a"] + ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    want = [len(library.encode(t).ids) for t in texts]
    assert run.counts(texts).tolist() == want


def test_overlapping_places():
    hit = np.array([1, 1, 1, 0, 1, 1, 0, 1], bool)
    assert np.flatnonzero(TC._apart(hit, np.array([0, 4]), np.zeros(8, bool))).tolist() == [0, 2, 4, 7]
    assert np.flatnonzero(TC._apart(hit, np.array([0, 4]), np.ones(8, bool))).tolist() == [0, 4]


def test_memory_is_bounded(monkeypatch, rng):
    monkeypatch.setattr(TC, "REMEMBERED", 500)
    monkeypatch.setattr(TC, "LAID", 50)
    run = TC.Counter(PATH)
    texts = [words(rng, 30) for _ in range(20)]
    assert run.count(texts) == list(map(direct, texts)) and run.held <= 5000


def test_unknown_models_are_refused():
    with pytest.raises(ValueError):
        TC.Merges({"type": "WordPiece", "vocab": {}, "merges": []})
