"""Operator 12: token counts by rank-synchronous merging of ragged arrays.

The tokenizer file gives special strings, normalizer, pre-tokenizer and the
ranked merges; the merging is done here.  The different pre-tokens of a batch of texts are
laid end to end as one array of symbols with the sequence that each belongs to.
A round looks up the rank of every neighbouring pair, takes each sequence's lowest, applies it
at once wherever it stands in that sequence (left to right where places
overlap), and closes the gaps; a sequence without a ranked pair is done,
and its surviving symbols are its tokens.  A merge whose product begins or ends
a pair of lower rank would have to be applied one place at a time, and is.

Sequences longer than ``LONG`` symbols would need a round for nearly every
rank, each over all of their symbols; they go by the same rule, lowest rank first, over linked places
with a heap of ranks, in time that grows with their length alone.

Texts are counted in their own rows: no shuffle, and nothing but the
vocabulary file is held (a bounded memory of counted words saves repeats).

Defined results: null text counts as empty (no bytes, no tokens), and its doc_id is
kept; special strings in a text count as one token each, as the
tokenizer's default has it; very long texts and words are counted whole; repeated
rows each get a row; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikisift.llm.common import bounded_batches

TOKENIZER_FILE = "word_bpe_49k.json"
LIMIT = 2048
#: Symbols beyond which a sequence is merged over linked places.
LONG = 256
#: Symbols laid out at once, and characters of counted words that a worker remembers.
LAID, REMEMBERED = 1_000_000, 16_000_000
NONE = np.iinfo(np.int64).max


class Merges:
    """The merges of a tokenizer file's model, as sorted arrays."""

    def __init__(self, model: dict):
        if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain byte-pair models are counted")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.size = max(vocab.values(), default=0) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key, rank = left * self.size + right, np.arange(len(pairs), dtype=np.int64)
        # a pair that is listed twice has its last rank
        order = np.lexsort((rank, key))
        last = np.append(key[order][1:] != key[order][:-1], True) if len(key) else np.zeros(0, bool)
        order = order[last]
        self.keys, self.ranks, self.made = key[order], rank[order], made
        lowest = np.full(self.size, NONE)
        np.minimum.at(lowest, left[order], rank[order])
        np.minimum.at(lowest, right[order], rank[order])
        #: Whether a merge may be applied at all its places at once.
        self.at_once = lowest[made] > rank
        self.by_key = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        # symbols of one character, inside a pre-token and at its end; -1: none
        top = max((ord(t[0]) for t in vocab if t), default=0) + 1
        self.inside, self.end = np.full(top + 1, -1, np.int64), np.full(top + 1, -1, np.int64)
        for t, i in vocab.items():
            if len(t) == 1:
                self.inside[ord(t)] = i
            if len(t) == 1 + len(suffix) and t.endswith(suffix):
                self.end[ord(t[0])] = i

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE) if len(self.keys) else np.full(len(key), NONE)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' first symbols, end to end, and the word of each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.minimum(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), len(self.inside) - 1)
        out = self.inside[chars]
        ends = np.cumsum(sizes)[sizes > 0] - 1
        out[ends] = self.end[chars[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        return out[out >= 0], word[out >= 0]

    def counts(self, words: list[str]) -> np.ndarray:
        """How many symbols of each word survive."""
        symbol, word = self.symbols(words)
        sizes = np.bincount(word, minlength=len(words))
        out = sizes.copy()
        for k in np.flatnonzero(sizes > LONG).tolist():
            a, z = np.searchsorted(word, [k, k + 1])
            out[k] = self.count_long(symbol[a:z].tolist())
        short = (sizes <= LONG)[word] & (sizes > 1)[word]
        symbol, word = symbol[short], word[short]
        while len(symbol):
            own = word[1:] == word[:-1]
            rank = np.full(len(symbol), NONE)  # of the pair that starts at a symbol
            rank[:-1][own] = self.rank_of(symbol[:-1][own], symbol[1:][own])
            starts = np.flatnonzero(np.append(True, ~own))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbol))))
            open_ = lowest < NONE
            hit = open_ & (rank == lowest)
            hit = _apart(hit, starts, open_ & ~self.at_once[np.where(open_, lowest, 0)])
            at = np.flatnonzero(hit)
            symbol[at] = self.made[rank[at]]
            gone = np.zeros(len(symbol), bool)
            gone[at + 1] = True
            np.subtract.at(out, word[at], 1)
            stay = open_ & ~gone
            symbol, word = symbol[stay], word[stay]
        return out

    def count_long(self, symbol: list[int]) -> int:
        """Survivors of one sequence: lowest rank first, over linked places."""
        n, size, by_key = len(symbol), self.size, self.by_key
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        places: dict[int, list[int]] = {}
        heap: list[int] = []

        def note(at: int) -> None:
            z = after[at]
            if z < n:
                r = by_key.get(symbol[at] * size + symbol[z])
                if r is not None:
                    if r not in places:
                        places[r] = []
                        heapq.heappush(heap, r)
                    heapq.heappush(places[r], at)

        for k in range(n):
            note(k)
        left = n
        while heap:
            r = heap[0]
            if not places[r]:
                heapq.heappop(heap)
                del places[r]
                continue
            at = heapq.heappop(places[r])
            z = after[at]
            # the pair may have gone since it was noted
            if symbol[at] < 0 or z >= n or by_key.get(symbol[at] * size + symbol[z]) != r:
                continue
            symbol[at], symbol[z] = int(self.made[r]), -1
            after[at] = after[z]
            if after[z] < n:
                before[after[z]] = at
            left -= 1
            note(at)
            if before[at] >= 0:
                note(before[at])
        return left


def _apart(hit: np.ndarray, starts: np.ndarray, singly: np.ndarray) -> np.ndarray:
    """``hit`` without places that overlap one already taken to their left, and with
    the first place alone where a sequence is marked ``singly``."""
    at = np.flatnonzero(hit)
    if len(at):
        # of a run of neighbouring places every second falls
        fresh = np.append(True, np.diff(at) > 1)
        run = np.maximum.accumulate(np.where(fresh, at, 0))
        at = at[(at - run) % 2 == 0]
        sequence = np.searchsorted(starts, at, side="right")
        first = np.append(True, sequence[1:] != sequence[:-1])
        at = at[first | ~singly[at]]
    out = np.zeros(len(hit), bool)
    out[at] = True
    return out


class Counter:
    """Token counts of texts by one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        plain = [t["content"] for t in said["added_tokens"] if not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])]
        if len(plain) < len(said["added_tokens"]):
            raise ValueError("only added tokens that are matched as they stand are counted")
        self.special = re.compile("|".join(map(re.escape, sorted(plain, key=len, reverse=True)))) if plain else None
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.merges = Merges(said["model"])
        self.known: dict[str, int] = {}
        self.held = 0

    def chunks(self, text: str) -> tuple[int, list[str]]:
        """Special strings in a text, and its normal form cut at blanks: no
        pre-token crosses a blank."""
        parts = self.special.split(text) if self.special else [text]
        out: list[str] = []
        for p in parts:
            if p:
                out += (self.normalizer.normalize_str(p) if self.normalizer else p).split(" ")
        return len(parts) - 1, out

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        out: list[int] = []
        at = 0
        while at < len(texts):
            group, size = [], 0
            while at < len(texts) and (not group or size < LAID):
                group.append(self.chunks(texts[at]))
                size += len(texts[at])
                at += 1
            # the words of many texts are merged together
            new = {c for _, chunks in group for c in chunks if c not in self.known}
            if new:
                self._learn(list(new))
            known = self.known
            out += [specials + sum(map(known.__getitem__, chunks)) for specials, chunks in group]
            if self.held > REMEMBERED:
                self.known, self.held = {}, 0
        return out

    def _learn(self, chunks: list[str]) -> None:
        words, of, laid = [], [], 0
        total = [0] * len(chunks)

        def settle():
            for k, n in zip(of, self.merges.counts(words).tolist()):
                total[k] += n

        for k, c in enumerate(chunks):
            if not c:
                continue
            for w, _ in self.pre_tokenizer.pre_tokenize_str(c) if self.pre_tokenizer else [(c, None)]:
                words.append(w)
                of.append(k)
                laid += len(w)
                if laid >= LAID:
                    settle()
                    words, of, laid = [], [], 0
        if words:
            settle()
        self.known.update(zip(chunks, total))
        self.held += sum(map(len, chunks)) + 64 * len(chunks)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, limit: int = LIMIT, tokenizer_file: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    ``tokenizer_file``: a path that every executor can read; by default the public
    tokenizers' word file.
    """
    bounded_batches(docs.sparkSession)

    def count(texts: pa.Array) -> pa.Array:
        run = counter(tokenizer_file or public_tokenizers.path(TOKENIZER_FILE))
        return pa.array(run.count([t or "" for t in texts.to_pylist()]), pa.int64())

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), F.arrow_udf(count, T.LongType())("text").alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
