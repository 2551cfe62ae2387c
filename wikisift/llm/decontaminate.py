"""Operator 2: benchmark decontamination with a BM25 index and block-max WAND.

The benchmark items are indexed; every passage of every document is a query.
Weights are divided by the score an item gives its own text, so a score is the
share of the item that the passage accounts for and one threshold serves
items of any length.

* Items of like length (classes of a factor four) share an index; documents
  are read in windows of twice the class's length, each half a window on, so an
  item of the class lies whole in some window.
* A window whose terms' list-wide maxima cannot reach the threshold, or whose
  block maxima reach it in no block, is passed over (the two bounds of block-max
  WAND, for all windows of a text at once); the others run block-max WAND, which
  returns every item at or above the threshold.
* A hit is verified: the item's question and its answer must each have at least
  ``OVERLAP`` of their word n-grams in the window.

The index is built from statistics over all items and dealt into shards of at
most ``SHARD_POSTINGS`` postings.  A shard's hits are written and its broadcast is destroyed
before the next one is built, so driver and executors hold one shard, whatever the benchmark's
size.  Documents are never shuffled.

Defined results: null or empty text or item = no words, no hit; null doc_id and null
item_id are carried; rows with one doc_id, and items with one item_id, count as one (the
best hit of the pair stays, ties by overlap and first word); very long texts are read whole, in windows; empty
tables give no hits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikisift.llm.common import bounded_batches, scratch
from wikisift.session import cut_lineage

K1, B = 1.2, 0.75
#: Share of an item's own score that makes a passage a candidate.
THRESHOLD = 0.5
#: Word n-grams of question and answer, and the share of each to be found.
NGRAM, OVERLAP = 2, 0.35
#: Words of the shortest length class, and the factor from class to class.
CLASS_WORDS, CLASS_FACTOR = 64, 4
SHARD_POSTINGS = 200_000
#: Items of one block of the index.
BLOCK_ITEMS = 2

_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    """Words: runs of ASCII letters, digits and non-ASCII, in lower case."""
    return raw.decode().lower().encode().translate(_FOLD).split()


@F.arrow_udf(T.ArrayType(T.BinaryType()))
def words_udf(texts: pa.Array) -> pa.Array:
    return pa.array([words_of(x or b"") for x in texts.cast(pa.binary()).to_pylist()], pa.list_(pa.binary()))


def question_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """An item's question (to its first question mark with words on both sides,
    else the first half of its words) and answer (the rest)."""
    head, mark, tail = text.partition(b"?")
    if mark and words_of(head) and words_of(tail):
        return words_of(head), words_of(tail)
    words = words_of(text)
    half = (len(words) + 1) // 2
    return words[:half], words[half:]


def grams(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[k:] for k in range(n))))


def overlap(part: list[bytes], window: list[bytes]) -> float:
    """Share of a part's n-grams that the window holds (shorter parts: their
    whole length is the n; an empty part counts as found)."""
    n = min(NGRAM, len(part))
    if not n:
        return 1.0
    own = grams(part, n)
    return len(own & grams(window, n)) / len(own)


@dataclass
class Index:
    """One shard.  ``lists[t]``: item places, weights, and maxima by block."""

    terms: dict[bytes, int]
    lists: list[tuple[list[int], list[float], dict[int, float]]]
    most: np.ndarray  # list-wide maximum of each term
    first: np.ndarray  # place of each term's block maxima in the two below
    blocks: np.ndarray
    block_most: np.ndarray
    item_ids: list
    questions: list[list[bytes]]
    answers: list[list[bytes]]
    step: int  # half a window, in words


def build_index(rows, step: int) -> Index:
    """``rows``: (item_id, text bytes, [(term, weight)]), any order.

    Items are ordered by their commonest term, so that a block holds items of one
    kind (language) and its maxima are low for texts of another.
    """
    held: dict[bytes, int] = {}
    for _, _, postings in rows:
        for term, _ in postings:
            held[term] = held.get(term, 0) + 1
    ranked = sorted(rows, key=lambda r: (max((held[t], t) for t, _ in r[2]), r[1]))
    terms: dict[bytes, int] = {}
    lists: list = []
    for place, (_, _, postings) in enumerate(ranked):
        for term, weight in postings:
            t = terms.setdefault(term, len(terms))
            if t == len(lists):
                lists.append(([], [], {}))
            items, weights, blocks = lists[t]
            items.append(place)
            weights.append(weight)
            block = place // BLOCK_ITEMS
            blocks[block] = max(blocks.get(block, 0.0), weight)
    parts = [question_answer(r[1]) for r in ranked]
    first = np.concatenate(([0], np.cumsum([len(b) for _, _, b in lists], dtype=np.int64)))
    blocks = np.array([k for _, _, b in lists for k in b], np.int64)
    block_most = np.array([x for _, _, b in lists for x in b.values()])
    return Index(terms, lists, np.array([max(w) for _, w, _ in lists]), first, blocks, block_most, [r[0] for r in ranked], [p[0] for p in parts], [p[1] for p in parts], step)


def block_max_wand(index: Index, query: list[int], least: float) -> list[tuple[int, float]]:
    """(item place, score) of every item whose score for the query's terms is at
    least ``least``."""
    most = index.most
    least -= 1e-9  # sums in another order may fall short by rounding
    # cursors: [item, position, term, items, weights, blocks]
    heads = [[index.lists[t][0][0], 0, t, *index.lists[t]] for t in query]
    out = []
    while heads:
        heads.sort(key=lambda h: h[0])
        bound, pivot = 0.0, -1
        for k, h in enumerate(heads):
            bound += most[h[2]]
            if bound >= least:
                pivot = k
                break
        if pivot < 0:
            break
        item = heads[pivot][0]
        while pivot + 1 < len(heads) and heads[pivot + 1][0] == item:
            pivot += 1
        block = item // BLOCK_ITEMS
        if sum(h[5].get(block, 0.0) for h in heads[: pivot + 1]) < least:
            # nothing up to the block's end or the next list's item can pass
            goal = (block + 1) * BLOCK_ITEMS
            if pivot + 1 < len(heads):
                goal = min(goal, heads[pivot + 1][0])
            goal = max(goal, item + 1)
        elif heads[0][0] == item:
            score = sum(h[4][h[1]] for h in heads[: pivot + 1])
            if score >= least:
                out.append((item, score))
            goal = item + 1
        else:
            goal = item
        left = []
        for k, h in enumerate(heads):
            if k <= pivot and h[0] < goal:
                items, at = h[3], h[1] + 1
                while at < len(items) and items[at] < goal:
                    at += 1
                if at == len(items):
                    continue
                h[0], h[1] = items[at], at
            left.append(h)
        heads = left
    return out


def block_bound(index: Index, at: np.ndarray, term: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each of ``windows``: the largest sum, over any one block, of the block
    maxima of its terms.  ``at``, ``term``: sorted (window, term) pairs."""
    row = np.searchsorted(windows, at)
    row[row == len(windows)] = 0
    own = windows[row] == at
    row, term = row[own], term[own]
    out = np.zeros(len(windows))
    n_blocks = int(index.blocks.max()) + 1
    group = max(1, (1 << 20) // n_blocks)  # windows at a time: bounds the sums held
    edges = np.searchsorted(row, np.arange(0, len(windows) + group, group))
    for k, (a, z) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        size = index.first[term[a:z] + 1] - index.first[term[a:z]]
        ends = np.cumsum(size)
        spot = np.arange(ends[-1] if len(ends) else 0) + np.repeat(index.first[term[a:z]] - (ends - size), size)
        cell = np.repeat(row[a:z] - k * group, size) * n_blocks + index.blocks[spot]
        here = min(group, len(windows) - k * group)
        out[k * group : k * group + here] = np.bincount(cell, index.block_most[spot], here * n_blocks).reshape(here, n_blocks).max(axis=1)
    return out


def text_hits(index: Index, raw: bytes, first_only: bool = False) -> dict:
    """item_id -> (score, question share, answer share, first word of the
    window) of the verified items in one text."""
    words = words_of(raw)
    n, step = len(words), index.step
    get = index.terms.get
    known = np.fromiter((get(w, -1) for w in words), np.int64, n)
    pos = np.flatnonzero(known >= 0)
    if not len(pos):
        return {}
    windows = max(1, -(-n // step) - 1)
    term, half = known[pos], pos // step
    key = np.concatenate((half * len(index.terms) + term, (half - 1) * len(index.terms) + term))
    at = np.concatenate((half, half - 1))
    key = np.unique(key[(at >= 0) & (at < windows)])
    at, term = np.divmod(key, len(index.terms))
    bound = np.bincount(at, index.most[term], windows)
    edges = np.searchsorted(at, np.arange(windows + 1))
    passing = bound >= THRESHOLD - 1e-9
    if passing.any():
        passing[passing] = block_bound(index, at, term, np.flatnonzero(passing)) >= THRESHOLD - 1e-9
    out: dict = {}
    for w in np.flatnonzero(passing).tolist():
        found = block_max_wand(index, term[edges[w] : edges[w + 1]].tolist(), THRESHOLD)
        if not found:
            continue
        passage = words[w * step : (w + 2) * step]
        for item, score in found:
            q, a = overlap(index.questions[item], passage), overlap(index.answers[item], passage)
            if q >= OVERLAP and a >= OVERLAP:
                hit = (float(score), q, a, w * step)
                out[index.item_ids[item]] = max(out.get(index.item_ids[item], hit), hit)
                if first_only:
                    return out
    return out


def shards(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark's indexes, one at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"),
                             words_udf(F.col("text").cast("string")).alias("words"))
    items = items.withColumn("n", F.size("words")).where("n > 0").withColumn(
        "step", (CLASS_WORDS * F.pow(F.lit(CLASS_FACTOR), F.greatest(F.ceil(F.log(float(CLASS_FACTOR), F.col("n") / CLASS_WORDS)), F.lit(0)))).cast("int"))
    # a number for each item row; the checkpoint fixes it
    items = cut_lineage(items.withColumn("row", F.monotonically_increasing_id()))
    total, mean = items.agg(F.count(F.lit(1)), F.avg("n")).first()
    if not total:
        return
    counts = items.select("row", "step", "n", F.explode("words").alias("term")).groupBy("row", "step", "n", "term").agg(F.count(F.lit(1)).alias("tf"))
    seen = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n") / mean))
    weighed = counts.join(seen, "term").withColumn("w", weight)
    postings = weighed.groupBy("row").agg(F.sum("w").alias("own"), F.collect_list(F.struct("term", "w")).alias("postings"))
    table = items.drop("words").join(postings, "row")
    sizes = {r["step"]: r["n"] for r in table.groupBy("step").agg(F.sum(F.size("postings")).alias("n")).collect()}
    dealt = cut_lineage(table)
    for step in sorted(sizes):
        parts = -(-sizes[step] // SHARD_POSTINGS)
        for k in range(parts):
            rows = dealt.where((F.col("step") == step) & (F.pmod(F.xxhash64("row"), F.lit(parts)) == k)).collect()
            rows = [(r["item_id"], bytes(r["raw"]), [(bytes(p["term"]), p["w"] / r["own"]) for p in r["postings"]]) for r in sorted(rows, key=lambda r: r["row"])]
            if rows:
                yield build_index(rows, step)


_HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, first_word: a
    row for every document and item it verifiably holds."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = scratch(spark, "contamination")
    spark.createDataFrame([], _HITS).write.parquet(out)
    for index in shards(benchmark):
        held = spark.sparkContext.broadcast(index)

        def find(batches, held=held):
            for b in batches:
                hits = [(doc, item, *hit) for doc, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()) for item, hit in text_hits(held.value, raw or b"").items()]
                cols = list(zip(*hits)) if hits else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])

        rows.mapInArrow(find, _HITS).write.mode("append").parquet(out)
        held.destroy()
    # an item's rows may lie in several shards
    best = spark.read.schema(_HITS).parquet(out).groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "question_overlap", "answer_overlap", "first_word")).alias("hit"))
    return best.select("doc_id", "item_id", "hit.*")


def _body() -> list:
    """What tells texts apart in a join: two hashes and the length."""
    text = F.col("text").cast("string")
    return [F.xxhash64(text).alias("_h"), F.crc32(text.cast("binary")).alias("_c"), F.octet_length(text).alias("_n")]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item.

    The only shard of a usual benchmark filters the rows as they lie.  Further shards each write
    the few texts that they find, by hash, and these are anti-joined.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    found = None
    indexes = shards(benchmark)
    first, second = next(indexes, None), next(indexes, None)
    if first is None:
        return docs
    if second is None:
        return docs.where(~_holds(spark.sparkContext.broadcast(first))(F.col("text").cast("string")))
    out = scratch(spark, "contaminated")
    for index in chain([first, second], indexes):
        held = spark.sparkContext.broadcast(index)
        found = docs.where(_holds(held)(F.col("text").cast("string"))).select(*_body())
        found.write.mode("append").parquet(out)
        held.destroy()
    dirty = spark.read.schema(found.schema).parquet(out).distinct()
    row = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    return docs.select(row, *_body()).join(dirty, ["_h", "_c", "_n"], "left_anti").select("row.*")


def _holds(held):
    def holds(texts: pa.Array) -> pa.Array:
        return pa.array([bool(text_hits(held.value, x or b"", first_only=True)) for x in texts.cast(pa.binary()).to_pylist()], pa.bool_())

    return F.arrow_udf(holds, T.BooleanType())
