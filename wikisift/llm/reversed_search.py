"""Operator 13: ranked lexical search with the roles of query and index reversed.

The items are indexed, not the documents: a shard of the items' inverted index
(term -> items) is broadcast, and every document's term counts are streamed
through it.  A document's scores for all items that share a term with it are summed from the
lists of its terms; each task keeps, per item, the ``k`` best documents it has seen, and
the tasks' heaps are merged per item.  Documents are never shuffled: what a task
gives is at most ``k`` rows an item.

Shards are cut from the running total of the items' different terms, so one holds at most
2 x ``SHARD_TERMS`` of them, whatever the benchmark's size; a shard's statistics and
hits are written and its broadcast is destroyed before the next one.  An item of
more different terms than that is no part of a shard: its terms are joined with the documents' counts.

Defined results: null or empty text has no terms and no rank; documents of equal doc_id are documents of their
own (equal rows are interchangeable); equal scores rank by ascending doc_id, a null doc_id last; rows
with one item_id (also a null one) count as one item with the terms of all; very
long texts are read whole; empty documents or items give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikisift.llm.common import bounded_batches, persisted, scratch
from wikisift.operators.ordering import running_sum

K = 10
#: Different terms (summed over items) that bound a shard.
SHARD_TERMS = 200_000
#: Sums held at once, and postings visited at once.
CELLS = 4_000_000
#: Fixed numbers of the score.
UNIT, LENGTH_SHARE = 1000, 90

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII, with A-Z in lower case."""
    return raw.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(UNIT * math.log((2 * n_docs + 2) / (2 * df + 1)))


@F.arrow_udf(T.ArrayType(T.BinaryType()))
def _different_terms(texts: pa.Array) -> pa.Array:
    return pa.array([sorted(set(terms_of(x or b""))) for x in texts.cast(pa.binary()).to_pylist()], pa.list_(pa.binary()))


@dataclass
class Shard:
    """Postings of one shard: items of term ``t`` are items[first[t]:first[t + 1]]."""

    terms: dict[bytes, int]
    first: np.ndarray
    items: np.ndarray
    item_ids: list
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0


def build_shard(postings: list[tuple]) -> Shard:
    """``postings``: different (item_id, term) pairs."""
    place: dict = {}
    terms: dict[bytes, int] = {}
    pairs = np.array([(terms.setdefault(t, len(terms)), place.setdefault(i, len(place))) for i, t in postings], np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    first = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
    return Shard(terms, first, pairs[:, 1], list(place))


def batch_counts(get, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n of each text; row, term and tf of the known terms) of a batch."""
    sizes, known, rows = [], [], []
    for r, raw in enumerate(texts):
        words = terms_of(raw or b"")
        sizes.append(len(words))
        own = [t for w in words if (t := get(w)) is not None]
        known.append(np.array(own, np.int64))
        rows.append(np.full(len(own), r, np.int64))
    if not texts:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    term, row = np.concatenate(known), np.concatenate(rows)
    top = int(term.max(initial=0)) + 1
    key, tf = np.unique(row * top + term, return_counts=True)
    return np.array(sizes, np.int64), key // top, key % top, tf.astype(np.int64)


class Heaps:
    """The ``k`` best documents of each item seen so far, as flat sorted arrays."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.zeros(n_items, np.int64)  # a score below cannot enter
        none = np.zeros(0, np.int64)
        self.item, self.score, self.doc, self.null = none, none, none, np.zeros(0, bool)

    def add(self, item, score, doc, null) -> None:
        fit = score >= self.least[item]
        item, score, doc, null = (np.concatenate(p) for p in ((self.item, item[fit]), (self.score, score[fit]), (self.doc, doc[fit]), (self.null, null[fit])))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        starts = np.flatnonzero(np.append(True, item[1:] != item[:-1])) if len(item) else np.zeros(0, np.int64)
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        keep = place < self.k
        order = order[keep]
        self.item, self.score, self.doc, self.null = item[keep], score[order], doc[order], null[order]
        full = place[keep] == self.k - 1
        self.least[self.item[full]] = self.score[full]


def score_batch(shard: Shard, texts: list, docs: np.ndarray, nulls: np.ndarray, heaps: Heaps) -> None:
    """Stream one batch of documents through the shard."""
    sizes, row, term, tf = batch_counts(shard.terms.get, texts)
    if not len(row):
        return
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * sizes * shard.n_docs) // shard.n_terms
    gain = shard.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
    width = shard.first[term + 1] - shard.first[term]
    n_items = len(shard.item_ids)
    upto = np.concatenate(([0], np.cumsum(width)))
    a = 0
    while a < len(row):
        # whole documents: at most CELLS sums and, but for a single document, CELLS postings
        last = min(row[a] + max(1, CELLS // n_items), row[-1] + 1)
        z = int(np.searchsorted(row, last))
        if upto[z] - upto[a] > CELLS:
            z = int(np.searchsorted(upto, upto[a] + CELLS, side="right")) - 1
            z = max(int(np.searchsorted(row, row[max(z, a)])), int(np.searchsorted(row, row[a] + 1)))
        size = width[a:z]
        ends = np.cumsum(size)
        spot = np.arange(ends[-1]) + np.repeat(shard.first[term[a:z]] - (ends - size), size)
        n_rows = int(row[z - 1] - row[a]) + 1
        sums = np.zeros(n_rows * n_items, np.int64)
        np.add.at(sums, np.repeat((row[a:z] - row[a]) * n_items, size) + shard.items[spot], np.repeat(gain[a:z], size))
        hit = np.flatnonzero(sums)
        own = hit // n_items + row[a]
        heaps.add(hit % n_items, sums[hit], docs[own], nulls[own])
        a = z


def _columns(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list]:
    ids = b.column(0)
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False), b.column(1).cast(pa.binary()).to_pylist()


_STATS = "term int, n long"


def _statistics(rows: DataFrame, held) -> tuple[int, int, np.ndarray]:
    """(N, L, df of the shard's terms) over all documents."""

    def count(batches):
        shard = held.value
        df, docs, terms = np.zeros(len(shard.terms), np.int64), 0, 0
        for b in batches:
            sizes, _, term, _ = batch_counts(shard.terms.get, b.column(1).cast(pa.binary()).to_pylist())
            docs += int((sizes > 0).sum())
            terms += int(sizes.sum())
            np.add.at(df, term, 1)
        own = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-2, -1], own)), pa.int32()), pa.array(np.concatenate(([docs, terms], df[own])), pa.int64())], ["term", "n"])

    out = np.zeros(len(held.value.terms), np.int64)
    n_docs = n_terms = 0
    for r in rows.mapInArrow(count, _STATS).groupBy("term").agg(F.sum("n").alias("n")).collect():  # at most the shard's terms and two
        if r["term"] == -2:
            n_docs = r["n"]
        elif r["term"] == -1:
            n_terms = r["n"]
        else:
            out[r["term"]] = r["n"]
    return n_docs, n_terms, out


_HITS = "item_id long, doc_id long, score long"


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_shard(rows: DataFrame, shard: Shard, k: int, out: str) -> None:
    """Append the tasks' heaps for one shard's items to ``out``."""
    sc = rows.sparkSession.sparkContext
    held = sc.broadcast(shard)
    shard.n_docs, shard.n_terms, df = _statistics(rows, held)
    held.destroy()
    if not shard.n_terms:
        return
    shard.weights = np.array([weight(shard.n_docs, int(d)) for d in df], np.int64)
    held = sc.broadcast(shard)

    def search(batches):
        shard = held.value
        heaps = Heaps(len(shard.item_ids), k)
        for b in batches:
            docs, nulls, texts = _columns(b)
            score_batch(shard, texts, docs, nulls, heaps)
        ids = pa.array(shard.item_ids, pa.int64())
        doc = pa.array(heaps.doc, pa.int64(), mask=heaps.null) if len(heaps.doc) else pa.array([], pa.int64())
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(heaps.item, pa.int64())), doc, pa.array(heaps.score, pa.int64())], ["item_id", "doc_id", "score"])

    rows.mapInArrow(search, _HITS).write.mode("append").parquet(out)
    held.destroy()


_COUNTS = "uid long, doc_id long, n long, term binary, tf long"


def _count_rows(batches):
    """A row for every document and different term."""
    for b in batches:
        uid, n, term, tf, doc = [], [], [], [], []
        for u, d, raw in zip(*(b.column(c).to_pylist() for c in (2, 0)), b.column(1).cast(pa.binary()).to_pylist()):
            words = terms_of(raw or b"")
            own, counts = np.unique(np.array(words, object), return_counts=True) if words else ([], [])
            term += list(own)
            tf += list(map(int, counts))
            uid += [u] * len(own)
            doc += [d] * len(own)
            n += [len(words)] * len(own)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((uid, doc, n, term, tf), kinds)], ["uid", "doc_id", "n", "term", "tf"])


def _search_by_join(docs: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """The best documents of items too large for a shard, by joins on the term."""
    # counted rows are written: the row numbers in them must not be made twice
    counted = persisted(docs.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(_count_rows, _COUNTS), "search-counts")
    sizes = counted.groupBy("uid").agg(F.first("n").alias("n")).agg(F.count(F.lit(1)), F.sum("n")).first()
    n_docs, n_terms = sizes[0], sizes[1] or 1
    seen = counted.join(postings.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    gains = F.udf(lambda df: weight(n_docs, df), "long")  # one call a term
    weighed = postings.join(seen.select("term", gains("df").alias("w")), "term")
    score = F.expr(f"w * ((1000000000 * tf) div (1000 * tf + 8 * ({100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {n_docs}L) div {n_terms}L)))")
    sums = counted.join(weighed, "term").groupBy("item_id", "uid").agg(F.first("doc_id").alias("doc_id"), F.sum(score).alias("score"))
    return _best(sums.where("score > 0").select("item_id", "doc_id", "score"), k)


def _of_items(postings: DataFrame, items: DataFrame) -> DataFrame:
    return postings.alias("p").join(items.select("item_id").alias("i"), F.expr("p.item_id <=> i.item_id"), "left_semi")


def search(docs: DataFrame, items: DataFrame, k: int = K, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    terms = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(_different_terms(F.col("text").cast("string"))).alias("term"))
    postings = persisted(terms.distinct(), "search-postings")
    sizes = postings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    dealt = running_sum(sizes.where(F.col("n") <= shard_terms), ["item_id"], "n", "upto")
    dealt = persisted(dealt.select("item_id", F.floor((F.col("upto") - 1) / shard_terms).alias("shard")), "search-shards")
    out = scratch(spark, "search-hits")
    spark.createDataFrame([], _HITS).write.parquet(out)
    for s in range((dealt.agg(F.max("shard")).first()[0] + 1) if not dealt.isEmpty() else 0):
        own = _of_items(postings, dealt.where(F.col("shard") == s))
        pairs = [(r["item_id"], bytes(r["term"])) for r in own.collect()]  # at most 2 x shard_terms
        if pairs:
            _search_shard(rows, build_shard(pairs), k, out)
    best = _best(spark.read.schema(_HITS).parquet(out), k)
    large = sizes.where(F.col("n") > shard_terms)
    if not large.isEmpty():
        best = best.unionAll(_search_by_join(rows, _of_items(postings, large), k))
    return best
