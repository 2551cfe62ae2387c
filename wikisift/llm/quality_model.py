"""Operator 8: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed once and written.  The trees
are grown from a bounded sample of labelled rows (``MAX_ROWS``, the smallest
hashes of doc_id): features are binned by quantiles, each level of a tree is
one histogram per feature, and the finished trees lie flattened in arrays
(feature, threshold, children, value).  Scoring walks all trees of a batch of
rows at once, one array step per level.

Defined results: empty or null text is scored like any other (its
statistics are zeros); null doc_id is never a training row and not held out;
a document with several label rows counts once each; without labels, or
with labels of one class, every score is the prior (0.5 without any label);
only doc_id and text of `documents`, doc_id and quality of `labels` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikisift.llm.common import bounded_batches, scratch

#: Training rows at most; the sample's bound.
MAX_ROWS = 20_000
TREES, DEPTH, BINS, RATE, MIN_LEAF, L2 = 60, 4, 64, 0.15, 20, 1.0
THRESHOLD = 0.7
HELD_OUT = 2

_SETS = {
    "upper": bytes(range(65, 91)), "digit": b"0123456789", "symbol": b"#*$%&|<>", "stop": b".?!", "comma": b",;:",
    "shout": b"!", "bracket": b"()[]{}", "quote": b"\"'", "other": b"@_~^`=+\\/-",
}
FEATURES = ["log_words", "word_len", "word_len_sd", "long_words", "distinct", "distinct_pairs", "top_word", "log_lines", "dup_lines", "words_line", "max_line", *_SETS, "non_ascii"]


def document_features(raw: bytes) -> list[float]:
    """Statistics of one text (UTF-8)."""
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    sizes = np.fromiter(map(len, words), np.int64, n)
    chars = int(sizes.sum())
    held = b"".join(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    top = int(np.bincount(ids).max())
    pairs = np.sort(ids[:-1] * len(number) + ids[1:])
    lines = [x for x in raw.split(b"\n") if x.strip()]
    per_line = [len(x) for x in lines]
    out = [np.log(n), chars / n, float(sizes.std()), float((sizes > 12).mean()), len(number) / n,
           (1 + np.count_nonzero(pairs[1:] != pairs[:-1])) / (n - 1) if n > 1 else 1.0, top / n,
           np.log(len(lines)), 1 - len(set(lines)) / len(lines), n / len(lines), float(np.log(max(per_line)))]
    out += [(chars - len(held.translate(None, s))) / chars for s in _SETS.values()]
    out.append(float(np.count_nonzero(np.frombuffer(held, np.uint8) >= 128)) / chars)
    return out


@F.arrow_udf(T.ArrayType(T.FloatType()))
def features_udf(texts: pa.Array) -> pa.Array:
    return pa.array([document_features(x or b"") for x in texts.cast(pa.binary()).to_pylist()], pa.list_(pa.float32()))


@dataclass
class Forest:
    """Flattened trees.  Leaves point to themselves, so a walk may overstay."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.prior + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _bins(x: np.ndarray) -> list[np.ndarray]:
    """Upper edges of each feature's bins (last bin open)."""
    return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for labels ``y`` (0/1) on features ``x``."""
    x = x.astype(np.float32)
    n, p = x.shape if len(x) else (0, len(FEATURES))
    share = float(y.mean()) if n else 0.5
    parts = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    flat = lambda prior: Forest(*(np.array(parts[k], t) for k, t in (("feature", np.int64), ("threshold", np.float32), ("left", np.int64), ("right", np.int64), ("value", float))),
                                np.array(roots, np.int64), DEPTH, prior)
    if not n or not 0 < share < 1:
        # one class only: a Laplace-smoothed prior
        share = (float(y.sum()) + 1) / (n + 2) if n else 0.5
        parts["feature"], parts["threshold"], parts["left"], parts["right"], parts["value"] = [0], [0.0], [0], [0], [0.0]
        roots.append(0)
        return flat(float(np.log(share / (1 - share))))
    edges = _bins(x)
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    prior = float(np.log(share / (1 - share)))
    margin = np.full(n, prior)
    for _ in range(TREES):
        prob = 1 / (1 + np.exp(-margin))
        grad, hess = prob - y, prob * (1 - prob)
        base = len(parts["feature"])
        roots.append(base)
        node = np.zeros(n, np.int64)  # place in this level
        level = [base]
        for k in ("feature", "threshold", "left", "right", "value"):
            parts[k].append(0 if k != "value" else 0.0)
        parts["left"][base] = parts["right"][base] = base
        place = np.full(n, base)
        for depth in range(DEPTH + 1):
            m = len(level)
            live = node >= 0
            g = np.bincount(node[live], grad[live], m)
            h = np.bincount(node[live], hess[live], m)
            for i, at in enumerate(level):
                parts["value"][at] = float(-RATE * g[i] / (h[i] + L2))
            if depth == DEPTH:
                break
            best = np.full(m, 1e-6)
            split: list = [None] * m
            for f in range(p):
                key = node[live] * BINS + binned[live, f]
                hg = np.bincount(key, grad[live], m * BINS).reshape(m, BINS).cumsum(1)
                hh = np.bincount(key, hess[live], m * BINS).reshape(m, BINS).cumsum(1)
                hn = np.bincount(key, minlength=m * BINS).reshape(m, BINS).cumsum(1)
                total = hn[:, -1:]
                gain = hg**2 / (hh + L2) + (g[:, None] - hg) ** 2 / (h[:, None] - hh + L2) - (g**2 / (h + L2))[:, None]
                gain[(hn < MIN_LEAF) | (total - hn < MIN_LEAF)] = -1
                gain[:, len(edges[f]) :] = -1
                top = gain.argmax(1)
                for i in np.flatnonzero(gain[np.arange(m), top] > best).tolist():
                    best[i], split[i] = gain[i, top[i]], (f, int(top[i]))
            following: list[int] = []
            new_node = np.full(n, -1)
            for i, at in enumerate(level):
                if split[i] is None:
                    continue
                f, cut = split[i]
                here = node == i
                right = here & (binned[:, f] > cut)
                parts["feature"][at], parts["threshold"][at] = f, float(edges[f][cut])
                for side, mask in (("left", here & ~right), ("right", right)):
                    child = len(parts["feature"])
                    for k in ("feature", "threshold", "left", "right", "value"):
                        parts[k].append(0 if k not in ("left", "right") else child)
                    parts[side][at] = child
                    new_node[mask] = len(following)
                    place[mask] = child
                    following.append(child)
            if not following:
                break
            node, level = new_node, following
        margin += np.array(parts["value"])[place]
    return flat(prior)


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def training_rows(features: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(x, quality) of at most ``max_rows`` labelled rows that are not held out:
    those with the smallest hashes of doc_id.

    A first cut by the hash leaves little more than ``max_rows`` rows, so the final
    order and limit work on a bounded set, however many rows are labelled.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality IS NOT NULL")
    rows = features.join(known.where(~held_out(F.col("doc_id"))), "doc_id").withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
    total = rows.count()
    if total > max_rows:
        rows = rows.where(F.col("place") < int((1 << 30) * (1.1 * max_rows + 100) / total))
    return rows.orderBy("place", "doc_id", "quality", "x").limit(max_rows).select("x", "quality")


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = scratch(spark, "features")
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), features_udf(F.col("text").cast("string")).alias("x")).write.parquet(path)
    rows = spark.read.schema("doc_id long, x array<float>").parquet(path)
    sample = training_rows(rows, labels, max_rows).collect()
    forest = grow(np.array([r["x"] for r in sample], np.float32).reshape(-1, len(FEATURES)), np.array([r["quality"] for r in sample], float))

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        flat = x.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, len(FEATURES))
        return pa.array(forest.score(flat), pa.float64())

    return (rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("x").alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
