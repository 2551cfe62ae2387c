"""Operator 3: line de-duplication over levelled sorted runs.

The seen line keys live in *runs*: tables bucketed and sorted by the key's
128-bit hash.  Documents come in batches, ascending in doc_id.  A batch

1. reduces its (document, key) rows to one row per key, the smallest holder;
2. merge-anti-joins that with the runs: keys found there belong to an earlier
   document, the others to their smallest holder in the batch;
3. notes every (document, key) that is not the holder, to be dropped, with
   the row that it stands in;
4. writes its new keys as a level-0 run.  ``FANOUT`` runs of a level are
   merged into one run of the next level, so the number of runs stays
   logarithmic in the number of batches.

Runs share their bucketing, so the merge joins and compactions move no run
row.  A key in a third of all documents is reduced map-side in step 1; in step
3 it is a skewed join side, which AQE splits.  Dropped hashes are gathered per
row (doc_id and a hash of the text), not per document, so that an array is
bounded by one row's own lines though a third of the rows share one doc_id or
have none.  Rows of equal doc_id and text share an array; so would two texts of
equal hash, which changes no result, as drops are decided by document.

Defined results: null or empty text = one empty line; null doc_id = one
document that comes after all others; rows that repeat a doc_id count as one
document (its lines never make each other duplicates); other columns of the
input are not read.  Keys are compared by two 64-bit hashes (128 bits).
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikisift.llm.common import bounded_batches, drop_scratch, scratch

#: Keys shorter than this many code points are never dropped.
MIN_CHARS = 10
#: Batches one table is split into (by doc_id quantiles); runs merged at once.
BATCHES = 4
FANOUT = 3
#: Buckets of a run when the session does not say how many partitions to use.
NULL_ID = 2**63 - 1


def line_hash(line: bytes) -> bytes | None:
    """The 128-bit hash of a line's key; None when the key is too short."""
    key = line.strip().lower()  # bytes: ASCII white space and A-Z only
    if len(key) < MIN_CHARS or len(key) < 4 * MIN_CHARS and len(key.decode()) < MIN_CHARS:
        return None
    return xxhash.xxh3_128_digest(key)


_LINES = "doc long, body long, h binary"


def _row_key() -> list[Column]:
    """doc (null doc_id is NULL_ID) and body, a hash of the text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(F.col("text").cast("string")).alias("body")]


def _hash_rows(batches):
    for b in batches:
        ids, bodies, keys = [], [], []
        for i, body, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
            found = {h for x in (raw or b"").split(b"\n") if (h := line_hash(x))}
            ids += [i] * len(found)
            bodies += [body] * len(found)
            keys += found
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bodies, pa.int64()), pa.array(keys, pa.binary())], ["doc", "body", "h"])


def document_lines(docs: DataFrame) -> DataFrame:
    """(doc, body, h): the different line keys of each row."""
    bounded_batches(docs.sparkSession)
    return docs.select(*_row_key(), F.col("text").cast("string")).mapInArrow(_hash_rows, _LINES)


class Runs:
    """The levelled sorted runs of the keys seen so far (a set of hashes)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int, fanout: int = FANOUT):
        self.spark, self.root, self.buckets, self.fanout = spark, root, buckets, fanout
        self.levels: list[list[str]] = []

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (keys.repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").sortBy("h")
         .option("path", f"{self.root}/{name}").saveAsTable(name))
        return name

    def tables(self) -> list[str]:
        return [t for level in self.levels for t in level]

    def add(self, keys: DataFrame) -> None:
        """``keys`` (h, none of them in the runs) as a level-0 run; compact."""
        level, name = 0, self._write(keys.select("h"))
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(name)
            if len(self.levels[level]) < self.fanout:
                return
            old, self.levels[level] = self.levels[level], []
            merged = self.spark.table(old[0])
            for t in old[1:]:
                merged = merged.unionAll(self.spark.table(t))  # runs are disjoint
            name, level = self._write(merged), level + 1
            self._forget(old)

    def without(self, keys: DataFrame) -> DataFrame:
        """Rows of ``keys`` whose hash no run holds: one merge anti-join a run."""
        for t in self.tables():
            keys = keys.join(self.spark.table(t).hint("merge"), "h", "left_anti")
        return keys

    def _forget(self, tables: list[str]) -> None:
        for t in tables:
            self.spark.sql(f"DROP TABLE {t}")
            drop_scratch(self.spark, f"{self.root}/{t}")

    def close(self) -> None:
        self._forget(self.tables())
        self.levels = []


def add_batch(runs: Runs, lines: DataFrame, out: str) -> None:
    """Decide one batch against the runs; append its (doc, body, h) drops to ``out``.

    ``lines`` (doc, body, h) must hold no document smaller than an earlier batch's.
    """
    spark = lines.sparkSession
    holder = lines.groupBy("h").agg(F.min("doc").alias("holder"), F.max("doc").alias("last"))
    path = scratch(spark, "line-new")
    runs.without(holder).write.parquet(path)
    new = spark.read.parquet(path)
    # a key with one new holder drops nothing; every other key of the batch
    # drops all its documents but a new key's holder
    kept = new.select("h", "holder", (F.col("last") == F.col("holder")).alias("single"))
    drops = lines.join(kept, "h", "left").where("holder IS NULL OR (NOT single AND doc <> holder)").select("doc", "body", "h")
    drops.write.mode("append").parquet(out)
    runs.add(new)
    drop_scratch(spark, path)


def line_drops(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc, body, dropped): per row the hashes of the lines it loses."""
    spark = docs.sparkSession
    root = scratch(spark, "lines")
    document_lines(docs).write.parquet(f"{root}/lines")
    lines = spark.read.schema(_LINES).parquet(f"{root}/lines")
    cuts = sorted({c for c in lines.agg(F.percentile_approx("doc", [k / batches for k in range(1, batches)], 10_000).alias("c")).first()["c"] or []})
    edges = [None, *cuts, None]
    runs = Runs(spark, root, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")), fanout=fanout)
    spark.createDataFrame([], _LINES).write.parquet(f"{root}/drops")
    for low, high in zip(edges, edges[1:]):
        batch = lines
        if low is not None:
            batch = batch.where(F.col("doc") > low)
        if high is not None:
            batch = batch.where(F.col("doc") <= high)
        add_batch(runs, batch, f"{root}/drops")
    runs.close()
    drop_scratch(spark, f"{root}/lines")
    drops = spark.read.schema(_LINES).parquet(f"{root}/drops")
    # a set, as rows of equal doc_id and text repeat their hashes
    return drops.groupBy("doc", "body").agg(F.collect_set("h").alias("dropped"))


_RESULT = T.StructType([T.StructField("n_lines", T.LongType(), False), T.StructField("n_dropped", T.LongType(), False),
                        T.StructField("kept_sha256", T.StringType(), False), T.StructField("kept_text", T.StringType(), False)])


def strip_lines(raw: bytes, dropped: frozenset | set) -> tuple[int, int, bytes]:
    lines = raw.split(b"\n")
    kept = [x for x in lines if line_hash(x) not in dropped] if dropped else lines
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


@F.arrow_udf(_RESULT)
def _strip(texts: pa.Array, dropped: pa.Array) -> pa.Array:
    rows = []
    for raw, drop in zip(texts.cast(pa.binary()).to_pylist(), dropped.to_pylist()):
        n, gone, kept = strip_lines(raw or b"", set(drop or ()))
        rows.append((n, gone, hashlib.sha256(kept).hexdigest(), kept.decode()))
    a, b, c, d = zip(*rows) if rows else ([], [], [], [])
    return pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string()), pa.array(d, pa.string())],
                                      fields=[pa.field("n_lines", pa.int64(), False), pa.field("n_dropped", pa.int64(), False),
                                              pa.field("kept_sha256", pa.string(), False), pa.field("kept_text", pa.string(), False)])


def _with_drops(docs: DataFrame, columns: list[str], batches: int, fanout: int) -> DataFrame:
    """(row, n_lines, n_dropped, kept_sha256, kept_text), row = ``columns``."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*(F.col(c) for c in columns)).alias("row"), F.col("text").cast("string").alias("text"), *_row_key())
    both = rows.join(line_drops(docs, batches, fanout), ["doc", "body"], "left")
    return both.select("row", _strip("text", "dropped").alias("s")).select("row", "s.*")


def line_dedup(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 and kept_text of every row."""
    out = _with_drops(docs, ["doc_id"], batches, fanout)
    return out.select("row.doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text")


def drop_repeated_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with the kept lines as text and n_chars, where there is one, counted anew."""
    out = _with_drops(docs, docs.columns, batches, fanout)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))
