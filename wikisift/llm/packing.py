"""Operator 5: pack documents into sequences along a Hilbert curve.

Each document's token ids are hashed into a count vector, which a fixed sign
matrix projects to three dimensions; the Hilbert key of that point orders the
corpus, so neighbours on the curve are alike.  Rows are dealt by ranges of
the key, and the ids of all documents, laid end to end along the curve, are cut
every ``LENGTH`` ids.  The end of the corpus, shorter than a sequence, is cut at
the powers of two of its binary form, so no sequence holds padding.

The ids are computed once and written; key ranges of even tokens and their offsets
come from the narrow columns of that table (a bounded list of sums reaches the
driver), and one shuffle by range brings the ids into order.  Equal documents share a curve
point, so the key's lower bits are a hash of doc_id and ids: copies spread over
ranges instead of filling one.

Defined results: null or empty text = the closing id alone; null doc_id is kept
as null; repeated rows are packed each (equal rows are interchangeable); only
doc_id and text are read; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikisift.llm.common import bounded_batches, scratch
from wikisift.llm.tokens import encoder

LENGTH = 2048
CLOSING_ID = 1
#: Buckets of the hashed count vector, dimensions and bits a dimension.
HASHED, DIMS, BITS = 1024, 3, 10
#: Tokens that one range (a task's share of the sorted stream) should hold; ranges at
#: most (beyond, each holds more), and small ranges they are merged from.
RANGE_TOKENS, MAX_RANGES, FINE = 4_000_000, 20_000, 8


@lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(5))
    return rng.choice(np.array([-1.0, 1.0]), size=(HASHED, DIMS))


def project(ids: np.ndarray) -> np.ndarray:
    """The document's point: integer coordinates of ``BITS`` bits."""
    slots = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(np.int64)
    counts = np.bincount(slots, minlength=HASHED).astype(float)
    norm = np.linalg.norm(counts)
    point = (counts / norm if norm else counts) @ _signs()
    top = (1 << BITS) - 1
    return np.clip(np.rint((np.tanh(point / 2) + 1) / 2 * top), 0, top).astype(np.int64)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each point (rows of coordinates) on the Hilbert curve.

    The curve's cell orientation is undone bit plane by bit plane, from the top;
    the transposed coordinates are then one Gray-coded number.
    """
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


_SPREAD_BITS = 63 - DIMS * BITS


def _encode(batches):
    enc = encoder()
    kind = np.dtype("<u2") if enc.size <= 1 << 16 else np.dtype("<u4")
    for b in batches:
        ids, sizes, points, tails, blobs = b.column(0), [], [], [], []
        for doc, text in zip(ids.to_pylist(), b.column(1).to_pylist()):
            got = np.append(enc.file_ids(text or ""), np.uint32(CLOSING_ID))
            blob = got.astype(kind).tobytes()
            sizes.append(len(got))
            points.append(project(got))
            tails.append(zlib.crc32(blob, zlib.crc32(str(doc).encode())))
            blobs.append(blob)
        key = (hilbert_key(np.array(points)) << _SPREAD_BITS) | (np.array(tails, np.int64) << (_SPREAD_BITS - 32)) if points else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([ids, pa.array(key, pa.int64()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())], ["doc_id", "curve", "n", "ids"])


def tail_cuts(total: int, length: int = LENGTH) -> list[int]:
    """Ends of the sequences after the last whole one: the set bits of the rest."""
    at, out = total - total % length, []
    for k in range(length.bit_length(), -1, -1):
        if total % length & (1 << k):
            at += 1 << k
            out.append(at)
    return out


def cut_pieces(at: int, n: int, total: int, length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """(start in the document, length, sequence, offset) of the pieces of a
    document whose ids fill [at, at + n) of the corpus' ``total`` ids."""
    whole = total // length
    tail = tail_cuts(total, length) if at + n > whole * length else []
    out, start = [], 0
    while start < n:
        pos = at + start
        if pos < whole * length:
            seq, first = divmod(pos, length)
            end = (seq + 1) * length
            out.append((start, min(end - pos, n - start), seq, first))
        else:
            k = next(i for i, e in enumerate(tail) if e > pos)
            first = tail[k - 1] if k else whole * length
            out.append((start, min(tail[k] - pos, n - start), whole + k, pos - first))
        start += out[-1][1]
    return out


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _cut(firsts: dict[int, int], total: int, length: int, wide: bool, with_ids: bool):
    kind = np.dtype("<u4") if wide else np.dtype("<u2")

    def run(batches):
        part, at = None, 0
        for b in batches:
            rows, blobs = [], []
            for bucket, doc, n, blob in zip(*(b.column(k).to_pylist() for k in range(4))):
                if bucket != part:
                    part, at = bucket, firsts[bucket]
                ids = np.frombuffer(blob, kind).astype("<u4")
                for start, size, seq, offset in cut_pieces(at, n, total, length):
                    piece = ids[start : start + size].tobytes()
                    rows.append((doc, start, size, zlib.crc32(piece), n, seq, offset))
                    blobs.append(piece)
                at += n
            cols = list(zip(*rows)) if rows else [[]] * 7
            arrays = [pa.array(c, pa.int64()) for c in cols] + ([pa.array(blobs, pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids)

    return run


def _bucket(bounds: np.ndarray):
    def bucket(curve: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, curve.to_numpy(zero_copy_only=False), side="left"), pa.int32())

    return F.arrow_udf(bucket, T.IntegerType())


def _ranges(rows: DataFrame, total: int, ranges: int) -> tuple[np.ndarray, dict[int, int]]:
    """Inner bounds of key ranges of about equal tokens, and the first token of each.

    Quantiles of the key give ``FINE`` times as many small ranges; their token
    sums (a number each, at most FINE x MAX_RANGES) are merged to even ones.
    """
    if ranges == 1:
        return np.zeros(0, np.int64), {0: 0}
    n = FINE * ranges
    fine = np.array(sorted(set(rows.agg(F.percentile_approx("curve", [k / n for k in range(1, n)], 20 * n)).first()[0])), np.int64)
    sums = {r["b"]: r["n"] for r in rows.groupBy(_bucket(fine)("curve").alias("b")).agg(F.sum("n").alias("n")).collect()}
    bounds, firsts, at, last = [], {0: 0}, 0, 0
    for k in range(len(fine) + 1):
        if at * ranges // total > last:
            last = at * ranges // total
            bounds.append(fine[k - 1])
            firsts[len(bounds)] = at
        at += sums.get(k, 0)
    return np.array(bounds, np.int64), firsts


def pack(docs: DataFrame, length: int = LENGTH, range_tokens: int = RANGE_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset; ``with_ids`` adds the ids (little-endian 32-bit)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = scratch(spark, "ids")
    schema = "doc_id long, curve long, n long, ids binary"
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_encode, schema).write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    total = rows.agg(F.sum("n")).first()[0] or 0
    bounds, firsts = _ranges(rows, total, min(MAX_RANGES, max(1, -(-total // range_tokens))))
    dealt = rows.withColumn("part", _bucket(bounds)("curve"))
    placed = dealt.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "curve", "doc_id", "n", "ids")
    out = _PIECES + (", ids binary" if with_ids else "")
    return placed.select("part", "doc_id", "n", "ids").mapInArrow(_cut(firsts, total, length, encoder().size > 1 << 16, with_ids), out)
