"""Operator 1: SimHash near-duplicates by segment popcounts.

A fingerprint of 64 bits is embedded as the bit counts of its 32 two-bit
segments, a point with coordinates 0..2.  Flipping a bit moves one coordinate
by one, so the Manhattan distance of two points is a lower bound of their
Hamming distance, and a range join under Manhattan distance with radius 3
returns every pair within 3 bits.

Range join on a grid: the coordinates form two halves of 16.  Points within
Manhattan distance 3 are within 1 in one half.  A half is a grid cell (its 16
counts, 32 bits); a point stands in its own cell and, as a *visitor*, in
the cells one step up, so two points one step apart meet in the upper one's
cell.  Only a cell's own points pair with each other and with its visitors.
Every meeting is checked against the whole Manhattan distance and then
exactly, by XOR and popcount.

Only different fingerprints take part (copies are grouped first).  A cell
with more than ``BLOCK`` points is dealt out as pairs of blocks, so no task
ever holds more than two blocks of it; per block pair a spanning forest of the
verified links leaves the task, not all links of a dense group: the forest has
the same components.

Defined results: null or blank text = fingerprint zero, linked like any other;
null doc_id rows carry a fingerprint and the component's smallest non-null id
(null if it has none); repeated rows each get a row; only doc_id and text are
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wikisift.llm.common import bounded_batches, drop_scratch, scratch
from wikisift.llm.graph import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Own points (or visitors) of a cell in one block; a task compares two blocks.
BLOCK = 2048
_CHUNK = 1 << 16
_EVEN = np.uint64(0x5555555555555555)


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text (UTF-8), in blocks of bounded memory."""
    words = raw.lower().split()
    if not words:
        return 0
    n = len(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        starts = np.concatenate(([0], ends[:-1]))
        hashes = (digest(line[a:b], SEED) for a, b in zip(starts[: n - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist()))
    total, count, it = np.zeros(64, np.int64), 0, iter(hashes)
    size = max(1, n - shingle + 1)
    while count < size:
        m = min(_CHUNK, size - count)
        part = np.fromiter(it, np.uint64, m)
        total += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(m, 8), axis=1).sum(axis=0, dtype=np.int64)
        count += m
    bits = np.packbits(2 * total > count)
    return int(bits.view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprint_udf(shingle: int = SHINGLE):
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x or b"", shingle) for x in texts.cast(pa.binary()).to_pylist()], pa.int64())

    return F.arrow_udf(prints, "long")


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """The 32 two-bit popcounts of each fingerprint, packed two bits each."""
    fp = fp.astype(np.uint64)
    return (fp & _EVEN) + ((fp >> np.uint64(1)) & _EVEN)


def unary(counts: np.ndarray) -> np.ndarray:
    """Packed counts 0, 1, 2 as bits 00, 01, 11: the Manhattan distance of two
    points is then the popcount of the XOR of their codes."""
    return ((counts | (counts >> np.uint64(1))) & _EVEN) | (counts & ~_EVEN)


def _cells(batches):
    """Rows (half, cell, fp, own): a point's own cells and those one step up."""
    step = np.uint64(1) << np.arange(0, 32, 2, dtype=np.uint64)
    for b in batches:
        fp = b.column(0).to_numpy()
        counts = segment_counts(fp.view(np.uint64))
        out = []
        for half in range(2):
            cell = (counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
            level = (cell[:, None] >> np.arange(0, 32, 2, dtype=np.uint64)) & np.uint64(3)
            row, seg = np.nonzero(level < 2)
            up = cell[row] + step[seg]
            out.append((np.full(len(cell) + len(up), half, np.int8), np.concatenate((cell, up)).astype(np.int64),
                        np.concatenate((fp, fp[row])), np.arange(len(cell) + len(up)) < len(cell)))
        cols = [np.concatenate(x) for x in zip(*out)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["half", "cell", "fp", "own"])


def _forest(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links a[i]-b[i] (indices into ``fps``)."""
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def block_links(left: np.ndarray, own_left: np.ndarray, right: np.ndarray | None, own_right: np.ndarray | None, max_bits: int) -> list[tuple[int, int]]:
    """Forest of verified links within a block (right None) or between two.

    Two visitors of a cell are no pair of that cell.
    """
    fps = left if right is None else np.concatenate((left, right))
    u = fps.view(np.uint64)
    own = own_left if right is None else np.concatenate((own_left, own_right))
    n, first = len(fps), len(left)
    links_a, links_b = [], []
    code = unary(segment_counts(u))
    for at in range(0, first, 256):
        rows = np.arange(at, min(at + 256, first))
        cols = np.arange(at + 1, n) if right is None else np.arange(first, n)
        if not len(cols):
            continue
        close = np.bitwise_count(code[rows][:, None] ^ code[cols][None, :]) <= max_bits  # Manhattan
        close &= own[rows][:, None] | own[cols][None, :]
        if right is None:
            close &= cols[None, :] > rows[:, None]
        i, j = np.nonzero(close)
        i, j = rows[i], cols[j]
        exact = np.bitwise_count(u[i] ^ u[j]) <= max_bits
        links_a.append(i[exact])
        links_b.append(j[exact])
    if not links_a:
        return []
    return [(int(fps[x]), int(fps[y])) for x, y in _forest(fps, np.concatenate(links_a), np.concatenate(links_b))]


def _meet(max_bits: int):
    """mapInArrow over rows sorted by (half, cell, i, j): links of each block pair."""

    def links(key, fp, own, side):
        _, _, i, j = key
        if i == j:
            return block_links(fp, own, None, None, max_bits)
        first = side == i
        return block_links(fp[first], own[first], fp[~first], own[~first], max_bits)

    def run(batches):
        held, last = [], None
        for b in batches:
            half, cell, i, j, side, fp, own = (b.column(k).to_numpy(zero_copy_only=False) for k in range(7))
            if not len(fp):
                continue
            change = np.flatnonzero((half[1:] != half[:-1]) | (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            out = []
            for a, z in zip([0, *change.tolist()], [*change.tolist(), len(fp)]):
                key = (half[a], cell[a], i[a], j[a])
                if key != last and held:
                    out += links(last, *(np.concatenate(x) for x in zip(*held)))
                    held = []
                held.append((fp[a:z], own[a:z], side[a:z]))
                last = key
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])
        if held:
            out = links(last, *(np.concatenate(x) for x in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) links among the different fingerprints ``fps`` (fp long) with the
    same components as all pairs within ``max_bits`` (at most 3) bits."""
    if max_bits > 3:
        raise ValueError("two halves of one step cover distances up to 3")
    cells = fps.select("fp").mapInArrow(_cells, "half byte, cell long, fp long, own boolean")
    sizes = (cells.groupBy("half", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("met"))
             .where("n > 1 AND met").select("half", "cell", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    meeting = cells.join(sizes, ["half", "cell"]).withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = meeting.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("half", "cell", F.least("side", "other").cast("int").alias("i"), F.greatest("side", "other").cast("int").alias("j"), "side", "fp", "own")
    dealt = dealt.repartition("half", "cell", "i", "j").sortWithinPartitions("half", "cell", "i", "j")
    return dealt.mapInArrow(_meet(max_bits), "a long, b long")


def _components(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) for every different fingerprint of ``prints``."""
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    root = connected_components(fingerprint_links(least.select("fp"), max_bits))
    rooted = least.join(root, least["fp"] == root["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = scratch(spark, "prints")
    udf = fingerprint_udf(shingle)
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), udf(F.col("text").cast("string")).alias("fp")).write.parquet(path)
    prints = spark.read.schema("doc_id long, fp long").parquet(path)
    return prints.join(_components(prints, max_bits), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id.

    Rows are told apart by doc_id and a 64-bit hash of the text, so a repeated
    doc_id with another text is judged by its own component, and of equal rows
    one stays.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path = scratch(spark, "prints")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), fingerprint_udf(shingle)(F.col("text").cast("string")).alias("fp"))
     .write.parquet(path))
    prints = spark.read.schema("doc_id long, th long, fp long").parquet(path)
    # hit rows of one (id, text) share a fingerprint, hence a component
    kept = (prints.join(_components(prints.select("doc_id", "fp"), max_bits), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.first("component_id").alias("own_id"), F.min("th").alias("own_th")))
    row = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("keep_id"), F.xxhash64(text).alias("keep_th"))
    hit = row.join(kept, F.col("keep_id").eqNullSafe(F.col("own_id")) & (F.col("keep_th") == F.col("own_th")))
    one = hit.withColumn("nth", F.row_number().over(Window.partitionBy("keep_id", "keep_th").orderBy("root")))
    return one.where("nth = 1").select("row.*")
