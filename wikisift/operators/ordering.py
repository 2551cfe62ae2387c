"""Global order without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Instead: range-partition and sort, number rows inside each partition with
``monotonically_increasing_id`` (partition id in the upper bits, row index in
the lower 33), and add per-partition offsets.  The offset table has one row
per partition - its size is bounded by the partition count, not by the
data - so broadcasting it is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikisift.session import cut_lineage

_LOW33 = (1 << 33) - 1


def dense_index(df: DataFrame, order_cols: list, name: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order_cols`` order.

    ``order_cols`` must identify rows uniquely (add a key as the last column)
    so the numbering is deterministic.  The sorted frame is checkpointed once
    so the partition boundaries used by the count and the join agree, also
    after a lost executor.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    s = s.withColumn("_mid", F.monotonically_increasing_id())
    s = cut_lineage(s)
    s = s.withColumn("_pid", F.shiftrightunsigned("_mid", 33)).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit(_LOW33))
    )
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna({"_off": 0})
    return (
        s.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint"))
        .drop("_mid", "_pid", "_local", "_off")
    )


def running_sum(df: DataFrame, order_cols: list, value_col: str, name: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` plus the running total of ``value_col`` in ``order_cols`` order.

    One range shuffle; the sums inside a partition run over its sorted rows as
    they lie, and a table of one row per partition gives the offsets.  Give it
    narrow rows: all of ``df``'s columns move and are written once.
    """
    import numpy as np
    import pyarrow as pa

    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols).withColumn("_pid", F.spark_partition_id())
    at = s.columns.index(value_col)

    def sums(batches):
        total = 0
        for b in batches:
            run = total + np.cumsum(b.column(at).to_numpy(zero_copy_only=False).astype(np.int64))
            total = int(run[-1]) if len(run) else total
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(run, pa.int64())], [*b.schema.names, "_local"])

    s = cut_lineage(s.mapInArrow(sums, T.StructType([*s.schema.fields, T.StructField("_local", T.LongType())])))
    totals = s.groupBy("_pid").agg(F.max("_local").alias("_t"))  # values are not negative
    offsets = totals.select(
        "_pid", F.sum("_t").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_off")
    ).fillna({"_off": 0})
    return (
        s.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint"))
        .drop("_pid", "_local", "_off")
    )


def _openers(cum, before, start: int, cap: int):
    """Places of the chain of groups that place ``start`` opens: each next group
    opens at the first later place whose total passes the cap."""
    import numpy as np

    out = [start]
    while (at := max(out[-1] + 1, int(np.searchsorted(cum, before[out[-1]] + cap, side="right")))) < len(cum):
        out.append(at)
    return out


def greedy_groups(df: DataFrame, order_cols: list, size_col: str, cap: int, name: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name``: the number of the group that takes the row when rows are
    put in order into groups of at most ``cap``, a group closing before the row that
    would pass it (a row larger than ``cap`` is alone, behind an empty first group
    when it comes first).

    Exact, without a walk through all rows in one task.  Running totals come from
    :func:`running_sum`.  In each sorted partition, every row that may open the partition's first
    group (those of its first ``cap``) is followed to the last group
    it leads to there: one pass backwards over the partition's narrow rows.  These heads are
    linked to the heads they lead to in later partitions, and the chain from the first row is
    found by pointer doubling over the heads alone, in log2(partitions) rounds.  One
    number a partition comes to the driver.
    """
    import numpy as np
    import pyarrow as pa

    spark = df.sparkSession
    s = running_sum(df, order_cols, size_col, "_cum", num_partitions)
    s = cut_lineage(s.withColumn("_pid", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    ends = {r["_pid"]: r["e"] for r in s.groupBy("_pid").agg(F.max("_cum").alias("e")).collect()}  # a number a partition
    if not ends:
        return s.withColumn(name, F.lit(0).cast("long")).drop("_cum", "_pid", "_row")
    pids = sorted(ends)
    total = np.array([ends[p] for p in pids], np.int64)
    cum_at, size_at, pid_at, row_at = (s.columns.index(c) for c in ("_cum", size_col, "_pid", "_row"))

    def arrays(batches):
        got = [(b.column(pid_at)[0].as_py(), *(b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (cum_at, size_at))) for b in batches if b.num_rows]
        if not got:
            return None
        cum, size = (np.concatenate([g[k] for g in got]) for k in (1, 2))
        return got[0][0], cum, cum - size

    def heads(batches):
        if (own := arrays(batches)) is None:
            return
        pid, cum, before = own
        n = len(cum)
        following = np.maximum(np.arange(n) + 1, np.searchsorted(cum, before + cap, side="right"))
        count, last = np.ones(n, np.int64), np.arange(n)
        for k in range(n - 1, -1, -1):
            if following[k] < n:
                count[k], last[k] = count[following[k]] + 1, last[following[k]]
        first = np.flatnonzero(before < before[0] + cap) if n else np.zeros(0, np.int64)
        first = first if len(first) else np.zeros(1, np.int64)
        limit = before[last[first]] + cap
        at = pids.index(pid)
        to = np.maximum(np.searchsorted(total, limit, side="right"), at + 1)
        cols = (np.full(len(first), at), first, cum[first], count[first], limit, to)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], ["part", "place", "total", "groups", "limit", "to"])

    table = cut_lineage(s.mapInArrow(heads, "part long, place long, total long, groups long, limit long, to long"))
    head = F.struct("part", "place")
    # the head that a head leads to: the first of its target partition whose total passes its limit
    own = table.select(F.col("part").alias("at"), F.col("total").alias("v"), F.lit(0).alias("kind"), F.col("place").alias("o"), head.alias("head"), F.lit(None).cast("long").alias("groups"))
    ask = table.where(F.col("to") < len(pids)).select(F.col("to").alias("at"), F.col("limit").alias("v"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("o"), head.alias("head"), "groups")
    later = Window.partitionBy("at").orderBy("v", "kind", "o").rowsBetween(1, Window.unboundedFollowing)
    both = own.unionByName(ask).withColumn("next", F.first(F.when(F.col("kind") == 0, F.col("head")), ignorenulls=True).over(later))
    jump = cut_lineage(both.where("kind = 1 AND next IS NOT NULL").select("head", "next", "groups"))
    chain = cut_lineage(table.where("part = 0 AND place = 0").select(head.alias("head"), F.lit(0).cast("long").alias("number")))
    for _ in range(len(pids).bit_length()):
        more = chain.join(jump, "head").select(F.col("next").alias("head"), (F.col("number") + F.col("groups")).alias("number"))
        chain = cut_lineage(chain.unionByName(more).distinct())
        step = jump.select(F.col("head").alias("next"), F.col("next").alias("after"), F.col("groups").alias("g"))
        jump = cut_lineage(jump.join(step, "next").select("head", F.col("after").alias("next"), (F.col("groups") + F.col("g")).alias("groups")))
    # at most one head a partition lies on the chain
    entry = {r["part"]: (r["place"], r["number"], r["groups"]) for r in table.join(chain.select("head.*", "number"), ["part", "place"]).collect()}
    plan, number = {}, 0
    for k, p in enumerate(pids):
        place, first, groups = entry.get(k, (None, number, 0))
        plan[p] = (place, number)
        number = first + groups

    first_size = s.orderBy("_row").limit(1).select(size_col).first()[0]
    shift = 1 if first_size > cap else 0
    out_type = T.StructType([*s.schema.fields, T.StructField(name, T.LongType())])

    def place_rows(batches):
        held = [b for b in batches if b.num_rows]
        if (own := arrays(held)) is None:
            return
        pid, cum, before = own
        start, number = plan[pid]  # rows before ``start`` go on with the group that is open
        numbers = np.full(len(cum), number - 1, np.int64)
        if start is not None:
            opened = np.array(_openers(cum, before, start, cap))
            numbers = number - 1 + np.searchsorted(opened, np.arange(len(cum)), side="right")
        at = 0
        for b in held:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers[at : at + b.num_rows] + shift, pa.int64())], [*b.schema.names, name])
            at += b.num_rows

    return s.mapInArrow(place_rows, out_type).drop("_cum", "_pid", "_row")
