"""Connected components of an edge table, without the driver seeing a node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikisift.llm.common import drop_scratch, scratch


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long).

    Alternating stars: each round links every larger neighbour of a node to
    the smallest one (large star), then every smaller neighbour likewise
    (small star), until the forest is stars around each component's smallest
    node.  Rounds grow with the logarithm of the longest path.  A star's
    centre is a hot key: its minimum is reduced map-side, and the join back is
    a plain shuffled join whose long side AQE splits.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
            e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        joined = both.join(least, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def write(e: DataFrame) -> tuple[str, DataFrame, tuple]:
        path = scratch(spark, "edges")
        e.write.parquet(path)
        e = spark.read.schema("a long, b long").parquet(path)
        return path, e, tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    path, now, mark = write(edges.select("a", "b").where("a <> b").distinct())
    while mark[0]:
        new_path, new, new_mark = write(star(star(now, True), False))
        drop_scratch(spark, path)
        path, now, done, mark = new_path, new, new_mark == mark, new_mark
        if done:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select("b", "b").distinct().toDF("node", "root"))
