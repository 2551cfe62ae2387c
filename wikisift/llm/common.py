"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wikisift.session import checkpoint_dir

#: Rows of one Arrow batch handed to Python.  Whole texts travel in these
#: batches, so the bound keeps a worker's memory at rows x text length.
ARROW_ROWS = 256

#: ASCII white space as the operators' contracts define it: space, \t \n \v \f \r.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Small Arrow batches for the jobs that send whole texts to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def persisted(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage at files every executor can read again, so a lost
    executor costs the tasks it was running and nothing before them.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch path of this run (a folder made by :func:`scratch`)."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
