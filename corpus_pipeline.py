"""The training-corpus pipeline: five operators, one after the other.

Every stage works on all that its predecessor kept and returns the columns of
`documents`; the last returns the packed pieces.  ``run`` writes each stage's
rows to the shared folder and reads them again, so a stage that is lost with its
executors starts from files.

Rows-only by SQL: the first and third stage rest on iterated estimates and on
64-bit hashes that SQL cannot express, so tests/llm holds the stages against
brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wikisift.llm.common import read_table, scratch
from wikisift.llm.decontaminate import drop_contaminated
from wikisift.llm.line_dedup import drop_repeated_lines
from wikisift.llm.packing import pack
from wikisift.llm.quality_rules import keep_good
from wikisift.llm.simhash import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distance reject go.

    Null and empty texts go (no words); null lang or source is a group of its own; equal rows
    share a verdict; very long texts are read whole; an empty table stays empty."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; text and n_chars follow.

    No document goes: one without lines left has an empty text, as has a null text; a null
    doc_id comes last; rows of one doc_id are one document; an empty table stays empty."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within 3 fingerprint bits stays.

    Null and empty texts have fingerprint zero and are one group; equal rows are one group; of a
    tie the smallest doc_id stays, a null one last; an empty table stays empty."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts or items hold nothing; equal rows share a verdict; very long texts are
    read whole; an empty table or benchmark changes nothing."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences.

    Null and empty texts are the closing id alone; equal rows are packed each; very long texts
    span sequences; an empty table gives no pieces."""
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole `documents` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
