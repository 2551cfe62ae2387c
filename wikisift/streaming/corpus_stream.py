"""Structured Streaming form of the corpus and cleaning steps.

Every per-row step (markup cleaning, line rendering as a per-row fold,
paragraph / sentence / token split) holds no cross-row state, so the same
functions run unchanged on a streaming DataFrame.  Two parts keep state: the vocabulary
(a running count per word, ``update`` mode) and page de-duplication (the
ids seen, until the page numbers are far beyond).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from wikisift.functions.markup import clean_markup
from wikisift.operators.corpus import corpus
from wikisift.operators.lines import compact_text
from wikisift.session import checkpoint_dir, scratch_path

DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def read_documents_stream(spark: SparkSession, src_dir: str, max_files: int = 16) -> DataFrame:
    return spark.readStream.schema(DOCUMENT_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(src_dir)


def stream_sentences(docs: DataFrame, clean: bool = False) -> DataFrame:
    """Streaming documents -> tokenised sentences (optionally cleaned first)."""
    d = docs.select("doc_id", "text", "lang")
    if clean:
        d = clean_markup(d, "text").withColumn("text", compact_text("text"))
    return corpus(d).select("doc_id", "par_no", "sent_no", F.array_join("tokens", " ").alias("line"))


def stream_vocabulary(docs: DataFrame) -> DataFrame:
    """Running word counts (stateful aggregation; filter by min count on read)."""
    return corpus(docs.select("doc_id", "text", "lang")).select(F.explode("tokens").alias("word")).groupBy("word").count()


def run_sentences_once(spark: SparkSession, src_dir: str, out_dir: str, name: str = "sentences") -> None:
    """Process every file present now (availableNow) into a parquet sink;
    progress is kept under the shared checkpoint folder so a restarted job
    resumes where it stopped."""
    ck = f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    q = (
        stream_sentences(read_documents_stream(spark, src_dir))
        .writeStream.format("parquet")
        .option("checkpointLocation", ck)
        .option("path", out_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def run_vocabulary_once(docs: DataFrame) -> DataFrame:
    """A1 over every file present now: (word, count).

    Each batch appends the counts that it changed; a word's count is that of its last
    batch, so a batch that is run twice after a failure changes nothing.
    """
    spark = docs.sparkSession
    out, ck = scratch_path(spark, "counts"), scratch_path(spark, "stream")
    spark.createDataFrame([], "word string, count long, batch long").write.parquet(out)

    def append(batch: DataFrame, number: int) -> None:
        batch.select("word", "count", F.lit(number).cast("long").alias("batch")).write.mode("append").parquet(out)

    stream_vocabulary(docs).writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("word").agg(F.max_by("count", "batch").alias("count"))


def read_pages_stream(spark: SparkSession, src_dir: str, schema, max_files: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(src_dir)


def stream_dedup_pages(pages: DataFrame, reach: int = 100_000_000) -> DataFrame:
    """Of each id the first page (lowest page_num) of the batch that first holds it.

    An id's state is dropped once the stream is ``reach`` page numbers beyond it (copies
    are neighbours in a dump); files may arrive as much out of order, pages that come
    later than that are dropped as late by the stream's watermark.
    """
    columns = pages.columns

    def first_only(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        frames = list(frames)
        # most ids have one page: no frame is built for it again
        rows = frames[0] if len(frames) == 1 else pd.concat(frames)
        if not state.exists:
            yield (rows if len(rows) == 1 else rows.nsmallest(1, "page_num"))[columns]
        seen = max(int(rows["page_num"].max()), state.get[0] if state.exists else 0)
        state.update((seen,))
        state.setTimeoutTimestamp(max((seen + reach) * 1000, state.getCurrentWatermarkMs() + 1))

    # from second 1 on: what lies at the first watermark, 0, counts as late
    placed = pages.withColumn("_at", F.timestamp_seconds(F.col("page_num") + 1)).withWatermark("_at", f"{reach} seconds")
    return placed.groupBy("id").applyInPandasWithState(first_only, pages.schema, "last long", "append", GroupStateTimeout.EventTimeTimeout)


def run_dedup_once(pages: DataFrame) -> DataFrame:
    """:func:`stream_dedup_pages` over every file present now, as a table."""
    spark = pages.sparkSession
    out, ck = scratch_path(spark, "pages"), scratch_path(spark, "stream")
    stream_dedup_pages(pages).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(pages.schema).parquet(out)
