"""The streams' batches have files for every task slot, and the number of batches stays."""

import os

from wikisift.plans import corpus_jobs
from wikisift.session import arriving_files


def test_a_batch_has_a_file_for_every_slot(spark, tmp_path):
    rows = [(k, f"word{k % 5} x.", "en", "s", 8) for k in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    path, each = corpus_jobs._stream_of(spark, str(tmp_path))
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
    slots = spark.sparkContext.defaultParallelism
    assert each >= slots and len(files) == 3 * each
    assert arriving_files(spark.range(0, 100, 1, 6 * slots)) == (6 * slots, 2 * slots)
    got = {r["word"]: r["count"] for r in corpus_jobs.q_stream_vocabulary(spark, str(tmp_path)).collect()}
    assert got == {"x": 400, ".": 400, **{f"word{k}": 80 for k in range(5)}}
