"""The pipeline's stages, each judged on its own input."""

import re

from llm_helpers import DOCS, rows_of
from test_decontaminate import planted
from test_quality import base, corpus

import corpus_pipeline
from wikisift.llm import jobs


def test_registry():
    assert sorted(JOB for JOB in jobs.JOBS) == sorted(f"op{n}_{x}" for n, x in enumerate(
        "simhash_near_dedup benchmark_decontamination line_dedup license_scan packing secret_scan html_extraction quality_classifier chat_formatting quality_rules merkle_manifest token_counts ranked_search".split(), 1))
    import __spark_entry__ as entry

    assert {*jobs.JOBS, "pipeline"} <= set(entry.queries()) and set(jobs.ORACLE) <= set(entry.oracle_sql())


def test_stages(spark, rng, tmp_path):
    rows, junk = corpus(rng, 300)
    items, leaky, want = planted(rng)
    rows += [(1000 + d, t, "en", "big", 1) for d, t in leaky if d is not None and t]
    rows += [(5000, rows[1][1], "en", "big", 1), (5001, rows[1][1] + " x", "en", "big", 1)]  # copies
    line = "A passage that stands in several documents of the corpus."
    rows = [(d, t + ("\n" + line if d in (2, 4, 5) else ""), *r) for d, t, *r in rows]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
    ids = lambda name: {d for d, in rows_of(seen[name], "doc_id")}
    assert not ids("quality_rules") & junk and not any(base(t)[5] for t, in rows_of(seen["quality_rules"], "text"))
    texts = {d: t for d, t in rows_of(seen["line_dedup"], "doc_id", "text")}
    assert line in texts[2] and line not in texts[4] and line not in texts[5]
    assert ids("line_dedup") == ids("quality_rules")
    # the copies' lines went to the first document, so what is left of them is one empty text
    assert sum(not texts[d].strip() for d in ids("near_dedup")) <= 1
    # line dedup may have taken an item's lines out of later documents: those that
    # still hold one whole go, and only planted ones go
    words = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    held = {d for d, t in rows_of(seen["near_dedup"], "doc_id", "text") if any(words(x) in words(t) for _, x in items if words(x).strip())}
    gone = ids("near_dedup") - ids("decontamination")
    assert held and held <= gone <= {1000 + d for d, _ in want if d is not None}
    assert ids("packing") == ids("decontamination")
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert rows_of(run, *run.columns) == rows_of(seen["packing"], *run.columns)
