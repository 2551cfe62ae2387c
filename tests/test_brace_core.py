"""Text outside all nodes is left out while braces are read, and put back."""

import random

import pytest
from pyspark.sql import functions as F

from wikisift.functions import braces as B

CASES = [
    ("", B.EDGE),
    ("plain | text", B.EDGE),
    ("long a {{T|x}} long b {{{p|{{Q}}}}} long c", f"{B.EDGE}{{{{T|x}}}}{B.EDGE}{{{{{{p|{{{{Q}}}}}}}}}}{B.EDGE}"),
    # one brace is text; runs that close more than is open
    ("a { b } {{T}}} c {{U}} d", f"{B.EDGE}{{{{T}}}}}}{B.EDGE}{{{{U}}}}{B.EDGE}"),
    # braces balance before the long text, yet the first run is closed behind it
    ("{{x {{a}}} y {{b}}} long }} end", "{{x {{a}}} y {{b}}} long }}" + B.EDGE),
    ("{{never closed, {{T}} then text", "{{never closed, {{T}}" + B.EDGE),
]


def test_core(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)], "k int, text string")
    rows = df.select("k", "text", B.core(F.col("text")).alias("core")).withColumn("back", B.around(F.col("text"), F.col("core"))).orderBy("k").collect()
    for (text, want), r in zip(CASES, rows):
        assert text.startswith("{{") or r["core"] == want
        assert r["core"] == (want if not text.startswith("{{") else B.EDGE + want) and r["back"] == text


def test_a_null_stays_null(spark):
    assert spark.createDataFrame([(None,)], "text string").select(B.core(F.col("text")), B.calls_of("text")).first()[0] is None


@pytest.mark.parametrize("most", [B.MOST_RUNS, 3])
def test_nodes_of_the_core_are_the_nodes_of_the_text(spark, monkeypatch, most):
    """Random runs of braces; with ``most`` 3 the longer texts are read whole."""
    monkeypatch.setattr(B, "MOST_RUNS", most)
    rnd = random.Random(most)
    words = ["{{"] * 4 + ["}}"] * 4 + ["{{{", "}}}", "{", "}", "{{{{", "}}}}", "}}}}}", "{{{{{", "a", "b|c", "[[x|y]]", "#if: q", "\n", " ", "|", "k=v", "["]
    texts = ["".join(rnd.choice(words) for _ in range(rnd.choice([3, 8, 25]))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    whole, own = B.outermost(F.col("text")), B.outermost(B.core(F.col("text")))
    read = df.select("text", whole.alias("whole"), own.alias("own"))
    read = read.withColumn("shown", B.put_back(F.col("whole.frame"), F.col("whole.nodes"))).withColumn("back", B.around(F.col("text"), B.put_back(F.col("own.frame"), F.col("own.nodes"))))
    assert read.where("whole.nodes <> own.nodes OR shown <> back").count() == 0 and read.where("own.nodes <> ''").count() > 300


def test_expansion_keeps_the_page_once(spark, monkeypatch):
    """What is written between the passes holds a page's text once, not in its frame too."""
    from wikisift.operators import templates as OT

    written, cut = [], OT.cut_lineage
    monkeypatch.setattr(OT, "cut_lineage", lambda df: written.append(cut(df)) or written[-1])
    text = "before {{T|x}} " + "word " * 2000 + "{{T|y}} after"
    pages = spark.createDataFrame([(1, "P", text)], "page_num long, title string, text string")
    catalog = spark.createDataFrame([("Template:T", "<{{{1}}}>")], "title string, body string")
    got = OT.expand_templates(pages, catalog).first()
    assert got["text"] == text.replace("{{T|x}}", "<x>").replace("{{T|y}}", "<y>")
    passes = [df for df in written if "_x" in df.columns]
    assert passes and all(df.agg(F.max(F.length("_o.frame") + F.length("_x.text"))).first()[0] < 200 for df in passes)
