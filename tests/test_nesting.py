"""Nested spans: rounds against the fold, and their cost on rows with very many delimiters."""

import random
import time

import pytest
from pyspark.sql import functions as F

from wikisift.functions import markup as M


def texts(rnd):
    pieces = ["{{", "}}", "[[", "]]", "a", " b|", "|", "c", "{|", "|}", "Category:x", "<ref>", "</ref>", "\n"]
    out = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(2, 60))) for _ in range(300)]
    for k in (5, 9, 20, 300):
        out += ["{{x|" * k + "y" + "}}" * k, "[[p|" * k + "y" + "]]" * (k - 1), "<ref>" * k + "y" + "</ref>" * k, "[[q" * (k - 1) + "]]" * k]
    return out + ["", "[[", "]]", None]


@pytest.mark.parametrize("rounds", [200, 3])
def test_rounds_give_what_the_fold_gives(spark, monkeypatch, rounds):
    monkeypatch.setattr(M, "LOOP_ROUNDS", rounds)
    df = spark.createDataFrame([(t,) for t in texts(random.Random(6))], "t string")
    show = lambda top: M._internal_link_text(F.substring(top, 3, 1 << 30))
    folded = F.replace(M.nested_fold(F.col("t"), r"\[\[", r"\]\]", on_close=show), F.lit(M.LINKED), F.lit(""))
    pairs = [(M.drop_templates("t"), M.nested_fold(F.col("t"), r"\{\{", r"\}\}")), (M.drop_tables("t"), M.nested_fold(F.col("t"), r"\{\|", r"\|\}")), (M.internal_links("t"), folded),
             (M.drop_element("t", "ref"), M.nested_fold(F.col("t"), r"(?i)<\s*ref\b[^>/]*>", r"(?i)<\s*/\s*ref>"))]
    for got, want in pairs:
        for r in df.select("t", got.alias("got"), want.alias("want")).collect():
            assert r["got"] == r["want"], r["t"]


def test_cost_grows_with_the_delimiters(spark):
    """Ten times the delimiters cost about ten times as much, not a hundred times."""
    def seconds(n):
        df = spark.createDataFrame([("[[a|b [[c]]]] {{x|{{y{{z{{u{{v{{w}}}}}}}}}}}} <ref><ref>r</ref></ref> " * n,)], "t string")
        best = 1e9
        for _ in range(2):
            began = time.monotonic()
            out = df.select(M.internal_links("t").alias("a"), M.drop_templates("t").alias("b"), M.drop_element("t", "ref").alias("c")).first()
            best = min(best, time.monotonic() - began)
        assert out["a"].startswith("b c {{") and out["b"].count("{") == 0 and out["c"].count("<ref>") == 0
        return best

    seconds(50)
    small, large = seconds(500), seconds(5_000)  # 10,000 and 100,000 delimiters
    assert large < 25 * max(small, 0.2)
