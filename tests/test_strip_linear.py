"""White space is stripped at both ends in one pass, whatever runs of it stand inside."""

from pyspark.sql import functions as F

from wikisift.functions.text import WHITE_CHARS, pystrip


def test_strip_takes_every_white_character_and_no_pattern(spark):
    texts = [f"{w}a{w}b{w}" for w in WHITE_CHARS] + [WHITE_CHARS, "", None, "x", "​x﻿", " \n a" + " " * 50_000 + "b\r\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pystrip("t").alias("s"))
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    for r in df.collect():
        assert r["s"] == (None if r["t"] is None else r["t"].strip(WHITE_CHARS))


def test_white_characters_are_those_of_the_pattern(spark):
    from wikisift.functions.text import WHITE

    points = spark.createDataFrame([(c, chr(c)) for c in range(1, 0x3100)], "id long, c string")
    assert {r["c"] for r in points.where(F.col("c").rlike(f"[{WHITE}]")).collect()} == set(WHITE_CHARS)
