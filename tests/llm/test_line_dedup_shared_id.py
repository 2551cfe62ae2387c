"""Operator 3: rows that share one doc_id, or have none."""

import pytest
from llm_helpers import rows_of
from pyspark.sql import functions as F
from test_line_dedup import COLS, model

from wikisift.llm.line_dedup import line_dedup, line_drops


@pytest.mark.parametrize("shared", [None, 9])
def test_dropped_hashes_are_bounded_by_a_row(spark, shared):
    lines = [f"a line that document one holds {k}" for k in range(120)]
    rows = [(1, "\n".join(lines))]
    rows += [(shared, "\n".join([*lines[3 * k : 3 * k + 3], f"a line of row {k} only"])) for k in range(40)]
    rows += [(shared, "\n".join(lines[:3]))] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes = line_drops(df).select(F.size("dropped")).collect()
    assert len(sizes) == 41 and {n for (n,) in sizes} == {3}
    assert rows_of(line_dedup(df), *COLS) == model(rows)
