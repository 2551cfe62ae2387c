import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import CLASH, DOCS, edge_rows  # noqa: E402


@pytest.fixture()
def rng():
    return random.Random(7)


@pytest.fixture()
def edge(spark, rng):
    return spark.createDataFrame(edge_rows(rng), DOCS)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture()
def clash():
    """Adds columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return lambda df: df.select("*", *(F.lit("other").alias(c) for c in CLASH if c not in df.columns))
