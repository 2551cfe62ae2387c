"""Registry of named jobs: key -> (Spark job, DuckDB oracle SQL or None).

Each job takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables (or data Spark derives from them).  The oracle SQL is written
independently against the same tables, with the same output column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Job) -> Job:
        if key in JOBS:
            raise ValueError(f"duplicate job key {key}")
        JOBS[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def load_all() -> None:
    # Importing the modules fills the registry.
    from wikisift.plans import (  # noqa: F401
        corpus_jobs,
        markup_jobs,
        lines_jobs,
        pages_jobs,
        template_jobs,
        embed_jobs,
    )
