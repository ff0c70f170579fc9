"""Registered queries, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "search_exact_ranked"


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with its SQL."""

    def register(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from . import acquisition, aggregates, checks, decisions, evidence, joins, merges, ordered, records, scalars, search, sets, titles  # noqa: E402, F401
