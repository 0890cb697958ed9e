"""Registry that keeps each named query next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.session import apply_settings, spread

Query = Callable[[SparkSession, str], DataFrame]

# Characters of text in one task that takes documents apart, sorts and counts their words.
TASK_CHARACTERS = 4_000_000

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the DuckDB statement its result must equal."""

    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(apply_settings(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, columns: str = "doc_id text") -> DataFrame:
    """Documents in enough tasks for text work."""
    return spread(table(spark, sf_dir, "documents").select(*columns.split()), "doc_id")


def texts_by_id(spark: SparkSession, sf_dir: str, columns: str = "doc_id text") -> DataFrame:
    """Documents dealt out by doc_id, so that windows and counts by document need no other exchange.

    Texts are shuffled instead of their words, and the number of tasks grows
    with the characters: what a task holds does not depend on the table's size.
    """
    docs = table(spark, sf_dir, "documents").select(*columns.split())
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return docs.repartition(max(spark.sparkContext.defaultParallelism, -(-total // TASK_CHARACTERS)), "doc_id")
