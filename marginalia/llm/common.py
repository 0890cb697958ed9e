"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.session import apply_settings, shared_folder


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows of narrow tables (ids, hashes, counts) that every executor may hold.
BROADCAST_ROWS = 200_000


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this subpackage; ``sql`` is the DuckDB statement its result must equal."""

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


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever other letters the text has."""
    return F.translate(text, UPPER, LOWER)


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``taken`` has that name in any case."""
    held = {c.lower() for c in taken}
    while wanted.lower() in held:
        wanted = "_" + wanted
    return wanted


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use`` takes it into a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder below the one the cluster shares."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def kept(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and gives the
    following plans column pruning and true sizes.
    """
    path = new_folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Ask for a broadcast of a written narrow table only after counting it."""
    return F.broadcast(df) if df.count() <= limit else df


def bounded_sample(df: DataFrame, limit: int, draw: list[Column], total: int) -> DataFrame:
    """The ``limit`` rows that come first by a hash of ``draw``, of ``total`` rows.

    About twice as many are let through by their hash before they meet in one
    place, so what meets there does not grow with the table. Where very many
    rows are equal in ``draw``, the sample may be smaller.
    """
    mark = F.pmod(F.xxhash64(*draw), F.lit(1 << 40))
    some = df.filter(mark < F.lit(int(min(1.0, 2 * limit / max(total, 1)) * (1 << 40)))) if total > 2 * limit else df
    return some.orderBy(mark, *draw).limit(limit)


def of_worker(name: str, make: Callable[[], object]) -> object:
    """An object made once per Python worker and used again by its later tasks."""
    held = sys.modules.setdefault("_marginalia_worker", types.ModuleType("_marginalia_worker"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)
