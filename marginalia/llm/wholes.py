"""Whole numbers from vectors, exact at any size, and sums of them over tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whole numbers below this stay 64-bit; anything larger becomes Python integers.
NARROW = 1 << 62
# Partial sums are first merged in at most this many tasks, then in one.
MERGE_TASKS = 32


def finite(vector: str) -> Column:
    """Neither NULL nor with a component that is NULL or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~bad, F.lit(False))


def floors(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) for a power of two ``scale``: int64 where all fit, else Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    if not scaled.size or np.abs(scaled).max() < NARROW:
        return scaled.astype(np.int64)
    # A double beyond 2**53 is whole, so scaling it as an integer is exact even where doubles overflow.
    return np.array([int(y) if np.isfinite(y) else int(x) * scale for x, y in zip(values.ravel(), scaled.ravel())], object).reshape(values.shape)


def largest(values: np.ndarray) -> int:
    """Largest absolute value, 0 if there is none."""
    return int(np.abs(values).max()) if values.size else 0


def vector_matrix(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """The vectors of an Arrow batch as rows of whole numbers; short rows end in zeros."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    if not len(lengths) or (lengths == width).all():
        return floors(flat.reshape(len(lengths), width), scale)
    filled = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    filled[rows, places] = flat
    return floors(filled, scale)


def total(partials: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Sum partial rows (key int, n long, sums array<string>) by key, exactly.

    A task writes one row per key; these are merged in several tasks and then in
    one, so the driver gets one row per key however many tasks there
    were. Sums travel as decimal text, so no width of a type bounds them.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield partial_rows(_summed((key, n, sums) for batch in batches for key, n, sums in zip(*(c.to_pylist() for c in batch.columns))))

    schema = "key int, n long, sums array<string>"
    several = min(MERGE_TASKS, partials.sparkSession.sparkContext.defaultParallelism)
    merged = partials.repartition(several).mapInArrow(merge, schema).repartition(1).mapInArrow(merge, schema)
    return _summed((row["key"], row["n"], row["sums"]) for row in merged.collect())


def _summed(rows) -> dict[int, tuple[int, list[int]]]:
    held: dict[int, tuple[int, list[int]]] = {}
    for key, n, sums in rows:
        old_n, old = held.get(key, (0, None))
        fresh = [int(s) for s in sums]
        held[key] = (old_n + n, fresh if old is None else [a + b for a, b in zip(old, fresh)])
    return held


def partial_rows(held: dict[int, tuple[int, list[int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(held), pa.int32()),
            pa.array([n for n, _ in held.values()], pa.int64()),
            pa.array([[str(s) for s in sums] for _, sums in held.values()], pa.list_(pa.string())),
        ],
        names=["key", "n", "sums"],
    )


def long_or_null(values: np.ndarray) -> pa.Array:
    """As 64-bit column; NULL where a Python integer does not fit."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if -(1 << 63) <= v < 1 << 63 else None for v in values], pa.int64())
