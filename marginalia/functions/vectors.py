"""Vector helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_l2(left: Column, right: Column) -> Column:
    """Squared Euclidean distance, accumulated in double precision."""
    squares = F.zip_with(
        left, right, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))
    )
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def l2_normalize(vector: Column) -> Column:
    """Unit-length copy of a vector; a zero vector stays as it is."""
    norm = l2_norm(vector)
    return F.when(norm > 0, F.transform(vector, lambda x: x.cast("double") / norm)).otherwise(
        F.transform(vector, lambda x: x.cast("double"))
    )


def similarity(distance: Column) -> Column:
    """Distance to a score in (0, 1]."""
    return F.exp(-distance)
