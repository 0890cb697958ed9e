"""Ranking and numbering operators shared by every retrieval path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.session import checkpointed

# Rows of ids and scores that are still cheap to hold on every executor.
BROADCAST_ROWS = 500_000


def top_k_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank_name: str = "rank"
) -> DataFrame:
    """First ``k`` rows per group with their 1-based rank.

    ``row_number() <= k`` makes Spark add a WindowGroupLimit below the shuffle,
    so each task sends at most ``k`` rows per group and a hot group never
    arrives whole in one task. The optimizer only does so up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``; beyond it the same
    two-step reduction is spelled out with a salt.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        # As many parts as shuffle tasks, so a hot group can use them all.
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        first = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
            .withColumn("_local", F.row_number().over(first))
            .filter(F.col("_local") <= k)
            .drop("_salt", "_local")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(window)).filter(F.col(rank_name) <= k)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key, the smallest by ``order``.

    An aggregate instead of a window: partial aggregation leaves one row per
    key and task before the shuffle, whatever the size of a key's group.
    """
    others = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*others), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key, the largest by ``order`` (upsert, last one wins)."""
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def lookup_per_key(
    big: DataFrame, per_key: DataFrame, keys: list[str], count: str, salts: int = 64
) -> DataFrame:
    """Left-join one row per key onto a large side whose keys may be hot.

    ``per_key`` carries the group size in ``count``. Keys holding more than a
    thousandth of all rows number at most a thousand, so that list is broadcast
    safely; only those keys are salted and their one row repeated.
    """
    total = per_key.agg(F.sum(count).alias("n"))
    hot = (
        per_key.filter(F.col(count) * 1000 > total.scalar())
        .select(*keys)
        .withColumn("_hot", F.lit(True))
    )
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(*big.columns), F.lit(salts))).otherwise(F.lit(0))
    left = big.join(F.broadcast(hot), keys, "left").withColumn("_salt", spread.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = (
        per_key.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_hot")
    )
    return left.join(right, [*keys, "_salt"], "left").drop("_salt")


def join_hits(
    big: DataFrame, hits: DataFrame, keys: list[str], limit: int = BROADCAST_ROWS, written: bool = False
) -> DataFrame:
    """Inner join of a large table with a result that should be small.

    The size of ``hits`` is checked, not assumed: its rows are written once and
    counted. Up to ``limit`` they are broadcast and the large side is only
    streamed past them, never shuffled; beyond it both sides are shuffled.
    ``written`` says that ``hits`` comes from a checkpoint already.
    """
    held = hits if written else checkpointed(hits)
    small = F.broadcast(held) if held.count() <= limit else held
    return big.join(small, keys)


def number_rows(df: DataFrame, order: list[str], name: str, start: Column | int = 0) -> DataFrame:
    """Dense global numbering in ``order`` without one task seeing all rows.

    Range partitions are sorted, and each row's place in its partition is
    shifted by the sizes of the partitions before it (one row per partition).
    The checkpoint fixes the range bounds: recomputing them could place a row
    in another partition than the one it was counted in.
    """
    placed = checkpointed(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # The upper bits of the generated id are the partition, the lower 33 the row.
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    first = start if isinstance(start, Column) else F.lit(start)
    local = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(shifts), "_part")
        .withColumn(name, (first + F.col("_shift") + local).cast("long"))
        .drop("_part", "_place", "_shift")
    )
