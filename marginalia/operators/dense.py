"""Exact dense retrieval by squared L2 distance.

Scoring is a narrow stage: every task turns its Arrow batches into a matrix,
scores them against the query block and passes on only its own best rows per
query. The single shuffle carries ``tasks x queries x k`` small rows, however
many vectors there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators.topk import top_k_per_group

# Query vectors scored together in a task, and values of all query vectors that
# travel to the tasks for one scan. Every scan works through all its blocks; only
# a query table beyond PASS_CELLS (a quarter of a million vectors of 64 values)
# takes another scan.
QUERY_BLOCK = 1024
PASS_CELLS = 16_000_000

# Digits of reported scores; ranks follow the full values.
DIGITS = 6

LOCAL_SCHEMA = "query_id long, embedding_index long, distance double, deleted boolean"


def query_blocks(queries: DataFrame, size: int = QUERY_BLOCK, weight=None, cells: int = 8_000_000) -> Iterator[list]:
    """Bounded blocks of the query table, streamed partition by partition.

    A block ends at ``size`` rows, or earlier when rows times their summed
    ``weight`` (say, the number of terms) would pass ``cells``.
    """
    block, load = [], 0
    for row in queries.toLocalIterator(prefetchPartitions=True):
        extra = weight(row) if weight else 0
        if block and (len(block) == size or (load + extra) * (len(block) + 1) > cells):
            yield block
            block, load = [], 0
        block.append(row)
        load += extra
    if block:
        yield block


def best_rows(primary: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` smallest by (primary, tie), exact under ties."""
    if len(primary) > k:
        bar = np.partition(primary, k - 1)[k - 1]
        keep = np.flatnonzero(primary <= bar)
    else:
        keep = np.arange(len(primary))
    order = np.lexsort((tie[keep], primary[keep]))[:k]
    return keep[order]


def exact_distances(matrix: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Squared distances, summed in one order for all rows, so that equal vectors tie."""
    gap = matrix - query
    return np.einsum("ij,ij->i", gap, gap)


def nearest(matrix: np.ndarray, index: np.ndarray, block: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query: positions and distances of rows that can be among the best k.

    One matrix product gives all distances up to rounding noise. Rows within a
    safe margin of the k-th are measured exactly, so the answer is exact.
    """
    rows, queries = np.einsum("ij,ij->i", matrix, matrix), np.einsum("ij,ij->i", block, block)
    rough = rows[:, None] + queries[None, :] - 2.0 * (matrix @ block.T)
    margin = 1e-12 * (rows.max() + queries.max())
    for j, query in enumerate(block):
        column = rough[:, j]
        if len(column) > k:
            close = np.flatnonzero(column <= np.partition(column, k - 1)[k - 1] + margin)
        else:
            close = np.arange(len(column))
        measured = exact_distances(matrix[close], query)
        best = best_rows(measured, index[close], k)
        yield close[best], measured[best]


def passes(blocks: Iterator[list], cells) -> Iterator[list[list]]:
    """Blocks gathered for one scan each; ``cells`` measures a block."""
    held, load = [], 0
    for block in blocks:
        if held and load + cells(block) > PASS_CELLS:
            yield held
            held, load = [], 0
        held.append(block)
        load += cells(block)
    if held:
        yield held


def _local_search(shared, k: int):
    """Task function; ``shared``: broadcast blocks of (ids, matrix)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = shared.value
        ids = [i for names, _ in blocks for i in names]
        firsts = np.cumsum([0] + [len(names) for names, _ in blocks])
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.empty(0), np.empty(0, np.int64), np.empty(0, bool)) for _ in ids
        ]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = batch.column("embedding")
            width = blocks[0][1].shape[1]
            flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
            if len(flat) != width * batch.num_rows:
                raise ValueError(f"every indexed vector must have the query dimension {width}")
            matrix = flat.reshape(-1, width)
            index = batch.column("embedding_index").to_numpy(zero_copy_only=False)
            deleted = batch.column("deleted").to_numpy(zero_copy_only=False).astype(bool)
            for first, (_, block) in zip(firsts, blocks):
                for j, (rows, measured) in enumerate(nearest(matrix, index, block, k), start=first):
                    d = np.concatenate([kept[j][0], measured])
                    i = np.concatenate([kept[j][1], index[rows]])
                    t = np.concatenate([kept[j][2], deleted[rows]])
                    best = best_rows(d, i, k)
                    kept[j] = (d[best], i[best], t[best])
        for query_id, (d, i, t) in zip(ids, kept):
            if len(d):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(d), query_id, np.int64)),
                        pa.array(i),
                        pa.array(d),
                        pa.array(t),
                    ],
                    names=["query_id", "embedding_index", "distance", "deleted"],
                )

    return search


def fetch_size(k: int, total: int, tombstoned: int) -> int:
    """Candidates to fetch so that deleted rows rarely leave fewer than ``k``."""
    if total == 0:
        return 0
    return min(int(k * (1.0 + tombstoned / total + 0.1)) + 1, total)


def search_dense(
    vectors: DataFrame, queries: DataFrame, k: int, exact: bool = True
) -> DataFrame:
    """Top ``k`` live vectors per query.

    ``vectors``: embedding_index, embedding, optional deleted_utc.
    ``queries``: query_id, embedding.
    Result: query_id, rank, embedding_index, distance.

    ``exact`` filters deleted rows before ranking. ``exact=False`` is the
    over-fetch rule: cut to the fetch size first, drop deleted rows then, which
    may leave fewer than ``k``.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = vectors.sparkSession
    if "deleted_utc" in vectors.columns:
        flagged = vectors.withColumn("deleted", F.col("deleted_utc").isNotNull())
    else:
        flagged = vectors.withColumn("deleted", F.lit(False))
    if exact:
        flagged = flagged.filter(~F.col("deleted"))
        fetch = k
    else:
        stats = flagged.agg(
            F.count(F.lit(1)).alias("total"), F.count_if("deleted").alias("tombstoned")
        ).first()
        fetch = fetch_size(k, stats["total"], stats["tombstoned"])
    source = flagged.select(
        F.col("embedding_index").cast("long").alias("embedding_index"), "embedding", "deleted"
    )
    order = [F.col("distance"), F.col("embedding_index")]
    answer = spark.createDataFrame([], LOCAL_SCHEMA)
    parts = []
    blocks = query_blocks(queries.select("query_id", "embedding"), QUERY_BLOCK)
    for held in passes(blocks, lambda block: sum(len(row["embedding"]) for row in block)) if fetch else ():
        packed = [
            ([int(row["query_id"]) for row in block], np.array([row["embedding"] for row in block], dtype=np.float64))
            for block in held
        ]
        shared = spark.sparkContext.broadcast(packed)
        parts.append(source.mapInArrow(_local_search(shared, fetch), LOCAL_SCHEMA))
    for position, part in enumerate(parts):
        answer = part if position == 0 else answer.unionByName(part)
    pool = top_k_per_group(answer, ["query_id"], order, max(fetch, 1))
    if exact:
        return pool.select("query_id", "rank", "embedding_index", F.round("distance", DIGITS).alias("distance"))
    live = pool.filter(~F.col("deleted")).drop("rank")
    return top_k_per_group(live, ["query_id"], order, k).select(
        "query_id", "rank", "embedding_index", F.round("distance", DIGITS).alias("distance")
    )


def centroids(vectors: DataFrame, key: str) -> DataFrame:
    """Mean vector per key as (key, embedding): the group sizes do not matter
    because the averages are aggregated per position before the shuffle."""
    means = (
        vectors.select(key, F.posexplode("embedding").alias("pos", "x"))
        .groupBy(key, "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(key).agg(F.transform(ordered, lambda p: p["x"]).alias("embedding"))
