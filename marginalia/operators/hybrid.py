"""Reciprocal-rank fusion of the dense and the lexical channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.operators.topk import top_k_per_group

# Fixed value: damping constant of reciprocal-rank fusion.
K_RRF = 60

SCORE_DIGITS = 12


def rrf_term(rank: Column, k_rrf: int = K_RRF) -> Column:
    """Share of one channel; a chunk missing from the channel adds nothing."""
    if k_rrf < 1:
        raise ValueError("k_rrf must be at least 1")
    return F.coalesce(F.lit(1.0) / (rank + k_rrf), F.lit(0.0))


def pool_size(top_k: int, hybrid_pool: int, rerank_pool: int = 0) -> int:
    """Candidates per channel: enough for fusion, reranking and the answer."""
    return max(hybrid_pool, rerank_pool, top_k)


def fuse(
    dense: DataFrame,
    lexical: DataFrame,
    top_k: int,
    k_rrf: int = K_RRF,
    tombstones: DataFrame | None = None,
    key: str = "chunk_id",
) -> DataFrame:
    """Fuse two ranked pools per query.

    dense:   query_id, chunk_id, doc_id, rank, distance
    lexical: query_id, chunk_id, doc_id, rank
    tombstones: keys of rows deleted in either channel.
    ``key`` names the column that tells rows apart: the row position where an
    updated chunk keeps its id, so that deleting the old row spares the new one.

    Both pools are bounded by queries times pool size, so the outer join stays
    small however large the indexes are.
    """
    left = dense.select(
        "query_id",
        key,
        F.col("chunk_id").alias("dense_chunk"),
        F.col("doc_id").alias("dense_doc"),
        F.col("rank").alias("dense_rank"),
        F.col("distance").alias("dense_distance"),
    )
    right = lexical.select(
        "query_id",
        key,
        F.col("chunk_id").alias("lexical_chunk"),
        F.col("doc_id").alias("lexical_doc"),
        F.col("rank").alias("bm25_rank"),
    )
    if tombstones is not None:
        dead = tombstones.select(key)
        left = left.join(dead, key, "left_anti")
        right = right.join(dead, key, "left_anti")
    merged = left.join(right, ["query_id", key], "full_outer").select(
        "query_id",
        *([] if key == "chunk_id" else [key]),
        F.coalesce("dense_chunk", "lexical_chunk").alias("chunk_id"),
        F.coalesce("dense_doc", "lexical_doc").alias("doc_id"),
        "dense_rank",
        "bm25_rank",
        "dense_distance",
        F.round(
            rrf_term(F.col("dense_rank"), k_rrf) + rrf_term(F.col("bm25_rank"), k_rrf), SCORE_DIGITS
        ).alias("rrf_score"),
        F.lit(False).alias("hybrid_degraded"),
    )
    order = [F.col("rrf_score").desc(), F.col("chunk_id"), F.col(key)]
    return top_k_per_group(merged, ["query_id"], order, top_k)


def dense_only(
    dense: DataFrame, top_k: int, k_rrf: int = K_RRF, tombstones: DataFrame | None = None, key: str = "chunk_id"
) -> DataFrame:
    """Same shape without a lexical index; every row is flagged as degraded."""
    alive = dense if tombstones is None else dense.join(tombstones.select(key), key, "left_anti")
    rows = alive.select(
        "query_id",
        *([] if key == "chunk_id" else [key]),
        "chunk_id",
        "doc_id",
        F.col("rank").alias("dense_rank"),
        F.lit(None).cast("int").alias("bm25_rank"),
        F.col("distance").alias("dense_distance"),
        F.round(rrf_term(F.col("rank"), k_rrf), SCORE_DIGITS).alias("rrf_score"),
        F.lit(True).alias("hybrid_degraded"),
    )
    return top_k_per_group(rows, ["query_id"], [F.col("rrf_score").desc(), F.col("chunk_id"), F.col(key)], top_k)


def cross_channel_drops(
    dense: DataFrame, lexical: DataFrame, dense_dead: DataFrame, lexical_dead: DataFrame
) -> DataFrame:
    """Candidates of one channel that only the other channel has deleted."""
    from_dense = (
        dense.select("query_id", "chunk_id")
        .join(lexical_dead.select("chunk_id"), "chunk_id", "left_semi")
        .join(dense_dead.select("chunk_id"), "chunk_id", "left_anti")
        .withColumn("channel", F.lit("dense"))
    )
    from_lexical = (
        lexical.select("query_id", "chunk_id")
        .join(dense_dead.select("chunk_id"), "chunk_id", "left_semi")
        .join(lexical_dead.select("chunk_id"), "chunk_id", "left_anti")
        .withColumn("channel", F.lit("bm25"))
    )
    return from_dense.unionByName(from_lexical).groupBy("channel").agg(F.count(F.lit(1)).alias("dropped"))
