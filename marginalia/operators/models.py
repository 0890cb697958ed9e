"""Pluggable models: embedders and rerankers.

A model is given as a factory. Each Python worker calls it once and keeps the
result for all its batches, so loading is paid per worker, not per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions.text import is_blank
from marginalia.operators.topk import top_k_per_group

Embedder = Callable[[list[str]], np.ndarray]
Scorer = Callable[[list[str], list[str]], list[float]]


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms > 0, norms, 1.0)


def embed(chunks: DataFrame, factory: Callable[[], Embedder], text: str = "text") -> DataFrame:
    """Add a unit-length ``embedding``; blank chunks drop out beforehand."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for batch in batches:
            matrix = _unit(np.asarray(model(batch.tolist()), dtype=np.float64))
            yield pd.Series(list(matrix.astype(np.float32)))

    vectors = F.pandas_udf(run, T.ArrayType(T.FloatType()))
    # The UDF's result is read from a column of its own: filtering first keeps
    # the model away from rows that are not needed.
    return chunks.filter(~is_blank(F.col(text))).withColumn("embedding", vectors(F.col(text)))


def digest_embedder(width: int = 32) -> Callable[[], Embedder]:
    """Deterministic stand-in for a model: bytes of the text's SHA-256."""

    def factory() -> Embedder:
        def model(texts: list[str]) -> np.ndarray:
            rows = [np.frombuffer(hashlib.sha256(t.encode("utf-8")).digest(), np.uint8) for t in texts]
            return np.array([np.resize(r, width) / 255.0 for r in rows])

        return model

    return factory


def rerank(pool: DataFrame, factory: Callable[[], Scorer], top_k: int, text: str = "text") -> DataFrame:
    """Score (query, text) pairs of each query's pool and rank them anew.

    The pool is bounded by queries times pool size. Equal scores keep the order
    they came in; the former rank stays available as ``pool_rank``.
    """
    if text not in pool.columns:
        raise KeyError(text)

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = factory()
        for queries, texts in batches:
            yield pd.Series(np.asarray(model(queries.tolist(), texts.tolist()), dtype=np.float64))

    score = F.pandas_udf(run, T.DoubleType())
    scored = pool.withColumn("rerank_score", score(F.col("query"), F.col(text))).withColumnRenamed("rank", "pool_rank")
    return top_k_per_group(scored, ["query_id"], [F.col("rerank_score").desc(), F.col("pool_rank")], top_k)


def overlap_scorer() -> Scorer:
    """Deterministic stand-in for a cross-encoder: share of query words found."""
    import re

    def words(value: str) -> set[str]:
        return set(re.findall(r"\w+", value.lower()))

    def model(queries: list[str], texts: list[str]) -> list[float]:
        out = []
        for query, body in zip(queries, texts):
            asked = words(query)
            out.append(round(len(asked & words(body)) / len(asked), 6) if asked else 0.0)
        return out

    return model
