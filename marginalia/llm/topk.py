"""Exact top-k inner products over vectors grouped by length.

Vectors are dealt to groups that fit one task. A group sorts its vectors by
length and cuts them into buckets. For each query and bucket, the k-th best
product so far gives a local cosine threshold; a low threshold is answered by
length pruning and one block product, a high one by coordinate pruning. What
is left is verified by its exact integer product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators.topk import top_k_per_group

# A group has at most so many rows, and fewer where vectors are wide: a task holds two matrices of it.
GROUP_ROWS = 1 << 17
GROUP_CELLS = 1 << 23
BUCKET_ROWS = 1024
QUERY_ROWS = 256
# Above this local cosine threshold single coordinates rule out enough rows.
COORDINATE_FROM = 0.6
FOCUS = 5
# Products stay exact in doubles while squared lengths are below this; rows
# and queries beyond are answered in whole numbers, without pruning.
EXACT = float(1 << 53)
# Sums of products below this fit 64 bits; beyond, Python integers take over.
NARROW = float(1 << 62)
LOW, HIGH = -(1 << 63), (1 << 63) - 1

LOCAL_SCHEMA = "_query long, query_id long, vec_id long, score long"


def quantized(vector: str, scale: int = 256):
    """floor(scale * x) per component; NULL if any component is NULL or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def whole_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact products of whole-number rows, held to the range of a long."""
    bound = np.abs(left).max(initial=0) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if bound < NARROW:
        return left @ right.T
    return np.clip(left.astype(object) @ right.astype(object).T, LOW, HIGH).astype(np.int64)


class Group:
    """The vectors of one group in buckets of falling length, very long ones apart."""

    def __init__(self, ids: np.ndarray, rows: list[np.ndarray], width: int):
        whole = np.zeros((len(ids), width), np.int64)
        for i, row in enumerate(rows):
            whole[i, : len(row)] = row
        matrix = whole.astype(np.float64)
        squares = np.einsum("ij,ij->i", matrix, matrix)
        far = squares >= EXACT
        self.far_ids, self.far = ids[far], whole[far]
        ids, matrix, squares = ids[~far], matrix[~far], squares[~far]
        order = np.lexsort((ids, -squares))
        self.ids, self.matrix, self.norms = ids[order], matrix[order], np.sqrt(squares[order])
        self.buckets = []
        for a in range(0, len(ids), BUCKET_ROWS):
            b = min(a + BUCKET_ROWS, len(ids))
            norms = self.norms[a:b]
            unit = self.matrix[a:b] / np.where(norms > 0, norms, 1.0)[:, None]
            self.buckets.append((a, b, norms[0], np.ascontiguousarray(unit.T)))

    def search(self, own: np.ndarray, whole: np.ndarray, far: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query of the block: the best ids and scores of this group. ``far`` marks very long queries."""
        block = np.where(far[:, None], 0, whole).astype(np.float64)
        norms = np.sqrt(np.einsum("ij,ij->i", block, block))
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in own]
        least = np.full(len(own), -np.inf)

        def offer(j: int, scores: np.ndarray, ids: np.ndarray) -> None:
            fit = (scores >= least[j]) & (ids != own[j])
            if not fit.any():
                return
            # Scores that came as doubles are whole numbers below 2**53.
            scores, ids = scores[fit].astype(np.int64), ids[fit]
            if len(scores) > 4 * k:
                # Ties with the k-th score must stay for the order by id.
                fit = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                scores, ids = scores[fit], ids[fit]
            scores = np.concatenate([best[j][0], scores])
            ids = np.concatenate([best[j][1], ids])
            # The complement falls as a score rises and exists for every long.
            order = np.lexsort((ids, ~scores))[:k]
            best[j] = (scores[order], ids[order])
            if len(order) == k:
                least[j] = scores[order[-1]]

        if len(self.far):
            for j, row in enumerate(whole_products(whole, self.far)):
                offer(j, row, self.far_ids)
        for j in np.flatnonzero(far):
            for a, b, _, _ in self.buckets:
                offer(j, whole_products(whole[j : j + 1], self.matrix[a:b].astype(np.int64))[0], self.ids[a:b])
        for a, b, longest, unit in self.buckets:
            bound = longest * norms
            alive = ~far & (least <= bound * (1 + 1e-9))
            if not alive.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                local = np.where(bound > 0, least / bound, -np.inf)
                reach = np.where(norms > 0, least / norms, -np.inf) * (1 - 1e-9)
            by_length = np.flatnonzero(alive & (local < COORDINATE_FROM))
            if len(by_length):
                lengths = self.norms[a:b]
                upto = np.searchsorted(-lengths, -reach[by_length], side="right")
                products = block[by_length] @ self.matrix[a : a + upto.max()].T
                for row, j, m in zip(products, by_length, upto):
                    offer(j, row[:m], self.ids[a : a + m])
            for j in np.flatnonzero(alive & (local >= COORDINATE_FROM)):
                direction = block[j] / norms[j]
                near = np.arccos(min(1.0, local[j])) + 1e-7
                left = None
                for f in np.argsort(-np.abs(direction))[:FOCUS]:
                    angle = np.arccos(np.clip(direction[f], -1.0, 1.0))
                    low, high = np.cos(min(np.pi, angle + near)), np.cos(max(0.0, angle - near))
                    column = unit[f] if left is None else unit[f][left]
                    fit = np.flatnonzero((column >= low - 1e-9) & (column <= high + 1e-9))
                    left = fit if left is None else left[fit]
                if len(left):
                    offer(j, self.matrix[a + left] @ block[j], self.ids[a + left])
        for j, (scores, ids) in enumerate(best):
            yield j, scores, ids


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, rows, group = None, [], [], None
        for batch in batches:
            part = batch.column("_group").to_numpy(zero_copy_only=False)
            asks = batch.column("_query").to_numpy(zero_copy_only=False)
            own = batch.column("_id").to_numpy(zero_copy_only=False)
            ends = batch.column("_vector").offsets.to_numpy()
            flat = batch.column("_vector").values.to_numpy(zero_copy_only=False)
            a = 0
            while a < len(part):
                b = a + int(np.searchsorted(part[a:], part[a], side="right"))
                if part[a] != current:
                    current, ids, rows, group = part[a], [], [], None
                split = a + int(np.searchsorted(asks[a:b], 0))
                for i in range(a, split):
                    rows.append(flat[ends[i] : ends[i + 1]])
                ids.append(own[a:split])
                for first in range(split, b, QUERY_ROWS):
                    if group is None:
                        every = np.concatenate(ids)
                        group = Group(every, rows, max([0, *map(len, rows)]))
                        rows = []
                    span = range(first, min(first + QUERY_ROWS, b))
                    block = np.zeros((len(span), group.matrix.shape[1]), np.int64)
                    far = np.zeros(len(span), bool)
                    for j, i in enumerate(span):
                        vector = flat[ends[i] : ends[i + 1]]
                        far[j] = vector.astype(np.float64) @ vector.astype(np.float64) >= EXACT
                        cut = vector[: block.shape[1]]
                        block[j, : len(cut)] = cut
                    out = [(asks[span[j]], own[span[j]], i, s) for j, s, i in group.search(own[span], block, far, k)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([np.full(len(i), q, np.int64) for q, _, i, _ in out])),
                            pa.array(np.concatenate([np.full(len(i), q, np.int64) for _, q, i, _ in out])),
                            pa.array(np.concatenate([i for _, _, i, _ in out])),
                            pa.array(np.concatenate([s for _, _, _, s in out]).astype(np.int64)),
                        ],
                        names=["_query", "query_id", "vec_id", "score"],
                    )
                a = b

    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` highest integer inner products per query row.

    Both inputs have an id and an array of whole numbers; other columns are
    ignored. A row never meets candidates that carry its own id. Rows with a
    NULL id or vector take no part. Vectors of unlike lengths are compared over
    the components both have. A repeated candidate row counts each time; a
    repeated query row is answered each time. Ties go to the smaller id.
    Very long vectors are compared exactly in whole numbers; a product beyond
    the range of a long counts as its end.
    Result: query_id, rank, vec_id, score; queries without candidates are absent.

    Each candidate is shuffled once. Queries are copied to every group of at
    most GROUP_ROWS candidates and about GROUP_CELLS components, and a group streams past them in blocks, so memory
    is one group and one block whatever the number of either.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    context = vectors.sparkSession.sparkContext

    def narrow(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_vector")).filter(
            F.col("_id").isNotNull() & F.col("_vector").isNotNull() & ~F.exists("_vector", lambda x: x.isNull())
        )

    sizes = vectors.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.greatest(F.size(vector_col), F.lit(0)).cast("long")).alias("cells")).first()
    groups = max(context.defaultParallelism, -(-sizes["rows"] // GROUP_ROWS), -(-(sizes["cells"] or 0) // GROUP_CELLS))
    rows = narrow(vectors).select(
        F.pmod(F.monotonically_increasing_id(), F.lit(groups)).alias("_group"), F.lit(-1).cast("long").alias("_query"), "_id", "_vector"
    )
    asked = narrow(queries).select(F.monotonically_increasing_id().alias("_query"), "_id", "_vector")
    copies = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("_group"), "_query", "_id", "_vector")
    met = rows.unionByName(copies).repartition(groups, "_group").sortWithinPartitions("_group", "_query")
    local = met.mapInArrow(_search(k), LOCAL_SCHEMA)
    order = [F.col("score").desc(), F.col("vec_id")]
    return top_k_per_group(local, ["_query"], order, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
