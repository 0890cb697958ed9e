"""Centroid clustering over dictionaries of subvectors.

Vectors are rounded to whole numbers and dictionary-encoded once, without loss:
a chunk of rows holds, for each block of dimensions, the distinct subvectors
and one code per row. A round measures each distinct subvector against the
centroids once, and a row's squared distance is the sum of its codes' entries.
New centroids come from the counts per code. All figures are whole numbers, so
the result does not depend on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import kept
from marginalia.llm.wholes import NARROW, finite, largest, long_or_null, partial_rows, total, vector_matrix

# Rows that share dictionaries: about a megabyte of codes at 64 dimensions.
CHUNK_ROWS = 8192

CHUNK_SCHEMA = "ids array<long>, widths array<int>, sizes array<int>, codes binary, entries binary, wide boolean"
ROW_SCHEMA = "vec_id long, cluster int, distance long"


@dataclass
class Chunk:
    """Encoded rows: per block its width, its distinct subvectors and a code per row."""

    ids: pa.Array
    codes: list[np.ndarray]
    entries: list[np.ndarray]

    @staticmethod
    def of(ids: pa.Array, matrix: np.ndarray) -> "Chunk":
        """Encode; blocks double in width while that makes a round cheaper."""
        codes, entries = [], []
        for column in matrix.T:
            values, code = np.unique(column, return_inverse=True)
            codes.append(code)
            entries.append(values[:, None])
        while len(codes) > 1:
            joined = [_paired(codes, entries, i) for i in range(0, len(codes), 2)]
            wider_codes, wider_entries = [c for c, _ in joined], [e for _, e in joined]
            if _cost(wider_codes, wider_entries) >= _cost(codes, entries):
                break
            codes, entries = wider_codes, wider_entries
        return Chunk(ids, codes, entries)

    def packed(self) -> list:
        wide = any(e.dtype == object for e in self.entries)
        numbers = " ".join(str(v) for e in self.entries for v in e.ravel()).encode() if wide else b"".join(e.astype("<i8").tobytes() for e in self.entries)
        return [
            self.ids.to_pylist(),
            [e.shape[1] for e in self.entries],
            [len(e) for e in self.entries],
            b"".join(c.astype("<u2" if CHUNK_ROWS <= 1 << 16 else "<u4").tobytes() for c in self.codes),
            numbers,
            wide,
        ]

    @staticmethod
    def unpacked(batch: pa.RecordBatch, i: int) -> "Chunk":
        ids = batch.column("ids")[i].values
        widths, sizes = batch.column("widths")[i].as_py(), batch.column("sizes")[i].as_py()
        codes = np.frombuffer(batch.column("codes")[i].as_buffer(), "<u2" if CHUNK_ROWS <= 1 << 16 else "<u4")
        raw = batch.column("entries")[i]
        wide = batch.column("wide")[i].as_py()
        numbers = np.array([int(v) for v in raw.as_py().split()], object) if wide else np.frombuffer(raw.as_buffer(), "<i8")
        entries, at = [], 0
        for width, size in zip(widths, sizes):
            entries.append(numbers[at : at + width * size].reshape(size, width))
            at += width * size
        return Chunk(ids, list(codes.reshape(len(widths), len(ids)).astype(np.intp)), entries)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance per row; the smaller number wins ties."""
        reach = max(largest(e) for e in self.entries) + largest(centroids)
        exact = np.int64 if centroids.shape[1] * reach * reach < NARROW else object
        places = centroids.astype(exact)
        sums = np.zeros((len(self.ids), len(centroids)), exact)
        at = 0
        for code, entry in zip(self.codes, self.entries):
            gap = entry.astype(exact)[:, None, :] - places[None, :, at : at + entry.shape[1]]
            sums += (gap * gap).sum(axis=2)[code]
            at += entry.shape[1]
        cluster = sums.argmin(axis=1)
        return cluster, sums[np.arange(len(cluster)), cluster]

    def members(self, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows per cluster, and their componentwise sums from the counts per code."""
        parts = []
        for code, entry in zip(self.codes, self.entries):
            counts = np.bincount(cluster * len(entry) + code, minlength=k * len(entry)).reshape(k, len(entry))
            exact = np.int64 if largest(entry) * max(1, len(code)) < NARROW else object
            parts.append(counts.astype(exact) @ entry.astype(exact))
        return np.bincount(cluster, minlength=k), np.concatenate([p.astype(object) for p in parts], axis=1)


def _paired(codes: list[np.ndarray], entries: list[np.ndarray], i: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks i and i+1 as one; the last of an odd number stays as it is."""
    if i + 1 == len(codes):
        return codes[i], entries[i]
    both, code = np.unique(codes[i].astype(np.int64) * len(entries[i + 1]) + codes[i + 1], return_inverse=True)
    left, right = np.divmod(both, len(entries[i + 1]))
    return code, np.concatenate([entries[i][left], entries[i + 1][right]], axis=1)


def _cost(codes: list[np.ndarray], entries: list[np.ndarray]) -> int:
    """Steps of a round per centroid: an addition per row and block; a difference, a product and a sum per dictionary component."""
    return sum(map(len, codes)) + 3 * sum(e.size for e in entries)


def _encode(width: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def chunk(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            packed = Chunk.of(whole.column(0), vector_matrix(whole.column(1), width, scale)).packed()
            kinds = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(packed, kinds)], names=["ids", "widths", "sizes", "codes", "entries", "wide"]
            )

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, CHUNK_ROWS - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == CHUNK_ROWS:
                    yield chunk(held)
                    held, rows = [], 0
        if rows:
            yield chunk(held)

    return run


def _partials(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = centroids.shape
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), object)
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk.unpacked(batch, i)
                n, s = chunk.members(chunk.nearest(centroids)[0], k)
                counts += n
                sums += s
        yield partial_rows({c: (int(counts[c]), list(sums[c])) for c in range(k) if counts[c]})

    return run


def _rows(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk.unpacked(batch, i)
                cluster, distance = chunk.nearest(centroids)
                yield pa.RecordBatch.from_arrays(
                    [chunk.ids.cast(pa.int64()), pa.array(cluster.astype(np.int32)), long_or_null(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

    return run


def cluster_vectors(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    width: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Exact k-means in whole numbers floor(scale * x); ``scale`` is a power of two.

    Only vectors of exactly ``width`` finite components take part. Centroids
    start as the ``k`` vectors with the smallest SHA-256 of "<seed>:<id>"; of
    rows that share an id, and so a hash, the one with the smaller vector
    comes first, and each may start a centroid. A NULL id is hashed as empty
    and reported as NULL. With fewer than ``k`` vectors there are as many
    centroids as vectors; without any the result is empty. Other columns are
    ignored, whatever their names.

    Result, one row per vector: vec_id, cluster, distance, cluster_inertia,
    inertia, centroid_sha256. Distances and sums that do not fit a long are
    NULL; assignments stay exact for them.

    Vectors are encoded once into the shared folder and never shuffled. A round
    is one narrow stage over the codes; what meets are k rows of sums per task,
    merged in tasks before the driver divides k rows.
    """
    if k < 1 or rounds < 0 or width < 1:
        raise ValueError("k and width must be at least 1, rounds at least 0")
    spark = vectors.sparkSession
    usable = vectors.filter(finite(vector_col) & (F.size(vector_col) == width)).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    chunks = kept(usable.mapInArrow(_encode(width, scale), CHUNK_SCHEMA), "subvectors")

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = usable.orderBy(F.sha2(name, 256), "vector").limit(k).select("vector").collect()
    if not first:
        return spark.createDataFrame([], ROW_SCHEMA + ", cluster_inertia long, inertia long, centroid_sha256 string")
    start = vector_matrix(pa.array([row["vector"] for row in first], pa.list_(pa.float64())), width, scale)
    centroids = start.astype(object)
    for _ in range(rounds):
        sums = total(chunks.mapInArrow(_partials(centroids), "key int, n long, sums array<string>"))
        moved = np.array([[s // sums[c][0] for s in sums[c][1]] if c in sums else list(centroids[c]) for c in range(len(centroids))], object)
        if (moved == centroids).all():
            # Nothing moved, so the rounds that are left would not move anything either.
            break
        centroids = moved

    rows = kept(chunks.mapInArrow(_rows(centroids), ROW_SCHEMA), "assigned")
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(20,0)")))
    per_cluster = rows.groupBy("cluster").agg(whole.alias("s")).collect()
    held = {row["cluster"]: None if row["s"] is None else int(row["s"]) for row in per_cluster}

    def fits(value: int | None) -> int | None:
        return value if value is not None and value < 1 << 63 else None

    inertia = None if None in held.values() else sum(held.values())
    figures = [
        (c, fits(s), fits(inertia), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in sorted(held.items())
    ]
    side = spark.createDataFrame(figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid.
    return rows.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
