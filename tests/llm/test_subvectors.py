import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from marginalia.llm import subvectors
from marginalia.llm.queries import QUERIES


def brute(rows, k=8, rounds=10, width=64, scale=1024, seed=3):
    used = [(i, [math.floor(scale * Fraction(x)) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in used)
    centroids = [v for _, v in hashed[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in used:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    last = [(i, *nearest(v)) for i, v in used]
    own = {n: sum(d for _, d, m in last if m == n) for n in range(len(centroids))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def fits(x):
        return x if x < 1 << 63 else None

    return sorted(((i, n, fits(d), fits(own[n]), fits(sum(own.values())), names[n]) for i, d, n in last), key=repr)


def told(df):
    return sorted(map(tuple, df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


@pytest.mark.parametrize("chunk", [16, 8192])
def test_equals_brute_force(frame, monkeypatch, chunk):
    monkeypatch.setattr(subvectors, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(chunk)
    centres = rng.normal(0, 0.3, (5, 6))
    rows = [(i, [float(x) for x in centres[i % 5] + rng.normal(0, 0.1, 6)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(120)]  # a hot vector
    rows += [(9, None), (10, [1.0] * 5), (11, [1.0] * 5 + [None]), (12, [math.nan] * 6), (13, [math.inf] + [0.0] * 5), (14, []), (None, rows[0][1])]
    df = frame(rows, "vec_id long, embedding array<double>")
    assert told(subvectors.cluster_vectors(df, 4, 10, 6)) == brute(rows, 4, 10, 6)


def test_huge_components_stay_exact(frame):
    rows = [(1, [1e6, 0.0]), (2, [-1e6, 0.5]), (3, [1e6, 1.0]), (4, [3e9, 0.0]), (5, [1e300, 0.0]), (6, [1.7e308, -1.0])]
    df = frame(rows, "vec_id long, embedding array<double>")
    assert told(subvectors.cluster_vectors(df, 2, 10, 2)) == brute(rows, 2, 10, 2)
    small = frame(rows[:3], "vec_id long, embedding array<double>")
    got = told(subvectors.cluster_vectors(small, 2, 10, 2))
    assert got == brute(rows[:3], 2, 10, 2) and all(None not in r for r in got)


def test_odd_tables(frame, spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert subvectors.cluster_vectors(empty).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert subvectors.cluster_vectors(empty).count() == 0
    few = [(7, [0.25, -0.5]), (7, [0.5, 0.5]), (7, [0.25, -0.5])]
    df = frame(few, "vec_id long, embedding array<double>").selectExpr("*", "1 as cluster", "2 as id", "3 as distance")
    assert told(subvectors.cluster_vectors(df, 8, 10, 2)) == brute(few, 8, 10, 2)


def test_blocks_widen_where_subvectors_repeat():
    rng = np.random.default_rng(1)
    spread = subvectors.Chunk.of(None, rng.integers(-500, 500, (1000, 8)))
    assert len(spread.codes) == 8
    base = rng.integers(-500, 500, (10, 8))
    copies = subvectors.Chunk.of(None, base[rng.integers(0, 10, 1000)])
    assert len(copies.codes) == 1 and copies.entries[0].shape == (10, 8)
    odd = rng.integers(0, 2, (1000, 7))
    chunk = subvectors.Chunk.of(None, odd)
    assert (np.concatenate([e[c] for c, e in zip(chunk.codes, chunk.entries)], axis=1) == odd).all()


def test_query_on_given_vectors(spark, small):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert told(QUERIES["op11_centroid_clustering"](spark, small)) == brute(rows)
