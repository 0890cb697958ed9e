import math
import random

import numpy as np
import pytest

from marginalia.llm import topk
from marginalia.llm.queries import QUERIES


def brute(vectors, queries, k):
    out = []
    for q, x in queries:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread", [1, 40])
def test_equals_brute_force(frame, spread):
    rng = np.random.default_rng(spread)
    rows = []
    for i in range(600):
        length = rng.integers(1, 1 + spread)
        rows.append((i, [int(v) for v in rng.normal(0, 30 * length, 16)]))
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # ties in score
    rows.append((2000, [0] * 16))
    df = frame(rows, "vec_id long, embedding array<long>")
    queries = [r for r in rows if r[0] % 50 == 0]
    got = topk.exact_top_k(df, df.filter("vec_id % 50 = 0"), 5).collect()
    assert sorted(map(tuple, got)) == brute(rows, queries, 5)


def test_coordinate_pruning_keeps_the_best(frame):
    # Tight clusters of one direction give high local cosine thresholds.
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 100, (20, 8))
    rows = [(i, [int(v) for v in centres[i % 20] + rng.normal(0, 2, 8)]) for i in range(5000)]
    df = frame(rows, "vec_id long, embedding array<long>")
    got = topk.exact_top_k(df, df.filter("vec_id % 500 = 0"), 5).collect()
    assert sorted(map(tuple, got)) == brute(rows, [r for r in rows if r[0] % 500 == 0], 5)


def test_odd_rows(frame, spark):
    rows = [(1, [1, 2]), (2, None), (None, [5, 5]), (3, [4, None]), (4, [3]), (50, [1, 1, 1]), (50, [1, 1, 1]), (6, [])]
    df = frame(rows, "vec_id long, embedding array<long>")
    got = sorted(map(tuple, topk.exact_top_k(df, df.filter("vec_id = 50"), 5).collect()))
    want = [(50, 1, 1, 3), (50, 2, 4, 3), (50, 3, 6, 0)]
    assert got == sorted(want + want)  # a repeated query row is answered each time
    empty = spark.createDataFrame([], "vec_id long, embedding array<long>")
    assert topk.exact_top_k(empty, empty, 5).count() == 0
    extra = df.selectExpr("*", "1 as rank", "2 as score", "3 as query_id")
    assert topk.exact_top_k(extra, extra.filter("vec_id = 50"), 1).count() == 2


def test_quantized(frame):
    rows = [(1, [0.5, -0.001]), (2, [math.nan]), (3, [math.inf]), (4, [None]), (5, None), (6, [])]
    got = dict(frame(rows, "i int, v array<float>").select("i", topk.quantized("v")).collect())
    assert got == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}


def test_query_on_given_vectors(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    vectors = [(r.vec_id, [math.floor(256 * float(x)) for x in r.embedding]) for r in rows]
    got = sorted(map(tuple, QUERIES["op3_exact_topk"](spark, small).collect()))
    assert got == brute(vectors, [v for v in vectors if v[0] % 50 == 0], 5)


def test_many_groups(frame, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_ROWS", 16)
    random.seed(1)
    rows = [(i, [random.randint(-9, 9) for _ in range(4)]) for i in range(300)]
    df = frame(rows, "vec_id long, embedding array<long>")
    got = topk.exact_top_k(df, df.filter("vec_id % 50 = 0"), 3).collect()
    assert sorted(map(tuple, got)) == brute(rows, [r for r in rows if r[0] % 50 == 0], 3)


def test_very_long_vectors_are_exact(frame):
    rng = np.random.default_rng(8)
    rows = [(i, [int(v) for v in rng.normal(0, 50, 4)]) for i in range(200)]
    # 1e6 quantised by 256, lengths next to each other beyond 2**53, and products beyond a long.
    rows += [(1000, [256_000_000, 1, 0, 0]), (1001, [256_000_000, 0, 0, 1]), (1050, [256_000_001, 3, 1, 0]), (1100, [-256_000_000, 7, 7, 7])]
    rows += [(1150, [1 << 40, 1, 1, 1]), (1200, [-(1 << 40), 5, 1, 1]), (1250, [(1 << 62), 0, 0, 3])]
    df = frame(rows, "vec_id long, embedding array<long>")
    queries = [r for r in rows if r[0] % 50 == 0]
    got = sorted(map(tuple, topk.exact_top_k(df, df.filter("vec_id % 50 = 0"), 5).collect()))
    want = []
    for q, x in queries:
        scored = sorted((-max(topk.LOW, min(topk.HIGH, sum(a * b for a, b in zip(x, y)))), i) for i, y in rows if i != q)
        want += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:5])]
    assert got == sorted(want)
