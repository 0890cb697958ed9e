"""Shared operators under skew: a third and more of all rows in one group."""

import random

import pytest
from pyspark.sql import functions as F

from marginalia.operators.topk import (
    first_per_key,
    last_per_key,
    lookup_per_key,
    number_rows,
    top_k_per_group,
)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(9)
    rows = [("hot" if i % 2 else f"k{rng.randint(0, 40)}", i, rng.randint(0, 50)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "key string, id long, v int").repartition(6)


def grouped(rows):
    out = {}
    for key, i, v in rows:
        out.setdefault(key, []).append((v, i))
    return out


@pytest.mark.parametrize("k", [3, 1200])
def test_top_k_per_group(skewed, k):
    rows, frame = skewed
    got = {}
    for r in top_k_per_group(frame, ["key"], [F.col("v").desc(), F.col("id")], k).orderBy("key", "rank").collect():
        got.setdefault(r["key"], []).append(r["id"])
    want = {key: [i for v, i in sorted(group, key=lambda x: (-x[0], x[1]))[:k]] for key, group in grouped(rows).items()}
    assert got == want


def test_top_k_needs_a_positive_k(skewed):
    with pytest.raises(ValueError):
        top_k_per_group(skewed[1], ["key"], [F.col("id")], 0)


def test_top_k_limits_rows_before_the_shuffle(skewed):
    plan = top_k_per_group(skewed[1], ["key"], [F.col("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_first_and_last_per_key(skewed):
    rows, frame = skewed
    first = {r["key"]: r["id"] for r in first_per_key(frame, ["key"], [F.col("v"), F.col("id")]).collect()}
    last = {r["key"]: r["id"] for r in last_per_key(frame, ["key"], [F.col("v"), F.col("id")]).collect()}
    assert first == {k: min(g)[1] for k, g in grouped(rows).items()}
    assert last == {k: max(g)[1] for k, g in grouped(rows).items()}


def test_lookup_per_key_keeps_every_row_and_salts_hot_keys(skewed):
    rows, frame = skewed
    sizes = frame.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup_per_key(frame, sizes, ["key"], "n")
    counts = {k: len(g) for k, g in grouped(rows).items()}
    got = joined.collect()
    assert len(got) == len(rows)
    assert all(r["n"] == counts[r["key"]] for r in got)
    without = lookup_per_key(frame, sizes.filter("key <> 'hot'"), ["key"], "n")
    assert without.filter("n IS NULL").count() == counts["hot"]


def test_number_rows_is_dense_and_ordered(skewed):
    rows, frame = skewed
    got = [r["id"] for r in number_rows(frame, ["v", "id"], "n", 10).orderBy("n").collect()]
    assert got == [i for _, i in sorted((v, i) for _, i, v in rows)]
    numbers = sorted(r["n"] for r in number_rows(frame, ["v", "id"], "n", 10).select("n").collect())
    assert numbers == list(range(10, 10 + len(rows)))
