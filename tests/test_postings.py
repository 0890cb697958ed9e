"""Block search against scores computed posting by posting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.operators import bm25, postings
from test_retrieval import brute_bm25


@pytest.fixture
def small_segments(monkeypatch):
    monkeypatch.setattr(postings, "SEGMENT_BITS", 4)
    monkeypatch.setattr(postings, "SEGMENT", 16)
    monkeypatch.setattr(postings, "STRETCH_BITS", 1)


def bodies_of(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    return [" ".join(rng.choices(words, weights, k=rng.randrange(0, 30))) for _ in range(n)]


def index_of(spark, bodies, dead=(), materialize=True, partitions=5):
    rows = [(i, f"c{i}", f"d{i}", b) for i, b in enumerate(bodies)]
    chunks = spark.createDataFrame(rows, "bm25_index long, chunk_id string, doc_id string, text string").repartition(partitions)
    gone = F.when(F.col("bm25_index").isin([-1, *dead]), F.to_timestamp(F.lit("2024-01-01")))
    return bm25.build_index(chunks.withColumn("deleted_utc", gone), materialize)


@pytest.mark.parametrize("k", [1, 7, 400])
def test_block_search_equals_brute_force(spark, small_segments, k):
    bodies = bodies_of(300, 3)
    dead = set(range(0, 300, 7))
    index = index_of(spark, bodies, dead)
    texts = ["w0 w1", "w39 w38 w2", "w5", "w17 w17 w0", "none", "w3 none w30 w31 w32"]
    asked = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    got = {}
    for r in bm25.search_bm25(index, asked, k, digits=9).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["bm25_index"], r["score"]))
    for q, text in enumerate(texts):
        scores = brute_bm25(bodies, text)
        live = [i for i in range(300) if i not in dead]
        want = sorted(live, key=lambda i: (-scores[i], i))[:k]
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, len(want) + 1))
        assert [s for _, _, s in found] == pytest.approx([scores[i] for i in want], abs=2e-6)
        assert [i for _, i, _ in found] == want


def test_over_fetch_and_added_deletions(spark, small_segments):
    bodies = bodies_of(80, 5)
    index = index_of(spark, bodies, {0, 3})
    asked = spark.createDataFrame([(1, "w0 w7")], "query_id long, text string")
    more = spark.createDataFrame([(i,) for i in range(5, 20)], "bm25_index long")
    full = [r["bm25_index"] for r in bm25.search_bm25(index, asked, 80).orderBy("rank").collect()]
    got = [r["bm25_index"] for r in bm25.search_bm25(index, asked, 80, deleted=more).orderBy("rank").collect()]
    assert got == [i for i in full if not 5 <= i < 20]
    loose = [r["bm25_index"] for r in bm25.search_bm25(index, asked, 4, exact=False).orderBy("rank").collect()]
    assert loose == full[:4]


def test_blocks_hold_every_posting_and_its_peaks(spark, small_segments):
    bodies = bodies_of(60, 9)
    index = index_of(spark, bodies, materialize=True, partitions=4)
    flat = {(r["term"], r["bm25_index"]): (r["tf"], r["dl"]) for r in postings.flat_postings(index.blocks).collect()}
    want = {}
    for i, body in enumerate(bodies):
        for word in set(body.split()):
            want[word, i] = (body.split().count(word), len(body.split()))
    assert flat == want
    for row in index.blocks.filter("term <> ''").collect():
        best = {(t, d) for t, d in zip(row["peak_tfs"], row["peak_dls"])}
        for tf, dl in zip(row["tfs"], row["dls"]):
            assert any(t >= tf and d <= dl for t, d in best)
    terms = {r["term"]: r["df"] for r in index.terms.collect()}
    assert terms == {w: sum(w == k for k, _ in want) for w in {k for k, _ in want}}


def test_a_search_reads_the_folders_and_row_groups_of_its_terms(spark):
    index = index_of(spark, bodies_of(50, 1))
    asked = spark.createDataFrame([(1, "w3")], "query_id long, text string")
    plan = bm25.search_bm25(index, asked, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slot" in plan or "PartitionFilters: [slot" in plan
    assert "PushedFilters: [In(term, [w3])" in plan or "EqualTo(term,w3)" in plan
    assert "tokens" not in plan


def test_blocks_out_of_reach_are_not_read():
    k1, b = 1.5, 0.75
    scorer = postings.Scorer([(1, [("rare", 5.0), ("stop", 0.1)])], 10.0, k1, b, 2, None)
    def part(places, tf, dl):
        places = np.array(places)
        return [places, np.full(len(places), tf), np.full(len(places), dl), np.array([tf]), np.array([dl])]
    nothing = np.empty(0, np.int64)
    scorer.segment(0, {"rare": [part([1, 2, 3], 4, 5)], "stop": [part([2, 9], 1, 5)]}, nothing, None)
    read = scorer.read
    base = 1 << postings.SEGMENT_BITS
    scorer.segment(1, {"stop": [part(list(range(base, base + 500)), 1, 5)]}, nothing, None)
    assert scorer.read == read and scorer.skipped == 1
    assert [list(p) for _, p in scorer.best] == [[2, 1]]


def worded(spark, rows):
    return spark.createDataFrame([(i, str(i), str(i), text) for i, text in rows], "bm25_index long, chunk_id string, doc_id string, text string")


def test_tasks_of_blocks_grow_with_the_chunks(spark, monkeypatch):
    rows = [(i, f"common w{i % 7} w{i % 11}") for i in range(300)]
    docs = bm25.forward_side(worded(spark, rows))
    whole = sorted(map(tuple, bm25.postings(docs).collect()))
    monkeypatch.setattr(postings, "SLOT_CHUNKS", 50)
    dealt = postings.block_rows(docs)
    assert dealt.rdd.getNumPartitions() == 6 * postings.SLOTS
    assert sorted(map(tuple, bm25.postings(docs).collect())) == whole
    assert dealt.groupBy("term", "segment").count().filter("count > 1").count() == 0


def test_postings_search_moves_postings_not_pairs(spark):
    rows = [(i, f"common w{i % 7} w{i % 11}") for i in range(300)] + [(5, "common w3"), (40_000, "w3 w3 w4")]
    index = bm25.build_index(worded(spark, rows), materialize=True)
    queries = spark.createDataFrame([("a", "common w3 w3"), ("b", "w4 none"), (None, "w3")], "query_id string, text string")
    stored = bm25.stored_postings(index)
    found = bm25.search_postings(stored, index.terms, index.meta, queries, 9, digits=9)
    assert "bm25_index" not in "".join(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in line)
    idf, avgdl = {r["term"]: r["idf"] for r in index.terms.collect()}, index.meta.first()["avgdl"]
    scores = {}
    for query, words in (("a", ["common", "w3", "w3"]), ("b", ["w4"]), (None, ["w3"])):
        for r in stored.collect():
            part = words.count(r["term"]) * idf[r["term"]] * r["tf"] * 2.5 / (r["tf"] + 1.5 * (0.25 + 0.75 * r["dl"] / avgdl))
            if r["term"] in words:
                scores[query, r["bm25_index"]] = scores.get((query, r["bm25_index"]), 0.0) + part
    for query in ("a", "b", None):
        best = sorted((-round(s, 9), i) for (q, i), s in scores.items() if q == query)[:9]
        got = found.filter(F.col("query_id").eqNullSafe(query)).orderBy("rank").collect()
        assert [r["bm25_index"] for r in got] == [i for _, i in best]
        assert [r["score"] for r in got] == pytest.approx([-s for s, _ in best], abs=1e-6)
