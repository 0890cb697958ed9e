import math

import pytest
from pyspark.sql import functions as F

from marginalia.operators import evaluation as ev

ITEMS = "item_id string, query string, expected_page_start int, expected_page_end int, expected_section string"
FOUND = "item_id string, rank int, doc_id string, chunk_index int, page_start int, page_end int, section_heading string"


def items(spark, rows):
    return spark.createDataFrame([(i, "q", *r) for i, r in rows], ITEMS)


def ranks_frame(spark, ranks):
    return spark.createDataFrame([(f"i{n}", r) for n, r in enumerate(ranks)], "item_id string, first_hit_rank int")


def test_metric_literals(spark):
    assert ranks_frame(spark, [1, 3, None, 7]).agg(ev.recall(5)).first()[0] == 0.5
    assert ranks_frame(spark, [1, 2, None, 4]).agg(ev.mean_reciprocal_rank()).first()[0] == 0.4375
    assert ranks_frame(spark, []).agg(ev.recall(5), ev.mean_reciprocal_rank()).first()[:] == (0.0, 0.0)
    with pytest.raises(ValueError):
        ev.recall(0)


def test_ndcg_literal_and_zero_ideal(spark):
    base = items(spark, [("a", (None, None, None)), ("b", (None, None, None))])
    found = spark.createDataFrame([("a", r, f"d{r}", 1, None, None, None) for r in (1, 2, 3)], FOUND)
    expected = spark.createDataFrame([("a", "d3")], "item_id string, doc_id string")
    rows = {r["item_id"]: r for r in ev.item_results(base, found, expected).collect()}
    assert rows["a"]["ndcg"] == pytest.approx(0.5) and rows["a"]["first_hit_rank"] == 3
    assert rows["b"]["ndcg"] == 0.0 and rows["b"]["first_hit_rank"] is None


@pytest.fixture(scope="module")
def mini(spark):
    """Three queries over five chunks of three documents."""
    base = items(spark, [("alpha", (None, None, None)), ("beta", (5, 6, "2.1 Interval")), ("gamma", (12, 12, None))])
    order = {
        "alpha": [("doc-alpha", 1), ("doc-alpha", 2), ("doc-beta", 1)],
        "beta": [("doc-beta", 2), ("doc-beta", 1), ("doc-gamma", 1)],
        "gamma": [("doc-gamma", 1), ("doc-beta", 1), ("doc-alpha", 1)],
    }
    place = {("doc-beta", 2): (5, 6, "2.1 Interval"), ("doc-gamma", 1): (12, 12, "Falsifiability")}
    rows = [
        (item, rank, doc, chunk, *place.get((doc, chunk), (3, 3, None)))
        for item, hits in order.items()
        for rank, (doc, chunk) in enumerate(hits, start=1)
    ]
    expected = spark.createDataFrame([(k, f"doc-{k}") for k in order], "item_id string, doc_id string")
    return base, spark.createDataFrame(rows, FOUND), expected


def test_mini_corpus_golden(mini):
    row = ev.aggregate(ev.item_results(*mini)).first()
    assert row["ndcg_at_10"] == pytest.approx(1.4206198357143052, abs=1e-15)
    assert [row[f"recall_at_{k}"] for k in (1, 3, 5, 10)] == [1.0] * 4
    assert (row["mrr"], row["citation_accuracy"], row["n_citation_items"], row["n_items"]) == (1.0, 1.0, 2, 3)


def test_counting_documents_once_bounds_ndcg(mini):
    assert ev.aggregate(ev.item_results(*mini, dedup_docs=True)).first()["ndcg_at_10"] == pytest.approx(1.0)


def test_ideal_gain(spark):
    values = spark.range(13).select(ev.ideal_gain(F.col("id")).alias("v"))
    want = [sum(1 / math.log2(i + 1) for i in range(1, min(10, n) + 1)) for n in range(13)]
    assert [r["v"] for r in values.collect()] == pytest.approx(want)


@pytest.mark.parametrize(
    "want,top,correct",
    [
        ((5, 5, None), (4, 6, "S"), 1.0),
        ((7, 7, None), (4, 6, "S"), 0.0),
        ((6, 9, None), (4, 6, "S"), 1.0),
        ((7, 9, None), (4, 6, "S"), 0.0),
        ((5, 5, None), (None, None, "S"), 0.0),
        ((None, None, "S"), (None, None, "S"), 1.0),
        ((None, None, "s"), (1, 1, "S"), 0.0),
        ((None, None, "S"), (1, 1, None), 0.0),
        ((5, 5, "S"), (5, 5, "T"), 0.0),
        ((5, 5, "S"), (5, 5, "S"), 1.0),
        ((None, None, None), (5, 5, "S"), None),
    ],
)
def test_citation_cases(spark, want, top, correct):
    base = items(spark, [("a", want)])
    found = spark.createDataFrame([("a", 1, "d", 1, *top), ("a", 2, "d", 2, 5, 5, "S")], FOUND)
    expected = spark.createDataFrame([("a", "d")], "item_id string, doc_id string")
    got = ev.item_results(base, found, expected).select(ev.citation_correct().alias("c")).first()["c"]
    assert got == correct


def test_citation_accuracy_is_null_without_expectations(spark):
    base = items(spark, [("a", (None, None, None))])
    found = spark.createDataFrame([("a", 1, "d", 1, 1, 1, "S")], FOUND)
    expected = spark.createDataFrame([("a", "d")], "item_id string, doc_id string")
    row = ev.aggregate(ev.item_results(base, found, expected)).first()
    assert row["citation_accuracy"] is None and row["n_citation_items"] == 0


def test_items_with_missing_documents_are_skipped(spark):
    base = items(spark, [("a", (None,) * 3), ("b", (None,) * 3)])
    expected = spark.createDataFrame([("a", "d1"), ("b", "d1"), ("b", "gone")], "item_id string, doc_id string")
    manifest = spark.createDataFrame([("d1",)], "doc_id string")
    runnable, skipped = ev.split_items(base, expected, manifest)
    assert [r["item_id"] for r in runnable.collect()] == ["a"]
    assert [r["item_id"] for r in skipped.collect()] == ["b"]


def test_per_tag_counts_repeated_tags(spark):
    results = ranks_frame(spark, [1, None])
    tags = spark.createDataFrame([("i0", "x"), ("i0", "x"), ("i1", "y")], "item_id string, tag string")
    rows = {r["tag"]: r for r in ev.per_tag(results, tags).collect()}
    assert (rows["x"]["n_items"], rows["x"]["low_sample"], rows["x"]["mrr"]) == (2, False, 1.0)
    assert (rows["y"]["n_items"], rows["y"]["low_sample"], rows["y"]["recall_at_5"]) == (1, True, 0.0)


METRICS = "tag string, ordinal int, metric string, value double"


def test_gate_takes_the_first_worst_metric(spark):
    old = spark.createDataFrame([("", 0, "recall_at_1", 0.9), ("", 4, "mrr", 0.8), ("x", 100, "per_tag.x.recall_at_5", 1.0), ("", 6, "citation_accuracy", None)], METRICS)
    new = spark.createDataFrame([("", 0, "recall_at_1", 1.0), ("", 4, "mrr", 0.7), ("x", 100, "per_tag.x.recall_at_5", 0.9), ("", 6, "citation_accuracy", 0.0)], METRICS)
    row = ev.gate(ev.baseline_diff(new, old), 0.05).first()
    assert row["worst_drop"] == pytest.approx(0.1) and row["worst_drop_metric"] == "mrr" and not row["passes"]
    better = ev.gate(ev.baseline_diff(old, old), 0.05).first()
    assert (better["worst_drop"], better["worst_drop_metric"], better["passes"]) == (0.0, "", True)


def test_strict_hits_compare_document_and_chunk(mini, spark):
    wanted = spark.createDataFrame([("alpha", "doc-alpha", 2), ("beta", "doc-beta", 9)], "item_id string, doc_id string, chunk_index int")
    rows = ev.strict_first_hit(mini[1], wanted).collect()
    assert [(r["item_id"], r["strict_first_hit_rank"]) for r in rows] == [("alpha", 2)]
