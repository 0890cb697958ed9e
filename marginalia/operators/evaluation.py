"""Retrieval evaluation, batched over all items in one plan.

Relations:
  items      item_id, query, expected_page_start, expected_page_end, expected_section
  expected   item_id, doc_id            documents that count as a hit
  tags       item_id, tag
  retrieved  item_id, rank, doc_id[, chunk_id, page_start, page_end, section_heading]

``retrieved`` holds at most top_k rows per item; ``expected`` may be long and
stays a relation, it is never gathered into one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.operators.topk import join_hits
from marginalia.session import checkpointed

# Metric names in report order, and the per-tag ones.
AGGREGATE_METRICS = (
    "recall_at_1",
    "recall_at_3",
    "recall_at_5",
    "recall_at_10",
    "mrr",
    "ndcg_at_10",
    "citation_accuracy",
)
TAG_METRICS = ("recall_at_5", "mrr")

NDCG_DEPTH = 10


def split_items(items: DataFrame, expected: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runnable, skipped): an item is skipped when any expected document is
    missing from the manifest."""
    missing = expected.join(manifest.select("doc_id"), "doc_id", "left_anti").select("item_id").distinct()
    return items.join(missing, "item_id", "left_anti"), items.join(missing, "item_id", "left_semi")


def mark_hits(retrieved: DataFrame, expected: DataFrame, written: bool = False) -> DataFrame:
    """Add a boolean ``hit``. The expected relation may be long; it is streamed
    past the retrieved keys, and only rows that match are kept."""
    keys = ["item_id", "doc_id"]
    met = join_hits(expected.select(*keys), retrieved.select(*keys), keys, written=written)
    pairs = met.distinct().withColumn("_hit", F.lit(True))
    return (
        retrieved.join(pairs, ["item_id", "doc_id"], "left")
        .withColumn("hit", F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )


def ideal_gain(relevant: Column, k: int = NDCG_DEPTH) -> Column:
    """Discounted gain of ``min(k, relevant)`` hits at the top."""
    top = F.least(relevant, F.lit(k)).cast("int")
    gains = F.transform(F.sequence(F.lit(1), top), lambda i: F.lit(1.0) / F.log2(i + 1.0))
    return F.when(top >= 1, F.aggregate(gains, F.lit(0.0), lambda total, g: total + g)).otherwise(0.0)


def item_results(items: DataFrame, retrieved: DataFrame, expected: DataFrame, dedup_docs: bool = False) -> DataFrame:
    """One row per item: first hit, gains, and the first chunk's citation.

    Every chunk of an expected document counts as a hit while the ideal counts
    documents, so nDCG can exceed 1; ``dedup_docs`` counts a document once.
    """
    # A few rows per item; written once, because retrieval must not run again
    # for each use below.
    retrieved = checkpointed(retrieved)
    hits = mark_hits(retrieved, expected, written=True)
    gain = F.when(F.col("hit") & (F.col("rank") <= NDCG_DEPTH), F.lit(1.0) / F.log2(F.col("rank") + 1.0))
    firsts = [F.min(F.when(F.col("hit"), F.col("rank"))).alias("first_hit_rank")]
    for name in ("page_start", "page_end", "section_heading"):
        value = F.col(name) if name in retrieved.columns else F.lit(None)
        firsts.append(F.max(F.when(F.col("rank") == 1, value)).alias(f"top_{name}"))
    if dedup_docs:
        best = hits.groupBy("item_id", "doc_id").agg(F.min("rank").alias("rank"), F.max("hit").alias("hit"))
        gains = best.groupBy("item_id").agg(F.coalesce(F.sum(gain), F.lit(0.0)).alias("dcg"))
        per_item = hits.groupBy("item_id").agg(*firsts).join(gains, "item_id")
    else:
        per_item = hits.groupBy("item_id").agg(*firsts, F.coalesce(F.sum(gain), F.lit(0.0)).alias("dcg"))
    counts = expected.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_expected"))
    ideal = ideal_gain(F.coalesce("n_expected", F.lit(0)))
    return (
        items.join(per_item, "item_id", "left")
        .join(counts, "item_id", "left")
        .withColumn("ndcg", F.when(ideal > 0, F.coalesce("dcg", F.lit(0.0)) / ideal).otherwise(0.0))
    )


def strict_first_hit(retrieved: DataFrame, expected_chunks: DataFrame) -> DataFrame:
    """Best rank of an expected chunk, compared on (doc_id, chunk_index)."""
    return (
        retrieved.join(expected_chunks.distinct(), ["item_id", "doc_id", "chunk_index"], "left_semi")
        .groupBy("item_id")
        .agg(F.min("rank").alias("strict_first_hit_rank"))
    )


def recall(k: int, rank: str = "first_hit_rank") -> Column:
    """Share of items whose first hit is within ``k``; no items give 0."""
    if k < 1:
        raise ValueError("k must be at least 1")
    return F.coalesce(F.avg(F.when(F.col(rank) <= k, 1.0).otherwise(0.0)), F.lit(0.0))


def mean_reciprocal_rank(rank: str = "first_hit_rank") -> Column:
    return F.coalesce(F.avg(F.coalesce(F.lit(1.0) / F.col(rank), F.lit(0.0))), F.lit(0.0))


def page_matches() -> Column:
    """Page ranges overlap; a single expected page is a range of one."""
    overlap = (F.col("top_page_start") <= F.col("expected_page_end")) & (
        F.col("expected_page_start") <= F.col("top_page_end")
    )
    return F.coalesce(overlap, F.lit(False))


def citation_expected() -> Column:
    return F.col("expected_page_start").isNotNull() | F.col("expected_section").isNotNull()


def citation_correct() -> Column:
    """Both expectations must hold where set; NULL for items without any."""
    page = F.col("expected_page_start").isNull() | page_matches()
    section = F.col("expected_section").isNull() | F.coalesce(
        F.col("top_section_heading") == F.col("expected_section"), F.lit(False)
    )
    return F.when(citation_expected(), F.when(page & section, 1.0).otherwise(0.0))


def aggregate(results: DataFrame) -> DataFrame:
    """One row with all metrics. citation_accuracy is NULL without expectations."""
    return results.agg(
        F.count(F.lit(1)).alias("n_items"),
        *[recall(k).alias(f"recall_at_{k}") for k in (1, 3, 5, 10)],
        mean_reciprocal_rank().alias("mrr"),
        F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg_at_10"),
        F.avg(citation_correct()).alias("citation_accuracy"),
        F.count_if(citation_expected()).alias("n_citation_items"),
    )


def per_tag(results: DataFrame, tags: DataFrame) -> DataFrame:
    """Metrics per tag; an item counts once per listed occurrence of a tag."""
    return (
        tags.join(results.select("item_id", "first_hit_rank"), "item_id")
        .groupBy("tag")
        .agg(
            recall(5).alias("recall_at_5"),
            mean_reciprocal_rank().alias("mrr"),
            F.count(F.lit(1)).alias("n_items"),
        )
        .withColumn("low_sample", F.col("n_items") < 2)
    )


def metric_rows(aggregated: DataFrame, tags: DataFrame) -> DataFrame:
    """Metrics as rows (ordinal, metric, value), in the order drops are compared."""
    top = aggregated.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit("").alias("tag"), F.lit(n).alias("ordinal"), F.lit(m).alias("metric"),
                             F.col(m).cast("double").alias("value"))
                    for n, m in enumerate(AGGREGATE_METRICS)
                ]
            )
        )
    )
    tagged = tags.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.col("tag").alias("tag"), F.lit(100 + n).alias("ordinal"),
                             F.concat(F.lit("per_tag."), "tag", F.lit(f".{m}")).alias("metric"),
                             F.col(m).cast("double").alias("value"))
                    for n, m in enumerate(TAG_METRICS)
                ]
            )
        )
    )
    return top.unionByName(tagged)


def baseline_diff(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Signed change per metric present on both sides, with its drop."""
    old = baseline.select("metric", F.col("value").alias("baseline"))
    return (
        current.join(old, "metric")
        .filter("value IS NOT NULL AND baseline IS NOT NULL")
        .select(
            "tag",
            "ordinal",
            "metric",
            "value",
            "baseline",
            (F.col("value") - F.col("baseline")).alias("delta"),
            F.greatest(F.col("baseline") - F.col("value"), F.lit(0.0)).alias("drop"),
        )
    )


def gate(diff: DataFrame, fail_under: float) -> DataFrame:
    """Worst drop, the first metric that reaches it, and whether it passes."""
    worst = diff.agg(F.coalesce(F.max("drop"), F.lit(0.0)).alias("worst_drop"))
    first = (
        diff.filter(F.round("drop", 9) == F.round(worst.scalar(), 9))
        .agg(F.min_by("metric", F.struct("tag", "ordinal")).alias("metric"))
    )
    return worst.select(
        "worst_drop",
        F.when(F.col("worst_drop") > 0, first.scalar()).otherwise("").alias("worst_drop_metric"),
        (F.col("worst_drop") <= fail_under).alias("passes"),
    )
