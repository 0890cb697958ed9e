"""Incremental maintenance of an index against its manifest.

index:    embedding_index, chunk_id, doc_id, file_sha1, deleted_utc
manifest: doc_id, slug, file_sha1
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.text import fixed
from marginalia.operators.topk import number_rows

# Tombstone shares above which to warn and to rebuild.
WARN_RATIO = 0.20
REBUILD_RATIO = 0.30

SECONDS_PER_DOC = 10


def indexed_documents(index: DataFrame, include_tombstoned: bool = False) -> DataFrame:
    rows = index if include_tombstoned else index.filter(F.col("deleted_utc").isNull())
    return rows.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()


def live_hashes(index: DataFrame) -> DataFrame:
    """First known file hash of each document among its live rows."""
    known = F.col("deleted_utc").isNull() & F.col("file_sha1").isNotNull()
    return index.filter(known).groupBy("doc_id").agg(F.min_by("file_sha1", "embedding_index").alias("file_sha1"))


def tombstone_ratio(index: DataFrame) -> DataFrame:
    """total, tombstoned, ratio and advice (ok, warn, rebuild)."""
    counts = index.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("deleted_utc").isNotNull()).alias("tombstoned")
    )
    ratio = F.coalesce(F.try_divide("tombstoned", "total"), F.lit(0.0))
    return counts.withColumn("ratio", ratio).withColumn(
        "advice",
        F.when(F.col("ratio") > REBUILD_RATIO, "rebuild")
        .when(F.col("ratio") > WARN_RATIO, "warn")
        .otherwise("ok"),
    )


def changes(manifest: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, change) with change in new, deleted, updated, same.

    One outer join of two one-row-per-document sides instead of three set
    operations: every document is shuffled once.
    """
    listed = manifest.select("doc_id", F.col("file_sha1").alias("manifest_sha1"), F.lit(True).alias("listed"))
    live = index.filter(F.col("deleted_utc").isNull() & F.col("doc_id").isNotNull())
    indexed = live.groupBy("doc_id").agg(
        F.min_by("file_sha1", F.when(F.col("file_sha1").isNotNull(), F.col("embedding_index"))).alias("index_sha1"),
        F.lit(True).alias("indexed"),
    )
    change = (
        F.when(F.col("indexed").isNull(), "new")
        .when(F.col("listed").isNull(), "deleted")
        .when(F.col("manifest_sha1") != F.col("index_sha1"), "updated")
        .otherwise("same")
    )
    return listed.join(indexed, "doc_id", "full_outer").select("doc_id", change.alias("change"))


def plan_for_agent(change_rows: DataFrame, agent_docs: DataFrame) -> DataFrame:
    """Action per document: process, skip, or tombstone.

    New and updated documents count only inside the agent's slice. Deletions
    follow the whole manifest: a document that merely left the slice stays."""
    inside = agent_docs.select("doc_id").distinct().withColumn("_inside", F.lit(True))
    action = (
        F.when(F.col("change") == "deleted", "tombstone")
        .when(F.col("_inside").isNull(), None)
        .when(F.col("change").isin("new", "updated"), "process")
        .otherwise("skip")
    )
    return (
        change_rows.join(inside, "doc_id", "left")
        .select("doc_id", "change", action.alias("action"))
        .filter(F.col("action").isNotNull())
    )


def change_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("change").agg(F.count(F.lit(1)).alias("n_docs"))


def tombstone(index: DataFrame, doc_ids: DataFrame, at: Column) -> DataFrame:
    """Mark live rows of the given documents; rows already marked keep their time."""
    dead = doc_ids.select("doc_id").distinct().withColumn("_dead", F.lit(True))
    hit = F.col("_dead") & F.col("deleted_utc").isNull()
    return (
        index.join(dead, "doc_id", "left")
        .withColumn("newly_deleted", F.coalesce(hit, F.lit(False)))
        .withColumn("deleted_utc", F.when(F.col("newly_deleted"), at).otherwise(F.col("deleted_utc")))
        .drop("_dead")
        .select(*index.columns, "newly_deleted")
    )


def append(index: DataFrame, fresh: DataFrame, order: list[str]) -> DataFrame:
    """Append rows behind the last position, numbered in ``order``."""
    last = index.agg(F.coalesce(F.max("embedding_index"), F.lit(-1)).alias("last"))
    placed = number_rows(fresh, order, "embedding_index", last.scalar() + 1)
    return index.unionByName(placed.select(*index.columns), allowMissingColumns=True)


def apply_changes(index: DataFrame, manifest: DataFrame, fresh: DataFrame, at: Column, order: list[str]) -> DataFrame:
    """One incremental run: tombstone deleted and updated documents, append the
    rows of new and updated ones. ``fresh`` has rows for manifest documents."""
    found = changes(manifest, index)
    gone = found.filter(F.col("change").isin("deleted", "updated"))
    todo = found.filter(F.col("change").isin("new", "updated"))
    marked = tombstone(index, gone, at).drop("newly_deleted")
    return append(marked, fresh.join(todo.select("doc_id"), "doc_id", "left_semi"), order)


def duration_text(seconds: Column) -> Column:
    """Seconds as ``42s``, ``7m`` or ``1.5h``."""
    return (
        F.when(seconds < 60, F.concat(seconds.cast("string"), F.lit("s")))
        .when(seconds < 3600, F.concat(F.floor(seconds / 60).cast("string"), F.lit("m")))
        .otherwise(F.concat(fixed(seconds / 3600.0, 1), F.lit("h")))
    )
