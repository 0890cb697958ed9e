"""Manifest maintenance: upsert, collisions, and merging of manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators.topk import first_per_key, last_per_key, lookup_per_key


def upsert(manifest: DataFrame, incoming: DataFrame, key: str = "doc_id") -> DataFrame:
    """Replace or add entries; ``version`` decides between two incoming rows.

    Existing rows rank below any incoming row of the same key."""
    old = manifest.withColumn("_source", F.lit(0))
    new = incoming.withColumn("_source", F.lit(1))
    return last_per_key(
        old.unionByName(new, allowMissingColumns=True), [key], [F.col("_source"), F.col("version")]
    ).drop("_source")


def superseded(manifest: DataFrame, incoming: DataFrame) -> DataFrame:
    """Document ids that a re-ingest replaced: same slug, another doc_id."""
    fresh = incoming.select("slug", F.col("doc_id").alias("_new_id"))
    return (
        manifest.join(fresh, "slug").filter("doc_id <> _new_id").select("doc_id", "slug").distinct()
    )


def in_manifest_order(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy("slug", "doc_id")


def doc_id_collisions(docs: DataFrame) -> DataFrame:
    """Documents whose short id is already taken by other content.

    docs: pos (processing order), slug, doc_id, doc_sha1. The first document of
    an id stays the comparator.
    """
    first = docs.groupBy("doc_id").agg(
        F.min_by(F.struct("slug", "doc_sha1"), "pos").alias("first"), F.count(F.lit(1)).alias("_n")
    )
    return (
        lookup_per_key(docs, first, ["doc_id"], "_n")
        .filter(F.col("doc_sha1") != F.col("first.doc_sha1"))
        .select(
            "doc_id",
            F.col("first.slug").alias("existing_slug"),
            F.col("first.doc_sha1").alias("existing_sha1"),
            F.col("slug").alias("new_slug"),
            F.col("doc_sha1").alias("new_sha1"),
        )
    )


def slug_collisions(docs: DataFrame) -> DataFrame:
    """Slugs used by more than one document, with their group sizes."""
    return docs.groupBy("slug").agg(F.count(F.lit(1)).alias("n_docs")).filter("n_docs > 1")


def resolve_slugs(docs: DataFrame) -> DataFrame:
    """Add ``target_slug``: the first document of a slug keeps it, the others
    get their short doc_id, or their agent's name without one.

    docs: agent, pos, slug, doc_id. Order is (agent, pos).
    """
    groups = docs.groupBy("slug").agg(
        F.min(F.struct("agent", "pos")).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    suffix = F.coalesce(F.substring("doc_id", 1, 8), F.substring(F.lower("agent"), 1, 8))
    keeps = (F.col("_first.agent") == F.col("agent")) & (F.col("_first.pos") == F.col("pos"))
    return (
        lookup_per_key(docs, groups, ["slug"], "_n")
        .withColumn(
            "target_slug", F.when(keeps, F.col("slug")).otherwise(F.concat("slug", F.lit("-"), suffix))
        )
        .drop("_first", "_n")
    )


def merge_manifests(resolved: DataFrame) -> DataFrame:
    """One manifest from those of all agents.

    Entries with a doc_id are kept once, first by (agent, pos). Their slug is
    looked up by doc_id, otherwise by (agent, slug); the later document wins a
    lookup, and paths follow a renamed slug.
    """
    order = [F.col("agent"), F.col("pos")]
    with_id = resolved.filter(F.col("doc_id").isNotNull())
    without_id = resolved.filter(F.col("doc_id").isNull())
    by_id = with_id.groupBy("doc_id").agg(F.max_by("target_slug", F.struct(*order)).alias("new_slug"))
    by_name = resolved.groupBy("agent", "slug").agg(
        F.max_by("target_slug", F.struct(*order)).alias("new_slug"), F.count(F.lit(1)).alias("_n")
    )
    kept = first_per_key(with_id, ["doc_id"], order).join(by_id, "doc_id")
    rest = lookup_per_key(without_id, by_name, ["agent", "slug"], "_n").drop("_n")
    return kept.unionByName(rest).select(
        "agent",
        "pos",
        "doc_id",
        F.col("slug").alias("orig_slug"),
        F.col("new_slug").alias("slug"),
        F.replace("doc_path", F.col("slug"), F.col("new_slug")).alias("doc_path"),
    )


def chunk_files(hits: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add ``slug`` and ``chunk_path`` to hits(doc_id, chunk_index): where a chunk's file stands.

    manifest: doc_id, slug and pos, the order of its entries; the first entry of
    a doc_id that names a slug counts. A document the manifest does not know, or
    without a slug, leaves both NULL. Columns of these names are replaced.
    """
    named = manifest.filter(F.col("doc_id").isNotNull() & (F.col("slug") != ""))
    first = named.groupBy("doc_id").agg(F.min_by("slug", "pos").alias("slug"), F.count(F.lit(1)).alias("_n"))
    placed = lookup_per_key(hits.drop("slug", "chunk_path"), first, ["doc_id"], "_n").drop("_n")
    return placed.withColumn("chunk_path", F.concat("slug", F.format_string("/chunks/ch_%04d.md", F.col("chunk_index").cast("long"))))


def documents_per_agent(docs: DataFrame) -> DataFrame:
    return docs.groupBy("agent").agg(F.count(F.lit(1)).alias("n_docs"))


def agent_slug_rows(resolved: DataFrame) -> DataFrame:
    """Slug lists of the agent definitions, as rows rather than one value."""
    return resolved.select("agent", F.col("target_slug").alias("slug")).distinct()


def processing_stats(files: DataFrame) -> DataFrame:
    """Run summary from rows (status, parse_ms)."""
    return files.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.coalesce(F.sum("parse_ms"), F.lit(0.0)).alias("total_ms"),
    )
