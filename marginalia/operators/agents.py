"""Agent slices of the corpus: which documents each agent may search.

Agent configurations come as small relations:
  agents(agent), agent_collections(agent, collection),
  agent_slugs(agent, slug), agent_excludes(agent, slug)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.text import valid_collections


def agent_predicate(
    slug: Column,
    collections: Column,
    slugs: list[str] | None,
    wanted: list[str] | None,
    excluded: list[str] | None,
) -> Column:
    """Filter of one agent: no slugs and no collections means everything;
    otherwise either may match; exclusions always win."""
    if not slugs and not wanted:
        keep = F.lit(True)
    else:
        by_slug = slug.isin(list(slugs)) if slugs else F.lit(False)
        by_collection = (
            F.coalesce(F.arrays_overlap(collections, F.array(*[F.lit(c) for c in wanted])), F.lit(False))
            if wanted
            else F.lit(False)
        )
        keep = by_slug | by_collection
    return keep & ~slug.isin(list(excluded)) if excluded else keep


def agent_documents(
    docs: DataFrame,
    agents: DataFrame,
    agent_collections: DataFrame,
    agent_slugs: DataFrame,
    agent_excludes: DataFrame,
) -> DataFrame:
    """(agent, doc_id, slug) for all agents at once.

    docs: doc_id, slug, collections. The configuration side is small, so Spark
    joins it by broadcast from its size statistics; a common collection then
    needs no shuffle at all.
    """
    base = docs.select("doc_id", "slug", "collections")
    by_collection = (
        base.select("doc_id", "slug", F.explode(F.array_distinct("collections")).alias("collection"))
        .join(agent_collections, "collection")
        .select("agent", "doc_id", "slug")
    )
    by_slug = base.join(agent_slugs, "slug").select("agent", "doc_id", "slug")
    unrestricted = agents.join(agent_collections, "agent", "left_anti").join(agent_slugs, "agent", "left_anti")
    names = unrestricted.agg(F.sort_array(F.collect_set("agent")).alias("names"))
    by_default = base.select(F.explode(names.scalar()).alias("agent"), "doc_id", "slug")
    return (
        by_collection.unionByName(by_slug)
        .unionByName(by_default)
        .dropDuplicates(["agent", "doc_id"])
        .join(agent_excludes, ["agent", "slug"], "left_anti")
        .select("agent", "doc_id", "slug")
    )


def affected_agents(changed: DataFrame, agent_collections: DataFrame) -> DataFrame:
    """Agents whose configuration names a changed collection."""
    return (
        agent_collections.join(changed.select("collection").distinct(), "collection")
        .select("collection", "agent")
        .distinct()
    )


def collection_counts(docs: DataFrame) -> DataFrame:
    """Documents per collection tag."""
    return (
        docs.select(F.explode("collections").alias("collection"))
        .groupBy("collection")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )


def merge_collections(docs: DataFrame) -> DataFrame:
    """Add ``added`` tags to ``collections``; rows without a new tag drop out."""
    extra = F.array_except("added", "collections")
    return docs.withColumn("new_tags", F.array_sort(extra)).filter(F.size("new_tags") > 0).withColumn(
        "collections", F.array_sort(F.array_union("collections", "added"))
    )


def clean_collections(docs: DataFrame) -> DataFrame:
    """Keep valid tags in ``collections`` and list the rest in ``invalid``."""
    valid = valid_collections(F.col("collections"))
    return docs.withColumn("invalid", F.array_except("collections", valid)).withColumn("collections", valid)


def available_agents(vectors: DataFrame) -> DataFrame:
    """Agents that have an index, by name."""
    return vectors.select("agent").distinct().orderBy("agent")
