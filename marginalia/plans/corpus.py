"""Agents, manifest and incremental index maintenance over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import hashing, render, text
from marginalia.operators import agents, manifest, staleness
from marginalia.plans.registry import query, table
from marginalia.session import checkpointed

NOW = "2024-06-01 00:00:00"

# --- agents: one per region; its nations name the collections it may read ---


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.format_string("doc-%d", "doc_id").alias("slug"),
        F.array("lang", "source").alias("collections"),
    )


def _agent_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """agents, collections, slugs, exclusions. Region 4 is unrestricted; good
    documents are spread over regions 0..2 by id, toxic ones excluded over all."""
    region = table(spark, sf_dir, "region").select(
        F.col("r_name").alias("agent"), F.col("r_regionkey").cast("long").alias("key")
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"), F.col("n_regionkey").cast("long").alias("key"))
    labels = table(spark, sf_dir, "labels")
    collections = (
        nation.filter("key < 4").join(region, "key").select("agent", F.format_string("src%d", "n").alias("collection"))
    )
    slug = F.format_string("doc-%d", "doc_id").alias("slug")
    slugs = labels.filter("quality = 1").select((F.col("doc_id") % 3).alias("key"), slug).join(region, "key").select("agent", "slug")
    excludes = labels.filter("toxic = 1").select((F.col("doc_id") % 5).alias("key"), slug).join(region, "key").select("agent", "slug")
    return region.select("agent"), collections, slugs, excludes


AGENT_SQL = """
ac AS (SELECT r_name AS agent, 'src' || n_nationkey AS collection FROM region JOIN nation ON n_regionkey = r_regionkey WHERE r_regionkey < 4),
asl AS (SELECT r_name AS agent, doc_id FROM labels JOIN region ON r_regionkey = doc_id % 3 WHERE quality = 1),
ax AS (SELECT r_name AS agent, doc_id FROM labels JOIN region ON r_regionkey = doc_id % 5 WHERE toxic = 1),
members AS (
  SELECT r_name AS agent, d.doc_id FROM region CROSS JOIN documents d
  WHERE (r_regionkey = 4 OR EXISTS (SELECT 1 FROM ac WHERE ac.agent = r_name AND ac.collection IN (d.lang, d.source))
         OR EXISTS (SELECT 1 FROM asl WHERE asl.agent = r_name AND asl.doc_id = d.doc_id))
    AND NOT EXISTS (SELECT 1 FROM ax WHERE ax.agent = r_name AND ax.doc_id = d.doc_id)
)"""


@query("agent_filter", f"WITH {AGENT_SQL} SELECT agent, doc_id, 'doc-' || doc_id AS slug FROM members")
def agent_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agents.agent_documents(_corpus(spark, sf_dir), *_agent_tables(spark, sf_dir))


@query(
    "agent_filter_one",
    """
SELECT doc_id FROM documents
WHERE (lang IN ('fr', 'es') OR source IN ('fr', 'src2', 'es') OR 'doc-' || doc_id IN ('doc-1', 'doc-3', 'doc-10'))
  AND 'doc-' || doc_id NOT IN ('doc-3', 'doc-7')
""",
)
def agent_filter_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One agent given as configuration values; the filter reaches the scan."""
    keep = agents.agent_predicate(
        F.col("slug"), F.col("collections"), ["doc-1", "doc-3", "doc-10"], ["fr", "es", "src2"], ["doc-3", "doc-7"]
    )
    return _corpus(spark, sf_dir).filter(keep).select("doc_id")


@query("agent_doc_counts", f"WITH {AGENT_SQL} SELECT agent, count(*) AS n_docs FROM members GROUP BY agent")
def agent_doc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.documents_per_agent(agent_filter(spark, sf_dir))


@query(
    "affected_agents",
    f"""
WITH {AGENT_SQL}, changed AS (SELECT DISTINCT source AS collection FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
SELECT DISTINCT collection, agent FROM ac JOIN changed USING (collection)
""",
)
def affected_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agents to refresh when the sources of toxic documents change."""
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    changed = table(spark, sf_dir, "documents").join(toxic, "doc_id", "left_semi").select(F.col("source").alias("collection"))
    return agents.affected_agents(changed, _agent_tables(spark, sf_dir)[1])


@query(
    "available_agents",
    "SELECT DISTINCT event_type AS agent FROM events ORDER BY agent",
)
def available_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct agent names of an index (event types stand for agents)."""
    return agents.available_agents(table(spark, sf_dir, "events").select(F.col("event_type").alias("agent")))


@query(
    "collection_counts",
    "SELECT collection, count(*) AS n_docs FROM (SELECT unnest([lang, source]) AS collection FROM documents) GROUP BY collection",
)
def collection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agents.collection_counts(_corpus(spark, sf_dir))


@query(
    "collection_merge",
    """
WITH l AS (
  SELECT d.doc_id, [lang, source] AS c, list_distinct([lang, CASE WHEN quality = 1 THEN 'curated' ELSE source END]) AS a
  FROM documents d JOIN labels USING (doc_id)
)
SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(c, a))), ',') AS collections,
       array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(c, x))), ',') AS new_tags
FROM l WHERE len(list_filter(a, lambda x: NOT list_contains(c, x))) > 0
""",
)
def collection_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag labelled documents; those that gain no tag are left out."""
    docs = _corpus(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    tag = F.when(F.col("quality") == 1, "curated").otherwise(F.col("collections")[1])
    merged = agents.merge_collections(docs.withColumn("added", F.array(F.col("collections")[0], tag)))
    return merged.select(
        "doc_id", F.array_join("collections", ",").alias("collections"), F.array_join("new_tags", ",").alias("new_tags")
    )


@query(
    "valid_collections",
    """
WITH c AS (
  SELECT doc_id, [lang, upper(source), source || '-' || lang, lang || '--' || source, ' ' || lang, ''] AS c FROM documents
)
SELECT doc_id, array_to_string(list_filter(c, lambda x: regexp_matches(x, '^[a-z0-9]+(-[a-z0-9]+)*$')), ',') AS collections,
       len(list_filter(c, lambda x: NOT regexp_matches(x, '^[a-z0-9]+(-[a-z0-9]+)*$')))::BIGINT AS n_invalid FROM c
""",
)
def valid_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang, source = F.col("lang"), F.col("source")
    names = F.array(
        lang, F.upper(source), F.concat_ws("-", source, lang), F.concat_ws("--", lang, source),
        F.concat(F.lit(" "), lang), F.lit(""),
    )
    cleaned = agents.clean_collections(table(spark, sf_dir, "documents").select("doc_id", names.alias("collections")))
    return cleaned.select(
        "doc_id", F.array_join("collections", ",").alias("collections"), F.size("invalid").cast("long").alias("n_invalid")
    )


@query(
    "split_collections",
    """
SELECT doc_id, array_to_string(list_filter(list_transform(string_split(' ' || lang || ', ,' || source || ' ,', ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS names
FROM documents
""",
)
def split_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    argument = F.concat(F.lit(" "), "lang", F.lit(", ,"), "source", F.lit(" ,"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(text.split_collections(argument), "|").alias("names")
    )


# --- manifest ---------------------------------------------------------------


@query(
    "manifest_upsert",
    """
WITH inc AS (SELECT doc_id + toxic * 100000000 AS doc_id, 'upd-' || doc_id AS slug, doc_id AS version FROM labels),
old AS (SELECT doc_id, 'doc-' || doc_id AS slug FROM documents)
SELECT doc_id, slug FROM inc UNION ALL SELECT doc_id, slug FROM old WHERE doc_id NOT IN (SELECT doc_id FROM inc)
ORDER BY slug, doc_id
""",
)
def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents come in again; toxic ones under a new id."""
    old = _corpus(spark, sf_dir).select("doc_id", "slug", F.lit(0).cast("long").alias("version"))
    incoming = table(spark, sf_dir, "labels").select(
        (F.col("doc_id") + F.col("toxic") * F.lit(100000000).cast("long")).alias("doc_id"),
        F.format_string("upd-%d", "doc_id").alias("slug"),
        F.col("doc_id").alias("version"),
    )
    return manifest.in_manifest_order(manifest.upsert(old, incoming).select("doc_id", "slug"))


@query(
    "manifest_superseded",
    """
SELECT doc_id, 'doc-' || doc_id AS slug FROM documents JOIN labels USING (doc_id) WHERE toxic = 1
""",
)
def manifest_superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old ids left behind by a re-ingest that changed the content id."""
    incoming = table(spark, sf_dir, "labels").select(
        F.format_string("doc-%d", "doc_id").alias("slug"),
        (F.col("doc_id") + F.col("toxic") * F.lit(100000000).cast("long")).alias("doc_id"),
    )
    return manifest.superseded(_corpus(spark, sf_dir).select("doc_id", "slug"), incoming)


@query(
    "doc_id_collisions",
    """
WITH d AS (SELECT doc_id AS pos, 'doc-' || doc_id AS slug, substr(sha1(text), 1, 2) AS id, sha1(text) AS h FROM documents),
f AS (SELECT id, arg_min(slug, pos) AS s, arg_min(h, pos) AS fh FROM d GROUP BY id)
SELECT id AS doc_id, s AS existing_slug, fh AS existing_sha1, slug AS new_slug, h AS new_sha1 FROM d JOIN f USING (id) WHERE h <> fh
""",
)
def doc_id_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids cut to two digits, so that different documents do collide."""
    full = hashing.sha1(F.col("text"))
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"),
        F.format_string("doc-%d", "doc_id").alias("slug"),
        hashing.short_id(full, 2).alias("doc_id"),
        full.alias("doc_sha1"),
    )
    return manifest.doc_id_collisions(docs)


def _agent_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as corpora of their sources, under the slug of their first
    word; source src5 has no content ids."""
    word = text.slug_of(F.substring_index(F.substring_index("text", "\n", 1), " ", 1))
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("agent"),
        F.col("doc_id").alias("pos"),
        word.alias("slug"),
        F.when(F.col("source") != "src5", hashing.short_id(hashing.sha1(F.col("text")))).alias("doc_id"),
        F.concat(word, F.lit("/doc.md")).alias("doc_path"),
    )


CORPORA_SQL = r"""
corp AS (
  SELECT source AS agent, doc_id AS pos,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(split_part(split_part(text, chr(10), 1), ' ', 1)),
           '[ _]', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS slug,
         CASE WHEN source <> 'src5' THEN substr(sha1(text), 1, 8) END AS id FROM documents
),
target AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY agent, pos) = 1 THEN slug
            ELSE slug || '-' || coalesce(id, substr(lower(agent), 1, 8)) END AS target_slug FROM corp
)"""


@query("slug_collisions", f"WITH {CORPORA_SQL} SELECT slug, count(*) AS n_docs FROM corp GROUP BY slug HAVING count(*) > 1")
def slug_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.slug_collisions(_agent_corpora(spark, sf_dir))


@query("slug_resolution", f"WITH {CORPORA_SQL} SELECT agent, pos, slug, target_slug FROM target")
def slug_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.resolve_slugs(_agent_corpora(spark, sf_dir)).select("agent", "pos", "slug", "target_slug")


@query(
    "manifest_merge",
    f"""
WITH {CORPORA_SQL},
byid AS (SELECT id, arg_max(target_slug, (agent, pos)) AS n FROM target WHERE id IS NOT NULL GROUP BY id),
byname AS (SELECT agent, slug, arg_max(target_slug, (agent, pos)) AS n FROM target GROUP BY agent, slug),
kept AS (
  SELECT * FROM target WHERE id IS NULL
  UNION ALL
  SELECT * FROM target WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY agent, pos) = 1
)
SELECT k.agent, k.pos, coalesce(k.id, '') AS doc_id, k.slug AS orig_slug, coalesce(i.n, m.n) AS slug,
       replace(k.slug || '/doc.md', k.slug, coalesce(i.n, m.n)) AS doc_path
FROM kept k LEFT JOIN byid i ON i.id = k.id LEFT JOIN byname m ON m.agent = k.agent AND m.slug = k.slug
""",
)
def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Entry rows without texts; the merge reads them for each of its lookups.
    resolved = checkpointed(manifest.resolve_slugs(_agent_corpora(spark, sf_dir)))
    merged = manifest.merge_manifests(resolved)
    return merged.withColumn("doc_id", F.coalesce("doc_id", F.lit("")))


@query("agent_definitions", f"WITH {CORPORA_SQL} SELECT DISTINCT agent, target_slug AS slug FROM target")
def agent_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.agent_slug_rows(manifest.resolve_slugs(_agent_corpora(spark, sf_dir)))


@query(
    "processing_stats",
    """
WITH s AS (SELECT CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'success' END AS status, value FROM events)
SELECT count(*) AS total, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status = 'failed') AS failed,
       count(*) FILTER (status = 'skipped') AS skipped, round(sum(value), 3) AS total_ms FROM s
""",
)
def processing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stand for processed files: errors failed, views were skipped."""
    files = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("success").alias("status"),
        F.col("value").alias("parse_ms"),
    )
    return manifest.processing_stats(files).withColumn("total_ms", F.round("total_ms", 3))


# --- incremental index ------------------------------------------------------


def _manifest_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.format_string("doc-%d", "doc_id").alias("slug"), hashing.sha1(F.col("text")).alias("file_sha1")
    )


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two vectors per document, ids in steps of seven, so that some documents
    are missing on either side. Labels 0-2 hold an old hash, 9 none, 8 is dead."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("embedding_index"),
        (F.floor(F.col("vec_id") / 2) * 7).alias("doc_id"),
        (F.col("vec_id") % 2 + 1).alias("chunk_index"),
        "label",
    )
    current = F.coalesce("file_sha1", hashing.sha1(F.col("doc_id").cast("string")))
    hashed = rows.join(_manifest_hashes(spark, sf_dir).drop("slug"), "doc_id", "left")
    return hashed.select(
        "embedding_index",
        hashing.chunk_id(F.col("doc_id").cast("string"), F.col("chunk_index")).alias("chunk_id"),
        "doc_id",
        F.when(F.col("label") < 3, hashing.sha1(F.concat(current, F.lit("#old"))))
        .when(F.col("label") < 9, current)
        .alias("file_sha1"),
        F.when(F.col("label") == 8, F.to_timestamp(F.lit("2024-01-01 00:00:00"))).alias("deleted_utc"),
    )


INDEX_SQL = """
man AS (SELECT doc_id, sha1(text) AS h FROM documents),
idx0 AS (SELECT vec_id, vec_id // 2 * 7 AS doc_id, vec_id % 2 + 1 AS ci, label FROM embeddings),
idx AS (
  SELECT vec_id AS embedding_index, i.doc_id, i.doc_id || '-000' || ci AS chunk_id,
         CASE WHEN label < 3 THEN sha1(coalesce(h, sha1(i.doc_id::VARCHAR)) || '#old')
              WHEN label < 9 THEN coalesce(h, sha1(i.doc_id::VARCHAR)) END AS file_sha1, label = 8 AS dead
  FROM idx0 i LEFT JOIN man ON man.doc_id = i.doc_id
),
live AS (SELECT doc_id, arg_min(file_sha1, embedding_index) FILTER (WHERE file_sha1 IS NOT NULL) AS h FROM idx WHERE NOT dead GROUP BY doc_id),
changes AS (
  SELECT coalesce(m.doc_id, l.doc_id) AS doc_id,
         CASE WHEN l.doc_id IS NULL THEN 'new' WHEN m.doc_id IS NULL THEN 'deleted'
              WHEN m.h <> l.h THEN 'updated' ELSE 'same' END AS change
  FROM man m FULL OUTER JOIN live l ON m.doc_id = l.doc_id
)"""


@query("staleness", f"WITH {INDEX_SQL} SELECT doc_id, change FROM changes")
def staleness_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staleness.changes(_manifest_hashes(spark, sf_dir), _index(spark, sf_dir))


@query("indexed_documents", f"WITH {INDEX_SQL} SELECT doc_id FROM live")
def indexed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staleness.indexed_documents(_index(spark, sf_dir))


@query("live_hashes", f"WITH {INDEX_SQL} SELECT doc_id, h AS file_sha1 FROM live WHERE h IS NOT NULL")
def live_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staleness.live_hashes(_index(spark, sf_dir))


@query(
    "incremental_plan",
    f"""
WITH {INDEX_SQL}
SELECT c.doc_id, change, CASE WHEN change = 'deleted' THEN 'tombstone' WHEN change IN ('new', 'updated') THEN 'process' ELSE 'skip' END AS action
FROM changes c LEFT JOIN documents d ON d.doc_id = c.doc_id WHERE change = 'deleted' OR lang = 'en'
""",
)
def incremental_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice is the English documents."""
    inside = table(spark, sf_dir, "documents").filter("lang = 'en'").select("doc_id")
    return staleness.plan_for_agent(staleness_changes(spark, sf_dir), inside)


@query("incremental_summary", f"WITH {INDEX_SQL} SELECT change, count(*) AS n_docs FROM changes GROUP BY change")
def incremental_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staleness.change_summary(staleness_changes(spark, sf_dir))


@query(
    "tombstone_ratio",
    f"""
WITH {INDEX_SQL}, c AS (SELECT count(*) AS total, count(*) FILTER (dead) AS tombstoned FROM idx)
SELECT total, tombstoned, round(tombstoned::DOUBLE / total, 6) AS ratio,
       CASE WHEN tombstoned::DOUBLE / total > 0.3 THEN 'rebuild' WHEN tombstoned::DOUBLE / total > 0.2 THEN 'warn' ELSE 'ok' END AS advice FROM c
""",
)
def tombstone_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staleness.tombstone_ratio(_index(spark, sf_dir)).withColumn("ratio", F.round("ratio", 6))


@query(
    "tombstone_apply",
    f"""
WITH {INDEX_SQL}, gone AS (SELECT doc_id FROM changes WHERE change = 'deleted')
SELECT embedding_index, doc_id, CASE WHEN dead THEN '2024-01-01' WHEN doc_id IN (FROM gone) THEN '2024-06-01' ELSE '' END AS deleted_on,
       NOT dead AND doc_id IN (FROM gone) AS newly_deleted FROM idx
""",
)
def tombstone_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    gone = staleness.changes(_manifest_hashes(spark, sf_dir), index).filter("change = 'deleted'")
    marked = staleness.tombstone(index, gone, F.to_timestamp(F.lit(NOW)))
    return marked.select(
        "embedding_index",
        "doc_id",
        F.coalesce(F.date_format("deleted_utc", "yyyy-MM-dd"), F.lit("")).alias("deleted_on"),
        "newly_deleted",
    )


def _fresh_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chunks for every manifest document."""
    chunks = _manifest_hashes(spark, sf_dir).withColumn("chunk_index", F.explode(F.array(F.lit(1), F.lit(2))))
    return chunks.select(
        hashing.chunk_id(F.col("doc_id").cast("string"), F.col("chunk_index")).alias("chunk_id"),
        "doc_id",
        "chunk_index",
        "file_sha1",
        F.lit(None).cast("timestamp").alias("deleted_utc"),
    )


FRESH_SQL = """
fresh AS (
  SELECT doc_id, ci, doc_id || '-000' || ci AS chunk_id FROM documents CROSS JOIN (SELECT unnest([1, 2]) AS ci)
  WHERE doc_id IN (SELECT doc_id FROM changes WHERE change IN ('new', 'updated'))
)"""


@query(
    "append_positions",
    f"""
WITH {INDEX_SQL}, {FRESH_SQL}
SELECT (SELECT max(embedding_index) FROM idx) + row_number() OVER (ORDER BY doc_id, ci) AS embedding_index, chunk_id, doc_id FROM fresh
UNION ALL SELECT embedding_index, chunk_id, doc_id FROM idx
""",
)
def append_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    todo = staleness.changes(_manifest_hashes(spark, sf_dir), index).filter(F.col("change").isin("new", "updated"))
    fresh = _fresh_rows(spark, sf_dir).join(todo.select("doc_id"), "doc_id", "left_semi")
    return staleness.append(index, fresh, ["doc_id", "chunk_index"]).select("embedding_index", "chunk_id", "doc_id")


@query(
    "incremental_apply",
    f"""
WITH {INDEX_SQL}, {FRESH_SQL}
SELECT (SELECT max(embedding_index) FROM idx) + row_number() OVER (ORDER BY doc_id, ci) AS embedding_index, chunk_id, true AS live FROM fresh
UNION ALL
SELECT embedding_index, chunk_id, NOT dead AND doc_id NOT IN (SELECT doc_id FROM changes WHERE change IN ('deleted', 'updated')) FROM idx
""",
)
def incremental_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index after one incremental run."""
    after = staleness.apply_changes(
        _index(spark, sf_dir), _manifest_hashes(spark, sf_dir), _fresh_rows(spark, sf_dir),
        F.to_timestamp(F.lit(NOW)), ["doc_id", "chunk_index"],
    )
    return after.select("embedding_index", "chunk_id", F.col("deleted_utc").isNull().alias("live"))


@query(
    "time_estimates",
    """
SELECT user_id, count(*) * 10 AS seconds, CASE WHEN count(*) * 10 < 60 THEN (count(*) * 10) || 's'
  WHEN count(*) * 10 < 3600 THEN (count(*) * 10 // 60) || 'm' ELSE format('{:.1f}h', count(*) * 10 / 3600.0) END AS shown
FROM events GROUP BY user_id
""",
)
def time_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten seconds per document, one user's events being its documents."""
    counted = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    timed = counted.select("user_id", (F.col("n") * staleness.SECONDS_PER_DOC).alias("seconds"))
    return timed.withColumn("shown", staleness.duration_text(F.col("seconds")))


@query(
    "document_listing",
    """
SELECT 'doc-' || doc_id AS slug, substr(replace(text, chr(10), ' '), 1, 40) AS description FROM documents ORDER BY slug LIMIT 20
""",
)
def document_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First twenty documents by slug with a short description; both limits
    are part of the listing."""
    docs = table(spark, sf_dir, "documents").select(
        F.format_string("doc-%d", "doc_id").alias("slug"),
        F.substring(F.replace("text", F.lit("\n"), F.lit(" ")), 1, 40).alias("description"),
    )
    return docs.orderBy("slug").limit(20)


@query(
    "embedding_ids",
    """
SELECT doc_id, doc_id || '_ch_' || format('{:04d}', n_chars) AS embedding_id, doc_id || '-' || format('{:04d}', n_chars) AS chunk_id FROM documents
""",
)
def embedding_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both chunk-id forms; numbers wider than four digits keep all of them."""
    doc = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        hashing.embedding_id(doc, F.col("n_chars")).alias("embedding_id"),
        hashing.chunk_id(doc, F.col("n_chars")).alias("chunk_id"),
    )


@query(
    "event_run_ids",
    "SELECT event_id, event_type || '-' || strftime(ts, '%Y%m%d-%H%M%S') AS run_id FROM events",
)
def event_run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run names from agent (event type) and start time."""
    return table(spark, sf_dir, "events").select(
        "event_id", render.run_id(F.col("event_type"), F.col("ts")).alias("run_id")
    )
