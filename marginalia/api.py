"""The few calls most users need: index a slice, keep it up to date, search it, evaluate it.

Tables live under one corpus folder: ``vectors/<agent>`` and ``bm25/<agent>``
as published versions, ``pairs/<agent>`` with the versions that belong
together. Searches take a whole batch of queries at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import hashing
from marginalia.functions.citations import citation_prefix
from marginalia.functions.text import is_blank, join_blocks, normalize_markdown, slugify
from marginalia.operators import agents, bm25, elements, evaluation, hybrid, manifest, models, provenance, splitter, staleness
from marginalia.operators.dense import search_dense
from marginalia.operators.topk import first_per_key, join_hits, number_rows
from marginalia.session import checkpointed
from marginalia.sources import files, parsers, store


# Parts of a stored index beyond which an update writes it anew.
MAX_PARTS = 64


def _file_sha1(documents: DataFrame) -> DataFrame:
    """Documents with ``file_sha1``: their own, else that of their text."""
    if "file_sha1" in documents.columns:
        return documents
    own = hashing.sha1(F.col("text")) if "text" in documents.columns else F.lit(None).cast("string")
    return documents.withColumn("file_sha1", own)


def _index_rows(
    documents: DataFrame, agent: str, embedder: Callable, config: splitter.ChunkConfig, parsed: DataFrame | None, first: int = 0
) -> DataFrame:
    """Chunk rows of documents with provenance, embedding and position from ``first`` on."""
    rows = parsed if parsed is not None else elements.text_elements(documents.select("doc_id", "text"))
    # The formatted texts of a slice: split and traced from one copy.
    formatted = checkpointed(elements.format_documents(rows, documents=documents.select("doc_id")))
    heads = _file_sha1(documents).select("doc_id", "slug", "source", "file_sha1")
    bodies = heads.drop("file_sha1").join(formatted.select("doc_id", F.col("markdown").alias("text")), "doc_id")
    chunks = splitter.split_documents(bodies, config)
    spans = chunks.select("doc_id", "chunk_index", "char_start", "char_end")
    traced = provenance.add_provenance(spans, formatted.select("doc_id", F.inline("elements"))).drop("char_start", "char_end")
    named = chunks.join(traced, ["doc_id", "chunk_index"]).join(heads.select("doc_id", "file_sha1"), "doc_id")
    kept = checkpointed(named.withColumn("chunk_id", F.format_string("%s-%04d", "doc_id", F.col("chunk_index").cast("long"))))
    embedded = models.embed(kept, embedder)
    # Blank chunks get no vector and no position; keys alone are sorted, not texts and vectors.
    keys = kept.filter(~is_blank(F.col("text"))).select("doc_id", "chunk_index")
    placed = number_rows(keys, ["doc_id", "chunk_index"], "embedding_index", first)
    return embedded.join(placed, ["doc_id", "chunk_index"]).withColumn("agent", F.lit(agent))


def _lexical(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("embedding_index").alias("bm25_index"), "chunk_id", "doc_id", "text")


def _folders(root: str, agent: str) -> tuple[str, str, str]:
    return f"{root}/vectors/{agent}", f"{root}/bm25/{agent}", f"{root}/pairs/{agent}"


def index_agent(
    documents: DataFrame,
    agent: str,
    root: str,
    embedder: Callable,
    config: splitter.ChunkConfig = splitter.ChunkConfig(),
    parsed: DataFrame | None = None,
) -> DataFrame:
    """Format, split, trace, number, embed and store one agent's slice in both indexes.

    documents: doc_id, slug, source, text and maybe file_sha1 (already filtered
    for the agent; text is not needed with ``parsed``). ``parsed`` has the
    elements a parser found: doc_id, pos, text, category, page_number,
    category_depth; without it blank lines part the text and hash marks make
    headings. Returns the stored chunk rows with page_start, page_end and
    section_heading.
    """
    spark = documents.sparkSession
    vectors, lexical, pair = _folders(root, agent)
    rows = _index_rows(documents, agent, embedder, config, parsed)
    if store.write_vectors(rows, vectors) is None:
        return rows
    # The second index reads what the first one stored.
    stored = store.read_vectors(spark, vectors, agent, check=False)
    store.write_bm25(bm25.build_index(_lexical(stored)), lexical)
    store.publish_pair(spark, pair, vectors, lexical)
    return stored


def update_agent(
    documents: DataFrame,
    agent: str,
    root: str,
    embedder: Callable,
    config: splitter.ChunkConfig = splitter.ChunkConfig(),
    parsed: DataFrame | None = None,
    manifest: DataFrame | None = None,
    compact_from: float = staleness.REBUILD_RATIO,
) -> DataFrame:
    """Bring a stored agent up to date; returns doc_id, change and action.

    ``documents`` is the agent's slice as it is now, ``manifest`` (doc_id,
    file_sha1) the whole corpus: a document missing there is deleted, one that
    only left the slice stays. Without a manifest the slice is the corpus.

    Only new and changed documents are split and embedded; they become one more
    part of both indexes, and rows of deleted and changed ones are listed as
    deleted by position. Beyond a deleted share of ``compact_from`` both
    indexes are written anew from their live rows, without embedding them
    again. Readers see either the old pair of versions or the new one.
    """
    spark = documents.sparkSession
    vectors, lexical, pair = _folders(root, agent)
    version, bm25_version = store.published_pair(spark, pair)
    if store.snapshot(spark, vectors) is None:
        rows = index_agent(documents, agent, root, embedder, config, parsed)
        return rows.select("doc_id").distinct().select("doc_id", F.lit("new").alias("change"), F.lit("process").alias("action"))
    known = _file_sha1(documents)
    rows = store.read_vectors(spark, vectors, agent, check=False, version=version)
    dead = store.deleted_rows(spark, vectors, version).withColumnRenamed("position", "embedding_index")
    keys = rows.select("embedding_index", "doc_id", "file_sha1").join(dead, "embedding_index", "left")
    found = staleness.changes(known if manifest is None else manifest, keys)
    plan = checkpointed(staleness.plan_for_agent(found, known))
    now = F.current_timestamp().alias("deleted_utc")
    todo = plan.filter("action = 'process'").select("doc_id")
    gone = plan.filter("change IN ('deleted', 'updated')").select("doc_id")
    lost = checkpointed(
        keys.filter(F.col("deleted_utc").isNull()).join(gone, "doc_id", "left_semi").select(F.col("embedding_index").alias("position"), now)
    )
    fresh = known.join(todo, "doc_id", "left_semi")
    if lost.isEmpty() and fresh.isEmpty():
        return plan
    last = keys.agg(F.max("embedding_index")).first()[0]
    own = None if parsed is None else parsed.join(todo, "doc_id", "left_semi")
    added = checkpointed(_index_rows(fresh, agent, embedder, config, own, 0 if last is None else last + 1))
    store.append_vectors(spark, vectors, added, lost)
    if bm25_version is not None or store.snapshot(spark, lexical) is not None:
        store.append_bm25(spark, lexical, _lexical(added), lost)
    if _worn(spark, vectors, compact_from):
        _compact(spark, vectors, lexical, agent)
    store.publish_pair(spark, pair, vectors, lexical if store.snapshot(spark, lexical) is not None else None)
    return plan


def ingest_files(
    spark: SparkSession,
    folder: str,
    agent: str,
    root: str,
    embedder: Callable,
    config: splitter.ChunkConfig = splitter.ChunkConfig(),
    ocr_mode: str = "auto",
    ocr: Callable | None = None,
) -> DataFrame:
    """Parse the files below ``folder`` and bring the agent's indexes up to date.

    Returns path, status, error, doc_id, change and action: failed files keep
    their error, files that are too large to be read are listed as failed, and
    of files with one content the first path counts (the others are duplicates).
    """
    found = files.read_files(spark, folder, files.PARSED_SUFFIXES + files.DIRECT_SUFFIXES)
    small, large = files.split_by_size(found)
    read = parsers.parse_files(small, ocr_mode, ocr)
    text = normalize_markdown(join_blocks(F.col("elements")))
    # Parsed (and OCRed) once.
    parsed = checkpointed(read.select("path", "name", "file_sha1", "typed", "status", "error", hashing.sha1(text).alias("doc_id")))
    good = first_per_key(parsed.filter("status = 'success'"), ["doc_id"], [F.col("path")])
    documents = good.select(
        "doc_id", slugify(F.regexp_replace("name", r"\.[^.]*$", "")).alias("slug"), F.col("name").alias("source"), "file_sha1"
    )
    plan = update_agent(documents, agent, root, embedder, config, parsed=parsers.typed_elements(good))
    chosen = good.select("path", "doc_id").join(plan, "doc_id", "left")
    outcome = parsed.drop("doc_id").join(chosen, "path", "left").select("path", "status", "error", "doc_id", "change", "action")
    done = outcome.withColumn("action", F.when((F.col("status") == "success") & F.col("doc_id").isNull(), "duplicate").otherwise(F.col("action")))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("doc_id", "change", "action")]
    return done.unionByName(large.select("path", "status", "error", *nothing))


def _worn(spark: SparkSession, vectors: str, compact_from: float) -> bool:
    held = store.snapshot(spark, vectors)
    total = store.read_vectors(spark, vectors, check=False).count()
    return len(held.parts) > MAX_PARTS or store.deleted_rows(spark, vectors).count() > compact_from * total


def _compact(spark: SparkSession, vectors: str, lexical: str, agent: str) -> None:
    """Live rows renumbered by document and chunk, as a full build numbers them."""
    live = store.without(store.read_vectors(spark, vectors, agent, check=False), store.deleted_rows(spark, vectors), "embedding_index")
    keys = live.select(F.col("embedding_index").alias("old"), "doc_id", "chunk_index")
    placed = number_rows(keys, ["doc_id", "chunk_index"], "embedding_index").select("old", "embedding_index")
    rows = live.withColumnRenamed("embedding_index", "old").join(placed, "old").drop("old")
    if store.write_vectors(rows, vectors) is None:
        # Nothing is left; the parts stay, with all their rows deleted.
        return
    stored = store.read_vectors(spark, vectors, agent, check=False)
    store.write_bm25(bm25.build_index(_lexical(stored)), lexical)


def search(
    spark: SparkSession,
    root: str,
    agent: str,
    queries: DataFrame,
    top_k: int = 5,
    mode: str = "hybrid",
    pool: int = 50,
    k_rrf: int = hybrid.K_RRF,
    embedder: Callable | None = None,
    scorer: Callable | None = None,
    rerank_pool: int = 50,
    entries: DataFrame | None = None,
) -> DataFrame:
    """Cited results for queries(query_id, text), best first per query.

    ``mode`` is dense, bm25 or hybrid; hybrid without a stored BM25 index runs
    dense only and flags its rows, bm25 without one is an error. ``scorer``
    reranks the pool. Rows are told apart by their position in the index, so
    an updated chunk never meets its deleted predecessor. ``entries`` of a
    manifest (doc_id, slug, pos) add slug and chunk_path, the chunk's file.
    """
    if mode not in ("dense", "bm25", "hybrid"):
        raise ValueError("mode must be dense, bm25 or hybrid")
    folder, lexical_folder, pair = _folders(root, agent)
    version, bm25_version = store.published_pair(spark, pair)
    every = store.read_vectors(spark, folder, agent, check=False, version=version)
    index = None if mode == "dense" else store.read_bm25(spark, lexical_folder, bm25_version)
    # A row deleted in either index is deleted in both, before anything is ranked.
    dead = store.deleted_rows(spark, folder, version).select("position")
    if "deleted_utc" in every.columns:
        dead = dead.unionByName(every.filter(F.col("deleted_utc").isNotNull()).select(F.col("embedding_index").alias("position")))
    if index is not None and index.deleted is not None:
        dead = dead.unionByName(index.deleted.select(F.col("bm25_index").alias("position")))
    dead = checkpointed(dead.distinct())
    vectors = every if dead.isEmpty() else store.without(every, dead, "embedding_index")
    wanted = hybrid.pool_size(top_k, pool if mode == "hybrid" else 1, rerank_pool if scorer else 0)
    keys = vectors.select("embedding_index", "chunk_id", "doc_id")

    def dense_channel(k: int) -> DataFrame:
        asked = models.embed(queries, embedder).select("query_id", "embedding")
        found = search_dense(vectors, asked, k)
        return join_hits(keys, found, ["embedding_index"])

    def lexical_channel(k: int) -> DataFrame | None:
        if index is None:
            return None
        found = bm25.search_bm25(index, queries, k, deleted=dead.select(F.col("position").alias("bm25_index")))
        named = index.docs.select(F.col("bm25_index").alias("embedding_index"), "chunk_id", "doc_id")
        return join_hits(named, found.withColumnRenamed("bm25_index", "embedding_index"), ["embedding_index"])

    if mode == "dense":
        ranked = dense_channel(wanted).select("query_id", "rank", "embedding_index", "chunk_id", "doc_id", "distance")
    elif mode == "bm25":
        lexical = lexical_channel(wanted)
        if lexical is None:
            raise store.StoreError(f"agent {agent} has no BM25 index")
        ranked = lexical.select("query_id", "rank", "embedding_index", "chunk_id", "doc_id", "score")
    else:
        near, lexical = dense_channel(wanted), lexical_channel(wanted)
        row = "embedding_index"
        ranked = (
            hybrid.dense_only(near, wanted, k_rrf, key=row)
            if lexical is None
            else hybrid.fuse(near, lexical, wanted, k_rrf, key=row)
        )
    # Ranking above runs on keys; bodies are fetched for ranked chunks only.
    place = {"page_start": "int", "page_end": "int", "section_heading": "string"}
    known = [F.col(c) if c in vectors.columns else F.lit(None).cast(kind).alias(c) for c, kind in place.items()]
    number = ["chunk_index"] if entries is not None else []
    bodies = vectors.select("embedding_index", "source", "text", *number, *known)
    hits = join_hits(bodies, ranked, ["embedding_index"])
    if scorer is not None:
        pairs = hits.join(queries.select("query_id", F.col("text").alias("query")), "query_id")
        hits = models.rerank(pairs, scorer, top_k).drop("query")
    cited = citation_prefix(*map(F.col, ("source", *place)))
    best = hits.filter(F.col("rank") <= top_k).withColumn("citation", cited)
    return best if entries is None else manifest.chunk_files(best, entries)


def evaluate(retrieved: DataFrame, fixture: dict[str, DataFrame], manifest: DataFrame) -> dict[str, DataFrame]:
    """Aggregate, per-tag and per-item figures of one run.

    retrieved: item_id, rank, doc_id and optional citation columns.
    """
    runnable, skipped = evaluation.split_items(fixture["items"], fixture["expected"], manifest)
    results = checkpointed(evaluation.item_results(runnable, retrieved, fixture["expected"]))
    return {
        "items": results,
        "skipped": skipped,
        "aggregate": evaluation.aggregate(results),
        "per_tag": evaluation.per_tag(results, fixture["tags"]),
    }


def list_agents(spark: SparkSession, root: str) -> DataFrame:
    """Agents with a stored index below ``root``."""
    return agents.available_agents(spark.read.parquet(f"{root}/vectors/*/v=*"))
