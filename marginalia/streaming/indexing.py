"""Documents log to chunk and vector log, as a stream.

The log only grows; which rows are live follows from the documents that are
current. A superseded or removed document thereby tombstones its chunks
without rewriting them, and live chunks with the same id are not affected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from marginalia.functions import hashing
from marginalia.functions.text import is_blank, tokenize
from marginalia.operators import bm25, elements, models, provenance, splitter
from marginalia.operators.topk import last_per_key, number_rows
from marginalia.session import checkpointed
from marginalia.sources import store
from marginalia.sources.parsers import TYPED, typed_elements
from marginalia.streaming.staging import DOCUMENT_SCHEMA, current_documents

VECTOR_SCHEMA = (
    "embedding_index long, chunk_id string, doc_id string, slug string, collection string, file_sha1 string, "
    "chunk_index int, char_start int, char_end int, content_hash string, page_start int, page_end int, section_heading string, "
    "text string, embedding array<float>, batch long"
)


def vectors_log(spark: SparkSession, corpus: str) -> DataFrame:
    try:
        return spark.read.schema(VECTOR_SCHEMA).parquet(f"{corpus}/vectors")
    except AnalysisException:
        return spark.createDataFrame([], VECTOR_SCHEMA)


def index_batch(documents: DataFrame, batch: int, corpus: str, embedder, config=splitter.ChunkConfig()) -> None:
    """Split and embed one micro-batch, numbered behind all earlier batches."""
    spark = documents.sparkSession
    good = documents.filter("status = 'success'")
    known = F.col("typed") if "typed" in documents.columns else F.lit(None).cast(TYPED)
    # Within a batch two files may have one content; blocks are told apart by slug as well.
    fresh = good.select(F.concat_ws("/", "slug", "doc_id").alias("key"), "doc_id", "slug", "collection", "file_sha1", "markdown", known.alias("typed"))
    named = fresh.select(F.col("key").alias("doc_id"), "typed", F.col("markdown").alias("text"))
    rows = typed_elements(named.filter(F.size("typed") > 0)).unionByName(
        elements.text_elements(named.filter(F.coalesce(F.size("typed"), F.lit(-1)) <= 0).select("doc_id", "text"))
    )
    formatted = checkpointed(elements.format_documents(rows, documents=named.select("doc_id")))
    bodies = fresh.drop("markdown", "typed").join(formatted.select(F.col("doc_id").alias("key"), F.col("markdown").alias("text")), "key")
    pieces = splitter.split_documents(bodies, config)
    spans = pieces.select(F.col("key").alias("doc_id"), "chunk_index", "char_start", "char_end")
    traced = provenance.add_provenance(spans, formatted.select("doc_id", F.inline("elements")))
    places = traced.select(F.col("doc_id").alias("key"), "chunk_index", "page_start", "page_end", "section_heading")
    chunks = pieces.join(places, ["key", "chunk_index"]).select(
        "*",
        hashing.chunk_id(F.col("doc_id"), F.col("chunk_index")).alias("chunk_id"),
        hashing.chunk_hash(F.col("text"), skip_front_matter=False).alias("content_hash"),
    )
    last = vectors_log(spark, corpus).filter(F.col("batch") < batch).agg(F.max("embedding_index")).first()[0]
    placed = number_rows(
        models.embed(chunks, embedder), ["slug", "doc_id", "chunk_index"], "embedding_index", 0 if last is None else last + 1
    )
    names = [f.split()[0] for f in VECTOR_SCHEMA.split(", ")][:-1]
    placed.select(*names).write.mode("overwrite").parquet(f"{corpus}/vectors/batch={batch}")


def run_indexing(
    spark: SparkSession, corpus: str, checkpoint: str, embedder, agent_collections: DataFrame | None = None
) -> StreamingQuery:
    """Vectors of new documents; with ``agent_collections`` (agent, collection)
    the stored indexes of the agents a batch touches grow as well."""
    documents = spark.readStream.schema(DOCUMENT_SCHEMA).parquet(f"{corpus}/documents")

    def work(rows: DataFrame, number: int) -> None:
        index_batch(rows, number, corpus, embedder)
        if agent_collections is not None:
            refresh_agents(rows, number, corpus, agent_collections)

    return (
        documents.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def live_vectors(spark: SparkSession, corpus: str) -> DataFrame:
    """Vectors of current documents. The same content ingested again appears
    in two batches; the first one counts."""
    current = current_documents(spark, corpus).select("slug", "doc_id")
    alive = vectors_log(spark, corpus).join(current, ["slug", "doc_id"], "left_semi")
    first = alive.groupBy("slug", "doc_id").agg(F.min("batch").alias("batch"))
    return alive.join(first, ["slug", "doc_id", "batch"], "left_semi")


def affected_slices(documents: DataFrame, agent_collections: DataFrame) -> DataFrame:
    """Agents whose slice a batch of documents touches."""
    return documents.select("collection").distinct().join(agent_collections, "collection").select("agent").distinct()


def refresh_agents(documents: DataFrame, batch: int, corpus: str, agent_collections: DataFrame) -> list[str]:
    """Grow both stored indexes of each agent the batch touches; others stay as they are.

    The number of agents is set by their configuration. A retried batch skips
    what its first try has published already, by the stamp of the snapshots.
    """
    good = documents.filter("status = 'success'")
    touched = sorted(row["agent"] for row in affected_slices(good, agent_collections).collect())
    for agent in touched:
        own = agent_collections.filter(F.col("agent") == agent).select("collection").distinct()
        _refresh(good.join(own, "collection", "left_semi"), batch, corpus, agent)
    return touched


def _refresh(documents: DataFrame, batch: int, corpus: str, agent: str) -> None:
    spark = documents.sparkSession
    folder, lexical, pair = (f"{corpus}/agents/{kind}/{agent}" for kind in ("vectors", "bm25", "pairs"))
    heads = documents.select("slug", "doc_id").distinct()
    held = store.snapshot(spark, folder)
    if held is None or held.figures["stamp"] < batch:
        fresh = vectors_log(spark, corpus).filter(F.col("batch") == batch).join(heads, ["slug", "doc_id"], "left_semi")
        first, lost = 0, None
        if held is not None:
            stored = store.read_vectors(spark, folder, agent, check=False).select("embedding_index", "slug", "doc_id")
            first = stored.agg(F.max("embedding_index")).first()[0] + 1
            alive = store.without(stored, store.deleted_rows(spark, folder), "embedding_index")
            # The same content again adds nothing; other content under a slug replaces what it had.
            fresh = fresh.join(alive.select("slug", "doc_id"), ["slug", "doc_id"], "left_anti")
            replaced = alive.join(heads.select("slug"), "slug", "left_semi").join(heads, ["slug", "doc_id"], "left_anti")
            lost = checkpointed(replaced.select(F.col("embedding_index").alias("position"), F.current_timestamp().alias("deleted_utc")))
        keys = number_rows(fresh.select(F.col("embedding_index").alias("log_index")), ["log_index"], "embedding_index", first)
        rows = fresh.withColumnRenamed("embedding_index", "log_index").join(keys, "log_index").drop("log_index", "batch")
        rows = rows.withColumn("agent", F.lit(agent))
        if held is None:
            store.write_vectors(rows, folder, batch)
        else:
            store.append_vectors(spark, folder, rows, lost, batch)
    held = store.snapshot(spark, folder)
    known = store.snapshot(spark, lexical)
    if held is None or (known is not None and known.figures["stamp"] >= batch):
        return
    # What the first store took for this batch is what the second one gets.
    added = store.part_rows(spark, folder, held.version).filter(F.col("agent") == agent)
    chunks = added.select(F.col("embedding_index").alias("bm25_index"), "chunk_id", "doc_id", "text")
    if known is None:
        store.write_bm25(bm25.build_index(chunks), lexical, batch)
    else:
        store.append_bm25(spark, lexical, chunks, store.part_deletions(spark, folder, held.version), batch)
    store.publish_pair(spark, pair, folder, lexical)


TERM_COUNTS = "agent string, term string, df long, tokens long, batch long"


def run_term_counts(
    spark: SparkSession, corpus: str, checkpoint: str, agent_collections: DataFrame, config=splitter.ChunkConfig()
) -> StreamingQuery:
    """BM25 frequencies as streaming state keyed by (agent, term).

    The state store holds the counts; a batch writes only the keys it changed.
    The empty term counts an agent's chunks and their tokens. A document whose
    slug and content were seen before is not counted again; superseded ones go
    on counting, as deleted chunks do in a stored index.
    """
    documents = spark.readStream.schema(DOCUMENT_SCHEMA).parquet(f"{corpus}/documents")
    fresh = documents.filter("status = 'success'").dropDuplicates(["slug", "doc_id"])
    chunks = splitter.split_documents(fresh.select("doc_id", "collection", F.col("markdown").alias("text")), config)
    tokens = chunks.filter(~is_blank(F.col("text"))).select("collection", tokenize(F.col("text")).alias("tokens"))
    named = tokens.join(F.broadcast(agent_collections.select("agent", "collection").distinct()), "collection")
    words = F.concat(F.array(F.lit("")), F.array_distinct("tokens"))
    counts = (
        named.select("agent", F.explode(words).alias("term"), F.size("tokens").alias("size"))
        .groupBy("agent", "term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum(F.when(F.col("term") == "", F.col("size")).otherwise(0)).alias("tokens"))
    )

    def write(rows: DataFrame, number: int) -> None:
        rows.select("agent", "term", "df", "tokens").write.mode("overwrite").parquet(f"{corpus}/terms/batch={number}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def term_counts(spark: SparkSession, corpus: str) -> tuple[DataFrame, DataFrame]:
    """(agent, term, df) and (agent, n_docs, avgdl): the last state of every key."""
    try:
        log = spark.read.schema(TERM_COUNTS).parquet(f"{corpus}/terms")
    except AnalysisException:
        log = spark.createDataFrame([], TERM_COUNTS)
    last = last_per_key(log, ["agent", "term"], [F.col("batch")])
    figures = last.filter("term = ''").select("agent", F.col("df").alias("n_docs"), (F.col("tokens") / F.col("df")).alias("avgdl"))
    return last.filter("term <> ''").select("agent", "term", "df"), figures
