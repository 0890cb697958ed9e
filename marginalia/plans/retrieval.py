"""Dense, lexical and hybrid retrieval over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.text import tokenize
from marginalia.functions.vectors import l2_normalize, similarity, squared_l2
from marginalia.operators import bm25, hybrid, models
from marginalia.operators.dense import centroids, search_dense
from marginalia.operators.topk import join_hits
from marginalia.plans import relations as rel
from marginalia.plans.registry import query, table, texts
from marginalia.session import shared_folder
from marginalia.sources import store

TOP_K = 10
POOL = 50


@query(
    "dense_topk",
    """
WITH mean AS (
  SELECT list(m ORDER BY pos) AS q FROM (
    SELECT pos, avg(x) AS m FROM (
      SELECT unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings
    ) GROUP BY pos)
), d AS (
  SELECT vec_id, list_sum(list_transform(list_zip(embedding, q),
           lambda z: (z[1]::DOUBLE - z[2]) * (z[1]::DOUBLE - z[2]))) AS exact
  FROM embeddings, mean
)
SELECT row_number() OVER (ORDER BY exact, vec_id) AS rank, vec_id AS embedding_index, round(exact, 6) AS distance
FROM d ORDER BY exact, vec_id LIMIT 10
""",
)
def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query (the mean vector) over the whole index."""
    vectors = rel.vectors(spark, sf_dir)
    mean = centroids(vectors.withColumn("all", F.lit(0)), "all")
    asked = mean.select(F.col("all").cast("long").alias("query_id"), "embedding")
    return search_dense(vectors, asked, TOP_K).drop("query_id")


DENSE_BATCHED_SQL = f"""
WITH {rel.CENTROID_SQL}, {rel.DISTANCE_SQL}
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) AS rank,
       vec_id AS embedding_index, distance
FROM dist QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) <= 10
"""


@query("dense_topk_batched", DENSE_BATCHED_SQL)
def dense_topk_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_dense(rel.vectors(spark, sf_dir), rel.label_queries(spark, sf_dir), TOP_K)


@query(
    "dense_similarity",
    f"""
WITH {rel.CENTROID_SQL}, {rel.DISTANCE_SQL}
SELECT query_id, vec_id AS embedding_index, round(exp(-distance), 4) AS similarity
FROM dist QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) <= 10
""",
)
def dense_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = dense_topk_batched(spark, sf_dir)
    return hits.select("query_id", "embedding_index", F.round(similarity(F.col("distance")), 4).alias("similarity"))


@query(
    "dense_tombstoned",
    f"""
WITH {rel.CENTROID_SQL}, {rel.DISTANCE_SQL},
fetched AS (
  SELECT least(CAST(floor(10 * (1.0::DOUBLE + count(*) FILTER (WHERE label = 3)::DOUBLE / count(*) + 0.1::DOUBLE)) AS BIGINT) + 1,
               count(*)) AS n FROM embeddings
),
pool AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) AS r FROM dist
),
live AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) AS rank
  FROM pool WHERE r <= (SELECT n FROM fetched) AND label <> 3
)
SELECT query_id, rank, vec_id AS embedding_index, distance FROM live WHERE rank <= 10
""",
)
def dense_tombstoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over-fetch rule: cut to the fetch size, then drop deleted rows (label 3)."""
    vectors = rel.vectors(spark, sf_dir).withColumn(
        "deleted_utc", F.when(F.col("label") == 3, F.to_timestamp(F.lit(rel.DELETED_AT)))
    )
    return search_dense(vectors, rel.label_queries(spark, sf_dir), TOP_K, exact=False)


@query(
    "dense_tombstoned_exact",
    f"""
WITH {rel.CENTROID_SQL}, {rel.DISTANCE_SQL}
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) AS rank,
       vec_id AS embedding_index, distance
FROM dist WHERE label <> 3
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) <= 10
""",
)
def dense_tombstoned_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = rel.vectors(spark, sf_dir).withColumn(
        "deleted_utc", F.when(F.col("label") == 3, F.to_timestamp(F.lit(rel.DELETED_AT)))
    )
    return search_dense(vectors, rel.label_queries(spark, sf_dir), TOP_K)


@query(
    "embedding_normalize",
    """
WITH s AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (1 + label)) AS v FROM embeddings
), n AS (
  SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM s
)
SELECT vec_id, round(norm, 6) AS norm, round(v[1] / norm, 6) AS first, round(v[len(v)] / norm, 6) AS last,
       round(list_sum(list_transform(v, lambda x: x / norm * x / norm)), 6) AS squared
FROM n
""",
)
def embedding_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale every vector by its label, then bring it back to unit length."""
    scaled = table(spark, sf_dir, "embeddings").withColumn(
        "v", F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    )
    unit = scaled.select("vec_id", "v", l2_normalize(F.col("v")).alias("u"))
    zero = F.transform("u", lambda x: F.lit(0.0))
    return unit.select(
        "vec_id",
        F.round(F.sqrt(squared_l2(F.col("v"), zero)), 6).alias("norm"),
        F.round(F.col("u")[0], 6).alias("first"),
        F.round(F.element_at("u", -1), 6).alias("last"),
        F.round(squared_l2(F.col("u"), zero), 6).alias("squared"),
    )


@query(
    "tokenize_docs",
    f"""
WITH {rel.TOKEN_SQL}
SELECT doc_id, len(tokens)::BIGINT AS n_tokens, len(list_distinct(tokens))::BIGINT AS n_distinct,
       md5(array_to_string(tokens, ' ')) AS token_digest FROM tok
""",
)
def tokenize_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = texts(spark, sf_dir).select("doc_id", tokenize(F.col("text")).alias("tokens"))
    return tokens.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"),
        F.md5(F.array_join("tokens", " ").cast("binary")).alias("token_digest"),
    )


@query(
    "bm25_terms",
    f"WITH {rel.BM25_STATS_SQL} SELECT term, df, round(idf, 6) AS idf FROM terms",
)
def bm25_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = rel.bm25_index(spark, sf_dir).terms
    return terms.select("term", "df", F.round("idf", 6).alias("idf"))


@query(
    "bm25_meta",
    f"""
WITH {rel.BM25_STATS_SQL}
SELECT n AS n_docs, round(avgdl, 6) AS avgdl, round(avg_idf, 6) AS avg_idf,
       'whitespace_lowercase_v1' AS tokenizer, 1::BIGINT AS version FROM figures, mean
""",
)
def bm25_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = rel.bm25_index(spark, sf_dir).meta
    return meta.select(
        "n_docs",
        F.round("avgdl", 6).alias("avgdl"),
        F.round("avg_idf", 6).alias("avg_idf"),
        "tokenizer",
        F.col("version").cast("long").alias("version"),
    )


@query(
    "bm25_postings",
    f"WITH {rel.BM25_STATS_SQL} SELECT term, doc_id AS bm25_index, dl::BIGINT AS dl, tf FROM post",
)
def bm25_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bm25.forward_side(rel.documents_as_chunks(spark, sf_dir))
    return bm25.postings(docs).select("term", "bm25_index", F.col("dl").cast("long").alias("dl"), "tf")


@query(
    "bm25_append_stats",
    f"""
WITH {rel.BM25_STATS_SQL}
SELECT term, df, round(idf, 6) AS idf, n AS n_docs, round(avgdl, 6) AS avgdl FROM terms, figures
""",
)
def bm25_append_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of English documents first, all others appended to them."""
    chunks = rel.documents_as_chunks(spark, sf_dir).join(
        table(spark, sf_dir, "documents").select(F.col("doc_id").alias("bm25_index"), "lang"), "bm25_index"
    )
    old = bm25.build_index(chunks.filter("lang = 'en'").drop("lang"))
    fresh = bm25.forward_side(chunks.filter("lang <> 'en'").drop("lang"))
    figures = bm25.append_figures(old.meta, fresh)
    terms, meta = bm25.term_statistics(bm25.append_frequencies(old.terms, fresh), figures)
    return terms.select(
        "term",
        "df",
        F.round("idf", 6).alias("idf"),
        meta.select("n_docs").scalar().alias("n_docs"),
        F.round(meta.select("avgdl").scalar(), 6).alias("avgdl"),
    )


BM25_TOPK_SQL = f"""
WITH {rel.BM25_SCORE_SQL}
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) AS rank,
       doc_id AS bm25_index, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) <= 10
"""


@query("bm25_topk", BM25_TOPK_SQL)
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.search_bm25(rel.bm25_index(spark, sf_dir, materialize=True), rel.benchmark_queries(spark, sf_dir), TOP_K, digits=rel.ORDER_DIGITS)


@query(
    "bm25_topk_postings",
    f"""
WITH {rel.BM25_SCORE_SQL}, m AS (SELECT query_id, doc_id, round(s, 6) AS score, round(s, 9) AS order_score FROM matched)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) AS rank,
       doc_id AS bm25_index, score
FROM m QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) <= 10
""",
)
def bm25_topk_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = rel.bm25_index(spark, sf_dir, materialize=True)
    inverted = bm25.stored_postings(index)
    asked = rel.benchmark_queries(spark, sf_dir)
    return bm25.search_postings(inverted, index.terms, index.meta, asked, TOP_K, digits=rel.ORDER_DIGITS)


@query(
    "bm25_tombstoned",
    f"""
WITH {rel.BM25_SCORE_SQL},
fetched AS (
  SELECT least(CAST(floor(10 * (1.0::DOUBLE + count(*) FILTER (WHERE source = 'src3')::DOUBLE / count(*) + 0.1::DOUBLE)) AS BIGINT) + 1,
               count(*)) AS n FROM documents
),
pool AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) AS r FROM scored
),
live AS (
  SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) AS rank
  FROM pool JOIN documents USING (doc_id) WHERE r <= (SELECT n FROM fetched) AND source <> 'src3'
)
SELECT query_id, rank, doc_id AS bm25_index, score FROM live WHERE rank <= 10
""",
)
def bm25_tombstoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one source are deleted; statistics still count them."""
    chunks = texts(spark, sf_dir, "doc_id text source").select(
        F.col("doc_id").alias("bm25_index"),
        F.format_string("doc-%06d", "doc_id").alias("chunk_id"),
        F.col("doc_id").cast("string").alias("doc_id"),
        "text",
        F.when(F.col("source") == "src3", F.to_timestamp(F.lit(rel.DELETED_AT))).alias("deleted_utc"),
    )
    return bm25.search_bm25(bm25.build_index(chunks, materialize=True), rel.benchmark_queries(spark, sf_dir), TOP_K, exact=False, digits=rel.ORDER_DIGITS)


@query(
    "bm25_after_updates",
    f"""
WITH {rel.BM25_SCORE_SQL}
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) AS rank,
       doc_id AS bm25_index, score
FROM scored JOIN documents USING (doc_id) WHERE source IS DISTINCT FROM 'src3'
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) <= 10
""",
)
def bm25_after_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored index that grew: English documents first, the others as a second
    part together with the deletion of one source, searched as last published."""
    root = f"{shared_folder(spark)}/updates-{uuid.uuid4().hex}"
    english, others = rel.english_and_others(spark, sf_dir)
    store.write_bm25(bm25.build_index(english), root)
    sources = table(spark, sf_dir, "documents").select("doc_id", "source")
    dead = sources.filter("source = 'src3'").select(F.col("doc_id").alias("position"), F.to_timestamp(F.lit(rel.DELETED_AT)).alias("deleted_utc"))
    store.append_bm25(spark, root, others, dead)
    return bm25.search_bm25(store.read_bm25(spark, root), rel.benchmark_queries(spark, sf_dir), TOP_K, digits=rel.ORDER_DIGITS)


def hybrid_pools(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pools per benchmark item: BM25 over documents, and vectors near the mean
    of label (item modulo ten), where vector n stands for document n."""
    asked = (
        table(spark, sf_dir, "benchmark")
        .select(F.col("item_id"), F.pmod("item_id", F.lit(10)).alias("query_id"))
    )
    near = search_dense(rel.vectors(spark, sf_dir), rel.label_queries(spark, sf_dir), POOL)
    dense = near.join(asked, "query_id").select(
        F.col("item_id").alias("query_id"),
        F.format_string("doc-%06d", "embedding_index").alias("chunk_id"),
        F.col("embedding_index").cast("string").alias("doc_id"),
        "rank",
        "distance",
    )
    found = bm25.search_bm25(rel.bm25_index(spark, sf_dir, materialize=True), rel.benchmark_queries(spark, sf_dir), POOL, digits=rel.ORDER_DIGITS)
    lexical = found.select(
        "query_id",
        F.format_string("doc-%06d", "bm25_index").alias("chunk_id"),
        F.col("bm25_index").cast("string").alias("doc_id"),
        "rank",
        "score",
    )
    return dense, lexical


HYBRID_POOLS_SQL = f"""
{rel.CENTROID_SQL}, {rel.DISTANCE_SQL}, {rel.BM25_SCORE_SQL},
near AS (
  SELECT query_id, vec_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) AS rank
  FROM dist QUALIFY rank <= 50
),
dense AS (
  SELECT b.item_id AS query_id, vec_id AS doc_id, rank, distance
  FROM near JOIN benchmark b ON b.item_id % 10 = near.query_id
),
lexical AS (
  SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) AS rank, score
  FROM scored QUALIFY rank <= 50
)"""


def _fused_columns(fused: DataFrame) -> DataFrame:
    """Report form: rank 0 and distance -1 stand for "not in that channel"."""
    return fused.select(
        "query_id",
        "rank",
        "chunk_id",
        "doc_id",
        F.coalesce(F.col("dense_rank").cast("long"), F.lit(0)).alias("dense_rank"),
        F.coalesce(F.col("bm25_rank").cast("long"), F.lit(0)).alias("bm25_rank"),
        "rrf_score",
        F.coalesce("dense_distance", F.lit(-1.0)).alias("dense_distance"),
        "hybrid_degraded",
    )


def _fused_sql(where: str) -> str:
    return f"""
WITH {HYBRID_POOLS_SQL},
fused AS (
  SELECT coalesce(d.query_id, l.query_id) AS query_id, coalesce(d.doc_id, l.doc_id) AS doc,
         d.rank AS dense_rank, l.rank AS bm25_rank, d.distance AS dense_distance,
         round(coalesce(1.0::DOUBLE / (60 + d.rank), 0) + coalesce(1.0::DOUBLE / (60 + l.rank), 0), 12) AS rrf_score
  FROM (SELECT * FROM dense WHERE {where}) d
  FULL OUTER JOIN (SELECT * FROM lexical WHERE {where}) l ON d.query_id = l.query_id AND d.doc_id = l.doc_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, doc) AS rank,
       format('doc-{{:06d}}', doc) AS chunk_id, doc::VARCHAR AS doc_id, coalesce(dense_rank, 0) AS dense_rank,
       coalesce(bm25_rank, 0) AS bm25_rank, rrf_score, coalesce(dense_distance, -1) AS dense_distance,
       false AS hybrid_degraded
FROM fused QUALIFY rank <= 10
"""


@query("hybrid_rrf", _fused_sql("true"))
def hybrid_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: batched dense plus BM25 retrieval, fused per query."""
    dense, lexical = hybrid_pools(spark, sf_dir)
    return _fused_columns(hybrid.fuse(dense, lexical, TOP_K))


TOXIC = "doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"


@query("hybrid_cross_tombstones", _fused_sql(TOXIC))
def hybrid_cross_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks deleted in either channel (toxic documents) leave both pools."""
    dense, lexical = hybrid_pools(spark, sf_dir)
    dead = table(spark, sf_dir, "labels").filter("toxic = 1").select(
        F.format_string("doc-%06d", "doc_id").alias("chunk_id")
    )
    return _fused_columns(hybrid.fuse(dense, lexical, TOP_K, tombstones=dead))


@query(
    "hybrid_degraded",
    f"""
WITH {rel.CENTROID_SQL}, {rel.DISTANCE_SQL},
near AS (
  SELECT query_id, vec_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) AS r
  FROM dist QUALIFY r <= 50
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(1.0::DOUBLE / (60 + r), 12) DESC, vec_id) AS rank,
       format('doc-{{:06d}}', vec_id) AS chunk_id, vec_id::VARCHAR AS doc_id, r AS dense_rank,
       0::BIGINT AS bm25_rank, round(1.0::DOUBLE / (60 + r), 12) AS rrf_score, distance AS dense_distance,
       true AS hybrid_degraded
FROM near QUALIFY rank <= 10
""",
)
def hybrid_degraded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No lexical index: the dense channel alone, flagged as degraded."""
    near = search_dense(rel.vectors(spark, sf_dir), rel.label_queries(spark, sf_dir), POOL)
    dense = near.select(
        "query_id",
        F.format_string("doc-%06d", "embedding_index").alias("chunk_id"),
        F.col("embedding_index").cast("string").alias("doc_id"),
        "rank",
        "distance",
    )
    return _fused_columns(hybrid.dense_only(dense, TOP_K))


@query(
    "hybrid_cross_drops",
    f"""
WITH {HYBRID_POOLS_SQL},
dd AS (SELECT doc_id FROM labels WHERE toxic = 1), ld AS (SELECT doc_id FROM labels WHERE quality = 0)
SELECT 'dense' AS channel, count(*) AS dropped FROM dense
WHERE doc_id IN (FROM ld) AND doc_id NOT IN (FROM dd) HAVING count(*) > 0
UNION ALL
SELECT 'bm25', count(*) FROM lexical
WHERE doc_id IN (FROM dd) AND doc_id NOT IN (FROM ld) HAVING count(*) > 0
""",
)
def hybrid_cross_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense, lexical = hybrid_pools(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select(
        F.format_string("doc-%06d", "doc_id").alias("chunk_id"), "toxic", "quality"
    )
    return hybrid.cross_channel_drops(
        dense, lexical, labels.filter("toxic = 1"), labels.filter("quality = 0")
    )


@query(
    "embed_documents",
    """
WITH b AS (
  SELECT doc_id, list_transform(range(0, 32), lambda i: (('0x' || substr(sha256(text), 2 * i + 1, 2))::INT / 255.0)::DOUBLE) AS v
  FROM documents WHERE regexp_matches(text, '\\S')
), n AS (SELECT doc_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM b)
SELECT doc_id, len(v)::BIGINT AS dim, round((v[1] / norm)::FLOAT::DOUBLE, 5) AS first, round((v[32] / norm)::FLOAT::DOUBLE, 5) AS last FROM n
""",
)
def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding stage with a deterministic stand-in for the model."""
    vectors = models.embed(texts(spark, sf_dir), models.digest_embedder())
    return vectors.select(
        "doc_id",
        F.size("embedding").cast("long").alias("dim"),
        F.round(F.col("embedding")[0].cast("double"), 5).alias("first"),
        F.round(F.col("embedding")[31].cast("double"), 5).alias("last"),
    )


@query(
    "rerank_pool",
    f"""
WITH {rel.BM25_SCORE_SQL},
pool AS (
  SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) AS pool_rank FROM scored QUALIFY pool_rank <= 50
),
asked AS (SELECT query_id, list(DISTINCT term) AS w FROM qterm GROUP BY query_id),
rr AS (
  SELECT p.query_id, p.doc_id, p.pool_rank,
         round(len(list_intersect(w, list_distinct(t.tokens)))::DOUBLE / len(w), 6) AS rerank_score
  FROM pool p JOIN asked a ON a.query_id = p.query_id JOIN tok t ON t.doc_id = p.doc_id
)
SELECT query_id, doc_id AS bm25_index, pool_rank, rerank_score, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, pool_rank) AS rank
FROM rr QUALIFY rank <= 10
""",
)
def rerank_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 pool reranked by a deterministic stand-in for a cross-encoder."""
    asked = rel.benchmark_queries(spark, sf_dir)
    pool = bm25.search_bm25(rel.bm25_index(spark, sf_dir, materialize=True), asked, POOL, digits=rel.ORDER_DIGITS)
    bodies = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("bm25_index"), "text")
    pairs = join_hits(bodies, pool, ["bm25_index"]).join(asked.withColumnRenamed("text", "query"), "query_id")
    ranked = models.rerank(pairs, models.overlap_scorer, TOP_K)
    return ranked.select("query_id", "bm25_index", "pool_rank", "rerank_score", "rank")
