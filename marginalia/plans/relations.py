"""Relations that several registered queries derive from the given tables,
each with the SQL text that derives the same relation for the check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators import bm25
from marginalia.operators.dense import centroids
from marginalia.plans.registry import table, texts
from marginalia.sources.store import BROADCAST_ROWS

DELETED_AT = "2024-01-01 00:00:00"


def _as_chunks(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").alias("bm25_index"),
        F.format_string("doc-%06d", "doc_id").alias("chunk_id"),
        F.col("doc_id").cast("string").alias("doc_id"),
        "text",
    )


def documents_as_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one chunk of itself."""
    return _as_chunks(texts(spark, sf_dir))


def english_and_others(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Chunks of English documents, and of the others, as if each text met the language of its id.

    A text with an id of its own has its own language and stays where it is. A
    repeated id gives each of its texts all languages of the id, so such a text
    counts once per row of the id in the part of that language. Texts without an
    id are in neither part.
    """
    is_english = F.coalesce(F.col("lang") == "en", F.lit(False))
    repeated = (
        table(spark, sf_dir, "documents")
        .filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_english).alias("english"))
        .filter("rows > 1")
    )
    docs = texts(spark, sf_dir, "doc_id text lang").filter("doc_id IS NOT NULL").withColumn("is_english", is_english)
    n = repeated.count()
    if n == 0:
        return _as_chunks(docs.filter("is_english")), _as_chunks(docs.filter("NOT is_english"))
    met = docs.join(F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated, "doc_id", "left")
    own = F.col("is_english").cast("long")
    times = {"english": F.coalesce("english", own), "others": F.coalesce(F.col("rows") - F.col("english"), 1 - own)}
    counted = met.select("doc_id", "text", *[t.cast("int").alias(name) for name, t in times.items()])
    english, others = (
        _as_chunks(counted.filter(F.col(name) > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(name))))) for name in times
    )
    return english, others


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def bm25_index(spark: SparkSession, sf_dir: str, materialize: bool = False) -> bm25.Bm25Index:
    return bm25.build_index(documents_as_chunks(spark, sf_dir), materialize)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("embedding_index"), "embedding", "label"
    )


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean of the label's vectors."""
    means = centroids(vectors(spark, sf_dir), "label")
    return means.select(F.col("label").cast("long").alias("query_id"), "embedding")


# Mean vector per label.
CENTROID_SQL = """
centroid AS (
  SELECT label AS query_id, list(m ORDER BY pos) AS q FROM (
    SELECT label, pos, avg(x) AS m FROM (
      SELECT label, unnest(range(1, len(embedding) + 1)) AS pos,
             unnest(embedding)::DOUBLE AS x FROM embeddings
    ) GROUP BY label, pos
  ) GROUP BY label
)"""

# Distance of every query vector to every vector.
DISTANCE_SQL = """
dist AS (
  SELECT *, round(exact, 6) AS distance FROM (
    SELECT query_id, vec_id, label,
           list_sum(list_transform(list_zip(embedding, q),
             lambda z: (z[1]::DOUBLE - z[2]) * (z[1]::DOUBLE - z[2]))) AS exact
    FROM embeddings, centroid)
)"""

# Tokens and BM25 statistics of documents.
TOKEN_SQL = r"""
tok AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS tokens FROM documents
)"""

BM25_STATS_SQL = (
    TOKEN_SQL.replace("tok AS (", "tok AS MATERIALIZED (")
    + """,
figures AS MATERIALIZED (
  SELECT count(*) AS n, sum(len(tokens))::DOUBLE / count(*) AS avgdl FROM tok
),
post AS MATERIALIZED (
  SELECT doc_id, dl, term, count(*) AS tf FROM (
    SELECT doc_id, len(tokens) AS dl, unnest(tokens) AS term FROM tok
  ) GROUP BY doc_id, dl, term
),
freq AS MATERIALIZED (SELECT term, count(*) AS df FROM post GROUP BY term),
rawidf AS MATERIALIZED (
  SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM freq, figures
),
mean AS MATERIALIZED (SELECT avg(raw) AS avg_idf FROM rawidf),
terms AS MATERIALIZED (
  SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * avg_idf ELSE raw END AS idf FROM rawidf, mean
)"""
)

# Both engines add the parts of a score in different orders; at nine digits
# they agree, so ranks of these queries follow that.
ORDER_DIGITS = 9

BM25_SCORE_SQL = (
    BM25_STATS_SQL
    + r""",
qterm AS (
  SELECT query_id, term, count(*) AS qtf FROM (
    SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM benchmark
  ) GROUP BY query_id, term
),
matched AS (
  SELECT query_id, doc_id,
         sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / (SELECT avgdl FROM figures)))) AS s
  FROM qterm JOIN post USING (term) JOIN terms USING (term) GROUP BY query_id, doc_id
),
scored AS (
  SELECT q.query_id, d.doc_id, round(coalesce(m.s, 0.0), 6) AS score,
         round(coalesce(m.s, 0.0), 9) AS order_score
  FROM (SELECT DISTINCT query_id FROM qterm) q CROSS JOIN documents d
  LEFT JOIN matched m ON m.query_id = q.query_id AND m.doc_id = d.doc_id
)"""
)
