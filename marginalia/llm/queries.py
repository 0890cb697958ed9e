"""The registered queries of this subpackage, each next to its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import (
    decontaminate,
    dedup,
    language,
    ngramjoin,
    packing,
    secrets,
    sharding,
    subvectors,
    tokens,
    topk,
    urls,
    warc,
    whitening,
)
from marginalia.llm.common import CHECK_SQL, QUERIES, query, table

__all__ = ["CHECK_SQL", "QUERIES"]


@query(
    "op3_exact_topk",
    """
    WITH v AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest quantised inner products of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantized("embedding").alias("embedding"))
    return topk.exact_top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


@query(
    "op10_warc",
    """
    WITH p AS (
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
        FROM pages
    ), held AS (
        SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to
    FROM held
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, found by the merged index and read back."""
    _, records = warc.archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_token_ids")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as Simple-8b coded token ids, read back from the files."""
    # Only this query needs the vocabulary files.
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.read_ids(tokens.write_ids(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sixteen shards of equal counts, equal texts together."""
    return sharding.shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), 16)


@query("op1_url_filter")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL judged by the longest rule, else by trees trained on the URLs that rules label."""
    return urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the rows that are not held out."""
    return language.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@query("op8_secrets")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: fixed forms, and tokens that look random."""
    return secrets.report(table(spark, sf_dir, "documents"))


@query(
    "op4_decontaminate",
    r"""
    WITH d AS MATERIALIZED (
        SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
        FROM documents
    ), i AS MATERIALIZED (
        SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
        FROM benchmark
    ), item_windows AS MATERIALIZED (
        SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[s + 1 : s + least(10, len(w))], ' ') AS words
        FROM (SELECT *, unnest(range(greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)
    ), sizes AS (SELECT DISTINCT size FROM item_windows),
    doc_windows AS (
        SELECT k, s, size, array_to_string(w[s + 1 : s + size], ' ') AS words
        FROM (SELECT k, w, size, unnest(range(len(w) - size + 1)) AS s FROM d, sizes WHERE len(w) >= size)
    ), hits AS MATERIALIZED (
        SELECT k, s, size, item FROM doc_windows JOIN item_windows USING (size, words)
    ), covered AS (
        SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + size)) AS p FROM hits) GROUP BY k
    ), named AS (
        SELECT k, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
        FROM (SELECT DISTINCT k, item FROM hits) GROUP BY k
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN covered USING (k) LEFT JOIN named USING (k)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold passages of the benchmark."""
    return decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query(
    "op9_ngram_jaccard",
    r"""
    WITH RECURSIVE d AS MATERIALIZED (
        SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
        FROM documents
    ), g AS MATERIALIZED (
        SELECT DISTINCT k, array_to_string(w[s + 1 : s + 4], ' ') AS gram
        FROM (SELECT k, w, unnest(range(greatest(len(w) - 3, 1))) AS s FROM d WHERE len(w) > 0)
    ), n AS MATERIALIZED (SELECT k, count(*) AS n FROM g GROUP BY k),
    links AS MATERIALIZED (
        SELECT x.k AS a, y.k AS b
        FROM g x JOIN g y ON x.gram = y.gram AND x.k <> y.k JOIN n p ON p.k = x.k JOIN n q ON q.k = y.k
        GROUP BY x.k, y.k, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
    ), reach(a, b) AS (
        SELECT k, k FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    ), least AS (
        SELECT a AS k, min(doc_id) AS component_id FROM reach JOIN d ON d.k = b GROUP BY a
    )
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM d LEFT JOIN n USING (k) JOIN least USING (k)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of four-word shingles are at least 85 percent alike."""
    return ngramjoin.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 4, 85)


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in bins of 4,096 words without two pieces of one source or of equal texts."""
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


@query(
    "op13_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _rounds_sql(rounds: int) -> str:
    """Each round of the clustering: c<i> are the centroids after round i, m<i> the members before it."""
    members = """
    m{i} AS MATERIALIZED (
        SELECT k, min(distance * 8 + c) // 8 AS distance, min(distance * 8 + c) % 8 AS c
        FROM (SELECT k, c, CAST(list_sum(list_transform(list_zip(v.q, p.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance
              FROM v, c{i} p) GROUP BY k
    )"""
    moved = """,
    c{j} AS MATERIALIZED (
        SELECT p.c, coalesce(f.q, p.q) AS q FROM c{i} p LEFT JOIN (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY place) AS q FROM (
                SELECT c, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
                    SELECT c, unnest(range(64)) AS place, unnest(q) AS x FROM m{i} JOIN v USING (k)) GROUP BY c, place
            ) GROUP BY c) f ON f.c = p.c
    )"""
    steps = ["," + members.format(i=i) + moved.format(i=i, j=i + 1) for i in range(rounds)]
    return "".join(steps) + "," + members.format(i=rounds)


@query(
    "op11_centroid_clustering",
    f"""
    WITH v AS MATERIALIZED (
        SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
        FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q FROM (SELECT sha256('3:' || vec_id) AS h, q FROM v) ORDER BY h, q LIMIT 8
    ){_rounds_sql(10)}
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(p.q, ',')) AS centroid_sha256
    FROM m10 JOIN v USING (k) JOIN c10 p USING (c)
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rounds of exact k-means over dictionaries of subvectors."""
    return subvectors.cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
