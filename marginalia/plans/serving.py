"""What callers see: citations, context, listings, tool calls, conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import render, toolcalls
from marginalia.functions.citations import citation_prefix
from marginalia.functions.text import fixed
from marginalia.operators import bm25, manifest
from marginalia.operators.topk import join_hits
from marginalia.plans import relations as rel
from marginalia.plans.registry import query, table
from marginalia.session import checkpointed

CONTEXT_K = 5


@query(
    "citation_prefix",
    """
WITH d AS (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source || '-' || lang WHEN 1 THEN upper(source) || '_Vol ' || lang || '.PDF' WHEN 2 THEN '' ELSE 'a b' || source END AS src,
    CASE doc_id % 4 WHEN 0 THEN source || '-' || lang WHEN 1 THEN source || '-vol-' || lang WHEN 2 THEN '' ELSE 'a-b' || source END AS slug,
    CASE WHEN doc_id % 3 > 0 THEN doc_id % 100 END AS p1, CASE WHEN doc_id % 5 > 0 THEN doc_id % 100 + doc_id % 2 END AS p2,
    CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE ' Part ' || lang || ' ' END AS sec FROM documents
)
SELECT doc_id, '[' || array_to_string(list_filter([CASE WHEN slug <> '' THEN slug END,
   CASE WHEN p1 IS NULL THEN NULL WHEN p2 IS NULL OR p1 = p2 THEN 'p.' || p1 ELSE 'p.' || p1 || '–' || p2 END,
   CASE WHEN trim(sec) <> '' THEN '§' || trim(sec) END], lambda x: x IS NOT NULL), ', ') || ']' AS citation FROM d
""",
)
def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every variant: slug, file name, empty source; pages and sections or not."""
    n = F.col("doc_id")
    source = (
        F.when(n % 4 == 0, F.concat_ws("-", "source", "lang"))
        .when(n % 4 == 1, F.concat(F.upper("source"), F.lit("_Vol "), "lang", F.lit(".PDF")))
        .when(n % 4 == 2, "")
        .otherwise(F.concat(F.lit("a b"), "source"))
    )
    section = F.when(n % 7 == 0, None).when(n % 7 == 1, "  ").otherwise(F.concat(F.lit(" Part "), "lang", F.lit(" ")))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        citation_prefix(
            source, F.when(n % 3 > 0, n % 100), F.when(n % 5 > 0, n % 100 + n % 2), section
        ).alias("citation"),
    )


def _hits(spark: SparkSession, sf_dir: str, k: int = CONTEXT_K) -> DataFrame:
    """Cited results: ranking runs without texts; only hits fetch their body."""
    found = bm25.search_bm25(rel.bm25_index(spark, sf_dir, materialize=True), rel.benchmark_queries(spark, sf_dir), k, digits=rel.ORDER_DIGITS)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("bm25_index"), "source", "lang", "text")
    joined = join_hits(docs, found, ["bm25_index"])
    name = F.concat("source", F.lit("_"), "lang", F.lit(".pdf"))
    page = F.col("bm25_index") % 50 + 1
    return joined.select(
        "query_id",
        "rank",
        "score",
        F.format_string("%d-0001", "bm25_index").alias("chunk_id"),
        F.col("bm25_index").cast("string").alias("doc_id"),
        name.alias("source"),
        citation_prefix(name, page, page + F.col("bm25_index") % 2, F.lit(None).cast("string")).alias("citation"),
        "text",
    )


HIT_SQL = f"""
{rel.BM25_SCORE_SQL},
ranked AS (
  SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY order_score DESC, doc_id) AS rank FROM scored QUALIFY rank <= 5
),
hits AS (
  SELECT r.*, d.source || '_' || d.lang || '.pdf' AS src, d.text,
    '[' || d.source || '-' || d.lang || ', p.' || (r.doc_id % 50 + 1) || CASE WHEN r.doc_id % 2 = 1 THEN '–' || (r.doc_id % 50 + 2) ELSE '' END || ']' AS cite
  FROM ranked r JOIN documents d USING (doc_id)
)"""


@query(
    "context_format",
    f"""
WITH {HIT_SQL}
SELECT query_id, count(*) AS n_chunks, md5(string_agg('[Source: ' || src || ']' || chr(10) || cite || chr(10) || text,
  chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank)) AS digest FROM hits GROUP BY query_id
""",
)
def context_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt context per query from its few best chunks."""
    block = render.context_block(F.col("source"), F.col("citation"), F.col("text"))
    hits = _hits(spark, sf_dir).select("query_id", "rank", block.alias("block"))
    grouped = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "block"))).alias("b"))
    context = F.array_join(F.transform("b", lambda b: b["block"]), render.CONTEXT_SEPARATOR)
    return grouped.select(
        "query_id", F.size("b").cast("long").alias("n_chunks"), F.md5(context.cast("binary")).alias("digest")
    )


@query(
    "tool_results",
    f"""
WITH {HIT_SQL}
SELECT query_id, rank, md5('--- Result ' || rank || ' (source: ' || src || ') ---' || chr(10) || cite || chr(10) || trim(text, ' ' || chr(10) || chr(9) || chr(13)) || chr(10)) AS tool,
  md5('### [' || rank || '] ' || src || ' (score: ' || format('{{:.4f}}', score) || ')' || chr(10) || cite || chr(10) || '*doc_id: ' || doc_id || ', chunk: ' || doc_id || '-0001*'
      || chr(10) || chr(10) || text || chr(10) || chr(10) || '---' || chr(10)) AS listing,
  '[' || rank || '] Score: ' || format('{{:.2f}}', score) || ' | ID: ' || doc_id || '-0001 | Source: ' || src || chr(10) || repeat('─', 60) || chr(10)
      || substr(text, 1, 200) || CASE WHEN length(text) > 200 THEN '...' ELSE '' END || chr(10) || repeat('─', 60) || chr(10) AS shown
FROM hits
""",
)
def tool_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row forms of the tool, listing and plain-text surfaces."""
    hits = _hits(spark, sf_dir)
    rank, source, cite, body = F.col("rank"), F.col("source"), F.col("citation"), F.col("text")
    listing = render.context_result(
        rank, source, fixed(F.col("score"), 4), cite, F.col("doc_id"), F.col("chunk_id"), body
    )
    return hits.select(
        "query_id",
        "rank",
        F.md5(render.tool_result(rank, source, cite, body).cast("binary")).alias("tool"),
        F.md5(listing.cast("binary")).alias("listing"),
        render.text_result(rank, F.col("score"), F.col("chunk_id"), source, body).alias("shown"),
    )


@query(
    "json_results",
    f"""
WITH {HIT_SQL}
SELECT query_id, rank, src AS source_document, doc_id || '-0001' AS chunk_id, text AS content FROM hits
""",
)
def json_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON form of each result, read back into columns."""
    hits = _hits(spark, sf_dir)
    line = render.json_result(F.col("rank"), F.col("score"), F.col("chunk_id"), F.col("source"), F.col("text"))
    parsed = F.from_json(line, "rank int, score double, chunk_id string, source_document string, content string")
    return hits.select("query_id", parsed.alias("r")).select(
        "query_id", "r.rank", "r.source_document", "r.chunk_id", "r.content"
    )


@query(
    "short_queries",
    """
WITH q AS (SELECT item_id, replace(replace(trim(text, ' ' || chr(10)), chr(10), ' '), '|', '\\|') AS t FROM benchmark)
SELECT item_id, CASE WHEN length(t) <= 80 THEN t ELSE rtrim(substr(t, 1, 79)) || '…' END AS shown FROM q
""",
)
def short_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", render.short_query(F.col("text")).alias("shown"))


@query(
    "top_k_clamp",
    """
SELECT event_id, least(greatest(coalesce(TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'many' ELSE (k - 20)::VARCHAR END AS INT), 5), 1), 20) AS top_k
FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)
""",
)
def top_k_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.when(F.col("event_id") % 10 == 0, "many").otherwise(
        (F.get_json_object("props", "$.k").cast("int") - 20).cast("string")
    )
    return table(spark, sf_dir, "events").select("event_id", render.clamp_top_k(asked).alias("top_k"))


@query(
    "hit_lookup",
    f"""
WITH {HIT_SQL}
SELECT query_id, rank, coalesce(CASE WHEN l.doc_id IS NOT NULL THEN h.doc_id::VARCHAR END, '') AS doc_id, coalesce(l.quality, -1) AS quality
FROM hits h LEFT JOIN labels l ON l.doc_id = h.doc_id
""",
)
def hit_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits keep their place when the lookup misses; the id is empty then."""
    found = checkpointed(
        bm25.search_bm25(rel.bm25_index(spark, sf_dir, materialize=True), rel.benchmark_queries(spark, sf_dir), CONTEXT_K, digits=rel.ORDER_DIGITS)
    )
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("bm25_index"), "quality")
    known = join_hits(labels, found.select("bm25_index").distinct(), ["bm25_index"])
    joined = found.join(known, "bm25_index", "left")
    return joined.select(
        "query_id",
        "rank",
        F.coalesce(F.when(F.col("quality").isNotNull(), F.col("bm25_index").cast("string")), F.lit("")).alias("doc_id"),
        F.coalesce("quality", F.lit(-1)).alias("quality"),
    )


@query(
    "chunk_paths",
    """
WITH m AS (SELECT sha1(text) AS doc_id, doc_id AS pos, lang || '-' || doc_id AS slug FROM documents WHERE text IS NOT NULL),
f AS (SELECT doc_id, arg_min(slug, pos) AS slug FROM m WHERE pos % 4 > 0 GROUP BY doc_id)
SELECT m.pos AS hit, f.slug, f.slug || '/chunks/ch_' || lpad((pos % 30 + 1)::VARCHAR, 4, '0') || '.md' AS chunk_path FROM m LEFT JOIN f ON f.doc_id = m.doc_id
""",
)
def chunk_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document a hit; a fourth of the entries is missing from the manifest, and equal texts have several."""
    docs = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull())
    entries = docs.select(F.sha1("text").alias("doc_id"), F.col("doc_id").alias("pos"), F.concat_ws("-", "lang", "doc_id").alias("slug"))
    hits = entries.select(F.col("pos").alias("hit"), "doc_id", (F.col("pos") % 30 + 1).alias("chunk_index"))
    return manifest.chunk_files(hits, entries.filter("pos % 4 > 0")).select("hit", "slug", "chunk_path")


@query(
    "tool_call_parse",
    """
WITH c AS (SELECT conv_id, turn, text, (conv_id + turn) % 5 AS kind, strip_accents(regexp_replace(text, '[^a-zA-Z ]', '', 'g')) AS words FROM conversations)
SELECT conv_id, turn, 0::BIGINT AS call, CASE kind WHEN 0 THEN 'search_corpus' WHEN 1 THEN 'read_chunk' ELSE 'grep' END AS name,
       kind = 2 AS is_raw, CASE kind WHEN 2 THEN '' ELSE text END AS query, CASE kind WHEN 2 THEN 'not json: ' || text ELSE '' END AS raw FROM c WHERE kind < 3
UNION ALL SELECT conv_id, turn, 1, 'list_agents', false, '', '' FROM c WHERE kind = 0
""",
)
def tool_call_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses built from conversation turns: object arguments, arguments as
    a JSON string in the other shape, broken arguments, and none at all."""
    kind = (F.col("conv_id") + F.col("turn")) % 5
    arguments = F.to_json(F.struct(F.col("text").alias("query"), F.col("turn").alias("top_k")))

    def quoted(value):
        return F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)

    def call(name, value):
        return F.concat(F.lit(f'{{"function":{{"name":"{name}","arguments":'), value, F.lit("}}"))

    listed = F.lit('{"function":{"name":"list_agents"}}')
    response = (
        F.when(kind == 0, F.concat(F.lit('{"message":{"role":"assistant","tool_calls":['), call("search_corpus", arguments), F.lit(","), listed, F.lit("]}}")))
        .when(kind == 1, F.concat(F.lit('{"message":{"content":""},"choices":[{"message":{"tool_calls":['), call("read_chunk", quoted(arguments)), F.lit("]}}]}")))
        .when(kind == 2, F.concat(F.lit('{"message":{"tool_calls":['), call("grep", quoted(F.concat(F.lit("not json: "), "text"))), F.lit("]}}")))
        .when(kind == 3, F.lit('{"message":{"content":"done","tool_calls":[]}}'))
        .otherwise(F.lit("{}"))
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", response.alias("response"))
    calls = rows.select("conv_id", "turn", F.posexplode(toolcalls.tool_calls(F.col("response"))).alias("call", "c"))
    return calls.select(
        "conv_id",
        "turn",
        F.col("call").cast("long").alias("call"),
        "c.name",
        "c.is_raw",
        F.coalesce(F.get_json_object("c.arguments", "$.query"), F.lit("")).alias("query"),
        F.coalesce(F.get_json_object("c.arguments", "$.raw"), F.lit("")).alias("raw"),
    )


# Fixed value: rounds after which an agent loop ends.
MAX_ROUNDS = 5


@query(
    "conversation_log",
    """
SELECT conv_id, count(*) AS n_messages, count(*) FILTER (role = 'assistant') AS iterations,
       coalesce(arg_max(text, turn) FILTER (role = 'assistant'), '') AS final_answer,
       CASE WHEN count(*) FILTER (role = 'assistant') >= 5 THEN 'max_iterations'
            WHEN arg_max(role, turn) = 'assistant' THEN 'answered' ELSE 'open' END AS outcome FROM conversations GROUP BY conv_id
""",
)
def conversation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent-loop log per conversation: rounds, last answer, how it ended."""
    answer = F.col("role") == "assistant"
    log = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.count_if(answer).alias("iterations"),
        F.max_by(F.when(answer, F.col("text")), F.when(answer, F.col("turn"))).alias("final_answer"),
        F.max_by("role", "turn").alias("last_role"),
    )
    outcome = (
        F.when(F.col("iterations") >= MAX_ROUNDS, "max_iterations")
        .when(F.col("last_role") == "assistant", "answered")
        .otherwise("open")
    )
    return log.select(
        "conv_id", "n_messages", "iterations", F.coalesce("final_answer", F.lit("")).alias("final_answer"), outcome.alias("outcome")
    )
