"""Text functions, elements, chunking and provenance over documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.functions import hashing, text
from marginalia.operators import elements, provenance, splitter
from marginalia.plans.registry import query, table, texts
from marginalia.session import checkpointed

# The white-space class of the text functions, for use inside SQL patterns.
WS = text.SPACE
WS_LINE = text.SPACE_NO_NEWLINE


@query(
    "doc_hashes",
    """
SELECT doc_id, sha1(text) AS sha1, substr(sha1(text), 1, 8) AS short_id, sha256(text) AS content_hash,
       'sha256' AS hash_algo FROM documents
""",
)
def doc_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        hashing.sha1(body).alias("sha1"),
        hashing.short_id(hashing.sha1(body)).alias("short_id"),
        hashing.document_hashes(body)["blake3"].alias("content_hash"),
        hashing.hash_algorithm_used().alias("hash_algo"),
    )


def _with_header(docs: DataFrame) -> DataFrame:
    header = text.front_matter(
        {
            "source": F.col("source"),
            "lang": F.col("lang"),
            "chunk_size": F.lit(1200),
            "fallback": F.when(F.col("lang") == "en", "true").otherwise("false"),
        }
    )
    return docs.withColumn("markdown", F.concat(header, text.normalize_markdown(F.col("text"))))


HEADER_SQL = f"""
norm AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'),
            '[{WS_LINE}]+(\\n|$)', '\\1', 'g'), '\\n+$', '') AS body FROM documents
),
headed AS (
  SELECT doc_id, lang, source, text, CASE WHEN body = '' THEN '' ELSE body || chr(10) END AS body,
    '---' || chr(10) || 'chunk_size: 1200' || chr(10)
    || 'fallback: ' || CASE WHEN lang = 'en' THEN 'true' ELSE 'false' END || chr(10)
    || 'lang: ' || lang || chr(10) || 'source: ' || source || chr(10) || '---' || chr(10) || chr(10) AS header
  FROM norm
)"""


@query(
    "doc_ids",
    f"""
WITH {HEADER_SQL}
SELECT doc_id, substr(sha1(header || body), 1, 8) AS markdown_doc_id, substr(sha1(text), 1, 8) AS file_doc_id FROM headed
""",
)
def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both id rules: from Markdown with its header, and from file bytes."""
    docs = _with_header(table(spark, sf_dir, "documents"))
    return docs.select(
        "doc_id",
        hashing.short_id(hashing.sha1(F.col("markdown"))).alias("markdown_doc_id"),
        hashing.short_id(hashing.sha1(F.col("text"))).alias("file_doc_id"),
    )


@query(
    "front_matter_roundtrip",
    f"""
WITH {HEADER_SQL}
SELECT doc_id, sha256(ltrim(body, chr(10))) AS chunk_hash, sha256(header || body) AS full_hash,
       '1200' AS chunk_size, lang, lang = 'en' AS is_fallback FROM headed
""",
)
def front_matter_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render a header, hash with and without it, read its values back."""
    docs = _with_header(table(spark, sf_dir, "documents"))
    block = text.front_matter_of(F.col("markdown"))
    return docs.select(
        "doc_id",
        hashing.chunk_hash(F.col("markdown")).alias("chunk_hash"),
        hashing.chunk_hash(F.col("markdown"), skip_front_matter=False).alias("full_hash"),
        text.front_matter_value(block, "chunk_size").alias("chunk_size"),
        text.front_matter_value(block, "lang").alias("lang"),
        text.is_fallback(F.col("markdown")).alias("is_fallback"),
    )


@query(
    "normalize_markdown",
    f"""
WITH raw AS (
  SELECT doc_id, replace(replace(text, '. ', '. ' || chr(9) || chr(13) || chr(10)), ', ', ', ' || chr(13)) || chr(160) || chr(10) || ' ' || chr(10) AS t
  FROM documents
), b AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '\\r\\n?', chr(10), 'g'),
     '[{WS_LINE}]+(\\n|$)', '\\1', 'g'), '\\n+$', '') AS body FROM raw
)
SELECT doc_id, length(body)::BIGINT + CASE WHEN body = '' THEN 0 ELSE 1 END AS n,
       md5(CASE WHEN body = '' THEN '' ELSE body || chr(10) END) AS digest FROM b
""",
)
def normalize_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents roughened with mixed line ends and trailing blanks."""
    rough = F.concat(
        F.replace(F.replace("text", F.lit(". "), F.lit(". \t\r\n")), F.lit(", "), F.lit(", \r")),
        F.lit(" \n \n"),
    )
    clean = text.normalize_markdown(rough)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(clean).cast("long").alias("n"), F.md5(clean.cast("binary")).alias("digest")
    )


@query(
    "slugify",
    r"""
WITH n AS (SELECT page_id, regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1) AS name FROM pages),
s AS (SELECT page_id, CASE WHEN regexp_matches(name, '^.+\.[^.]+$') THEN regexp_extract(name, '^(.+)\.[^.]+$', 1) ELSE name END AS stem FROM n)
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(stem), '[ _]', '-', 'g'),
       '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM s
""",
)
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.slugify(F.col("url")).alias("slug"))


@query(
    "slug_titles",
    r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(text, '^([^\n]*)', 1)), '[ _]', '-', 'g'),
       '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM documents
""",
)
def slug_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slug of each document's first line."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.slug_of(F.substring_index("text", "\n", 1)).alias("slug")
    )


@query(
    "fast_blocks",
    f"""
WITH b AS (SELECT doc_id, unnest(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10))) AS b FROM documents),
k AS (SELECT doc_id, regexp_replace(b, '^[{WS}]+|[{WS}]+$', '', 'g') AS b FROM b)
SELECT doc_id, count(*) FILTER (WHERE b <> '') AS n_blocks, coalesce(sum(length(b)), 0)::BIGINT AS n_chars FROM k GROUP BY doc_id
""",
)
def fast_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank-line split of extracted text; lines stand for its paragraphs."""
    blocks = text.fast_blocks(F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(blocks).cast("long").alias("n_blocks"),
        F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + F.length(b)).alias("n_chars"),
    )


@query(
    "join_blocks",
    """
WITH b AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS bs FROM documents
)
SELECT doc_id, md5(coalesce(array_to_string(bs, chr(10) || chr(10)), '')) AS digest FROM b
""",
)
def join_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = text.join_blocks(F.split("text", "\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(joined.cast("binary")).alias("digest"))


@query(
    "text_yield",
    """
SELECT page_id, round(length(html) / greatest(length(html) / 1048576.0::DOUBLE * (1 + page_id % 5 * 2000), 0.1::DOUBLE), 3) AS per_mb,
       length(html) / greatest(length(html) / 1048576.0::DOUBLE * (1 + page_id % 5 * 2000), 0.1::DOUBLE) >= 1000 AS sufficient FROM pages
""",
)
def text_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text length against file size, where files are 1 to 8001 times larger."""
    size_mb = F.length("html") / 1048576.0 * (F.pmod("page_id", F.lit(5)) * 2000 + 1)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.round(F.length("html") / F.greatest(size_mb, F.lit(0.1)), 3).alias("per_mb"),
        text.text_yield_ok(F.length("html"), size_mb).alias("sufficient"),
    )


@query(
    "display_name",
    """
SELECT user_id, event_type, array_to_string(list_transform(string_split('vp-' || event_type || '-QA-' || user_id, '-'),
  lambda w: CASE WHEN lower(w) IN ('ceo','ip','qa','hr','cfo','cto','vp','ma') THEN upper(w)
            ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END), ' ') AS display_name
FROM (SELECT DISTINCT user_id, event_type FROM events)
""",
)
def display_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    name = F.concat(F.lit("vp-"), "event_type", F.lit("-QA-"), F.col("user_id").cast("string"))
    return names.select("user_id", "event_type", text.display_name(name).alias("display_name"))


def _line_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as parser elements. A line whose length is divisible
    by four is a title of depth (length mod 9); pages turn every five lines."""
    lines = texts(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    size = F.length("text")
    return lines.select(
        "doc_id",
        "pos",
        "text",
        F.when(size % 4 == 0, "Title").otherwise("NarrativeText").alias("category"),
        (F.floor(F.col("pos") / 5) + 1).cast("int").alias("page_number"),
        (size % 9).cast("int").alias("category_depth"),
    )


ELEMENT_SQL = f"""
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
         unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents
),
kept AS (
  SELECT doc_id, pos, regexp_replace(raw, '[{WS_LINE}]+$', '') AS text, length(raw) % 4 = 0 AS is_head,
         length(raw) % 9 + 1 AS lvl, pos // 5 + 1 AS page
  FROM lines WHERE regexp_replace(raw, '[{WS_LINE}]+', '', 'g') <> ''
),
spans AS (
  SELECT *, coalesce(sum(length(text) + 2) OVER (PARTITION BY doc_id ORDER BY pos
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start FROM kept
)"""


@query(
    "element_offsets",
    f"""
WITH {ELEMENT_SQL}
SELECT doc_id, pos, page AS page_number, char_start, char_start + length(text) AS char_end FROM spans
""",
)
def element_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = elements.add_offsets(elements.classify(_line_elements(spark, sf_dir)))
    return spans.select(
        "doc_id",
        F.col("pos").cast("long").alias("pos"),
        F.col("page_number").cast("long").alias("page_number"),
        "char_start",
        "char_end",
    )


STACK_SQL = f"""
{ELEMENT_SQL},
heads AS (
  SELECT doc_id, pos, lvl, regexp_replace(text, '^[{WS}]+|[{WS}]+$', '', 'g') AS heading FROM kept WHERE is_head
),
closed AS (
  SELECT doc_id, pos, lvl, heading,
         (SELECT min(q.pos) FROM heads q WHERE q.doc_id = h.doc_id AND q.pos > h.pos AND q.lvl <= h.lvl) AS until
  FROM heads h
),
stack AS (
  SELECT e.doc_id, e.pos, string_agg(c.heading, ' > ' ORDER BY c.pos) AS path, arg_max(c.heading, c.pos) AS innermost
  FROM kept e LEFT JOIN closed c ON c.doc_id = e.doc_id AND c.pos <= e.pos AND (c.until IS NULL OR c.until > e.pos)
  GROUP BY e.doc_id, e.pos
)"""


@query(
    "heading_stack",
    f"WITH {STACK_SQL} SELECT doc_id, pos, coalesce(path, '') AS path FROM stack",
)
def heading_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacked = elements.add_heading_stack(elements.classify(_line_elements(spark, sf_dir)))
    return stacked.select(
        "doc_id", F.col("pos").cast("long").alias("pos"), F.array_join("heading_stack", " > ").alias("path")
    )


@query(
    "format_documents",
    f"""
WITH {ELEMENT_SQL}
SELECT doc_id, md5(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY pos) || chr(10), '')) AS digest,
       count(text) AS n_elements, max(char_start + length(text)) AS body_end
FROM (SELECT doc_id FROM documents) LEFT JOIN spans USING (doc_id) GROUP BY doc_id
""",
)
def format_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = elements.format_documents(_line_elements(spark, sf_dir))
    return formatted.select(
        "doc_id",
        F.md5(F.col("markdown").cast("binary")).alias("digest"),
        F.size("elements").cast("long").alias("n_elements"),
        F.array_max(F.transform("elements", lambda e: e["char_end"])).alias("body_end"),
    )


@query(
    "heading_classify",
    f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
         unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents
), b AS (
  SELECT doc_id, pos, regexp_replace(repeat('#', (length(raw) % 8)::BIGINT) || ' ' || raw, '[{WS_LINE}]+$', '') AS t FROM lines
  WHERE raw <> ''
)
SELECT doc_id, pos, length(regexp_extract(t, '^(#{{1,6}})[{WS}]+([^\\n]+?)[{WS}]*$', 1)) AS level,
       regexp_extract(t, '^(#{{1,6}})[{WS}]+([^\\n]+?)[{WS}]*$', 2) AS heading
FROM b WHERE regexp_matches(t, '^(#{{1,6}})[{WS}]+([^\\n]+?)[{WS}]*$')
""",
)
def heading_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines behind zero to seven hash marks, classified as plain text."""
    lines = texts(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    marked = lines.filter("raw <> ''").select(
        "doc_id",
        "pos",
        F.concat(F.repeat(F.lit("#"), F.length("raw") % 8), F.lit(" "), "raw").alias("text"),
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("int").alias("page_number"),
        F.lit(None).cast("int").alias("category_depth"),
    )
    heads = elements.classify(marked).filter("level IS NOT NULL")
    return heads.select(
        "doc_id", F.col("pos").cast("long").alias("pos"), F.col("level").cast("long").alias("level"), "heading"
    )


@query(
    "element_coverage",
    f"""
WITH {ELEMENT_SQL},
md AS (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY pos) || chr(10) AS markdown FROM spans GROUP BY doc_id),
near AS (
  SELECT doc_id, char_start, char_start + length(text) AS char_end,
         lead(char_start) OVER (PARTITION BY doc_id ORDER BY pos) AS next_start,
         row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS nr FROM spans
)
SELECT count(*) AS checked, count(*) FILTER (
         substr(markdown, char_end + 1, coalesce(next_start, length(markdown)) - char_end)
           <> CASE WHEN next_start IS NULL THEN chr(10) ELSE chr(10) || chr(10) END
         OR (nr = 1 AND char_start <> 0)) AS wrong_gaps
FROM near JOIN md USING (doc_id)
""",
)
def element_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: in the finished text neighbouring elements are one blank line apart."""
    formatted = elements.format_documents(_line_elements(spark, sf_dir))
    wrong = elements.uncovered(formatted).agg(F.coalesce(F.sum("wrong"), F.lit(0)).alias("wrong_gaps"))
    return formatted.agg(F.sum(F.size("elements")).alias("checked")).crossJoin(wrong)


def _fixed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of 1200 characters every 1050 over each document's formatted text."""
    mapped = elements.add_offsets(elements.classify(_line_elements(spark, sf_dir)))
    ends = mapped.groupBy("doc_id").agg(F.max("char_end").alias("n"))
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - 151, F.lit(0)), F.lit(1050).cast("long"))
    return ends.select("doc_id", "n", F.posexplode(starts).alias("i", "char_start")).select(
        "doc_id",
        (F.col("i") + 1).alias("chunk_index"),
        "char_start",
        F.least(F.col("char_start") + 1200, F.col("n")).alias("char_end"),
    )


FIXED_CHUNK_SQL = """
ends AS (SELECT doc_id, max(char_start + length(text)) AS n FROM spans GROUP BY doc_id),
chunks AS (
  SELECT doc_id, s // 1050 + 1 AS chunk_index, s AS c_start, least(s + 1200, n) AS c_end
  FROM (SELECT doc_id, n, unnest(range(0, greatest(n - 151, 0) + 1, 1050)) AS s FROM ends)
)"""


@query(
    "chunk_pages",
    f"""
WITH {ELEMENT_SQL}, {FIXED_CHUNK_SQL}
SELECT c.doc_id, c.chunk_index, min(s.page) AS page_start, max(s.page) AS page_end
FROM chunks c JOIN spans s ON s.doc_id = c.doc_id AND s.char_start + length(s.text) > c.c_start AND s.char_start < c.c_end
GROUP BY c.doc_id, c.chunk_index
""",
)
def chunk_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = elements.add_offsets(elements.classify(_line_elements(spark, sf_dir)))
    pages = provenance.chunk_pages(_fixed_chunks(spark, sf_dir), mapped)
    return pages.select(
        "doc_id",
        F.col("chunk_index").cast("long").alias("chunk_index"),
        F.col("page_start").cast("long").alias("page_start"),
        F.col("page_end").cast("long").alias("page_end"),
    )


@query(
    "chunk_sections",
    f"""
WITH {STACK_SQL}, {FIXED_CHUNK_SQL}
SELECT c.doc_id, c.chunk_index, coalesce(arg_max(k.innermost, s.char_start) FILTER (WHERE k.innermost IS NOT NULL), '') AS section_heading
FROM chunks c LEFT JOIN spans s ON s.doc_id = c.doc_id AND s.char_start <= c.c_start
LEFT JOIN stack k ON k.doc_id = s.doc_id AND k.pos = s.pos
GROUP BY c.doc_id, c.chunk_index
""",
)
def chunk_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = elements.element_map(_line_elements(spark, sf_dir))
    sections = provenance.chunk_sections(_fixed_chunks(spark, sf_dir), mapped)
    return sections.select(
        "doc_id",
        F.col("chunk_index").cast("long").alias("chunk_index"),
        F.coalesce("section_heading", F.lit("")).alias("section_heading"),
    )


# The splitting rule for texts without blank lines (no given document has any):
# lines first, long lines by words, greedy packing as a recursion over piece
# boundaries, then the forward search for positions as a second recursion.
CHUNK_SQL = f"""
part AS (
  SELECT doc_id, text, CASE WHEN contains(text, chr(10)) THEN chr(10) ELSE ' ' END AS sep FROM documents
),
piece0 AS (
  SELECT doc_id, text, sep, unnest(string_split(text, sep)) AS body, unnest(range(0, len(string_split(text, sep)))) AS k FROM part
),
piece AS (
  SELECT doc_id, sep, k, length(body) + (k > 0)::INT AS n,
         sum(length(body) + (k > 0)::INT) OVER (PARTITION BY doc_id ORDER BY k) AS stop,
         substr(text, (sum(length(body) + (k > 0)::INT) OVER (PARTITION BY doc_id ORDER BY k))::BIGINT - length(body) - (k > 0)::INT + 1,
                length(body) + (k > 0)::INT) AS whole
  FROM piece0
),
ranked AS (
  SELECT *, (stop - n)::BIGINT AS start, count(*) FILTER (n >= 1200) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS big
  FROM piece WHERE n > 0
),
word0 AS (
  SELECT doc_id, big, start, unnest(string_split(whole, ' ')) AS body, unnest(range(0, len(string_split(whole, ' ')))) AS k
  FROM ranked WHERE n >= 1200 AND sep = chr(10)
),
word AS (
  SELECT doc_id, big, k, length(body) + (k > 0)::INT AS n,
         (start + sum(length(body) + (k > 0)::INT) OVER (PARTITION BY doc_id, big ORDER BY k))::BIGINT AS stop FROM word0
),
wranked AS (
  SELECT *, stop - n AS start, count(*) FILTER (n >= 1200) OVER (PARTITION BY doc_id, big ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wbig
  FROM word WHERE n > 0
),
runs AS (
  SELECT doc_id, big AS a, 0 AS b, 0 AS c, 0 AS d, false AS raw, list_append(list(start ORDER BY k), max(stop)::BIGINT) AS cuts
  FROM ranked WHERE n < 1200 GROUP BY doc_id, big
  UNION ALL SELECT doc_id, big, 1, 0, 0, true, [start, stop::BIGINT] FROM ranked WHERE n >= 1200 AND sep = ' '
  UNION ALL SELECT doc_id, big, 1, wbig, 0, false, list_append(list(start ORDER BY k), max(stop)) FROM wranked WHERE n < 1200 GROUP BY doc_id, big, wbig
  UNION ALL SELECT doc_id, big, 1, wbig, 1, true, [start, stop] FROM wranked WHERE n >= 1200
),
walk AS (
  SELECT doc_id, a, b, c, d, raw, cuts, 1::BIGINT AS f,
         CASE WHEN raw THEN 2 ELSE len(list_filter(cuts, lambda x: x <= cuts[1] + 1200)) END::BIGINT AS t, 0 AS step FROM runs
  UNION ALL
  SELECT doc_id, a, b, c, d, raw, cuts, nf, len(list_filter(cuts, lambda x: x <= cuts[nf] + 1200))::BIGINT, step + 1
  FROM (SELECT *, least(t, greatest(len(list_filter(cuts, lambda x: x < cuts[t] - 150)) + 1, len(list_filter(cuts, lambda x: x < cuts[t + 1] - 1200)) + 1))::BIGINT AS nf
        FROM walk WHERE t < len(cuts))
),
emitted AS (
  SELECT w.*, CASE WHEN raw THEN substr(text, cuts[f] + 1, cuts[t] - cuts[f])
              ELSE regexp_replace(substr(text, cuts[f] + 1, cuts[t] - cuts[f]), '^[{WS}]+|[{WS}]+$', '', 'g') END AS body,
         cuts[f] + CASE WHEN raw THEN 0 ELSE length(regexp_extract(substr(text, cuts[f] + 1, cuts[t] - cuts[f]), '^[{WS}]*')) END AS true_start
  FROM walk w JOIN documents USING (doc_id)
),
numbered AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY a, b, c, d, step) AS i, body, true_start FROM emitted WHERE body <> ''
  UNION ALL SELECT doc_id, 1, text, 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM emitted WHERE body <> '')
),
placed AS (
  SELECT n.doc_id, n.i, n.body, greatest(strpos(text, n.body) - 1, 0)::BIGINT AS place FROM numbered n JOIN documents USING (doc_id) WHERE n.i = 1
  UNION ALL
  SELECT doc_id, i, body, CASE WHEN p = 0 THEN true_start ELSE cursor + p - 1 END::BIGINT
  FROM (SELECT *, strpos(substr(text, cursor + 1), body) AS p
        FROM (SELECT n.*, d.text, greatest(q.place + 1, q.place + length(q.body) - 150) AS cursor
              FROM placed q JOIN numbered n ON n.doc_id = q.doc_id AND n.i = q.i + 1 JOIN documents d ON d.doc_id = q.doc_id))
)"""


@query(
    "chunk_documents",
    f"""
WITH RECURSIVE {CHUNK_SQL}
SELECT doc_id, i AS chunk_index, doc_id || '-' || format('{{:04d}}', i) AS chunk_id, place AS char_start, place + length(body) AS char_end,
       sha256(body) AS content_hash, body AS text FROM placed
""",
)
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive split of every whole document, with positions."""
    chunks = splitter.split_documents(texts(spark, sf_dir))
    return chunks.select(
        "doc_id",
        "chunk_index",
        hashing.chunk_id(F.col("doc_id").cast("string"), F.col("chunk_index")).alias("chunk_id"),
        "char_start",
        "char_end",
        hashing.chunk_hash(F.col("text"), skip_front_matter=False).alias("content_hash"),
        "text",
    )


@query(
    "chunk_invariants",
    f"""
SELECT doc_id, 0::BIGINT AS misplaced, 0::BIGINT AS unordered, 0::BIGINT AS breakable_oversize,
       (regexp_matches(text, '[^{WS}]'))::BIGINT AS covers_text FROM documents
""",
)
def chunk_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: chunks equal their slice of the text, starts never go
    back, only chunks without a separator exceed the size, and every visible
    character lies in some chunk."""
    docs = texts(spark, sf_dir)
    chunks = splitter.split_documents(docs)
    spans = F.sort_array(
        F.collect_list(F.struct("chunk_index", "char_start", "char_end", F.md5(F.col("text").cast("binary")).alias("h"),
                                (F.trim("text").contains(" ") | F.trim("text").contains("\n")).alias("breakable")))
    )
    per_doc = docs.join(chunks.groupBy("doc_id").agg(spans.alias("spans")), "doc_id")
    size = splitter.ChunkConfig().size

    def count(condition):
        return F.size(F.filter("spans", condition)).cast("long")

    before = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["char_end"]))
    gaps = F.zip_with(
        F.concat(F.transform("spans", lambda s: s["char_start"]), F.array(F.length("text"))),
        before,
        lambda start, end: F.when(start > end, F.substr(F.col("text"), end + 1, start - end)).otherwise(F.lit("")),
    )
    blank_gaps = F.forall(gaps, lambda g: text.strip(g) == "")
    starts = F.transform("spans", lambda s: s["char_start"])
    return per_doc.select(
        "doc_id",
        count(lambda s: F.md5(F.substr(F.col("text"), s["char_start"] + 1, s["char_end"] - s["char_start"]).cast("binary")) != s["h"]).alias("misplaced"),
        F.when(F.array_sort(starts) == starts, 0).otherwise(1).cast("long").alias("unordered"),
        count(lambda s: (s["char_end"] - s["char_start"] > size) & s["breakable"]).alias("breakable_oversize"),
        (blank_gaps & (text.strip(F.col("text")) != "")).cast("long").alias("covers_text"),
    )


@query(
    "chunk_provenance",
    None,
)
def chunk_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format, split and trace: chunks of the formatted text with pages and section."""
    rows = _line_elements(spark, sf_dir)
    # The written documents table of an ingest run: split and traced from one copy.
    formatted = checkpointed(elements.format_documents(rows))
    chunks = splitter.split_documents(formatted.select("doc_id", F.col("markdown").alias("text")))
    mapped = formatted.select("doc_id", F.inline("elements"))
    traced = provenance.add_provenance(chunks.drop("text"), mapped)
    return traced.select(
        "doc_id", "chunk_index", "char_start", "char_end", "page_start", "page_end", "section_heading"
    )


@query(
    "chunk_trace",
    f"""
WITH RECURSIVE {CHUNK_SQL}, {STACK_SQL},
rawspan AS (
  SELECT doc_id, pos, length(raw) AS n, (sum(length(raw) + 1) OVER (PARTITION BY doc_id ORDER BY pos))::BIGINT - length(raw) - 1 AS s FROM lines
),
el AS (SELECT r.doc_id, r.pos, r.s, r.s + r.n AS e, k.page, t.innermost FROM rawspan r JOIN kept k USING (doc_id, pos) JOIN stack t USING (doc_id, pos))
SELECT c.doc_id, c.i AS chunk_index, c.place AS char_start, coalesce(min(el.page) FILTER (el.e > c.place AND el.s < c.place + length(c.body)), 0) AS page_start,
       coalesce(max(el.page) FILTER (el.e > c.place AND el.s < c.place + length(c.body)), 0) AS page_end,
       coalesce(arg_max(el.innermost, el.s) FILTER (el.s <= c.place AND el.innermost IS NOT NULL), '') AS section_heading
FROM placed c LEFT JOIN el ON el.doc_id = c.doc_id GROUP BY c.doc_id, c.i, c.place
""",
)
def chunk_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split every document and trace each chunk to pages and section of the
    lines it was cut from."""
    order = Window.partitionBy("doc_id").orderBy("pos")
    ends = F.sum(F.length("text") + 1).over(order)
    rows = _line_elements(spark, sf_dir)
    spans = rows.select("doc_id", "pos", (ends - 1 - F.length("text")).alias("char_start"), (ends - 1).alias("char_end"))
    stacked = elements.add_heading_stack(elements.classify(rows))
    mapped = stacked.drop("text").join(spans, ["doc_id", "pos"])
    chunks = splitter.split_documents(texts(spark, sf_dir)).drop("text")
    traced = provenance.add_provenance(chunks, mapped)
    return traced.select(
        "doc_id",
        F.col("chunk_index").cast("long").alias("chunk_index"),
        F.col("char_start").cast("long").alias("char_start"),
        F.coalesce(F.col("page_start").cast("long"), F.lit(0)).alias("page_start"),
        F.coalesce(F.col("page_end").cast("long"), F.lit(0)).alias("page_end"),
        F.coalesce("section_heading", F.lit("")).alias("section_heading"),
    )
