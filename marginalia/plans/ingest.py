"""Ingest-side operators over documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import hashing, markup, text, yaml_text
from marginalia.functions.formulas import formula_counts, formula_ids
from marginalia.operators import routing
from marginalia.plans.registry import query, table, texts
from marginalia.session import spread


@query(
    "html_to_text",
    """
WITH v AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '<x>', 'g'), '(?is)<script\\b[^>]*>.*?</script\\s*>', '<x>', 'g'),
    '(?is)<style\\b[^>]*>.*?</style\\s*>', '<x>', 'g') AS h FROM pages
), n AS (
  SELECT page_id, list_filter(list_transform(string_split_regex(h, '<[!/?a-zA-Z][^>"'']*(?:"[^"]*"[^>"'']*|''[^'']*''[^>"'']*)*>|<[!/?a-zA-Z][^>]*>'), lambda t:
    regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''),
      '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g')), lambda t: t <> '') AS b FROM v
)
SELECT page_id, len(b)::BIGINT AS n_blocks, array_to_string(b, chr(10) || chr(10)) AS text FROM n
""",
)
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    blocks = pages.select("page_id", markup.html_blocks(F.col("html")).alias("blocks"))
    return blocks.select(
        "page_id", F.size("blocks").cast("long").alias("n_blocks"), F.array_join("blocks", "\n\n").alias("text")
    )


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as staged files: the collection is a path part of the URL, the
    extension turns with the id, sizes differ from their text."""
    kinds = F.array(*[F.lit(k) for k in ("pdf", "PDF", "epub", "md", "docx", "doc", "txt", "")])
    n = F.col("page_id")
    folder = F.concat(F.when(n % 17 == 0, ".").otherwise(""), F.element_at(F.split("url", "/"), 4))
    name = F.concat(F.lit("File_"), (n % 40).cast("string"), F.lit("."), F.get(kinds, (n % 8).cast("int")))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.lit("/staging/"), folder, F.lit("/"), name).alias("path"),
        F.length("html").alias("text_length"),
        (F.length("html") * (n % 7 * 400 + 1)).alias("length"),
    )


STAGED_SQL = """
staged AS (
  SELECT page_id, CASE WHEN page_id % 17 = 0 THEN '.' ELSE '' END || split_part(url, '/', 4) AS collection,
    'File_' || (page_id % 40) || '.' || ['pdf', 'PDF', 'epub', 'md', 'docx', 'doc', 'txt', ''][page_id % 8 + 1] AS name,
    lower(['pdf', 'PDF', 'epub', 'md', 'docx', 'doc', 'txt', ''][page_id % 8 + 1]) AS extension,
    'file-' || (page_id % 40) AS slug, length(html) AS tl, length(html) * (page_id % 7 * 400 + 1) AS size FROM pages
)"""


@query(
    "route_files",
    f"""
WITH {STAGED_SQL}
SELECT page_id, collection, name, extension, slug, CASE
  WHEN slug IN (SELECT 'file-' || doc_id FROM labels WHERE quality = 1) THEN 'originals'
  WHEN extension = 'pdf' AND round(tl / (round(size / 1048576.0::DOUBLE, 2) + 0.1::DOUBLE)) < 1000 THEN 'ocr'
  WHEN extension IN ('pdf', 'epub') THEN 'parse' WHEN extension IN ('md', 'docx', 'doc') THEN 'direct' ELSE 'skipped' END AS route
FROM staged WHERE NOT starts_with(collection, '.')
""",
)
def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good documents make up the existing corpus."""
    corpus = table(spark, sf_dir, "labels").filter("quality = 1").select(F.format_string("file-%d", "doc_id").alias("slug"))
    return routing.route(_staged(spark, sf_dir), corpus).select(
        "page_id", "collection", "name", "extension", "slug", "route"
    )


@query(
    "staged_paths",
    f"""
WITH {STAGED_SQL}
SELECT page_id, regexp_matches('/staging/' || collection || '/' || name, '^/staging/[^/]+/[^/]+\\.(pdf|epub|md|docx|doc)$') AS accepted FROM staged
""",
)
def staged_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir).select("page_id", routing.is_staged_path(F.col("path"), "/staging").alias("accepted"))


@query(
    "scan_files",
    f"""
WITH {STAGED_SQL}
SELECT page_id, lower(name) AS name FROM staged WHERE extension IN ('pdf', 'epub') ORDER BY lower(name), page_id
""",
)
def scan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory scan rule: supported suffix in any case, by lower-cased name."""
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    files = _staged(spark, sf_dir).select("page_id", name.alias("name"))
    kept = files.filter(text.file_suffix(F.col("name")).isin(".pdf", ".epub"))
    return kept.orderBy("name", "page_id")


@query(
    "pdf_magic",
    "SELECT page_id, page_id % 3 = 0 AS is_pdf FROM pages",
)
def pdf_magic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four bytes of each file; every third page is given a PDF head."""
    content = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("%PDF-1.7\n"), "html")).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", routing.is_pdf(content.cast("binary")).alias("is_pdf"))


@query(
    "has_embedding",
    "SELECT doc_id, doc_id IN (SELECT vec_id FROM embeddings) AS has_embedding FROM documents",
)
def has_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(True).alias("e"))
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.join(embedded, "doc_id", "left").select("doc_id", F.coalesce("e", F.lit(False)).alias("has_embedding"))


@query(
    "blank_chunks",
    f"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) FILTER (regexp_matches(line, '[^{text.SPACE}]')) AS kept, count(*) FILTER (NOT regexp_matches(line, '[^{text.SPACE}]')) AS blank
FROM lines GROUP BY doc_id
""",
)
def blank_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as chunks; blank ones are not embedded."""
    lines = texts(spark, sf_dir).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    blank = text.is_blank(F.col("line"))
    return lines.groupBy("doc_id").agg(F.count_if(~blank).alias("kept"), F.count_if(blank).alias("blank"))


@query(
    "usable_outputs",
    """
SELECT doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(toxic, 0) = 0 AND lang <> 'es' AND trim(text, ' ' || chr(10)) <> ''
""",
)
def usable_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse results worth chunking: successful (not toxic), with an output
    (not Spanish), and not empty."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    parsed = table(spark, sf_dir, "documents").join(labels, "doc_id", "left").select(
        "doc_id",
        F.when(F.coalesce("toxic", F.lit(0)) == 0, "success").otherwise("failed").alias("status"),
        F.when(F.col("lang") != "es", F.col("text")).alias("markdown"),
    )
    return parsed.filter((F.col("status") == "success") & ~text.is_blank(F.col("markdown"))).select("doc_id")


@query(
    "manifest_meta",
    """
SELECT d.doc_id, 'doc-' || d.doc_id AS slug, coalesce(CASE WHEN l.quality = 1 THEN sha1(d.text) END, '') AS file_sha1
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.lang <> 'de'
""",
)
def manifest_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest entries with the file hash of their meta record, if any;
    entries without a slug (German) do not count."""
    docs = table(spark, sf_dir, "documents")
    entries = docs.select("doc_id", F.when(F.col("lang") != "de", F.format_string("doc-%d", "doc_id")).alias("slug"))
    meta = (
        table(spark, sf_dir, "labels").filter("quality = 1").join(docs, "doc_id").select("doc_id", hashing.sha1(F.col("text")).alias("file_sha1"))
    )
    listed = entries.filter("doc_id IS NOT NULL AND slug IS NOT NULL")
    return listed.join(meta, "doc_id", "left").withColumn("file_sha1", F.coalesce("file_sha1", F.lit("")))


def _chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    doc = hashing.short_id(hashing.sha1(F.col("text")))
    cid = hashing.chunk_id(doc, F.lit(1))
    counts = formula_counts(F.col("text"))
    section = F.when(n % 3 > 0, F.concat(F.lit("Sec: "), F.substring("text", 1, 12)))
    page = F.when(n % 4 > 0, n % 100)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        yaml_text.render_chunk(
            doc, F.concat("source", F.lit(".pdf")), cid, page, page + 1,
            hashing.chunk_hash(F.col("text"), skip_front_matter=False),
            F.to_timestamp(F.lit("2024-06-01 12:30:45")), F.col("text"), section, n % 2 == 0,
            counts, formula_ids(doc, F.lit(1), counts["total"]),
        ).alias("file"),
    )


@query(
    "chunk_files",
    """
SELECT doc_id, substr(sha1(text), 1, 8) || '-0001' AS chunk_id, source || '.pdf' AS source, sha256(text) AS hash,
  CASE WHEN doc_id % 4 > 0 THEN doc_id % 100 ELSE -1 END AS page_start,
  CASE WHEN doc_id % 3 > 0 THEN 'Sec: ' || substr(text, 1, 12) ELSE '' END AS section_heading,
  doc_id % 2 = 0 AS has_embedding, sha256(text || CASE WHEN text = '' OR text[-1] = chr(10) THEN '' ELSE chr(10) END) AS body_hash FROM documents
""",
)
def chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render every document as a chunk file and read its fields back."""
    files = _chunk_files(spark, sf_dir)
    block = text.front_matter_of(F.col("file"))
    body = F.regexp_replace("file", r"(?s)\A---\n.*?\n---\n\n", "")

    def value(key):
        return yaml_text.unquote(text.front_matter_value(block, key))

    return files.select(
        "doc_id",
        value("chunk_id").alias("chunk_id"),
        value("source").alias("source"),
        value("hash").alias("hash"),
        F.coalesce(value("page_start").try_cast("long"), F.lit(-1)).alias("page_start"),
        F.coalesce(value("section_heading"), F.lit("")).alias("section_heading"),
        (F.coalesce(value("has_embedding"), F.lit("false")) == "true").alias("has_embedding"),
        F.sha2(body.cast("binary"), 256).alias("body_hash"),
    )


@query(
    "grep_lines",
    r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_number FROM documents
)
SELECT doc_id, line_number, line FROM lines WHERE regexp_matches(line, '(?i)\bthe and\b') ORDER BY doc_id, line_number LIMIT 50
""",
)
def grep_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First fifty matching lines by document and line; the limit is the feature."""
    lines = texts(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    found = lines.filter(F.col("line").rlike(r"(?i)\bthe and\b"))
    return (
        found.select("doc_id", (F.col("i") + 1).cast("long").alias("line_number"), "line")
        .orderBy("doc_id", "line_number")
        .limit(50)
    )


@query(
    "meta_files",
    """
SELECT doc_id, 'doc_id: d' || substr(sha1(text), 1, 8) || chr(10) || 'slug: doc-' || doc_id || chr(10) || 'orig_name: doc-' || doc_id || '.pdf' || chr(10)
  || 'created_utc: ' || chr(39) || '2024-06-01T00:00:00+00:00' || chr(39) || chr(10) || 'collections:' || chr(10) || '- ' || lang || chr(10) || '- ' || source || chr(10)
  || CASE WHEN doc_id % 2 = 0 THEN 'source_agent: ' || source || chr(10) ELSE '' END || 'tooling:' || chr(10) || '  parser: unknown' || chr(10)
  || 'params:' || chr(10) || '  ocr_mode: auto' || chr(10) || 'hashes:' || chr(10) || '  file_sha1: x' || sha1(text) || chr(10) || '  sha256: x' || sha256(text) || chr(10) AS meta
FROM documents
""",
)
def meta_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata file of each document; ids and hashes get a letter in front so
    that none reads as a number, and two collection names are invalid."""
    body = F.col("text")
    meta = yaml_text.render_meta(
        F.concat(F.lit("d"), hashing.short_id(hashing.sha1(body))),
        F.format_string("doc-%d", "doc_id"),
        F.format_string("doc-%d.pdf", "doc_id"),
        F.to_timestamp(F.lit("2024-06-01 00:00:00")),
        F.create_map(F.lit("parser"), F.lit("unknown")),
        F.create_map(F.lit("ocr_mode"), F.lit("auto")),
        F.create_map(
            F.lit("file_sha1"), F.concat(F.lit("x"), hashing.sha1(body)),
            F.lit("sha256"), F.concat(F.lit("x"), hashing.sha256(body)),
        ),
        F.array("lang", F.upper("lang"), "source", F.concat_ws(" ", "lang", "source")),
        F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise(""),
    )
    return table(spark, sf_dir, "documents").select("doc_id", meta.alias("meta"))
