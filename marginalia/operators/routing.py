"""Where a staged file goes: skip, archive, ingest, or wait for OCR."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.text import slug_of

# Supported extensions and the text yield a PDF must reach.
PARSED = ("pdf", "epub")
DIRECT = ("md", "docx", "doc")
MIN_TEXT_PER_MB = 1000
PDF_MAGIC = "%PDF"

# Every way a staged file can go, see ``route``.
ROUTES = ("parse", "direct", "ocr", "originals", "skipped")


def staged_slug(name: Column) -> Column:
    """Slug of a staged file: like other slugs, but a leading dot may be cut."""
    return slug_of(F.regexp_replace(name, r"\.[^.]*$", ""))


def is_staged_path(path: Column, root: str) -> Column:
    """Supported file exactly one folder below the staging root."""
    escaped = "".join("\\" + c if not c.isalnum() and c not in "/_" else c for c in root.rstrip("/"))
    kinds = "|".join(PARSED + DIRECT)
    return path.rlike(rf"^{escaped}/[^/]+/[^/]+\.({kinds})$")


def enough_text(text_length: Column, size_bytes: Column) -> Column:
    """Characters per megabyte, both rounded the way the shell rule rounds."""
    size_mb = F.round(size_bytes / 1048576.0, 2)
    return F.round(text_length / (size_mb + 0.1), 0) >= MIN_TEXT_PER_MB


def is_pdf(head: Column) -> Column:
    return F.substring(head, 1, 4) == F.lit(PDF_MAGIC.encode()).cast("binary")


def route(files: DataFrame, corpus: DataFrame) -> DataFrame:
    """Add collection, name, extension, slug and route to files(path,
    text_length, length). Hidden collections drop out."""
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    staged = files.withColumn("collection", F.element_at(parts, -2)).withColumn("name", name)
    staged = (
        staged.withColumn("extension", F.lower(F.regexp_extract("name", r"([^.]*)$", 1)))
        .withColumn("slug", staged_slug(F.col("name")))
        .filter(~F.col("collection").startswith("."))
    )
    # Of the whole corpus only the slugs of this batch count: the small side of a semi-join.
    here = staged.select("slug").distinct()
    known = corpus.select("slug").join(here, "slug", "left_semi").distinct().withColumn("_known", F.lit(True))
    target = (
        F.when(F.col("_known"), "originals")
        .when((F.col("extension") == "pdf") & ~enough_text(F.col("text_length"), F.col("length")), "ocr")
        .when(F.col("extension").isin(*PARSED), "parse")
        .when(F.col("extension").isin(*DIRECT), "direct")
        .otherwise("skipped")
    )
    return staged.join(known, "slug", "left").withColumn("route", target).drop("_known")
