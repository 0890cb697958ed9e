"""From parsed elements to Markdown with an element map.

An element row is (doc_id, pos, text, category, page_number, category_depth);
``category`` is NULL for plain-text elements. All windows here are partitioned
by document, and a document is one row of its source table before it is taken
apart, so a partition never exceeds what a single string value can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.text import SPACE, front_matter, normalize_block, strip

# Element categories that count as headings.
HEADING_CATEGORIES = ("Title", "Header")

HEADING_MARKS = rf"\A(#{{1,6}})[{SPACE}]"


def text_elements(docs: DataFrame, separator: str = "\n\n") -> DataFrame:
    """doc_id, text to plain-text elements in reading order."""
    return docs.select("doc_id", F.posexplode(F.split("text", separator)).alias("pos", "text")).select(
        "doc_id",
        "pos",
        "text",
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("int").alias("page_number"),
        F.lit(None).cast("int").alias("category_depth"),
    )


def _behind_marks(text: Column) -> Column:
    return strip(F.ltrim(text, F.lit("#")))


def heading_level(text: Column, category: Column, depth: Column) -> Column:
    """Heading level of a normalized block, NULL for body text."""
    # The marks decide, if one line of text follows them; the rest is not matched but trimmed.
    body = _behind_marks(text)
    marks = F.when(F.startswith(text, F.lit("#")) & (body != "") & ~body.contains("\n"), F.regexp_extract(text, HEADING_MARKS, 1))
    by_category = F.when(F.coalesce(depth, F.lit(-1)) >= 0, depth + 1).otherwise(F.lit(1))
    return F.when(
        category.isNull(), F.when(marks != "", F.length(marks))
    ).otherwise(F.when(category.isin(*HEADING_CATEGORIES), by_category))


def heading_text(text: Column, category: Column) -> Column:
    return F.when(
        category.isNull(), _behind_marks(text)
    ).otherwise(strip(F.substring_index(text, "\n", 1)))


def classify(elements: DataFrame) -> DataFrame:
    """Normalize blocks, drop blank ones, add level and heading text.

    Page numbers are kept for categorized elements only."""
    staged = elements.withColumn("text", normalize_block(F.col("text"))).filter(strip(F.col("text")) != "")
    level = heading_level(F.col("text"), F.col("category"), F.col("category_depth"))
    page = F.when(F.col("category").isNotNull(), F.col("page_number"))
    return staged.select(
        "doc_id",
        "pos",
        "text",
        page.alias("page_number"),
        level.alias("level"),
        F.when(level.isNotNull(), heading_text(F.col("text"), F.col("category"))).alias("heading"),
    )


def add_offsets(blocks: DataFrame, header_length: Column | int = 0) -> DataFrame:
    """Character span of each block when joined with blank lines."""
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    header = header_length if isinstance(header_length, Column) else F.lit(header_length)
    start = header + F.coalesce(F.sum(F.length("text") + 2).over(before), F.lit(0))
    return blocks.withColumn("char_start", start.cast("long")).withColumn(
        "char_end", F.col("char_start") + F.length("text")
    )


def add_heading_stack(blocks: DataFrame) -> DataFrame:
    """Open headings at each block, outermost first, of any depth.

    The headings of a document are folded in order: each closes those of its
    own or a deeper level. A block has the stack that the headings up to it
    left, found by their number; both sides are partitioned by document.
    """
    upto = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    numbered = blocks.withColumn("_headings", F.count("level").over(upto))
    heads = blocks.filter(F.col("level").isNotNull()).groupBy("doc_id")
    ordered = heads.agg(F.sort_array(F.collect_list(F.struct("pos", "level", "heading"))).alias("_heads"))
    none = F.array().cast("array<struct<level:int,heading:string>>")

    def fold(state: Column, head: Column) -> Column:
        above = F.filter(state["open"], lambda h: h["level"] < head["level"])
        now = F.concat(above, F.array(F.struct(head["level"].cast("int").alias("level"), head["heading"].alias("heading"))))
        return F.struct(now.alias("open"), F.concat(state["all"], F.array(F.transform(now, lambda h: h["heading"]))).alias("all"))

    start = F.struct(none.alias("open"), F.array().cast("array<array<string>>").alias("all"))
    stacks = ordered.select("doc_id", F.aggregate("_heads", start, fold, lambda s: s["all"]).alias("_stacks"))
    found = F.when(F.col("_headings") > 0, F.element_at("_stacks", F.col("_headings").cast("int")))
    return (
        numbered.join(stacks, "doc_id", "left")
        .withColumn("heading_stack", F.coalesce(found, F.array().cast("array<string>")))
        .select(*blocks.columns, "heading_stack")
    )


def element_map(elements: DataFrame, header_length: Column | int = 0) -> DataFrame:
    """Spans, pages and heading stacks of all non-blank elements."""
    return add_heading_stack(add_offsets(classify(elements), header_length))


def format_documents(
    elements: DataFrame, metadata: dict[str, Column] | None = None, documents: DataFrame | None = None
) -> DataFrame:
    """Markdown plus element map per document: doc_id, markdown, elements.

    ``documents`` (doc_id and the columns that ``metadata`` uses, one row per
    document) gives the front matter; without it ``metadata`` may use doc_id
    only. Documents whose elements are all blank have an empty body.
    """
    known = (documents if documents is not None else elements.select("doc_id").distinct()).withColumn(
        "_header", front_matter(metadata) if metadata else F.lit("")
    )
    ordered = F.sort_array(
        F.collect_list(
            F.struct("pos", "text", "char_start", "char_end", "page_number", "heading_stack")
        )
    )
    grouped = element_map(elements).groupBy("doc_id").agg(ordered.alias("_rows"))
    joined = known.select("doc_id", "_header").join(grouped, "doc_id", "left")
    body = F.concat(F.array_join(F.transform("_rows", lambda r: r["text"]), "\n\n"), F.lit("\n"))
    shift = F.length("_header")
    spans = F.transform(
        "_rows",
        lambda r: F.struct(
            (r["char_start"] + shift).alias("char_start"),
            (r["char_end"] + shift).alias("char_end"),
            r["page_number"].alias("page_number"),
            r["heading_stack"].alias("heading_stack"),
        ),
    )
    empty = F.array().cast("array<struct<char_start:bigint,char_end:bigint,page_number:int,heading_stack:array<string>>>")
    return joined.select(
        "doc_id",
        F.concat("_header", F.coalesce(body, F.lit(""))).alias("markdown"),
        F.coalesce(spans, empty).alias("elements"),
    )


def uncovered(formatted: DataFrame, header_length: Column | int = 0) -> DataFrame:
    """Coverage check on the finished Markdown: doc_id, wrong (faults found).

    Between the spans, read from the text itself, there must be exactly one
    blank line, nothing before the first but the header, a line end after the
    last, and no span may be blank.
    """
    header = header_length if isinstance(header_length, Column) else F.lit(header_length)
    n = F.size("elements")
    piece = lambda start, end: F.substring(F.col("markdown"), start + 1, end - start)
    starts = F.transform("elements", lambda e: e["char_start"].cast("int"))
    ends = F.transform("elements", lambda e: e["char_end"].cast("int"))
    gaps = F.transform(F.arrays_zip(F.slice(ends, F.lit(1), n - 1).alias("a"), F.slice(starts, F.lit(2), n - 1).alias("b")), lambda g: piece(g["a"], g["b"]))
    wrong_gaps = F.size(F.filter(gaps, lambda g: g != "\n\n"))
    blank = F.size(F.filter("elements", lambda e: strip(piece(e["char_start"].cast("int"), e["char_end"].cast("int"))) == ""))
    edges = (F.element_at(starts, 1) != header).cast("int") + (piece(F.element_at(ends, n), F.length("markdown")) != "\n").cast("int")
    checked = F.when(n > 0, wrong_gaps + blank + edges).otherwise((F.length("markdown") != header).cast("int"))
    return formatted.select("doc_id", checked.cast("long").alias("wrong")).filter("wrong > 0")
