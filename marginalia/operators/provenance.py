"""Page range and section of each chunk, from the element map of its document.

Chunks:   doc_id, chunk_index, char_start, char_end
Elements: doc_id, char_start, char_end, page_number, heading_stack
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 4096


def _covered_buckets(start: str, end: str, width: int):
    first = F.floor(F.col(start) / width)
    last = F.floor(F.greatest(F.col(end) - 1, F.col(start)) / width)
    return F.sequence(first, last)


def chunk_pages(chunks: DataFrame, elements: DataFrame, width: int = BUCKET) -> DataFrame:
    """Add the smallest and largest page over the elements a chunk overlaps.

    Interval join by buckets of the text position: rows meet only inside a
    document's bucket, not across the whole document. A pair seen in two
    buckets does no harm, minimum and maximum ignore repeats. The chunk's own
    columns travel along, so chunks are read once.
    """
    left = chunks.select(
        "doc_id",
        "chunk_index",
        F.struct(*chunks.columns).alias("chunk"),
        F.explode(_covered_buckets("char_start", "char_end", width)).alias("bucket"),
    )
    right = elements.filter(F.col("page_number").isNotNull()).select(
        "doc_id",
        F.col("char_start").alias("e_start"),
        F.col("char_end").alias("e_end"),
        "page_number",
        F.explode(_covered_buckets("char_start", "char_end", width)).alias("bucket"),
    )
    overlap = (F.col("e_end") > F.col("chunk.char_start")) & (F.col("e_start") < F.col("chunk.char_end"))
    return (
        left.join(right, ["doc_id", "bucket"], "left")
        .groupBy("doc_id", "chunk_index")
        .agg(
            F.any_value("chunk").alias("chunk"),
            F.min(F.when(overlap, F.col("page_number"))).alias("page_start"),
            F.max(F.when(overlap, F.col("page_number"))).alias("page_end"),
        )
        .select("chunk.*", "page_start", "page_end")
    )


def chunk_sections(chunks: DataFrame, elements: DataFrame) -> DataFrame:
    """Add the innermost heading open where a chunk starts; the earlier section wins.

    A backward as-of join: both sides are merged in text order and the last
    seen heading is carried forward, which is linear in their sizes.
    """
    headed = elements.filter(F.size("heading_stack") > 0).select(
        "doc_id",
        F.col("char_start").cast("long").alias("at"),
        F.element_at("heading_stack", -1).alias("heading"),
    )
    asked = chunks.select(
        "doc_id", F.col("char_start").cast("long").alias("at"), F.struct(*chunks.columns).alias("chunk")
    )
    order = [F.col("at"), F.col("chunk").isNotNull()]
    upto = Window.partitionBy("doc_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        headed.unionByName(asked, allowMissingColumns=True)
        .withColumn("section_heading", F.last("heading", ignorenulls=True).over(upto))
        .filter(F.col("chunk").isNotNull())
        .select("chunk.*", "section_heading")
    )


def add_provenance(chunks: DataFrame, elements: DataFrame) -> DataFrame:
    """Chunks with page_start, page_end and section_heading. Leave long texts
    out of ``chunks`` here and join them by key afterwards."""
    return chunk_pages(chunk_sections(chunks, elements), elements)
