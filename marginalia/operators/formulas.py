"""Formula operators over formulas(doc_id, pos, page_num, x1, y1, kind, latex).

Groups are single documents, whose formulas end up in one Markdown value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import formulas as fx


def number_by_page(formulas: DataFrame) -> DataFrame:
    """Reading order within a page: top to bottom, then left to right."""
    page = Window.partitionBy("doc_id", "page_num").orderBy("y1", "x1", "pos")
    return formulas.withColumn("page_index", F.row_number().over(page))


def summarize(formulas: DataFrame) -> DataFrame:
    """Counts and complexity per document."""
    counts = formulas.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("formula_count"),
        F.count_if(F.col("kind") == "inline").alias("inline_count"),
        F.count_if(F.col("kind") == "display").alias("display_count"),
    )
    return counts.withColumn("complexity", fx.complexity(F.col("formula_count")))


def _ordered(entries: Column) -> Column:
    return F.sort_array(F.collect_list(entries))


def page_sections(formulas: DataFrame) -> DataFrame:
    """Markdown to append per document: one section per page with formulas."""
    numbered = number_by_page(formulas)
    entry = F.struct("page_index", fx.page_entry(F.col("page_index"), F.col("latex"), F.col("kind")).alias("t"))
    pages = numbered.groupBy("doc_id", "page_num").agg(_ordered(entry).alias("e"))
    title = F.format_string("\n## Formulas from Page %d\n", (F.col("page_num") + 1).cast("long"))
    section = F.concat_ws("\n", title, F.array_join(F.transform("e", lambda e: e["t"]), "\n"))
    per_doc = pages.groupBy("doc_id").agg(_ordered(F.struct("page_num", section.alias("t"))).alias("p"))
    return per_doc.select("doc_id", F.array_join(F.transform("p", lambda p: p["t"]), "\n").alias("sections"))


def merge_into_markdown(docs: DataFrame, formulas: DataFrame) -> DataFrame:
    """Append the page sections to docs(doc_id, markdown)."""
    joined = docs.join(page_sections(formulas), "doc_id", "left")
    return joined.withColumn(
        "markdown",
        F.when(F.col("sections").isNull(), F.col("markdown")).otherwise(
            F.concat("markdown", F.lit("\n"), "sections")
        ),
    ).drop("sections")


def appendix(docs: DataFrame, formulas: DataFrame) -> DataFrame:
    """Append a ``Mathematical Formulas`` section to docs(doc_id, markdown)."""
    order = Window.partitionBy("doc_id").orderBy("pos")
    numbered = formulas.withColumn("n", F.row_number().over(order))
    entry = F.struct("n", fx.appendix_entry(F.col("n"), F.col("page_num"), F.col("latex"), F.col("kind")).alias("t"))
    texts = numbered.groupBy("doc_id").agg(_ordered(entry).alias("e"))
    joined = docs.join(texts, "doc_id", "left")
    added = F.concat("markdown", F.lit("\n\n## Mathematical Formulas\n\n"), F.array_join(F.transform("e", lambda e: e["t"]), ""))
    return joined.withColumn("markdown", F.coalesce(added, F.col("markdown"))).drop("e")
