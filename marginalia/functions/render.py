"""Text forms of results: context blocks, tool answers, report lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.citations import EN_DASH, SECTION
from marginalia.functions.text import SPACE, fixed, strip

# Separators and limits of the text forms.
CONTEXT_SEPARATOR = "\n\n---\n\n"
PREVIEW_CHARS = 200
QUERY_CHARS = 80
RULE = "─" * 60
MAX_TOP_K = 20
DEFAULT_TOP_K = 5


def clamp_top_k(k: Column) -> Column:
    """Requested result count within 1..20; text that is no number gives 5."""
    return F.least(F.greatest(F.coalesce(k.try_cast("int"), F.lit(DEFAULT_TOP_K)), F.lit(1)), F.lit(MAX_TOP_K))


def context_block(source: Column, citation: Column, body: Column) -> Column:
    return F.concat(F.lit("[Source: "), source, F.lit("]\n"), citation, F.lit("\n"), body)


def preview(body: Column) -> Column:
    head = F.substring(body, 1, PREVIEW_CHARS)
    return F.when(F.length(body) > PREVIEW_CHARS, F.concat(head, F.lit("..."))).otherwise(head)


def text_result(rank: Column, score: Column, chunk_id: Column, source: Column, body: Column) -> Column:
    """Entry of the plain-text listing."""
    header = F.format_string("[%d] Score: %s | ID: %s | Source: %s", rank, fixed(score, 2), chunk_id, source)
    return F.concat_ws("\n", header, F.lit(RULE), preview(body), F.lit(RULE), F.lit(""))


def tool_result(rank: Column, source: Column, citation: Column, body: Column) -> Column:
    """Entry of the tool answer."""
    header = F.format_string("--- Result %d (source: %s) ---", rank, source)
    return F.concat_ws("\n", header, citation, strip(body), F.lit(""))


def context_result(rank, source, score, citation, doc_id, chunk_id, body) -> Column:
    """Entry of the Markdown listing."""
    header = F.concat(
        F.lit("### ["), rank.cast("string"), F.lit("] "), source, F.lit(" (score: "), score.cast("string"), F.lit(")")
    )
    ids = F.concat(F.lit("*doc_id: "), doc_id, F.lit(", chunk: "), chunk_id, F.lit("*"))
    return F.concat_ws("\n", header, citation, ids, F.lit(""), body, F.lit(""), F.lit("---"), F.lit(""))


def json_result(rank: Column, score: Column, chunk_id: Column, source: Column, body: Column) -> Column:
    return F.to_json(
        F.struct(
            rank.alias("rank"),
            score.alias("score"),
            chunk_id.alias("chunk_id"),
            source.alias("source_document"),
            body.alias("content"),
        )
    )


def short_query(query: Column, limit: int = QUERY_CHARS) -> Column:
    """One-line query for a table cell, cut with an ellipsis."""
    line = F.replace(F.replace(strip(query), F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|"))
    cut = F.concat(
        F.regexp_replace(F.substring(line, 1, limit - 1), rf"[{SPACE}]+\z", ""), F.lit("…")
    )
    return F.when(F.length(line) <= limit, line).otherwise(cut)


def delta_arrow(delta: Column) -> Column:
    """Change against a baseline: ``=``, an up arrow, or a down arrow."""
    size = fixed(F.abs(delta), 3)
    return (
        F.when(delta.isNull(), "")
        .when(F.abs(delta) < 1e-6, "=")
        .when(delta > 0, F.concat(F.lit("↑"), size))
        .otherwise(F.concat(F.lit("↓"), size))
    )


def report_citation(page_start: Column, page_end: Column, section: Column) -> Column:
    """Page and section of the first result for the report, ``-`` if unknown."""
    first = F.concat(F.lit("p."), page_start.cast("string"))
    pages = F.when(page_start == page_end, first).when(
        page_start.isNotNull() & page_end.isNotNull(), F.concat(first, F.lit(EN_DASH), page_end.cast("string"))
    )
    named = F.when(
        F.coalesce(section, F.lit("")) != "",
        F.concat(F.lit(SECTION), F.replace(section, F.lit("|"), F.lit("\\|"))),
    )
    joined = F.concat_ws(", ", pages, named)
    return F.when(joined == "", "-").otherwise(joined)


def report_line() -> Column:
    """Row of the per-item table from item results with a ``top3`` column."""
    cells = F.concat_ws(
        " | ",
        F.col("item_id").cast("string"),
        short_query(F.col("query")),
        F.coalesce(F.col("first_hit_rank").cast("string"), F.lit("-")),
        F.coalesce("top3", F.lit("-")),
        report_citation(F.col("top_page_start"), F.col("top_page_end"), F.col("top_section_heading")),
    )
    return F.concat(F.lit("| "), cells, F.lit(" |"))


# Metric labels in report order.
METRIC_LABELS = ("recall@1", "recall@3", "recall@5", "recall@10", "MRR", "nDCG@10", "citation_accuracy")


def metric_line() -> Column:
    """Row of the aggregate table from baseline_diff rows. Values are rounded
    to nine digits first, so that sums in another order print alike."""
    label = F.element_at(F.array(*[F.lit(name) for name in METRIC_LABELS]), (F.col("ordinal") + 1).cast("int"))
    cells = F.concat_ws(" | ", label, fixed(F.round("value", 9), 3), delta_arrow(F.round("delta", 9)))
    return F.concat(F.lit("| "), cells, F.lit(" |"))


def run_id(agent: Column, started: Column) -> Column:
    """Name of an evaluation run."""
    return F.concat(agent, F.lit("-"), F.date_format(started, "yyyyMMdd-HHmmss"))
