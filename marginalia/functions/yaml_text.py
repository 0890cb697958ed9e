"""YAML front matter of chunk files, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.text import valid_collections

# Plain scalars YAML 1.1 would not read back as text.
NOT_TEXT = (
    r"^(?:~|null|Null|NULL|yes|Yes|YES|no|No|NO|true|True|TRUE|false|False|FALSE|on|On|ON|off|Off|OFF|<<|=|"
    r"[-+]?0b[0-1_]+|[-+]?0[0-7_]+|[-+]?(?:0|[1-9][0-9_]*)|[-+]?0x[0-9a-fA-F_]+|[-+]?[1-9][0-9_]*(?::[0-5]?[0-9])+|"
    r"[-+]?[0-9][0-9_]*\.[0-9_]*(?:[eE][-+][0-9]+)?|[-+]?\.[0-9][0-9_]*(?:[eE][-+][0-9]+)?|"
    r"[-+]?[0-9][0-9_]*(?::[0-5]?[0-9])+\.[0-9_]*|[-+]?\.(?:inf|Inf|INF)|\.(?:nan|NaN|NAN)|"
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}|"
    r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[Tt]|[ \t]+)[0-9]{1,2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]*)?"
    r"(?:[ \t]*(?:Z|[-+][0-9]{1,2}(?::?[0-9]{2})?))?)$"
)

# Texts that need quotes although they are text.
NEEDS_QUOTES = r"""^$|^[\s]|[\s]$|^[#,\[\]{}&*!|>'"%@`]|^[-?:](?:\s|$)|^---|^\.\.\.|: |:$| #"""

# Named escapes inside double quotes.
ESCAPES = (
    ('"', '\\"'),
    ("\\", "\\\\"),
    ("\0", "\\0"),
    ("\a", "\\a"),
    ("\b", "\\b"),
    ("\t", "\\t"),
    ("\n", "\\n"),
    ("\v", "\\v"),
    ("\f", "\\f"),
    ("\r", "\\r"),
    ("\x1b", "\\e"),
    ("\x85", "\\N"),
    ("\xa0", "\\_"),
    ("\u2028", "\\L"),
    ("\u2029", "\\P"),
)


def _escaped(char: Column) -> Column:
    out = None
    for raw, code in ESCAPES:
        out = F.when(char == raw, code) if out is None else out.when(char == raw, code)
    point = F.ascii(char)
    hexed = F.hex(point.cast("long"))
    return (
        out.when(point.between(0x20, 0x7E), char)
        .when(point <= 0xFF, F.concat(F.lit("\\x"), F.lpad(hexed, 2, "0")))
        .when(point <= 0xFFFF, F.concat(F.lit("\\u"), F.lpad(hexed, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(hexed, 8, "0")))
    )


# The emitter breaks a line at the first chance beyond this column, and indents what follows.
WIDTH = 80
INDENT = 2


def _column(column: int | Column) -> Column:
    return F.lit(column) if isinstance(column, int) else column


def _folded(value: Column, column: int | Column, indent: int) -> Column:
    """Break at single spaces where the line is past the width already; the reader turns a break into a space."""
    begin = F.struct(F.lit("").alias("out"), _column(column).alias("column"))

    def add(state: Column, piece: Column) -> Column:
        broken = (piece == " ") & (state["column"] > WIDTH)
        out = F.when(broken, F.lit("\n" + " " * indent)).otherwise(piece)
        return F.struct(
            F.concat(state["out"], out).alias("out"), F.when(broken, F.lit(indent)).otherwise(state["column"] + F.length(piece)).alias("column")
        )

    pieces = F.regexp_extract_all(value, F.lit("([^ ]+ +$|[^ ]+| +)"), F.lit(1))
    return F.aggregate(pieces, begin, add, lambda state: state["out"])


def _folded_double(value: Column, column: int | Column, indent: int) -> Column:
    """Inside double quotes a backslash ends a broken line, and another one keeps a space that follows."""
    chars = F.split(value, "")
    # One row per character: itself, as it is written, and what follows (NULL for the last).
    pairs = F.arrays_zip(chars.alias("char"), F.slice(chars, F.lit(2), F.length(value)).alias("next"))
    steps = F.transform(
        pairs, lambda pair, at: F.struct(pair["char"].alias("char"), _escaped(pair["char"]).alias("code"), pair["next"].alias("next"), at.alias("at"))
    )
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("open"), (_column(column) + 1).alias("column"))

    def add(state: Column, step: Column) -> Column:
        char, code = step["char"], step["code"]
        special = code != char
        # Characters since the last escape or break are not counted into the column yet.
        reached = state["column"] + state["open"] + F.when(special, F.length(code)).otherwise(0)
        chance = (step["at"] > 0) & step["next"].isNotNull() & ((char == " ") | special | (state["open"] == 0))
        # After an escape the emitter's width counts one less.
        broken = chance & (reached - F.when(special, 1).otherwise(0) > WIDTH)
        kept = F.when(F.when(special, step["next"]).otherwise(char) == " ", F.lit("\\")).otherwise(F.lit(""))
        line = F.concat(F.lit("\\\n" + " " * indent), kept)
        out = F.when(broken & special, F.concat(code, line)).when(broken, F.concat(line, code)).otherwise(code)
        return F.struct(
            F.concat(state["out"], out).alias("out"),
            F.when(special, 0).when(broken, 1).otherwise(state["open"] + 1).alias("open"),
            F.when(broken, F.lit(indent) + F.length(kept)).when(special, reached).otherwise(state["column"]).alias("column"),
        )

    return F.aggregate(steps, begin, add, lambda state: state["out"])


def yaml_text(value: Column, column: int | Column = 0, indent: int = INDENT) -> Column:
    """A string as a YAML scalar: plain, single or double quoted.

    Long scalars are folded as an emitter of width 80 does that starts at
    ``column``; lines after the first are indented. A text with line breaks is
    double quoted."""
    double = F.concat(F.lit('"'), _folded_double(value, column, indent), F.lit('"'))
    doubled = F.replace(value, F.lit("'"), F.lit("''"))
    single = F.concat(F.lit("'"), _folded(doubled, column + 1, indent), F.lit("'"))
    return (
        F.when(value.isNull(), "null")
        .when(value.rlike(r"[^\x20-\x7E]"), double)
        .when(value.rlike(NOT_TEXT) | value.rlike(NEEDS_QUOTES), single)
        .otherwise(_folded(value, column, indent))
    )


def _line(key: str, value: Column) -> Column:
    return F.concat(F.lit(f"{key}: "), value)


def render_chunk(
    doc_id: Column,
    source: Column,
    chunk_id: Column,
    page_start: Column,
    page_end: Column,
    content_hash: Column,
    created_utc: Column,
    body: Column,
    section_heading: Column | None = None,
    has_embedding: Column | None = None,
    formula_counts: Column | None = None,
    formula_ids: Column | None = None,
) -> Column:
    """Chunk file text. Keys keep their fixed order, optional ones drop out.

    ``formula_counts`` is the struct of total, inline and display counts;
    its lines appear for chunks that have formulas."""
    lines = [
        F.lit("---"),
        _line("doc_id", yaml_text(doc_id)),
        _line("source", yaml_text(source)),
        _line("chunk_id", yaml_text(chunk_id)),
        _line("page_start", F.coalesce(page_start.cast("string"), F.lit("null"))),
        _line("page_end", F.coalesce(page_end.cast("string"), F.lit("null"))),
        _line("hash", yaml_text(content_hash)),
        _line("created_utc", yaml_text(F.date_format(created_utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))),
    ]
    if section_heading is not None:
        lines.append(F.when(section_heading.isNotNull(), _line("section_heading", yaml_text(section_heading))))
    if has_embedding is not None:
        lines.append(F.when(has_embedding, "has_embedding: true"))
    if formula_counts is not None:
        found = formula_counts["total"] > 0
        lines.append(F.when(found, _line("formula_count", formula_counts["total"].cast("string"))))
        lines.append(F.when(found, _line("inline_formula_count", formula_counts["inline"].cast("string"))))
        lines.append(F.when(found, _line("display_formula_count", formula_counts["display"].cast("string"))))
        if formula_ids is not None:
            listed = F.concat(F.lit("["), F.array_join(formula_ids, ", "), F.lit("]"))
            lines.append(F.when(found, _line("formula_ids", listed)))
    lines.append(F.lit("---"))
    ended = F.when((body == "") | body.endswith("\n"), body).otherwise(F.concat(body, F.lit("\n")))
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n\n"), ended)


def _unescaped(piece: Column) -> Column:
    out = None
    for raw, code in ESCAPES:
        out = F.when(piece == code, raw) if out is None else out.when(piece == code, raw)
    digits = F.regexp_extract(piece, r"^\\[xuU]([0-9A-F]+)$", 1)
    point = F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")
    return out.when(digits != "", point).otherwise(piece)


def unquote(value: Column) -> Column:
    """Text of a plain or quoted scalar as written by :func:`yaml_text`, folded or not."""
    whole = F.regexp_replace(F.regexp_replace(value, r"\\\n +\\(?= )", ""), r"\\\n +", "")
    value = F.when(value.startswith('"'), whole).otherwise(F.regexp_replace(value, r"\n +", " "))
    inner = F.regexp_extract(value, r"^(?:'|\")(.*)(?:'|\")$", 1)
    pieces = F.regexp_extract_all(
        inner, F.lit(r"\\U[0-9A-F]{8}|\\u[0-9A-F]{4}|\\x[0-9A-F]{2}|\\.|[^\\]+"), F.lit(0)
    )
    return (
        F.when(value == "null", None)
        .when(value.rlike("^'.*'$"), F.replace(inner, F.lit("''"), F.lit("'")))
        .when(value.startswith('"'), F.array_join(F.transform(pieces, _unescaped), ""))
        .otherwise(value)
    )


def _mapping(name: str, entries: Column) -> Column:
    """Block mapping of a map column, in the map's own order."""
    lines = F.transform(
        F.map_entries(entries), lambda e: F.concat(F.lit("  "), e["key"], F.lit(": "), yaml_text(e["value"], F.length(e["key"]) + 4, 2 * INDENT))
    )
    listed = F.concat(F.lit(f"{name}:\n"), F.array_join(lines, "\n"))
    return F.when(F.size(lines) > 0, listed).otherwise(f"{name}: {{}}")


def render_meta(
    doc_id: Column,
    slug: Column,
    orig_name: Column,
    created_utc: Column,
    tooling: Column,
    params: Column,
    hashes: Column,
    collections: Column | None = None,
    source_agent: Column | None = None,
) -> Column:
    """Metadata file of a document. Invalid collection names are left out, an
    empty list and an empty agent are not written."""
    stamp = F.date_format(created_utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    lines = [
        _line("doc_id", yaml_text(doc_id, 8)),
        _line("slug", yaml_text(slug, 6)),
        _line("orig_name", yaml_text(orig_name, 11)),
        _line("created_utc", yaml_text(stamp, 13)),
    ]
    if collections is not None:
        kept = F.transform(valid_collections(collections), lambda c: F.concat(F.lit("- "), yaml_text(c, 2)))
        lines.append(F.when(F.size(kept) > 0, F.concat(F.lit("collections:\n"), F.array_join(kept, "\n"))))
    if source_agent is not None:
        lines.append(F.when(source_agent != "", _line("source_agent", yaml_text(source_agent, 14))))
    lines += [_mapping("tooling", tooling), _mapping("params", params), _mapping("hashes", hashes)]
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n"))
