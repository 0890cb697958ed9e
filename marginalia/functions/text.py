"""Text functions as JVM column expressions (no Python workers involved)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token pattern (Unicode word characters) and tokenizer identity.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
TOKENIZER_ID = "whitespace_lowercase_v1"

# What a Unicode-aware strip removes, newline kept apart because
# line functions treat it as the separator. The same class text is valid in
# Java and RE2 patterns.
SPACE_NO_NEWLINE = (
    r"\t\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
SPACE = r"\n" + SPACE_NO_NEWLINE
# The same characters themselves, for functions that trim.
BLANKS = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# Fixed value: the kebab-case rule for collection names. ``\n?`` is there
# because the rule's end anchor also accepts one trailing newline.
COLLECTION_NAME = r"^[a-z0-9]+(-[a-z0-9]+)*\n?$"


def tokenize(text: Column) -> Column:
    """Lower-cased word tokens; empty text gives an empty array."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def fixed(value: Column, digits: int) -> Column:
    """Decimal text rounded from the exact binary value, without grouping.

    ``format_string`` rounds the shortest decimal form instead, which turns
    ties the other way."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit("\n" + BLANKS))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def unify_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def _strip_line_ends(text: Column) -> Column:
    # (?d) limits line ends to the newline; other separators end no line here.
    return F.regexp_replace(text, rf"(?md)[{SPACE_NO_NEWLINE}]+$", "")


def normalize_markdown(text: Column) -> Column:
    """Unix newlines, no trailing blanks per line, one final newline if not empty."""
    body = F.regexp_replace(_strip_line_ends(unify_newlines(text)), r"\n+\z", "")
    return F.when(body == "", F.lit("")).otherwise(F.concat(body, F.lit("\n")))


def normalize_block(text: Column) -> Column:
    """The per-element form of :func:`normalize_markdown`, without final newline."""
    lines = F.regexp_replace(_strip_line_ends(unify_newlines(text)), r"\n+\z", "")
    # A single line only loses what it ends with.
    return F.when(text.contains("\n") | text.contains("\r"), lines).otherwise(F.rtrim(text, F.lit(BLANKS)))


def file_stem(name: Column) -> Column:
    """Last path component without its last extension; dot-files keep their name."""
    base = F.regexp_extract(F.regexp_replace(name, r"/+\z", ""), r"([^/]*)\z", 1)
    stem = F.regexp_extract(base, r"(?s)\A(.+)\.[^.]+\z", 1)
    return F.when(stem != "", stem).otherwise(base)


def file_suffix(name: Column) -> Column:
    """Lower-cased extension with its dot, or the empty string."""
    base = F.regexp_extract(F.regexp_replace(name, r"/+\z", ""), r"([^/]*)\z", 1)
    return F.lower(F.regexp_extract(base, r"(?s)\A.+(\.[^.]+)\z", 1))


def slug_of(words: Column) -> Column:
    """Kebab-case slug of text that has no extension to drop."""
    dashed = F.regexp_replace(F.lower(words), "[ _]", "-")
    ascii_only = F.regexp_replace(dashed, "[^a-z0-9-]", "")
    return F.regexp_replace(F.regexp_replace(ascii_only, "-+", "-"), "^-|-$", "")


def slugify(name: Column) -> Column:
    """Kebab-case slug of a file name."""
    return slug_of(file_stem(name))


def is_collection_name(name: Column) -> Column:
    return F.coalesce(name.rlike(COLLECTION_NAME), F.lit(False))


def valid_collections(names: Column) -> Column:
    return F.filter(names, is_collection_name)


def split_collections(argument: Column) -> Column:
    """Comma-separated collection argument to an array without blanks."""
    return F.filter(F.transform(F.split(argument, ","), strip), lambda c: c != "")


def front_matter(entries: dict[str, Column]) -> Column:
    """Render ``---`` front matter; keys come out in sorted order."""
    lines = [F.concat(F.lit(f"{key}: "), entries[key].cast("string")) for key in sorted(entries)]
    return F.concat(F.concat_ws("\n", F.lit("---"), *lines, F.lit("---")), F.lit("\n\n"))


FRONT_MATTER_BLOCK = r"(?s)\A---\n(?:.*?\n)?---[ \t]*(?:\n|\z)"


def front_matter_of(text: Column) -> Column:
    """The front-matter block between its fences, or the empty string."""
    return F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---[ \t]*(?:\n|\z)", 1)


def strip_front_matter(text: Column) -> Column:
    """Body of a text whose first line opens a front-matter block."""
    return F.regexp_replace(F.regexp_replace(text, FRONT_MATTER_BLOCK, ""), r"\A\n+", "")


def front_matter_value(block: Column, key: str) -> Column:
    """Raw scalar of one key; NULL when the key is absent."""
    line = F.regexp_extract(block, rf"(?md)^{key}: (.*)$", 1)
    return F.when(block.rlike(rf"(?md)^{key}: "), line)


def is_fallback(text: Column) -> Column:
    """Whether the front matter marks the document as a fallback extraction."""
    return F.coalesce(front_matter_of(text).rlike(r"(?mid)^fallback:\s*true\s*$"), F.lit(False))


def join_blocks(blocks: Column) -> Column:
    """Join element texts with blank lines, leaving out missing and empty ones."""
    return F.array_join(F.filter(blocks, lambda b: F.coalesce(b, F.lit("")) != ""), "\n\n")


def fast_blocks(text: Column) -> Column:
    """Blank-line separated blocks of extracted text, stripped, empties dropped."""
    return F.filter(F.transform(F.split(text, "\n\n"), strip), lambda b: b != "")


def text_yield_ok(length: Column, size_mb: Column, minimum: float = 1000.0) -> Column:
    """Whether extraction gave enough characters per megabyte (floor 0.1 MB)."""
    return length / F.greatest(size_mb, F.lit(0.1)) >= minimum


def display_name(name: Column) -> Column:
    """Agent name to display form; well-known acronyms stay upper-case."""
    # Acronyms that are shown in capitals.
    acronyms = ["ceo", "ip", "qa", "hr", "cfo", "cto", "vp", "ma"]

    def word(part: Column) -> Column:
        capital = F.concat(F.upper(F.substring(part, 1, 1)), F.lower(F.substring(part, 2, 1 << 30)))
        return F.when(F.lower(part).isin(acronyms), F.upper(part)).otherwise(capital)

    return F.array_join(F.transform(F.split(name, "-"), word), " ")
