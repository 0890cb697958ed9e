"""Citation prefixes such as ``[alpha-paper, p.3–5, §Methods]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.text import file_suffix, slugify, strip

# Range dash, section sign, and the shape of a finished slug.
EN_DASH = "–"
SECTION = "§"
SLUG_SHAPE = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"


def source_slug(source: Column) -> Column:
    """A finished slug stays; anything else, or a file name, is slugified."""
    done = (file_suffix(source) == "") & source.rlike(SLUG_SHAPE)
    return F.when(F.coalesce(source, F.lit("")) == "", "").when(done, source).otherwise(slugify(source))


def page_part(start: Column, end: Column) -> Column:
    first = F.concat(F.lit("p."), start.cast("string"))
    single = end.isNull() | (end == start)
    return F.when(start.isNull(), None).when(single, first).otherwise(
        F.concat(first, F.lit(EN_DASH), end.cast("string"))
    )


def section_part(heading: Column) -> Column:
    name = strip(heading)
    return F.when(name != "", F.concat(F.lit(SECTION), name))


def citation_prefix(source: Column, page_start: Column, page_end: Column, section: Column) -> Column:
    slug = source_slug(source)
    parts = F.concat_ws(
        ", ", F.when(slug != "", slug), page_part(page_start, page_end), section_part(section)
    )
    return F.concat(F.lit("["), parts, F.lit("]"))
