"""Readable text of HTML.

Tags are cut by JVM expressions; character references are decoded by the
standard library's table in one Arrow step over the remaining text nodes.
"""

from __future__ import annotations

import html as html_library

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions.text import strip

# Parts without readable text; each becomes a tag so that it still separates.
HIDDEN = (
    r"(?s)<!--.*?-->",
    r"(?is)<script\b[^>]*>.*?</script\s*>",
    r"(?is)<style\b[^>]*>.*?</style\s*>",
)
# A tag ends at the first ">" outside quotes; one with an open quote at its first ">".
TAG = r"""<[!/?a-zA-Z][^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+>|<[!/?a-zA-Z][^>]*>"""


def _decode(nodes: pd.Series) -> pd.Series:
    return nodes.map(lambda texts: [html_library.unescape(t) for t in texts], na_action="ignore")


def html_blocks(html: Column) -> Column:
    """Text nodes in document order, stripped, blank ones dropped."""
    visible = html
    for pattern in HIDDEN:
        visible = F.regexp_replace(visible, pattern, "<x>")
    decode = F.pandas_udf(_decode, T.ArrayType(T.StringType()))
    decoded = decode(F.filter(F.split(visible, TAG), lambda node: node != ""))
    return F.filter(F.transform(decoded, strip), lambda node: node != "")


def html_text(html: Column) -> Column:
    """Text nodes joined by blank lines."""
    return F.array_join(html_blocks(html), "\n\n")
