"""File bytes to text elements.

Formats are containers that only Python libraries or host tools open, so each
file is parsed in an Arrow stage; errors stay in the row. OCR and layout models
are passed in as callables. ``elements`` holds the texts alone, ``typed`` what
is known of each block besides: category, page and depth.
"""

from __future__ import annotations

import io
import posixpath
import shutil
import subprocess
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# OCR modes, text yield, and tool time limits in seconds.
OCR_MODES = ("auto", "on", "off")
MIN_TEXT_PER_MB = 1000
PDF_SECONDS = 300
DOC_SECONDS = 60

WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

TYPED = "array<struct<text:string,category:string,page_number:int,category_depth:int>>"
SCHEMA = f"path string, name string, file_sha1 string, elements array<string>, typed {TYPED}, status string, error string"

# A block with what is known of it: text, category, page, depth below the top heading.
Block = tuple[str, str | None, int | None, int | None]
# Categories of headings and of running text.
TITLE, BODY = "Title", "NarrativeText"


def plain_blocks(text: str) -> list[Block]:
    """Blocks between blank lines; hash marks say which are headings."""
    return [(block, None, None, None) for block in text.split("\n\n") if block.strip()]


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[str] = []
        self.depths: list[int | None] = []  # of each node: depth of the heading it stands in
        self.hidden = 0
        self.depth: int | None = None

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            self.depth = int(tag[1]) - 1

    def handle_endtag(self, tag):
        if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            self.depth = None
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.nodes.append(data.strip())
            self.depths.append(self.depth)


def html_blocks(html: str) -> list[Block]:
    """Text nodes of an HTML page, those inside heading tags as titles."""
    parser = _Text()
    parser.feed(html)
    parser.close()
    return [(node, BODY if depth is None else TITLE, None, depth) for node, depth in zip(parser.nodes, parser.depths)]


def html_nodes(html: str) -> list[str]:
    """Stripped text nodes of an HTML page."""
    parser = _Text()
    parser.feed(html)
    parser.close()
    return parser.nodes


def _epub_parts(book: zipfile.ZipFile) -> list[str]:
    """Content documents in the order of the package's items; of a book without
    a package in archive order."""
    held = set(book.namelist())
    try:
        container = ElementTree.fromstring(book.read("META-INF/container.xml"))
        package = next(e.get("full-path") for e in container.iter() if e.tag.endswith("}rootfile"))
        items = [e for e in ElementTree.fromstring(book.read(package)).iter() if e.tag.endswith("}item")]
    except (KeyError, StopIteration, ElementTree.ParseError):
        return [name for name in book.namelist() if name.lower().endswith((".xhtml", ".html", ".htm"))]
    folder = posixpath.dirname(package)
    pages = [i.get("href") or "" for i in items if i.get("media-type") in ("application/xhtml+xml", "text/html")]
    return [name for href in pages if (name := posixpath.normpath(posixpath.join(folder, unquote(href)))) in held]


def epub_pages(content: bytes) -> list[list[Block]]:
    """Blocks of each non-empty content document, in the book's order."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        pages = [html_blocks(book.read(name).decode("utf-8", "ignore")) for name in _epub_parts(book)]
    if not any(pages):
        raise ValueError("no text in EPUB")
    return [page for page in pages if page]


def docx_blocks(content: bytes) -> list[Block]:
    """Paragraphs with text; heading styles make titles."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml"))
    blocks: list[Block] = []
    for paragraph in body.iter(f"{WORD}p"):
        text = "".join(t.text or "" for t in paragraph.iter(f"{WORD}t")).strip()
        if not text:
            continue
        style = paragraph.find(f"{WORD}pPr/{WORD}pStyle")
        name = style.get(f"{WORD}val", "") if style is not None else ""
        level = name.removeprefix("Heading").strip()
        title = name.startswith("Heading") and level.isdigit()
        blocks.append((text, TITLE if title else BODY, None, int(level) - 1 if title else None))
    return blocks


def docx_markdown(blocks: list[Block]) -> str:
    """Paragraphs joined by blank lines; titles get hash marks."""
    return "\n\n".join("#" * (depth + 1) + " " + text if category == TITLE else text for text, category, _, depth in blocks)


def _run_tool(command: list[str], content: bytes, seconds: int) -> str | None:
    """Output of a host tool fed through its standard input, None if it fails."""
    if shutil.which(command[0]) is None:
        return None
    try:
        done = subprocess.run(command, input=content, capture_output=True, timeout=seconds)
    except subprocess.TimeoutExpired:
        return None
    return done.stdout.decode("utf-8", "replace") if done.returncode == 0 else None


def pdf_blocks(content: bytes, ocr_mode: str, ocr: Callable[[bytes], list[str | Block]] | None) -> list[Block]:
    """Fast extraction where it yields enough text, else OCR if allowed.

    A form feed ends a page. An OCR engine gives texts, or blocks of its own.
    """
    if ocr_mode != "on":
        text = _run_tool(["pdftotext", "-layout", "-", "-"], content, PDF_SECONDS) or ""
        if text and len(text) / max(len(content) / 1048576, 0.1) >= MIN_TEXT_PER_MB:
            pages = enumerate(text.split("\f"), start=1)
            return [(block.strip(), BODY, page, None) for page, body in pages for block in body.split("\n\n") if block.strip()]
        if ocr_mode == "off":
            raise ValueError("scanned PDF needs OCR")
    if ocr is None:
        raise ValueError("no OCR engine configured")
    return [(found, None, None, None) if isinstance(found, str) else tuple(found) for found in ocr(content)]


def doc_text(content: bytes) -> str:
    for tool in ("antiword", "catdoc"):
        text = _run_tool([tool, "-"], content, DOC_SECONDS)
        if text is not None:
            return text
    raise ValueError("no reader for .doc files on this host")


def parse_files(files: DataFrame, ocr_mode: str = "auto", ocr: Callable[[bytes], list[str | Block]] | None = None) -> DataFrame:
    """Elements per file with status and error; a bad file never fails the job."""
    if ocr_mode.lower() not in OCR_MODES:
        raise ValueError(f"ocr_mode must be one of {OCR_MODES}")
    mode = ocr_mode.lower()

    def parsed(suffix: str, content: bytes) -> tuple[list[str], list[Block]]:
        if suffix == ".pdf":
            blocks = pdf_blocks(content, mode, ocr)
            return [block[0] for block in blocks], blocks
        if suffix == ".epub":
            pages = epub_pages(content)
            return ["\n\n".join(block[0] for block in page) for page in pages], [block for page in pages for block in page]
        if suffix == ".docx":
            blocks = docx_blocks(content)
            return [docx_markdown(blocks)], blocks
        if suffix in (".doc", ".md"):
            text = doc_text(content) if suffix == ".doc" else content.decode("utf-8")
            return [text], plain_blocks(text)
        raise ValueError(f"unsupported file type {suffix or '(none)'}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("text", "category", "page_number", "category_depth")
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                try:
                    found, blocks = parsed(row.suffix, bytes(row.content))
                    typed, status, error = [dict(zip(names, block)) for block in blocks], "success", None
                except Exception as problem:
                    found, typed, status, error = None, None, "failed", f"{type(problem).__name__}: {problem}"
                rows.append((row.path, row.name, row.file_sha1, found, typed, status, error))
            yield pd.DataFrame(rows, columns=["path", "name", "file_sha1", "elements", "typed", "status", "error"])

    hashed = files.selectExpr("path", "name", "suffix", "sha1(content) AS file_sha1", "content")
    return hashed.mapInPandas(run, SCHEMA)


def typed_elements(documents: DataFrame) -> DataFrame:
    """documents(doc_id, typed) to element rows as ``format_documents`` takes them."""
    return documents.select("doc_id", F.posexplode("typed").alias("pos", "e")).select("doc_id", "pos", "e.*")
