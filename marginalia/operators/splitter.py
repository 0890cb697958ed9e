"""Recursive text splitting with overlap, as an Arrow stage per document.

The rule is sequential within a document (each chunk depends on where the last
one ended), so it runs in Python; documents are independent, so the stage is
narrow. Work is done on positions instead of string pieces: a chunk is always
a contiguous stretch of its text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class ChunkConfig:
    # Default size, overlap and separators.
    size: int = 1200
    overlap: int = 150
    separators: tuple[str, ...] = ("\n\n", "\n", " ")

    def __post_init__(self) -> None:
        if self.size <= 0:
            raise ValueError("size must be positive")
        if not 0 <= self.overlap < self.size:
            raise ValueError("overlap must lie between 0 and size - 1")
        if not self.separators or not all(isinstance(s, str) for s in self.separators):
            raise ValueError("separators must be one or more strings")


def _trimmed(text: str, start: int, end: int) -> tuple[int, int] | None:
    piece = text[start:end]
    kept = piece.strip()
    if not kept:
        return None
    lead = len(piece) - len(piece.lstrip())
    return start + lead, start + lead + len(kept)


def _pack(text: str, cuts: list[int], config: ChunkConfig) -> Iterator[tuple[int, int]]:
    """Greedy packing of the pieces between ``cuts``, all shorter than a chunk."""
    first, last = 0, len(cuts) - 1
    while first < last:
        stop = bisect_right(cuts, cuts[first] + config.size) - 1
        span = _trimmed(text, cuts[first], cuts[stop])
        if span:
            yield span
        if stop == last:
            return
        # Keep the longest tail that fits the overlap and leaves room for the
        # next piece.
        tail = max(
            bisect_left(cuts, cuts[stop] - config.overlap),
            bisect_left(cuts, cuts[stop + 1] - config.size),
        )
        first = min(tail, stop)


def _split(text: str, start: int, end: int, config: ChunkConfig, depth: int) -> Iterator[tuple[int, int]]:
    level = depth
    while level < len(config.separators) - 1 and text.find(config.separators[level], start, end) < 0:
        level += 1
    found = re.compile(re.escape(config.separators[level])).finditer(text, start, end)
    cuts = sorted({start, end, *(m.start() for m in found)})
    deeper = level + 1 < len(config.separators) and len(cuts) > 1 and (
        text.find(config.separators[level], start, end) >= 0
    )
    run = [cuts[0]]
    for low, high in zip(cuts, cuts[1:]):
        if high - low < config.size:
            run.append(high)
            continue
        yield from _pack(text, run, config)
        if deeper:
            yield from _split(text, low, high, config, level + 1)
        else:
            yield low, high
        run = [high]
    yield from _pack(text, run, config)


def chunk_spans(text: str, config: ChunkConfig) -> list[tuple[int, int]]:
    """Spans of all chunks; a text without any becomes one whole chunk."""
    spans = list(_split(text, 0, len(text), config, 0)) if text else []
    return spans or [(0, len(text))]


def located(text: str, spans: list[tuple[int, int]], overlap: int) -> list[tuple[int, int]]:
    """Positions as a forward search reports them: first occurrence of the
    chunk's text at or after a cursor that trails the last chunk by the overlap.

    Two chunks can start at the same place when only white space was dropped
    between them; the search then has nothing left to find, and the true
    position is reported instead of failing the document."""
    out = []
    cursor = 0
    for start, end in spans:
        if start == end:
            out.append((cursor, cursor))
            continue
        at = text.find(text[start:end], cursor)
        if at < 0:
            at = start
        stop = at + end - start
        out.append((at, stop))
        cursor = max(at + 1, stop - overlap)
    return out


# Characters of source text after which a task hands its chunks on.
CHARS_AT_ONCE = 4_000_000


def split_documents(docs: DataFrame, config: ChunkConfig = ChunkConfig(), text: str = "text") -> DataFrame:
    """One row per chunk: the other columns of ``docs``, chunk_index (1-based),
    text, char_start, char_end."""
    kept = [c for c in docs.columns if c != text]
    source = docs.select(*kept, text)
    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + [
            T.StructField("chunk_index", T.IntegerType()),
            T.StructField("text", T.StringType()),
            T.StructField("char_start", T.IntegerType()),
            T.StructField("char_end", T.IntegerType()),
        ]
    )

    def packed(batch: pa.RecordBatch, rows: list[int], chunks: list[tuple[int, str, int, int]]) -> pa.RecordBatch:
        take = pa.array(rows, pa.int32())
        columns = [batch.column(i).take(take) for i in range(len(kept))]
        kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32())
        columns += [pa.array([c[i] for c in chunks], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=[*kept, "chunk_index", "text", "char_start", "char_end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, chunks, held = [], [], 0
            for row, value in enumerate(batch.column(batch.num_columns - 1)):
                body = value.as_py() or ""
                places = located(body, chunk_spans(body, config), config.overlap)
                rows += [row] * len(places)
                chunks += [(n, body[s:e], s, e) for n, (s, e) in enumerate(places, start=1)]
                held += len(body)
                if held >= CHARS_AT_ONCE:
                    yield packed(batch, rows, chunks)
                    rows, chunks, held = [], [], 0
            if rows:
                yield packed(batch, rows, chunks)

    return source.mapInArrow(run, schema)
