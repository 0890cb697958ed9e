"""Best-fit packing of documents into bins under conflicts.

A bin never holds two pieces of one source or of one duplicate cluster. Items
are dealt to cells that one task packs. A cell keeps its bins in the order of
their residual room; each bin carries bitmaps of its sources and clusters. An
item, longest first, goes to the tightest bin that has room and no bit in
common: the search starts at the successor of the item's length and continues
upwards until a compatible bin is found; of equally tight ones the oldest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import ascii_lower, kept

CAPACITY = 4096
CELL_ITEMS = 8192
SEARCH_ROWS = 256

PACKED_SCHEMA = "doc_id long, source string, piece int, first_word long, n_words long, cell long, bin int, slot int, bin_words long"


def bit_of(values: list) -> tuple[np.ndarray, int]:
    """A bit per value that occurs more than once; -1 for values that cannot conflict. NULL never conflicts."""
    _, code, counts = np.unique(np.array([v if v is not None else f"\0{i}" for i, v in enumerate(values)], object).astype(str), return_inverse=True, return_counts=True)
    code = code.reshape(-1)
    often = counts > 1
    number = np.where(often, np.cumsum(often) - 1, -1)
    return number[code], int(often.sum())


class Bins:
    """Open bins in the order of their residual room."""

    def __init__(self, capacity: int, bits: int):
        self.capacity = capacity
        self.words = max(1, -(-bits // 64))
        self.count = 0
        self.room = np.empty(64, np.int64)
        self.name = np.empty(64, np.int64)
        self.mask = np.zeros((64, self.words), np.uint64)
        self.open = 0

    def _move(self, start: int, stop: int, by: int) -> None:
        for a in (self.room, self.name, self.mask):
            a[start + by : stop + by] = a[start:stop].copy()

    def put(self, size: int, bits: list[int]) -> int:
        """Place an item; returns the bin."""
        at = self.tightest(size, bits)
        if at < 0:
            name, room, mask = self.count, self.capacity, np.zeros(self.words, np.uint64)
            self.count += 1
        else:
            name, room, mask = int(self.name[at]), int(self.room[at]), self.mask[at].copy()
            self._move(at + 1, self.open, -1)
            self.open -= 1
        room -= size
        for bit in bits:
            mask[bit >> 6] |= np.uint64(1 << (bit & 63))
        if room > 0:
            if self.open == len(self.room):
                self.room, self.name = (np.concatenate([a, np.empty_like(a)]) for a in (self.room, self.name))
                self.mask = np.concatenate([self.mask, np.zeros_like(self.mask)])
            # Bins of equal room lie in the order of their numbers.
            to, end = (int(np.searchsorted(self.room[: self.open], room, side)) for side in ("left", "right"))
            to += int(np.searchsorted(self.name[to:end], name))
            self._move(to, self.open, 1)
            self.room[to], self.name[to], self.mask[to] = room, name, mask
            self.open += 1
        return name

    def tightest(self, size: int, bits: list[int]) -> int:
        """Position of the compatible bin with least room, or -1."""
        first = int(np.searchsorted(self.room[: self.open], size))
        while first < self.open:
            stop = min(first + SEARCH_ROWS, self.open)
            free = np.ones(stop - first, bool)
            for bit in bits:
                free &= (self.mask[first:stop, bit >> 6] & np.uint64(1 << (bit & 63))) == 0
            hit = int(free.argmax())
            if free[hit]:
                return first + hit
            first = stop
        return -1


def pack(sizes: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int], dict[int, int]]:
    """Bin and slot of each item, and the words of each bin. Longest first, ties in the given order."""
    source_bit, n_sources = bit_of(sources)
    cluster_bit, n_clusters = bit_of(clusters)
    cluster_bit = np.where(cluster_bit >= 0, cluster_bit + n_sources, -1)
    bins = Bins(capacity, n_sources + n_clusters)
    where, slot, filled, used = [0] * len(sizes), [0] * len(sizes), {}, {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        bits = [int(b) for b in (source_bit[i], cluster_bit[i]) if b >= 0]
        where[i] = bins.put(sizes[i], bits)
        slot[i] = used.get(where[i], 0)
        used[where[i]] = slot[i] + 1
        filled[where[i]] = filled.get(where[i], 0) + sizes[i]
    return where, slot, filled


def _pack_cells(capacity: int):
    names = [c.split()[0] for c in PACKED_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]

    def packed(cell: int, rows: list[dict]) -> pa.RecordBatch:
        where, slot, filled = pack([r["n_words"] for r in rows], [r["source"] for r in rows], [r["cluster"] for r in rows], capacity)
        for row, b, s in zip(rows, where, slot):
            row |= {"cell": cell, "bin": b, "slot": s, "bin_words": filled[b]}
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in zip(names, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != cell and rows:
                    yield packed(cell, rows)
                    rows = []
                cell = row["cell"]
                rows.append(row)
        if rows:
            yield packed(cell, rows)

    return run


def cluster_of(text):
    """Stand-in for a duplicate cluster: texts that are equal but for case (A-Z) and white space; NULL for none."""
    plain = F.trim(F.regexp_replace(ascii_lower(text), r"[\x20\x09-\x0D]+", " "))
    return F.md5(F.encode(plain, "UTF-8"))


def word_count(text):
    """Words between ASCII white space; 0 for NULL."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")).cast("long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None) -> DataFrame:
    """Bins of at most ``capacity`` words for all rows of ``docs`` (doc_id, text, source).

    A text longer than a bin is cut: full pieces fill bins of their own, the
    rest is packed like a short text. A text without words is one piece of no
    words, which takes room 1 so that it has a bin. ``cluster`` names a column
    of duplicate clusters; without it equal texts form one. A NULL source or
    cluster conflicts with nothing. Repeated rows are packed each. Result, one
    row per piece: doc_id, source, piece, first_word, n_words (room taken),
    cell, bin (numbered within the cell), slot, bin_words.

    Narrow rows are written first and dealt to cells of CELL_ITEMS by a hash of
    their row number, so that neither a hot source nor a repeated id fills one.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    group = F.col(cluster).cast("string") if cluster else cluster_of(F.col("text"))
    sizes = kept(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("words"), group.alias("cluster")
        ),
        "sizes",
    )
    size = F.greatest("words", F.lit(1).cast("long"))
    full = F.floor((size - 1) / capacity)
    pieces = sizes.withColumn("_row", F.monotonically_increasing_id()).select(
        "doc_id", "source", "cluster", "_row", size.alias("size"), F.posexplode(F.sequence(F.lit(0).cast("long"), full)).alias("piece", "_at")
    )
    items = pieces.select(
        "doc_id",
        "source",
        "cluster",
        "piece",
        (F.col("_at") * capacity).alias("first_word"),
        F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("_at") * capacity).alias("n_words"),
        F.xxhash64("_row", "piece").alias("_draw"),
    )
    items = kept(items, "items")
    cells = max(1, -(-items.count() // CELL_ITEMS))
    dealt = items.withColumn("cell", F.pmod("_draw", F.lit(cells)))
    ordered = dealt.repartition(cells, "cell").sortWithinPartitions("cell", "doc_id", "piece", "_draw").drop("_draw")
    return ordered.mapInArrow(_pack_cells(capacity), PACKED_SCHEMA)
