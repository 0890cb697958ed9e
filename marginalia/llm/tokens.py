"""Token ids of whole documents in word-aligned Simple-8b files.

A 64-bit word has a four-bit selector and sixty bits of data. The selector says
how many ids of which width the word holds. Ids are coded in blocks of
BLOCK_IDS; a segment keeps the word offset of every block, so any block can be
decoded alone and all blocks of a segment are decoded together with array
operations. Values of more than sixty bits are escapes: selector 0 keeps the
low sixty bits and the high four follow in a list of the segment.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.bytehash import RangeHasher
from marginalia.llm.common import kept, new_folder, of_worker
from marginalia.sources.shared import opened, publish

# Ids per word and bits per id, by selector; 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 20
HEADER = "<8sqqqqq"
MAGIC = b"S8BTOK01"
NO_ID = -(1 << 63)

FILE_SCHEMA = "part long, path string, n_docs long, n_ids long"
READ_SCHEMA = "part long, doc_id long, local_start long, n_tokens long, ids_crc32 long"

# Ids of remembered pieces and bytes of text worked on at once.
IDS_KEPT = 9_000_000
BYTES_AT_ONCE = 4 << 20


def packed(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code unsigned ids: words, first word of each block (and the end), high bits of escapes."""
    n = len(ids)
    blocks = -(-n // BLOCK_IDS)
    # A block keeps room behind it, so that its last word may be padded.
    values = np.zeros((blocks, BLOCK_IDS + 64), np.uint64)
    full = n // BLOCK_IDS
    values[:full, :BLOCK_IDS] = ids[: full * BLOCK_IDS].reshape(full, BLOCK_IDS)
    if full < blocks:
        values[full, : n - full * BLOCK_IDS] = ids[full * BLOCK_IDS :]
    sizes = np.full(blocks, BLOCK_IDS)
    if blocks:
        sizes[-1] = n - (blocks - 1) * BLOCK_IDS
    # The first selector, from many narrow ids to one wide id, whose next ids all fit.
    bits = np.frexp(values.reshape(-1).astype(np.float64))[1].astype(np.uint8)
    widest = {1: bits}  # by n: the most bits that the next n ids need
    for n_ids in sorted(set(COUNTS.tolist()) - {1}):
        half = max(k for k in widest if 2 * k >= n_ids and n_ids - k in widest)
        widest[n_ids] = widest[half].copy()
        np.maximum(widest[half][:-half], widest[n_ids - half][half:], out=widest[n_ids][:-half])
    choice = np.zeros(len(bits), np.int8)
    for selector in range(len(COUNTS) - 1, 0, -1):
        choice[widest[int(COUNTS[selector])] <= WIDTHS[selector]] = selector
    choice = choice.reshape(values.shape)
    # All blocks step from word to word together.
    place, rows, starts = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(rows):
        starts.append((rows, place[rows]))
        place[rows] += COUNTS[choice[rows, place[rows]]]
        rows = rows[place[rows] < sizes[rows]]
    if not starts:
        return np.empty(0, np.uint64), np.zeros(1, np.int64), np.empty(0, np.uint8)
    row = np.concatenate([r for r, _ in starts])
    col = np.concatenate([c for _, c in starts])
    order = np.lexsort((col, row))
    row, col = row[order], col[order]
    kind = choice[row, col]
    words = kind.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(kind):
        use = np.flatnonzero(kind == selector)
        steps = np.arange(COUNTS[selector])
        taken = values[row[use][:, None], col[use][:, None] + steps]
        if selector == 0:
            taken = taken & np.uint64((1 << 60) - 1)
        words[use] |= np.bitwise_or.reduce(taken << (steps * WIDTHS[selector]).astype(np.uint64), axis=1)
    escapes = values[row[kind == 0], col[kind == 0]] >> np.uint64(60)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=blocks))])
    return words, offsets, escapes.astype(np.uint8)


def unpacked(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """Decode all blocks of a segment at once."""
    blocks = len(offsets) - 1
    kind = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[kind]
    before = np.cumsum(counts) - counts
    block = np.repeat(np.arange(blocks), np.diff(offsets))
    room = BLOCK_IDS + 64
    place = before - (before[offsets[:-1]][block] if len(words) else before) + block * room
    out = np.zeros(blocks * room, np.uint64)
    data = words & np.uint64((1 << 60) - 1)
    for selector in np.unique(kind):
        use = np.flatnonzero(kind == selector)
        steps = np.arange(COUNTS[selector])
        mask = np.uint64((1 << int(WIDTHS[selector])) - 1)
        ids = (data[use][:, None] >> (steps * WIDTHS[selector]).astype(np.uint64)) & mask
        if selector == 0:
            ids |= escapes.astype(np.uint64)[:, None] << np.uint64(60)
        out[place[use][:, None] + steps] = ids
    return out.reshape(blocks, room)[:, :BLOCK_IDS].reshape(-1)[:n]


def segment(doc_ids: list[int], lengths: list[int], ids: np.ndarray) -> bytes:
    words, offsets, escapes = packed(ids)
    head = struct.pack(HEADER, MAGIC, len(doc_ids), len(ids), len(offsets) - 1, len(words), len(escapes))
    arrays = (np.array(doc_ids, "<i8"), np.array(lengths, "<i8"), offsets.astype("<i8"), words.astype("<u8"), escapes)
    return head + b"".join(a.tobytes() for a in arrays)


def segments(source) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Segments of an opened file: document ids, their numbers of ids, and the ids."""
    while head := source.read(struct.calcsize(HEADER)):
        magic, docs, n, blocks, words, escapes = struct.unpack(HEADER, head)
        if magic != MAGIC:
            raise ValueError("not a token file")
        parts = []
        for kind, size in (("<i8", docs), ("<i8", docs), ("<i8", blocks + 1), ("<u8", words), ("u1", escapes)):
            raw = source.read(size * np.dtype(kind).itemsize)
            parts.append(np.frombuffer(raw, kind))
        yield parts[0], parts[1], unpacked(parts[3].astype(np.uint64), parts[2], parts[4], n)


def piece_starts(data: np.ndarray) -> np.ndarray:
    """Positions of spaces that follow a visible character.

    The byte-level splitter always starts a new word there, so the ids of the
    pieces, one after another, are the ids of the text. Where the character
    before might be white space (by its bytes), nothing is cut.
    """
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    one = data[at - 1]
    two = data[np.maximum(at - 2, 0)]
    three = data[np.maximum(at - 3, 0)]
    ascii_visible = (one > 32) & (one < 127)
    two_bytes = (one >= 128) & (two >= 0xC3) & (two <= 0xDF)
    three_bytes = (one >= 128) & (two >= 128) & (two < 0xC0) & (three >= 0xE4) & (three <= 0xEF)
    return at[ascii_visible | two_bytes | three_bytes]


def _with_room(held: np.ndarray, n: int) -> np.ndarray:
    """The array, made longer by doubling until ``n`` values fit."""
    while n > len(held):
        held = np.concatenate([held, np.zeros(len(held), held.dtype)])
    return held


class Encoder:
    """A byte-level tokenizer that remembers the ids of recent pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.hashes = RangeHasher()
        self.forget()

    def forget(self) -> None:
        # Marks in ascending order with the number of their piece; ids of all pieces, and where each begins.
        self.marks, self.pieces = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begins, self.known = np.zeros(1 << 16, np.int64), 0

    def learn(self, texts: list[str]) -> None:
        for first in range(0, len(texts), 4096):
            coded = [one.ids for one in self.tokenizer.encode_batch_fast(texts[first : first + 4096], add_special_tokens=False)]
            flat = np.fromiter(chain.from_iterable(coded), np.uint32)
            ends = self.used + np.cumsum([len(ids) for ids in coded])
            self.ids = _with_room(self.ids, self.used + len(flat))
            self.ids[self.used : self.used + len(flat)] = flat
            self.begins = _with_room(self.begins, self.known + len(coded) + 1)
            self.begins[self.known + 1 : self.known + len(coded) + 1] = ends
            self.used, self.known = self.used + len(flat), self.known + len(coded)

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a UTF-8 buffer, and the number of ids of each; ``ends``: where each text ends."""
        if len(data) == 0:
            return np.empty(0, np.uint32), np.zeros(len(ends), np.int64)
        heads = np.concatenate([[0], ends[:-1]])
        starts = np.unique(np.concatenate([piece_starts(data), heads[heads < ends]]))
        stops = np.concatenate([starts[1:], [len(data)]])
        marks, first, which = np.unique(self.hashes(data, starts, stops), return_index=True, return_inverse=True)
        if self.used > IDS_KEPT:
            self.forget()
        at = np.searchsorted(self.marks, marks)
        place = np.full(len(marks), -1)
        old = np.flatnonzero(at < len(self.marks))
        old = old[self.marks[at[old]] == marks[old]]
        place[old] = self.pieces[at[old]]
        new = np.flatnonzero(place < 0)
        if len(new):
            raw = data.tobytes()
            spans = zip(starts[first[new]].tolist(), stops[first[new]].tolist())
            place[new] = self.known + np.arange(len(new))
            self.learn([raw[a:b].decode("utf-8") for a, b in spans])
            self.marks, self.pieces = np.insert(self.marks, at[new], marks[new]), np.insert(self.pieces, at[new], place[new])
        begin, size = self.begins[place][which], (self.begins[place + 1] - self.begins[place])[which]
        total = np.cumsum(size)
        ids = self.ids[np.repeat(begin - (total - size), size) + np.arange(total[-1])]
        upto = np.concatenate([[0], total])[np.searchsorted(starts, ends)]
        return ids, np.diff(upto, prepend=0)


def _write(folder: str, tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = of_worker(f"encoder:{tokenizer_path}", lambda: Encoder(tokenizer_path))
        part = TaskContext.get().partitionId()
        path, total = f"{folder}/part-{part:07d}.s8b", [0, 0]

        def coded() -> Iterator[bytes]:
            docs, lengths, data_ids, held = [], [], [], 0

            def flush() -> bytes:
                return segment(docs, lengths, np.concatenate(data_ids))

            for batch in batches:
                texts = batch.column(1).cast(pa.large_string()).fill_null("")
                names = batch.column(0).to_pylist()
                at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
                buffer = texts.buffers()[2]
                data = np.frombuffer(buffer, np.uint8) if buffer else np.empty(0, np.uint8)
                a = 0
                while a < len(names):
                    b = max(a + 1, int(np.searchsorted(at, at[a] + BYTES_AT_ONCE, side="right")) - 1)
                    b = min(b, len(names))
                    ids, sizes = encoder.encode(data[at[a] : at[b]], at[a + 1 : b + 1] - at[a])
                    upto = np.cumsum(sizes)
                    ids = np.insert(ids, upto, end_id)
                    data_ids.append(ids)
                    docs += [NO_ID if doc is None else doc for doc in names[a:b]]
                    lengths += (sizes + 1).tolist()
                    total[0] += b - a
                    total[1] += len(ids)
                    held += len(ids)
                    if held >= SEGMENT_IDS:
                        yield flush()
                        docs, lengths, data_ids, held = [], [], [], 0
                    a = b
            if docs:
                yield flush()

        publish(path, coded())
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([path]), pa.array([total[0]]), pa.array([total[1]])], names=["part", "path", "n_docs", "n_ids"])

    return run


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write the ids of every text, ``end_id`` behind each, in ascending order of doc_id.

    ``docs``: doc_id, text; other columns are ignored. A NULL text is empty, a
    NULL doc_id comes first, rows that repeat a doc_id follow each other in the
    order of a hash of their text. Returns one row per file: part (their
    order), path, n_docs, n_ids. A task writes the one range of ids that it
    got, so a retry writes the same file again.
    """
    folder = folder or new_folder(docs.sparkSession, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return kept(ordered.mapInArrow(_write(folder, tokenizer_path, end_id), FILE_SCHEMA), "token-files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, path in zip(batch.column("part").to_pylist(), batch.column("path").to_pylist()):
            store, inner = opened(path)
            start = 0
            with store.open_input_stream(inner, compression=None) as source:
                for docs, lengths, ids in segments(source):
                    raw = memoryview(ids.astype("<u4").tobytes())
                    ends = np.cumsum(lengths)
                    begins = ends - lengths
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(docs), part, np.int64)),
                            pa.array(docs.astype(np.int64), mask=docs == NO_ID),
                            pa.array(begins + start),
                            pa.array(lengths.astype(np.int64)),
                            pa.array(crc, pa.int64()),
                        ],
                        names=["part", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                    )
                    start += int(lengths.sum())


def read_ids(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    One file is one task; the sizes of the files before it, one row per file,
    shift its own counts.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = files.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("_shift"))
    count = max(1, files.count())
    read = files.select("part", "path").repartition(count, "part").mapInArrow(_read, READ_SCHEMA)
    return read.join(F.broadcast(shifts), "part").select(
        "doc_id", (F.col("local_start") + F.col("_shift")).alias("start"), "n_tokens", "ids_crc32"
    )
