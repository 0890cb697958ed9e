"""WARC archives with revisit records and a globally ordered capture index.

Writers cut their rows into archives and note each record in a capture run that
is sorted locally by URL key and time. A range shuffle brings the pieces of all
runs for one key range together, and a loser tree merges them, so the index
parts in order are one capture history.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import kept, new_folder, small_side
from marginalia.sources.shared import opened, publish

# Payloads below this are always stored; a revisit record would save nothing.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
CRLF = b"\r\n"

RUN_SCHEMA = (
    "url_key string, captured string, page_id long, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long, archive string, start long, size long, run string, place long"
)
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query, lower case; no scheme, port or fragment."""
    plain = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", ""))
    host = F.regexp_extract(plain, r"^([^/?:]*)", 1)
    rest = F.regexp_replace(plain, r"^[^/?:]*(:[0-9]*)?", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def header_value(text: str | None) -> str:
    """A header line cannot hold line breaks; they are written as %0D and %0A."""
    return (text or "").replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict, payload: bytes) -> bytes:
    """One WARC record, compressed on its own so that it can be read on its own."""
    kind = row["record_type"]
    fields = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{row['page_id']}>",
        f"WARC-Date: {row['captured']}",
        f"WARC-Target-URI: {header_value(row['url'])}",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        fields += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{row['refers_to']}>",
        ]
    body = b"" if kind == "revisit" else payload
    fields += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    head = "\r\n".join(fields).encode("utf-8", "surrogatepass")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head + CRLF + CRLF + body + CRLF + CRLF) + packer.flush()


def parsed(raw: bytes) -> dict:
    """Fields of one record and its payload (None for a revisit)."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(CRLF + CRLF)
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    if rest[len(body) :] != CRLF + CRLF:
        raise ValueError("WARC record of a wrong length")

    def page(name: str) -> int | None:
        text = fields.get(name, "")[len("<urn:page:") : -1]
        return None if text in ("", "None") else int(text)

    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha1(body).hexdigest() != digest:
        raise ValueError("payload does not match its digest")
    return {
        "page_id": page("WARC-Record-ID"),
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "payload": None if revisit else bytes(body),
    }


class LoserTree:
    """Merge sorted iterators: each inner node keeps the loser of its match.

    Taking the winner replays only its path to the root, so every row costs
    log2(k) comparisons. Equal keys come in the order of the iterators.
    """

    def __init__(self, runs: Iterable[Iterator[tuple]]):
        self.runs = list(runs)
        self.heads = [next(run, None) for run in self.runs]
        self.size = max(1, len(self.runs))
        self.losers = [-1] * self.size
        self.winner = self._build(1) if self.runs else -1

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        first, last = (a, b) if self._before(a, b) else (b, a)
        self.losers[node] = last
        return first

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            at = self.winner
            yield self.heads[at]
            self.heads[at] = next(self.runs[at], None)
            node = (at + self.size) // 2
            while node:
                if self._before(self.losers[node], at):
                    at, self.losers[node] = self.losers[node], at
                node //= 2
            self.winner = at


def _write(folder: str):
    columns = [c.split()[0] for c in RUN_SCHEMA.split(", ")]

    def archive(rows: list[dict], blobs: list[bytes]) -> pa.RecordBatch:
        # The name follows from the rows, so that a repeated task writes the same file again.
        mark = hashlib.sha1(b"".join(blobs)).hexdigest()
        name, at = f"{folder}/{mark}.warc.gz", 0
        for row, blob in zip(rows, blobs):
            row |= {"archive": name, "start": at, "size": len(blob), "run": mark}
            at += len(blob)
        publish(name, blobs)
        rows.sort(key=lambda r: (r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0))
        for place, row in enumerate(rows):
            row["place"] = place
        kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "start": pa.int64(), "size": pa.int64(), "payload_bytes": pa.int64(), "place": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in columns], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, blobs, held = [], [], 0
        for batch in batches:
            payloads = batch.column("_payload")
            for i, row in enumerate(batch.select(["page_id", "url", "url_key", "captured", "record_type", "refers_to", "payload_digest"]).to_pylist()):
                payload = payloads[i].as_py()
                blob = record(row, payload)
                rows.append(row | {"payload_bytes": len(payload)})
                blobs.append(blob)
                held += len(blob)
                if held >= ARCHIVE_BYTES:
                    yield archive(rows, blobs)
                    rows, blobs, held = [], [], 0
        if rows:
            yield archive(rows, blobs)

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per row into archives below ``folder``; returns the capture runs.

    ``pages``: page_id, url, html, optional captured (WARC date text; else a
    date that follows from page_id). Other columns are ignored. NULL html is an
    empty payload, a NULL url an empty target. Among rows with equal payloads
    of REVISIT_BYTES or more the largest page_id holds the payload and the
    others refer to it; of rows that repeat that very page_id each holds it.
    Rows with a NULL page_id hold their own payload.
    """
    captured = (
        F.col("captured").cast("string")
        if "captured" in pages.columns
        else F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce(F.col("page_id"), F.lit(0)) % 100_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        url_key(F.col("url")).alias("url_key"),
        F.coalesce(captured, F.lit("1970-01-01T00:00:00Z")).alias("captured"),
        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("_payload"),
    ).withColumn("payload_digest", F.sha1("_payload"))
    # Only payloads held by several rows need a look-up: one narrow row each.
    shared = kept(
        rows.filter(F.octet_length("_payload") >= REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("_holder"), F.count(F.lit(1)).alias("_rows"))
        .filter((F.col("_rows") > 1) & F.col("_holder").isNotNull())
        .drop("_rows"),
        "payloads",
    )
    ready = (
        rows.join(small_side(shared), "payload_digest", "left")
        .withColumn("refers_to", F.when(F.col("page_id") != F.col("_holder"), F.col("_holder")))
        .withColumn("record_type", F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response"))
        .drop("_holder")
    )
    return kept(ready.mapInArrow(_write(folder), RUN_SCHEMA), "captures")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the run pieces of one key range; they arrive one after another, each in order."""
    runs: dict[str, list[pa.RecordBatch]] = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        marks = batch.column("run").to_pylist()
        first = 0
        for i in range(1, len(marks) + 1):
            if i == len(marks) or marks[i] != marks[first]:
                runs.setdefault(marks[first], []).append(batch.slice(first, i - first))
                first = i
    if schema is None:
        return

    def cursor(pieces: list[pa.RecordBatch]) -> Iterator[tuple]:
        for piece in pieces:
            keys, times, pages = (piece.column(c).to_pylist() for c in ("url_key", "captured", "page_id"))
            for i, (key, time, page) in enumerate(zip(keys, times, pages)):
                yield (key, time, page is not None, page or 0), piece, i

    out: dict[str, list] = {name: [] for name in schema.names}
    lists: dict[int, dict[str, list]] = {}
    for _, piece, i in LoserTree(cursor(pieces) for pieces in runs.values()):
        held = lists.get(id(piece))
        if held is None:
            held = lists[id(piece)] = {name: piece.column(name).to_pylist() for name in schema.names}
        for name in schema.names:
            out[name].append(held[name][i])
        if len(out["run"]) == 4096:
            yield pa.RecordBatch.from_pydict(out, schema=schema)
            out = {name: [] for name in schema.names}
    if out["run"]:
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def capture_history(runs: DataFrame) -> DataFrame:
    """All captures in the order of URL key, time and page: partition by partition one sorted index.

    The range bounds include time and page, so a URL with very many captures is
    spread over several ranges. A task holds the narrow rows of one range.
    """
    ranged = runs.repartitionByRange("url_key", "captured", "page_id").sortWithinPartitions("run", "place")
    return ranged.mapInArrow(_merge, runs.schema)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    source, name = None, None
    columns = [c.split()[0] for c in READ_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def packed(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in zip(columns, kinds)], names=columns)

    for batch in batches:
        rows, held = [], 0
        for archive, start, size in zip(*(batch.column(c).to_pylist() for c in ("archive", "start", "size"))):
            if archive != name:
                store, path = opened(archive)
                source, name = store.open_input_file(path), archive
            rows.append(parsed(source.read_at(size, start)))
            held += rows[-1]["payload_bytes"]
            if held > 8 << 20:
                yield packed(rows)
                rows, held = [], 0
        if rows:
            yield packed(rows)


def read_captures(index: DataFrame) -> DataFrame:
    """Read indexed captures back from their archives, each archive from front to end.

    Every archive is cut into stretches of 8 MiB, so that many tasks can read a
    large one. Digests are verified. A revisit has no payload of its own.
    """
    stretch = (F.col("start") / F.lit(8 << 20)).cast("long")
    dealt = index.select("archive", "start", "size", stretch.alias("_stretch")).repartition("archive", "_stretch")
    return dealt.sortWithinPartitions("archive", "start").drop("_stretch").mapInArrow(_read, READ_SCHEMA)


def archive_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write pages into new archives; returns their ordered index and the records read back."""
    runs = write_archives(pages, new_folder(pages.sparkSession, "warc"))
    index = kept(capture_history(runs), "index")
    return index, read_captures(index)
