"""Exact Jaccard join of documents on sets of word n-grams, and its connected groups.

Documents times n-grams is a sparse 0/1 matrix, and the join is its product
with itself, cut down by bounds that follow from the set sizes. Only the columns
of each document's prefix are multiplied: two sets that are alike enough share
an n-gram among the first ones of both in any common order, and rare columns
come first. Overlap counts of the columns choose one partner per document; the
groups these pairs form need no further products inside. Members of different
groups then meet in each column, and what is left between groups is multiplied
in full, block by block. Its overlap counts add up over the columns; a pair is
discarded if its count and what can still follow its last common column stay
below the overlap that both sizes require, or if the parity bits of both sets
exclude it. What is left is counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.bytehash import RangeHasher, mixed
from marginalia.llm.common import free_name, kept, small_side
from marginalia.operators.topk import lookup_per_key

# Texts worked on at once, at most, by bytes and by rows.
BYTES_AT_ONCE, ROWS_AT_ONCE = (1 << 19) - 2, 1000
# Columns counted as frequent: how many at most, and from how many documents on.
FREQUENT, FREQUENT_ROWS, FREQUENT_IN_TASK = 1 << 20, 4, 3
COUNTED_AT_ONCE = 2 << 20
# Rows up to which the rows of a column are paired by a join; the pairs then are
# at most half as many times the rows. Longer columns are paired inside tasks,
# BLOCK_ROWS rows against the others.
PAIRED_ROWS, BLOCK_ROWS = 64, 2048
# Rounds in which the groups left in a column meet its largest group.
MEETINGS = 2
# Rows of one column that meet one centre; a longer column is cut into that many more chunks.
CHUNK_ROWS = 4096

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SET_SCHEMA = "doc_id long, text_hash long, n long, sig long, parity binary, shingle long, rows long"
POSTING_SCHEMA = "shingle long, chunk int, chunks int, n long, sig long, place int"
PAIR_SCHEMA = "a long, b long, n_a long, n_b long, place_a int, place_b int"


def required(n: int, m: int, percent: int) -> int:
    """Least intersection of sets of n and m elements whose Jaccard index reaches percent / 100."""
    return -(-percent * (n + m) // (100 + percent))


class Shingler:
    """Distinct word n-grams of many texts, as sorted 64-bit hashes."""

    def __init__(self, size: int):
        self.size = size
        self.hashes = RangeHasher()
        self.factors = [np.uint64(pow(0xD1342543DE82EF95, k + 1, 1 << 64)) for k in range(size)]

    def __call__(self, data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """One set per text of the UTF-8 buffer ``data``; ``ends``: where each text ends."""
        space = SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[ends] = True
        edge[0] = True
        before = np.concatenate([[True], space])  # white space, or nothing, before each position
        after = np.concatenate([space, [True]])
        first = np.flatnonzero(~space & (before[:-1] | edge[:-1]))
        last = np.flatnonzero(~space & (after[1:] | edge[1:])) + 1
        words = self.hashes(LOWER[data], first, last)
        upto = np.searchsorted(first, ends)
        grams = np.zeros(max(0, len(words) - self.size + 1), np.uint64)
        for k, factor in enumerate(self.factors):
            grams += words[k : k + len(grams)] * factor
        grams = mixed(grams)
        a = 0
        for b in upto.tolist():
            if b - a >= self.size:
                yield np.unique(grams[a : b - self.size + 1])
            elif b > a:
                whole = sum(int(w) * int(f) for w, f in zip(words[a:b], self.factors)) + (b - a)
                yield mixed(np.array([whole % (1 << 64)], np.uint64))
            else:
                yield np.empty(0, np.uint64)
            a = b

    def of_column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """One set per row; NULL has the empty set."""
        for first in range(0, len(texts), ROWS_AT_ONCE):
            yield from self._of_rows(texts.slice(first, ROWS_AT_ONCE))

    def _of_rows(self, texts: pa.Array) -> Iterator[np.ndarray]:
        texts = texts.cast(pa.large_string()).fill_null("")
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer else np.empty(0, np.uint8)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(at, at[a] + BYTES_AT_ONCE, side="right")) - 1)
            b = min(b, len(texts))
            yield from self(data[at[a] : at[b]], at[a + 1 : b + 1] - at[a])
            a = b


def signature(grams: np.ndarray) -> int:
    """64 bits that stand for a set; with its size, the name of a node."""
    return int(mixed(np.array([np.add.reduce(mixed(grams ^ np.uint64(0xA0761D6478BD642F)))], np.uint64)).view(np.int64)[0])


def parity(grams: np.ndarray) -> bytes:
    """One bit per cell of a hash table: whether it holds an odd number of elements.

    Cells that differ between two sets hold an element that only one of them has.
    """
    size = max(64, 1 << (2 * len(grams) - 1).bit_length())
    cells = np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(cells.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of elements that only one of two sets has."""
    x, y = (np.frombuffer(v, np.uint8) for v in (a, b))
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, pending, held = Shingler(size), set(), [], 0

        def counted() -> pa.RecordBatch:
            grams = np.concatenate(pending)
            pending.clear()
            grams.sort()
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            rows = np.diff(first, append=len(grams))
            often = rows >= FREQUENT_IN_TASK
            return packed(shingle=pa.array(grams[first[often]].view(np.int64)), rows=pa.array(rows[often].astype(np.int64)))

        def packed(**columns: pa.Array) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            kinds = {"parity": pa.binary()}
            names = [c.split()[0] for c in SET_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, kinds.get(c, pa.int64()))) for c in names], names=names)

        for batch in batches:
            sizes, marks, bits = [], [], []
            for grams in shingler.of_column(batch.column("text")):
                sizes.append(len(grams))
                marks.append(signature(grams) if len(grams) else None)
                bits.append(parity(grams) if len(grams) else None)
                if len(grams) and marks[-1] not in seen:
                    # Copies count once per task.
                    seen.add(marks[-1])
                    pending.append(grams)
                    held += len(grams)
            yield packed(
                doc_id=batch.column("doc_id"), text_hash=batch.column("text_hash"), n=pa.array(sizes, pa.int64()), sig=pa.array(marks, pa.int64()), parity=pa.array(bits, pa.binary())
            )
            if held >= COUNTED_AT_ONCE:
                yield counted()
                seen, pending, held = set(), [], 0
        if pending:
            yield counted()

    return run


def _postings(size: int, percent: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts = frequent.value
        shingler, seen = Shingler(size), set()
        for batch in batches:
            out: list[tuple] = []
            for grams in shingler.of_column(batch.column("text")):
                n = len(grams)
                if n == 0:
                    continue
                mark = signature(grams)
                if mark in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen = set()
                seen.add(mark)
                rows = np.zeros(n, np.int64)
                if len(names):
                    at = np.minimum(np.searchsorted(names, grams), len(names) - 1)
                    rows = np.where(names[at] == grams, counts[at], 0)
                take = n - required_share(n, percent) + 1
                rare = np.flatnonzero(rows == 0)[:take]
                if len(rare) < take:
                    often = np.flatnonzero(rows)
                    often = often[np.lexsort((grams[often], rows[often]))][: take - len(rare)]
                    rare = np.concatenate([rare, often])
                chunks = 1 + rows[rare] // CHUNK_ROWS
                chunk = (mixed(grams[rare] ^ np.uint64(mark % (1 << 64))) % chunks.astype(np.uint64)).astype(np.int32)
                out.append((grams[rare].view(np.int64), chunk, chunks.astype(np.int32), np.full(take, n), np.full(take, mark), np.arange(take, dtype=np.int32)))
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "chunk", "chunks", "n", "sig", "place"])

    return run


def required_share(n: int, percent: int) -> int:
    """Least intersection of a set of n elements with any set that is alike enough."""
    return -(-percent * n // 100)


def _possible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()
            bits = zip(batch.column("parity_a").to_pylist(), batch.column("parity_b").to_pylist())
            keep = [least_difference(x, y) <= i + j - 2 * required(i, j, percent) for i, j, (x, y) in zip(n, m, bits)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _blocks(percent: int):
    """Pairs of a column's rows that parity allows, block by block; only those leave the task.

    Each pair leaves once per column: where both sides pass by each other's
    blocks (``both``), only the side with the higher root reports it.
    """

    def folded(matrix: np.ndarray, width: int) -> np.ndarray:
        while matrix.shape[1] > width:
            half = matrix.shape[1] // 2
            matrix = matrix[:, :half] ^ matrix[:, half:]
        return matrix

    class Block:
        """Left rows by the width of their parity bits; narrower forms are made when first needed."""

        def __init__(self, rows: list[tuple[int, int, int, int, bytes]]):
            self.parts, self.narrow = [], {}
            for width in sorted({len(r[4]) for r in rows}):
                some = [r for r in rows if len(r[4]) == width]
                sig, n, place, root = (np.array([r[i] for r in some], np.int64) for i in range(4))
                self.parts.append((sig, n, place, root, np.frombuffer(b"".join(r[4] for r in some), np.uint8).reshape(len(some), width)))

        def partners(self, n: int, root: int, bits: bytes, both: bool) -> np.ndarray:
            """Rows (sig, n, place) of the block that may be alike."""
            own = np.frombuffer(bits, np.uint8)[None, :]
            out = [np.empty((3, 0), np.int64)]
            for i, (other, m, place, other_root, matrix) in enumerate(self.parts):
                apart_groups = other_root < root if both else other_root != root
                fit = np.flatnonzero(apart_groups & (100 * m >= percent * n) & (100 * n >= percent * m))
                if len(fit) == 0:
                    continue
                width = min(own.shape[1], matrix.shape[1])
                if (i, width) not in self.narrow:
                    self.narrow[i, width] = folded(matrix, width)
                apart = np.bitwise_count(self.narrow[i, width][fit] ^ folded(own, width)).sum(axis=1, dtype=np.int64)
                need = -(-percent * (n + m[fit]) // (100 + percent))
                fit = fit[apart <= n + m[fit] - 2 * need]
                out.append(np.stack([other[fit], m[fit], place[fit]]))
            return np.concatenate(out, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, block = None, [], None
        for batch in batches:
            own, found = [], []
            columns = (batch.column(c).to_pylist() for c in ("shingle", "block", "right", "both", "sig", "n", "place", "root", "parity"))
            for shingle, part, right, both, sig, n, place, root, bits in zip(*columns):
                if (shingle, part) != key:
                    key, rows, block = (shingle, part), [], None
                if not right:
                    rows.append((sig, n, place, root, bits))
                    continue
                if block is None:
                    block = Block(rows)
                found.append(block.partners(n, root, bits, both))
                own.append(np.repeat(np.array([[sig], [n], [place]], np.int64), found[-1].shape[1], axis=1))
            if found:
                x, y = np.concatenate(own, axis=1), np.concatenate(found, axis=1)
                low = x[0] < y[0]
                first, second = np.where(low, x, y), np.where(low, y, x)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(side[i]) for i in (0, 1) for side in (first, second)), *(pa.array(side[2].astype(np.int32)) for side in (first, second))],
                    names=["a", "b", "n_a", "n_b", "place_a", "place_b"],
                )

    return run


def _alike(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            keep = []
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                for x, y in zip(shingler.of_column(part.column("text_a")), shingler.of_column(part.column("text_b"))):
                    shared = len(x) + len(y) - len(np.union1d(x, y))
                    keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): the smallest node that links reach.

    Rounds of smallest neighbour labels with pointer jumping; a star needs two
    whatever its size. Labels are written after each round.
    """
    both = kept(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).select("node", F.least("node", "root").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        new = kept(lower.join(jump, "mid", "left").select("node", "old", F.least("mid", "far").alias("root")), "labels")
        labels = new.select("node", "root")
        if new.filter(F.col("old") != F.col("root")).isEmpty():
            return labels


class NGramJoin:
    """The join over one table of documents; see ``near_duplicates``."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        if size < 1 or not 1 <= percent <= 100:
            raise ValueError("size is at least 1, percent is 1 to 100")
        self.spark, self.size, self.percent = docs.sparkSession, size, percent
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
        written = kept(self.docs.mapInArrow(_sets(size), SET_SCHEMA), "sets")
        self.counted = written.filter(F.col("rows").isNotNull()).select("shingle", "rows")
        self.rows = written.filter(F.col("n").isNotNull()).select("doc_id", "text_hash", "n", "sig", "parity")
        # One node per distinct set, however many copies it has.
        self.nodes = kept(
            self.rows.filter(F.col("n") > 0)
            .groupBy("sig", "n")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("holder"), F.min("doc_id").alias("least"), F.first("parity").alias("parity"), F.count(F.lit(1)).alias("copies")),
            "nodes",
        )

    def frequent(self) -> tuple[np.ndarray, np.ndarray]:
        """The most frequent n-grams of all documents (sorted hashes, numbers of rows)."""
        total = self.counted.groupBy("shingle").agg(F.sum("rows").alias("rows")).filter(F.col("rows") >= FREQUENT_ROWS)
        top = total.orderBy(F.desc("rows"), "shingle").limit(FREQUENT).toArrow()
        names = top.column("shingle").to_numpy().view(np.uint64)
        order = np.argsort(names)
        return names[order], top.column("rows").to_numpy()[order]

    def columns(self) -> DataFrame:
        """Prefix columns with at least two different sets, each row with its column's centre."""
        shared = self.spark.sparkContext.broadcast(self.frequent())
        postings = self.docs.select("text").mapInArrow(_postings(self.size, self.percent, shared), POSTING_SCHEMA)
        column = Window.partitionBy("shingle", "chunk")
        met = postings.withColumns(
            {"centre": F.min(F.struct("n", "sig")).over(column), "_first": F.min("sig").over(column), "_last": F.max("sig").over(column)}
        )
        return kept(met.filter((F.col("_first") != F.col("_last")) | (F.col("chunks") > 1)).drop("_first", "_last", "chunk", "chunks"), "columns")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b) of nodes those that are alike enough."""
        side = lambda s: self.nodes.select(F.col("sig").alias(s), F.col("n").alias(f"n_{s}"), F.col("parity").alias(f"parity_{s}"))
        sized = pairs.join(side("a"), "a").join(side("b"), "b")
        left = kept(sized.mapInArrow(_possible(self.percent), "a long, b long"), "possible")
        wanted = left.select(F.col("a").alias("sig")).union(left.select("b")).distinct()
        holders = kept(
            wanted.join(self.nodes, "sig").select("sig", F.col("holder.doc_id").alias("_id"), F.col("holder.text_hash").alias("_hash")), "holders"
        )
        here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        texts = kept(self.docs.join(small_side(holders), here).select("sig", "text").dropDuplicates(["sig"]), "texts")
        full = left.join(texts.select(F.col("sig").alias("a"), F.col("text").alias("text_a")), "a").join(
            texts.select(F.col("sig").alias("b"), F.col("text").alias("text_b")), "b"
        )
        return kept(full.mapInArrow(_alike(self.size, self.percent), "a long, b long"), "links")

    def links(self) -> DataFrame:
        """Links that connect exactly what all links connect."""
        columns = self.columns()
        fits = F.col("centre.n") * 100 >= F.col("n") * self.percent
        overlaps = (
            columns.filter((F.col("sig") != F.col("centre.sig")) & fits)
            .groupBy("sig", F.col("centre.sig").alias("centre"))
            .agg(F.count(F.lit(1)).alias("overlap"))
        )
        best = overlaps.groupBy("sig").agg(F.max(F.struct("overlap", "centre")).alias("best"))
        first = self.verified(best.select(F.col("sig").alias("a"), F.col("best.centre").alias("b")))
        links = first
        members = kept(columns.select("shingle", "sig", "n", "place").distinct(), "members")
        for turn in range(MEETINGS):
            links = links.unionByName(self.verified(self.meetings(self.between(members, links), turn)))
        rest = self.overlapping(self.between(members, links))
        return links.unionByName(self.verified(rest.filter("possible").select("a", "b")))

    def overlapping(self, between: DataFrame) -> DataFrame:
        """Pairs of different groups: their overlap in the prefix columns, and whether their sizes can be met (``possible``).

        Parity and sizes are the same for a pair in all columns, so a pair that
        they allow is counted in every column both prefixes have. Common
        columns up to the last counted one are all counted; after it follow at
        most as many as the shorter rest has.
        """
        groups = between.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("rows"))
        sizes = kept(groups.groupBy("shingle").agg(F.sum("rows").alias("all"), F.max(F.struct("rows", "root")).alias("largest")), "column-sizes")
        met = self.short_columns(between, sizes).unionByName(self.long_columns(between, sizes))
        counted = met.groupBy("a", "b", "n_a", "n_b").agg(
            F.count(F.lit(1)).alias("overlap"), F.max("place_a").alias("place_a"), F.max("place_b").alias("place_b")
        )
        still = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) - 1
        reached = (F.col("overlap") + still) * (100 + self.percent) >= (F.col("n_a") + F.col("n_b")) * self.percent
        return counted.select("a", "b", "overlap", reached.alias("possible"))

    def short_columns(self, between: DataFrame, sizes: DataFrame) -> DataFrame:
        """All pairs of different groups in columns of few rows."""
        rows = between.join(sizes.filter(F.col("all") <= PAIRED_ROWS).select("shingle"), "shingle", "left_semi")
        other = rows.select("shingle", F.col("sig").alias("b"), F.col("n").alias("m"), F.col("root").alias("root_b"), F.col("place").alias("at"))
        bounds = (F.col("root") < F.col("root_b")) & (F.col("n") * 100 >= F.col("m") * self.percent) & (F.col("m") * 100 >= F.col("n") * self.percent)
        pairs = rows.join(other, (rows["shingle"] == other["shingle"]) & bounds)
        low = F.col("sig") < F.col("b")
        both = lambda x, y, name: [F.when(low, F.col(x)).otherwise(F.col(y)).alias(f"{name}a"), F.when(low, F.col(y)).otherwise(F.col(x)).alias(f"{name}b")]
        return pairs.select(*both("sig", "b", ""), *both("n", "m", "n_"), *both("place", "at", "place_"))

    def long_columns(self, between: DataFrame, sizes: DataFrame) -> DataFrame:
        """Pairs of different groups in the other columns that parity allows.

        A column's largest group is cut into blocks, and the rows of the other
        groups pass by each of them; then those rows are cut into blocks and
        pass by each other. Rows of one group never meet.
        """
        long = sizes.filter(F.col("all") > PAIRED_ROWS)
        rows = between.join(long, "shingle").join(self.nodes.select("sig", "n", "parity"), ["sig", "n"])
        main = F.col("root") == F.col("largest.root")
        main_blocks = F.ceil(F.col("largest.rows") / BLOCK_ROWS).cast("int")
        rest_blocks = F.ceil((F.col("all") - F.col("largest.rows")) / BLOCK_ROWS).cast("int")
        draw = F.xxhash64("sig", "shingle")
        place = lambda block, right: F.struct(
            block.cast("int").alias("block"), F.lit(right).alias("right"), (block >= main_blocks).alias("both")
        )
        left = F.when(main, F.pmod(draw, main_blocks)).otherwise(main_blocks + F.pmod(draw, rest_blocks))
        passing = F.transform(F.sequence(F.lit(0), main_blocks + rest_blocks - 1), lambda i: place(i, True))
        places = F.when(main, F.array(place(left, False))).otherwise(F.concat(F.array(place(left, False)), passing))
        met = rows.select("shingle", "sig", "n", "place", "root", "parity", F.explode(places).alias("at")).select("*", "at.*").drop("at")
        dealt = met.repartition("shingle", "block").sortWithinPartitions("shingle", "block", "right")
        return dealt.mapInArrow(_blocks(self.percent), PAIR_SCHEMA)

    def between(self, members: DataFrame, links: DataFrame) -> DataFrame:
        """Rows of the columns that still hold several groups, with their group's root."""
        roots = components(links).select(F.col("node").alias("sig"), "root")
        rooted = kept(members.join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig")), "rooted")
        several = rooted.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter(F.col("low") != F.col("high"))
        return kept(rooted.join(several.select("shingle"), "shingle", "left_semi"), "between")

    def meetings(self, between: DataFrame, turn: int) -> DataFrame:
        """One pair per smaller group and column: a member of each, drawn anew in each column.

        A text that is alike to some members of a large group, but not to its
        centre, meets many of them this way at linear cost.
        """
        draw = F.xxhash64("sig", "shingle", F.lit(turn))
        groups = between.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct(draw.alias("draw"), "sig", "n")).alias("one"))
        largest = groups.groupBy("shingle").agg(F.max(F.struct("rows", "root", "one")).alias("top"))
        met = groups.join(largest, "shingle").filter(F.col("root") != F.col("top.root"))
        n, m = F.col("one.n"), F.col("top.one.n")
        fits = (n * 100 >= m * self.percent) & (m * 100 >= n * self.percent)
        return met.filter(fits).select(F.col("one.sig").alias("a"), F.col("top.one.sig").alias("b")).distinct()

    def groups(self) -> DataFrame:
        """(sig, n, root, component, copies): each node's group and the smallest doc_id in it."""
        roots = components(self.links()).select(F.col("node").alias("sig"), "root")
        rooted = self.nodes.select("sig", "n", "least", "copies").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
        least = rooted.groupBy("root").agg(F.min("least").alias("component"))
        return kept(rooted.join(least, "root").select("sig", "n", "root", "component", "copies"), "groups")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; others are ignored): doc_id, n_shingles, component_id.

    A text's set are its distinct runs of ``size`` words (A-Z lower-cased,
    ASCII white space between them); a text of fewer words is one run, a text
    without words or NULL has none and links with nothing. Texts link when
    their Jaccard index is percent / 100 or more; equal texts always do.
    component_id is the smallest doc_id that links reach, NULL ids left out.
    Repeated rows are copies like others.
    """
    join = NGramJoin(docs, size, percent)
    # Rows without words need no look-up, and those of a set with very many copies are spread.
    named = join.rows.filter(F.col("n") > 0).select("doc_id", "text_hash", "sig", "n")
    found = lookup_per_key(named, join.groups().select("sig", "n", "component", "copies"), ["sig", "n"], "copies")
    wordless = join.rows.filter(F.col("n") == 0).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")).unionByName(wordless)


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates; rows without words all stay.

    The row with the smallest doc_id stays, one without a doc_id only if no row
    of its group has any. All columns stay as they are.
    """
    join = NGramJoin(docs, size, percent)
    grouped = join.nodes.select("sig", "n", "holder", "copies").join(join.groups().select("sig", "n", "root"), ["sig", "n"])
    holders = grouped.groupBy("root").agg(F.min("holder").alias("stays"))
    stays = kept(grouped.join(holders, "root").select("sig", "n", "stays", "copies"), "stays")
    named = join.rows.filter(F.col("n") > 0).select("doc_id", "text_hash", "sig", "n")
    rows = lookup_per_key(named, stays, ["sig", "n"], "copies")
    own = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_hash") == F.col("stays.text_hash"))
    mark, doc, text = (free_name(docs.columns, c) for c in ("_text_hash", "_id", "_hash"))
    keys = [F.col("doc_id").alias(doc), F.col("text_hash").alias(text)]
    # Few rows leave, so these are looked up; most texts are never shuffled.
    leave = kept(rows.filter(~own).select(*keys).distinct(), "leave")
    again = kept(rows.filter(own).groupBy(*keys).count().filter("count > 1").drop("count"), "repeated")
    marked = docs.withColumn(mark, F.xxhash64("text"))
    here = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(mark) == F.col(text))
    left = marked.join(small_side(leave), here, "left_anti")
    if not again.isEmpty():
        # Rows that repeat both id and text: one of each stays.
        repeated = small_side(again)
        once = left.join(repeated, here, "left_semi").dropDuplicates(["doc_id", mark])
        left = left.join(repeated, here, "left_anti").unionByName(once)
    return left.select(*docs.columns)
