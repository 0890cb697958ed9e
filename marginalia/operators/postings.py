"""Postings in blocks, and top-k search over them that reads only query terms.

A block holds the postings of one term within one segment of SEGMENT positions:
positions, counts and chunk lengths, and its peaks, the (count, length) pairs
no other posting of the block beats. Peaks give the block's largest impact for
any mean length, so an index may grow without being rewritten. The pseudo term
"" lists all chunks of a segment.

Blocks lie in SLOTS folders by a hash of their term, sorted by term inside. A
search reads the slots of its terms and of these the row groups that can hold
them. Blocks of one segment meet in one task, which skips segments, and terms
of a segment, that cannot lift a chunk above the running k-th score.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT_BITS = 14
SEGMENT = 1 << SEGMENT_BITS
# Folders by hash of the term; the pseudo term has one of its own.
SLOTS = 16
ALL_CHUNKS_SLOT = -1
# Segments whose blocks are written together: a file holds one slot of a million chunks.
STRETCH_BITS = 6
# Chunks for which the terms of a slot are one task; more chunks deal them out over more tasks.
SLOT_CHUNKS = 1 << 16
# Tokens counted at once in a task.
TOKENS_AT_ONCE = 2_000_000

# Rows per group of a stored file are set by bytes; small groups let a term skip more.
GROUP_BYTES = 16 << 20

PART_SCHEMA = (
    "term string, segment long, n long, total long, positions array<long>, tfs array<int>, dls array<int>, "
    "peak_tfs array<int>, peak_dls array<int>"
)
BLOCK_SCHEMA = PART_SCHEMA + ", slot int"
LOCAL_SCHEMA = "query_id long, bm25_index long, score double"


def slot_of(term: Column) -> Column:
    return F.when(term == "", F.lit(ALL_CHUNKS_SLOT)).otherwise(F.pmod(F.xxhash64(term), F.lit(SLOTS)).cast("int"))


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values, kind))


def _blocks_of(terms: pa.Array, term: np.ndarray, positions: np.ndarray, tf: np.ndarray, dl: np.ndarray) -> pa.RecordBatch:
    """Blocks from postings in order of (term, position)."""
    segment = positions >> SEGMENT_BITS
    first = np.ones(len(term), bool)
    first[1:] = (term[1:] != term[:-1]) | (segment[1:] != segment[:-1])
    starts = np.flatnonzero(first)
    block = np.cumsum(first) - 1
    # Peaks: by falling count, those shorter than all before them in the block.
    order = np.lexsort((dl, -tf, block))
    # Each block lies below all earlier ones, so that the running minimum starts anew.
    level = dl[order] - block[order] * (1 << 32)
    peak = np.ones(len(order), bool)
    peak[1:] = level[1:] < np.minimum.accumulate(level)[:-1]
    best = order[peak]
    peak_starts = np.searchsorted(block[best], np.arange(len(starts)))
    return pa.RecordBatch.from_arrays(
        [
            terms.take(pa.array(term[starts])),
            pa.array(segment[starts]),
            pa.array(np.diff(np.append(starts, len(term)))),
            pa.array(np.add.reduceat(tf, starts).astype(np.int64) if len(starts) else np.empty(0, np.int64)),
            _lists(positions, starts, pa.int64()),
            _lists(tf, starts, pa.int32()),
            _lists(dl, starts, pa.int32()),
            _lists(tf[best], peak_starts, pa.int32()),
            _lists(dl[best], peak_starts, pa.int32()),
        ],
        names=["term", "segment", "n", "total", "positions", "tfs", "dls", "peak_tfs", "peak_dls"],
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token rows to blocks of what the task holds; one row per term and segment."""
    for batch in batches:
        lengths = np.asarray(batch.column("tokens").value_lengths().to_numpy(zero_copy_only=False), np.int64)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(np.cumsum(lengths[at:]), TOKENS_AT_ONCE)) + at)
            index = batch.column("bm25_index")[at:end].to_numpy(zero_copy_only=False)
            order = np.argsort(index, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            index, dl = index[order], lengths[at:end][order]
            yield _blocks_of(pa.array([""]), np.zeros(len(index), np.int64), index, dl, dl)
            coded = batch.column("tokens")[at:end].flatten().dictionary_encode()
            rows = np.repeat(place, lengths[at:end])
            cells = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(index) + rows
            pairs, tf = np.unique(cells, return_counts=True)
            term, row = np.divmod(pairs, len(index))
            if len(pairs):
                yield _blocks_of(coded.dictionary, term, index[row], tf, dl[row])
            at = end


def block_rows(docs: DataFrame) -> DataFrame:
    """Blocks of docs(bm25_index, tokens).

    Tokens are counted inside the tasks; one exchange moves what a task knows of
    a term and segment, and joins it to one block of at most SEGMENT postings.
    Parts of a slot grow in number with the chunks, so a task's share does not.
    """
    per_slot = max(1, -(-docs.select("bm25_index").count() // SLOT_CHUNKS))
    share = F.pmod(F.xxhash64(F.lit(1), "term"), F.lit(per_slot)).cast("int")
    dealt = ["slot", "_stretch", "_share"]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    parts = docs.select("bm25_index", "tokens").mapInArrow(_count, PART_SCHEMA)
    joined = [F.flatten(F.collect_list(c)).alias(c) for c in ("positions", "tfs", "dls", "peak_tfs", "peak_dls")]
    # The aggregate is content with the coarser exchange, which also decides the files.
    return (
        parts.withColumns({"slot": slot_of(F.col("term")), "_stretch": F.shiftright("segment", STRETCH_BITS), "_share": share})
        .repartition(*([] if per_slot == 1 else [max(SLOTS * per_slot, tasks)]), *dealt)
        .groupBy(*dealt, "term", "segment")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), *joined)
        .select(*[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])
    )


def write_blocks(blocks: DataFrame, folder: str) -> None:
    """Write rows of ``block_rows``, or of stored blocks; neither is shuffled again."""
    placed = blocks.select(*[c.split()[0] for c in BLOCK_SCHEMA.split(", ")]).sortWithinPartitions("slot", "term", "segment")
    placed.write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).partitionBy("slot").parquet(folder)


def flat_postings(blocks: DataFrame) -> DataFrame:
    """term, bm25_index, tf, dl, one row per posting."""
    zipped = F.arrays_zip("positions", "tfs", "dls")
    return (
        blocks.filter(F.col("slot") != ALL_CHUNKS_SLOT)
        .select("term", F.inline(zipped))
        .select("term", F.col("positions").alias("bm25_index"), F.col("tfs").alias("tf"), F.col("dls").alias("dl"))
    )


class Scorer:
    """Running best k per query over the segments one task sees."""

    def __init__(self, queries: list[tuple[int, list[tuple[str, float]]]], avgdl: float, k1: float, b: float, k: int, digits: int | None):
        # Terms in one order everywhere, so that equal chunks get equal sums in every segment.
        self.queries = [(q, sorted(terms)) for q, terms in queries]
        self.wanted = defaultdict(list)
        for j, (_, terms) in enumerate(self.queries):
            for term, _ in terms:
                self.wanted[term].append(j)
        self.positive = [all(w >= 0 for _, w in terms) for _, terms in self.queries]
        self.avgdl, self.k1, self.b, self.k, self.digits = avgdl, k1, b, k, digits
        self.best = [(np.empty(0), np.empty(0, np.int64)) for _ in self.queries]
        self.least = np.full(len(self.queries), -np.inf)
        self.read = self.skipped = 0  # blocks whose postings were, and were not, looked at

    def impact(self, tf: np.ndarray, dl: np.ndarray) -> np.ndarray:
        return tf * (self.k1 + 1.0) / (tf + self.k1 * (1.0 - self.b + self.b * dl / self.avgdl))

    def segment(self, number: int, blocks: dict[str, list], dead: np.ndarray, every: np.ndarray | None) -> None:
        """``blocks``: per term its parts (positions, tfs, dls, peak_tfs, peak_dls)."""
        base = number << SEGMENT_BITS
        bounds = {t: max(self.impact(p[3], p[4]).max() for p in parts) for t, parts in blocks.items()}
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def postings(term: str) -> tuple[np.ndarray, np.ndarray]:
            if term not in held:
                places = np.concatenate([p[0] for p in blocks[term]]) - base
                impacts = np.concatenate([self.impact(p[1], p[2]) for p in blocks[term]])
                if (places[1:] < places[:-1]).any():
                    order = np.argsort(places)
                    places, impacts = places[order], impacts[order]
                held[term] = (places, impacts)
            return held[term]

        touched = range(len(self.queries)) if every is not None else sorted({j for t in blocks for j in self.wanted[t]})
        for j in touched:
            present = [(t, w) for t, w in self.queries[j][1] if t in blocks]
            scores, places = self._found(j, present, bounds, postings, dead - base)
            if every is not None and self.least[j] <= 0:
                scores, places = self._with_others(j, present, postings, dead - base, every - base, scores, places)
            if len(places):
                self._offer(j, scores, places + base)
        self.read += len(held)
        self.skipped += len(blocks) - len(held)

    def add_all(self, number: int, blocks: dict[str, tuple]) -> None:
        """Every chunk of ``blocks`` (per term positions, tfs, dls) with its sum; repeated positions add up."""
        base = number << SEGMENT_BITS
        held = {t: (positions - base, self.impact(tf, dl)) for t, (positions, tf, dl) in blocks.items()}
        for j in sorted({j for t in blocks for j in self.wanted[t]}):
            present = [(t, w) for t, w in self.queries[j][1] if t in held]
            places = np.concatenate([held[t][0] for t, _ in present])
            found = np.flatnonzero(np.bincount(places, minlength=1))
            scores = np.bincount(places, np.concatenate([w * held[t][1] for t, w in present]))[found]
            scores = scores if self.digits is None else np.round(scores, self.digits)
            if len(found) > self.k:
                bar = np.partition(scores, len(found) - self.k)[len(found) - self.k]
                found, scores = found[scores >= bar], scores[scores >= bar]
            self._offer(j, scores, found + base)

    def _found(self, j: int, present, bounds, postings, dead) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that can still be among the best, with their full scores."""
        none = np.empty(0), np.empty(0, np.int64)
        positive, least = self.positive[j], self.least[j] if self.positive[j] else -np.inf
        slack = 1e-9 * max(1.0, abs(least)) + (0.0 if self.digits is None else 10.0**-self.digits)
        by_bound = sorted((w * bounds[t], t, w) for t, w in present)
        # Terms that together cannot lift a chunk to the k-th score find none of their own.
        rest, essential = 0.0, 0
        while positive and essential < len(by_bound) and rest + by_bound[essential][0] < least - slack:
            rest += by_bound[essential][0]
            essential += 1
        if essential == len(by_bound):
            return none
        dense, seen = np.zeros(SEGMENT), np.zeros(SEGMENT, bool)
        for _, term, weight in by_bound[essential:]:
            places, impacts = postings(term)
            dense[places] += weight * impacts
            seen[places] = True
        seen[dead] = False
        places = np.flatnonzero(seen)
        if positive and len(places) > self.k:
            # Partial sums only grow, so the k-th of them is a bar as well.
            least = max(least, np.partition(dense[places], len(places) - self.k)[len(places) - self.k])
        places = places[dense[places] + rest >= least - slack]
        if not len(places):
            return none
        scores = np.zeros(len(places))
        for term, weight in present:
            own, impacts = postings(term)
            at = np.minimum(np.searchsorted(own, places), len(own) - 1)
            scores += np.where(own[at] == places, weight * impacts[at], 0.0)
        return (scores if self.digits is None else np.round(scores, self.digits)), places

    def _with_others(self, j: int, present, postings, dead, every, scores, places) -> tuple[np.ndarray, np.ndarray]:
        """With the first k chunks of the segment that hold none of the terms; they score zero."""
        free = np.zeros(SEGMENT, bool)
        free[every] = True
        free[dead] = False
        for term, _ in present:
            free[postings(term)[0]] = False
        others = np.flatnonzero(free)[: self.k]
        return np.concatenate([scores, np.zeros(len(others))]), np.concatenate([places, others])

    def _offer(self, j: int, scores: np.ndarray, positions: np.ndarray) -> None:
        scores = np.concatenate([self.best[j][0], scores])
        positions = np.concatenate([self.best[j][1], positions])
        order = np.lexsort((positions, -scores))[: self.k]
        self.best[j] = (scores[order], positions[order])
        if len(order) == self.k:
            self.least[j] = scores[order[-1]]

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (query_id, _), (scores, positions) in zip(self.queries, self.best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), query_id, np.int64)), pa.array(positions), pa.array(scores + 0.0)],
                    names=["query_id", "bm25_index", "score"],
                )


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(**shared.value)
        nothing = np.empty(0, np.int64)
        current, blocks, dead, every = None, defaultdict(list), [], None
        for batch in batches:
            segments = batch.column("segment").to_numpy(zero_copy_only=False)
            terms = batch.column("term").to_pylist()
            arrays = []
            for name in ("positions", "tfs", "dls", "peak_tfs", "peak_dls"):
                column = batch.column(name)
                arrays.append((column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)))
            for i, (number, term) in enumerate(zip(segments, terms)):
                if number != current:
                    if current is not None:
                        scorer.segment(current, blocks, np.concatenate([nothing, *dead]), every)
                    current, blocks, dead, every = int(number), defaultdict(list), [], None
                part = [values[offsets[i] : offsets[i + 1]] for offsets, values in arrays]
                if term is None:
                    dead.append(part[0])
                elif term == "":
                    every = part[0] if every is None else np.concatenate([every, part[0]])
                else:
                    blocks[term].append(part)
        if current is not None:
            scorer.segment(current, blocks, np.concatenate([nothing, *dead]), every)
        yield from scorer.rows()

    return run


def search_pass(
    blocks: DataFrame,
    deleted: DataFrame | None,
    queries: list[tuple[int, list[tuple[str, float]]]],
    avgdl: float,
    k1: float,
    b: float,
    k: int,
    digits: int | None,
    slots: list[int] | None = None,
) -> DataFrame:
    """Best ``k`` of each task and query, zero scores included, for weighted queries.

    ``deleted`` (bm25_index) leaves before ranking. A query with fewer than
    ``k`` matches is filled up from the first chunks: among the first 2 k live
    ones at least k hold none of its terms. Only a negative weight, possible in
    very small corpora, makes chunks of every segment candidates.
    """
    spark = blocks.sparkSession
    vocabulary = sorted({t for _, terms in queries for t, _ in terms})
    slots = slots_of(spark, vocabulary) if slots is None else slots
    wanted = blocks.filter(F.col("slot").isin(slots) & among("term", vocabulary))
    columns = ["segment", "term", "positions", "tfs", "dls", "peak_tfs", "peak_dls"]
    every = blocks.filter((F.col("slot") == ALL_CHUNKS_SLOT) & (F.col("term") == ""))
    parts = [wanted.select(*columns)]
    none = F.array().cast("array<int>")
    gone = None
    if deleted is not None:
        segment = F.shiftright(F.col("bm25_index"), SEGMENT_BITS)
        gone = deleted.select("bm25_index").distinct().groupBy(segment.alias("segment")).agg(F.collect_list("bm25_index").alias("positions"))
        parts.append(gone.select("segment", F.lit(None).cast("string").alias("term"), "positions", *(none.alias(c) for c in columns[3:])))
    if any(w < 0 for _, terms in queries for _, w in terms):
        parts.append(every.select(*columns))
    else:
        sizes = every.groupBy("segment").agg(F.sum("n").alias("n"))
        if gone is not None:
            lost = gone.select("segment", F.size("positions").alias("lost"))
            sizes = sizes.join(lost, "segment", "left").withColumn("n", F.col("n") - F.coalesce("lost", F.lit(0)))
        left, low = 2 * k, []
        for row in sizes.filter("n > 0").orderBy("segment").limit(2 * k).collect():
            if left > 0:
                low.append(row["segment"])
                left -= row["n"]
        parts.append(every.filter(F.col("segment").isin(low)).select(*columns))
    met = parts[0]
    for part in parts[1:]:
        met = met.unionByName(part)
    task = {"queries": queries, "avgdl": avgdl, "k1": k1, "b": b, "k": k, "digits": digits}
    # Bounded by the pass: its queries and their terms.
    shared = spark.sparkContext.broadcast(task)
    return met.repartition("segment").sortWithinPartitions("segment").mapInArrow(_search(shared), LOCAL_SCHEMA)


def _sums(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(**shared.value)
        names = {t: i for i, t in enumerate(sorted(scorer.wanted))}
        words = list(names)
        current, held = None, []

        def finish() -> None:
            term, positions, tf, dl = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(term, kind="stable")
            term, positions, tf, dl = term[order], positions[order], tf[order], dl[order]
            starts = np.flatnonzero(np.diff(term, prepend=-1))
            ends = np.append(starts[1:], len(term))
            scorer.add_all(current, {words[term[a]]: (positions[a:b], tf[a:b], dl[a:b]) for a, b in zip(starts.tolist(), ends.tolist())})

        for batch in batches:
            segment = batch.column("segment").to_numpy()
            coded = batch.column("term").dictionary_encode()
            own = np.array([names[t] for t in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
            columns = [own, *(batch.column(c).to_numpy() for c in ("bm25_index", "tf", "dl"))]
            starts = np.flatnonzero(np.diff(segment, prepend=segment[:1] - 1)).tolist()
            for a, b in zip(starts, [*starts[1:], len(segment)]):
                if segment[a] != current and held:
                    finish()
                    held = []
                current = int(segment[a])
                held.append([c[a:b] for c in columns])
        if held:
            finish()
        yield from scorer.rows()

    return run


def sum_pass(inverted: DataFrame, queries: list[tuple[int, list[tuple[str, float]]]], avgdl: float, k1: float, b: float, k: int, digits: int | None) -> DataFrame:
    """Best ``k`` matching chunks of each task and query, from flat postings.

    Only postings of query terms move, once, to the task of their segment; sums
    of a segment need no further exchange.
    """
    vocabulary = sorted({t for _, terms in queries for t, _ in terms})
    wanted = inverted.filter(among("term", vocabulary)).select(F.shiftright("bm25_index", SEGMENT_BITS).alias("segment"), "term", "bm25_index", "tf", "dl")
    # Bounded by the pass: its queries and their terms.
    shared = inverted.sparkSession.sparkContext.broadcast({"queries": queries, "avgdl": avgdl, "k1": k1, "b": b, "k": k, "digits": digits})
    return wanted.repartition("segment").sortWithinPartitions("segment").mapInArrow(_sums(shared), LOCAL_SCHEMA)


def among(column: str, words: list[str]) -> Column:
    """column IN (words) as one expression text: thousands of words are parsed at once."""
    if not words:
        return F.lit(False)
    quoted = ("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    return F.expr(f"{column} IN ({', '.join(quoted)})")


def slots_of(spark, vocabulary: list[str]) -> list[int]:
    """Slots of the terms, by the same hash as the stored rows."""
    if not vocabulary:
        return []
    rows = spark.createDataFrame([(t,) for t in vocabulary], "term string")
    return [row["slot"] for row in rows.select(slot_of(F.col("term")).alias("slot")).distinct().collect()]
