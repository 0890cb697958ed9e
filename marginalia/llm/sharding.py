"""Shards of equal row counts by balanced label propagation.

Documents with equal texts are linked. They start in shards drawn by a hash,
which is even but cuts most links. In each round the documents of a group look
where their neighbours are, by a join of the group with the votes of its
members, and wish to move to the shard with most of them that has room for the
whole group. Shards admit wishes up to their quotas, larger groups first; who is
refused wishes anew in the next round, among the rooms that are left. What
lives there and has not settled yet swaps places with those who come. A
settled group has no cut edges, so these only fall; the rounds end when no
group is left that any shard has room for.

Groups larger than a shard fill whole ones first and go on with their rest.
Groups that no room can hold, fewer than there are shards, are cut at single
rows. Unlinked documents fill up what is left and make the counts exact.
"""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import kept
from marginalia.operators.topk import number_rows

# The rows of a link group meet their label in this many parts, so that no key holds a whole large group.
PARTS = 64
MAX_SHARDS = 1024


@dataclass
class Propagated:
    """Outcome of the rounds: groups with their shard, and what stayed without one."""

    settled: DataFrame  # link, n, shard
    homeless: list[tuple[bytes, int]]  # link, n
    room: list[int]
    cut_edges: list[int]  # before the first round and after each


def _admitted(wishes: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many wishes of each (target, size) fit, larger sizes first; ``room`` shrinks."""
    taken = {}
    for target, n in sorted(wishes, key=lambda cell: -cell[1]):
        count = min(wishes[target, n], room[target] // n)
        if count:
            taken[target, n] = count
            room[target] -= count * n
    return taken


def _cells(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A side of at most shards x sizes rows, all of which the driver has just counted; keys travel as hex text."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, (v.hex() if isinstance(v, bytes) else v for v in row))) for row in rows])
    held = F.from_json(F.lit(text), f"array<struct<{schema.replace('binary', 'string').replace(' ', ': ').replace(',:', ',')}>>")
    cells = spark.range(0, 1, 1, 1).select(F.inline(held))
    return F.broadcast(cells.withColumn("link", F.unhex("link")) if "link" in names else cells)


def propagate(groups: DataFrame, votes: DataFrame, room: list[int]) -> Propagated:
    """Settle groups(link, n) by votes(link, shard, votes) into shards with ``room`` rows.

    Only groups of the largest power of two wish in a round, so that small ones
    do not take the room of large ones. A group without neighbours in a shard
    with room wishes for one drawn by its link and the round.
    """
    spark, room = groups.sparkSession, list(room)
    apart = votes.groupBy("link").agg((F.sum("votes") * F.sum("votes") - F.sum(F.col("votes") * F.col("votes"))).alias("apart"))
    unsettled = kept(groups.join(apart, "link"), "unsettled")
    settled: list[DataFrame] = []
    homeless: list[tuple[bytes, int]] = []
    cuts: list[int] = []
    number = stuck = 0
    while True:
        left = unsettled.agg(F.max("n").alias("n"), F.sum(F.col("apart").cast("decimal(38,0)")).alias("apart")).first()
        # Pairs are counted from both sides; those of groups without a shard stay as they started.
        cuts.append((int(left["apart"] or 0) + stuck) // 2)
        if len(cuts) > 1 and cuts[-1] > cuts[-2]:
            raise RuntimeError(f"cut edges rose from {cuts[-2]} to {cuts[-1]}")
        if left["n"] is None:
            break
        if left["n"] > max(room):
            # Rooms only shrink: who fits nowhere now never will. They are fewer than the shards.
            out = F.col("n") > max(room)
            lost = unsettled.filter(out).collect()
            homeless += [(bytes(r["link"]), r["n"]) for r in lost]
            stuck += sum(int(r["apart"]) for r in lost)
            unsettled = kept(unsettled.filter(~out), "unsettled")
            continue
        number += 1
        asking = unsettled.filter(F.col("n") >= 1 << (left["n"].bit_length() - 1)).select("link", "n")
        rooms = _cells(spark, list(enumerate(room)), "shard int, room long")
        neighbours = asking.join(votes, "link").join(rooms, "shard").filter("room >= n")
        draw = F.xxhash64("link", F.col("shard"), F.lit(number))
        best = neighbours.groupBy("link").agg(F.max(F.struct("votes", draw.alias("draw"), "shard")).alias("best"))
        open_ = F.filter(F.array(*(F.struct(F.lit(s).alias("shard"), F.lit(r).alias("room")) for s, r in enumerate(room))), lambda x: x["room"] >= F.col("n"))
        drawn = F.element_at(open_, F.pmod(F.xxhash64("link", F.lit(number)), F.size(open_)).cast("int") + 1)["shard"]
        target = F.when(F.size(open_) > 0, F.coalesce("best.shard", drawn)).cast("int")
        wishes = kept(asking.join(best, "link", "left").withColumn("target", target).filter("target IS NOT NULL").select("link", "n", "target"), "wishes")
        counts = {(r["target"], r["n"]): r["count"] for r in wishes.groupBy("target", "n").count().collect()}
        taken = _admitted(counts, room)
        whole = [cell for cell, n in taken.items() if n == counts[cell]]
        some = [(*cell, n) for cell, n in taken.items() if n < counts[cell]]
        came = wishes.join(_cells(spark, whole, "target int, n long"), ["target", "n"], "left_semi")
        if some:
            # Of a cell that fits in part exactly so many come, drawn anew in each round.
            draw = F.xxhash64("link", F.lit(number))
            few = wishes.join(_cells(spark, some, "target int, n long, fits long"), ["target", "n"]).withColumn("draw", draw)
            placed = number_rows(few, ["target", "n", "draw", "link"], "place")
            starts = placed.groupBy("target", "n").agg(F.min("place").alias("start"))
            chosen = placed.join(F.broadcast(starts), ["target", "n"]).filter("place - start < fits")
            came = came.select("link", "n", "target").unionByName(chosen.select("link", "n", "target"))
        came = kept(came.select("link", "n", F.col("target").alias("shard")), "settled")
        settled.append(came)
        unsettled = kept(unsettled.join(came.select("link"), "link", "left_anti"), "unsettled")
    rows = groups.select("link", "n", F.lit(0).alias("shard")).limit(0)
    for came in settled:
        rows = rows.unionByName(came)
    return Propagated(rows, homeless, room, cuts)


def label_groups(nodes: DataFrame, quotas: list[int]) -> tuple[DataFrame, list[int], list[list[tuple[int, int]]], list[int]]:
    """Labels of all linked parts (link, part, label), rows of whole groups per shard, pieces of cut groups, cut edges by round.

    A label below the number of shards is the shard of a whole group, the others number the cut groups.
    """
    spark, shards = nodes.sparkSession, len(quotas)
    sums = kept(nodes.filter(F.col("link").isNotNull()).groupBy("link", "part").agg(F.count(F.lit(1)).alias("n")), "sums")
    groups = kept(sums.groupBy("link").agg(F.sum("n").alias("n")).filter(F.col("n") > 1), "groups")
    start = F.pmod(F.col("part"), F.lit(shards)).cast("int")
    votes = kept(
        sums.join(groups.select("link"), "link", "left_semi").groupBy("link", start.alias("shard")).agg(F.sum("n").alias("votes")), "votes"
    )
    room, cut = list(quotas), {}
    # Groups larger than every quota: fewer than there are shards.
    for row in groups.filter(F.col("n") > max(quotas)).collect():
        left, own = row["n"], []
        while empty := [(q, s) for s, q in enumerate(quotas) if 0 < q <= left and room[s] == q]:
            q, s = max(empty)
            own.append((s, q))
            room[s] = 0
            left -= q
        cut[bytes(row["link"])] = (own, left)
    large = _cells(spark, [(k, left) for k, (_, left) in cut.items()], "link binary, rest long")
    asked = groups.join(large, "link", "left").select("link", F.coalesce("rest", "n").alias("n")).filter("n > 0")
    outcome = propagate(asked, votes, room)
    for row in outcome.settled.join(large, "link", "left_semi").collect():
        cut[bytes(row["link"])][0].append((row["shard"], row["n"]))
    # What no room holds whole takes the least room for what is left of it, or else the largest.
    free = sorted((r, s) for s, r in enumerate(outcome.room) if r)
    for link, n in sorted(outcome.homeless, key=lambda group: -group[1]):
        own = cut.setdefault(link, ([], 0))[0]
        while n:
            r, s = free.pop(min(bisect_left(free, (n, -1)), len(free) - 1))
            own.append((s, min(n, r)))
            if r > n:
                insort(free, (r - n, s))
            n -= min(n, r)
    names = _cells(spark, [(k, shards + i) for i, k in enumerate(cut)], "link binary, cut int")
    single = outcome.settled.join(names, "link", "left_anti")
    whole = [0] * shards
    for row in single.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        whole[row["shard"]] = row["n"]
    label = groups.join(single.select("link", "shard"), "link", "left").join(names, "link", "left").select("link", F.coalesce("cut", "shard").alias("label"))
    return sums.join(label, "link").select("link", "part", "label"), whole, [own for own, _ in cut.values()], outcome.cut_edges


def shard_rows(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Put every row into a shard; the counts of shards differ by one at most (law ``rows``).

    ``docs``: doc_id, text; other columns are ignored. Rows with equal texts are
    linked; a NULL text is linked with nothing, has size 1 and checksum 0. A
    NULL or repeated doc_id is placed like any other. A group larger than a
    shard fills whole shards, and its rest is placed like a smaller group. Of
    the groups and rests that fit a shard fewer than ``shards`` are cut, and
    only those that no shard has room for when their turn comes. Result: doc_id, size, text_crc32, law,
    shard, slot (gapless per shard), grown_shard (NULL).
    """
    if not 1 <= shards <= MAX_SHARDS:
        raise ValueError(f"1 to {MAX_SHARDS} shards")
    raw = F.encode("text", "UTF-8")
    nodes = kept(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
            F.unhex(F.md5(raw)).alias("link"),
            F.pmod(F.xxhash64("doc_id", F.coalesce(F.octet_length("text"), F.lit(0))), F.lit(-(-PARTS // shards) * shards)).cast("int").alias("part"),
        ),
        "nodes",
    )
    total = nodes.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    units, whole, pieces, _ = label_groups(nodes, quotas)
    single = F.lit(shards + len(pieces))
    placed = kept(
        nodes.join(units, ["link", "part"], "left").select("doc_id", "size", "text_crc32", "link", F.coalesce("label", single).alias("label")), "placed"
    )
    # Rows in the order of their labels: where each stretch of them goes.
    used, spans, end = [0] * shards, [], 0

    def put(shard: int, rows: int) -> None:
        nonlocal end
        spans.append((end + rows, shard, used[shard] - end))
        used[shard] += rows
        end += rows

    for shard, rows in [*enumerate(whole), *(piece for cut in pieces for piece in cut)]:
        put(shard, rows)
    for shard, quota in enumerate(quotas):
        put(shard, quota - used[shard])
    numbered = number_rows(placed, ["label", "link", "doc_id"], "_row")
    ends, shard_of, shift = (F.array(*(F.lit(v).cast("long") for v in values)) for values in zip(*spans))
    numbered = numbered.withColumn("_span", F.size(F.filter(ends, lambda e: e <= F.col("_row"))) + 1)
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.element_at(shard_of, F.col("_span")).cast("int").alias("shard"),
        (F.col("_row") + F.element_at(shift, F.col("_span"))).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
