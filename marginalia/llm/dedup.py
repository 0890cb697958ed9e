"""Exact duplicates by a tree-merge of sorted digest runs.

Every row becomes one narrow entry: digest, size and second hash of its text,
its id. Each task's entries are one run. In round r the runs whose slots
differ only in place r (base FAN_IN) exchange parts: an entry goes to the slot
that has the digest's own figure in that place. Each slot sorts and merges what
it got into one run, where entries that agree in digest, size and second hash
become one that keeps the largest (or smallest) id and the count. After the
last round all entries of a digest have met, without any slot ever holding more
than its share of digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import kept

# Binary rounds taken in one exchange, and the runs a slot thus merges at once.
BITS = 5
FAN_IN = 1 << BITS

# What must agree for two entries to stand for equal texts.
SAME = ["digest", "bytes", "second"]


def text_entries(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """run, row, id, digest, bytes, second; one row per row of ``docs``. NULL texts count as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.spark_partition_id().cast("long").alias("run"),
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.xxhash64(text).alias("second"),
    )


def rounds_of(runs: int) -> int:
    """Rounds until FAN_IN ** rounds slots hold all runs; one at least."""
    rounds = 1
    while FAN_IN**rounds < runs:
        rounds += 1
    return rounds


def next_slot(slot: Column, digest: Column, place: int) -> Column:
    """``slot`` with the figure in ``place`` (base FAN_IN) replaced by the digest's own."""
    # Seven bytes of the digest as a whole number.
    number = F.conv(F.hex(F.substring(digest, 1, 7)), 16, 10).cast("long")
    figure = F.lit(FAN_IN - 1).cast("long")
    own = F.shiftright(number, BITS * place).bitwiseAND(figure)
    return slot + F.shiftleft(own - F.shiftright(slot, BITS * place).bitwiseAND(figure), BITS * place)


def merge_round(entries: DataFrame, place: int, keep: str) -> DataFrame:
    """One exchange and merge: slot, digest, bytes, second, best (id, row), n."""
    best = (F.max if keep == "largest" else F.min)("best").alias("best")
    return (
        entries.withColumn("slot", next_slot(F.col("slot"), F.col("digest"), place))
        .groupBy("slot", *SAME)
        .agg(best, F.sum("n").alias("n"))
    )


def merged_runs(entries: DataFrame, keep: str = "largest", places: int = 1) -> DataFrame:
    """The tree-merge: one row per distinct text."""
    # A NULL id never wins against another one.
    best = F.struct(F.col("id").isNull().alias("none") if keep == "smallest" else F.col("id").isNotNull().alias("known"), "id", "row")
    runs = entries.select(F.col("run").alias("slot"), *SAME, best.alias("best"), F.lit(1).cast("long").alias("n"))
    for place in range(places):
        runs = merge_round(runs, place, keep)
    return runs.select(*SAME, F.col("best.id").alias("best_id"), F.col("best.row").alias("best_row"), "n")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """Which row of each group of equal texts stays.

    ``docs`` has an orderable id and a text; other columns, whatever their
    names, are ignored. Result, one row per input row: ``id_col``, keep_id,
    group_size, kept, text_sha256. A NULL text counts as empty. Exactly one row
    of a group stays: that with the largest (``keep="smallest"``: smallest)
    id; rows with a NULL id only stay where no other has one, and of repeated
    rows with one id one stays. An empty table gives an empty result.

    Texts are read once and never shuffled. A round moves one entry per
    distinct text and run. Only groups of two and more rows are joined back;
    those with over a thousandth of all rows number less than a thousand and
    are broadcast, so a hot group never meets in one task.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be largest or smallest")
    entries = kept(text_entries(docs, id_col, text_col), "dedup-entries")
    seen = entries.agg(F.count(F.lit(1)).alias("n"), F.max("run").alias("run")).first()
    runs = 1 + (seen["run"] or 0)
    groups = kept(merged_runs(entries, keep, rounds_of(runs)).filter("n > 1"), "dedup-groups")

    answer = {
        "keep_id": lambda found: F.when(found, F.col("best_id")).otherwise(F.col("id")),
        "group_size": lambda found: F.when(found, F.col("n")).otherwise(F.lit(1).cast("long")),
        "kept": lambda found: F.when(found, F.col("row") == F.col("best_row")).otherwise(F.lit(True)),
    }

    def answered(rows: DataFrame) -> DataFrame:
        found = F.col("n").isNotNull()
        return rows.select(
            F.col("id").alias(id_col),
            *(make(found).alias(name) for name, make in answer.items()),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    hot = F.col("n") * 1000 > F.lit(seen["n"])
    few, many = F.broadcast(groups.filter(hot)), groups.filter(~hot)
    return answered(entries.join(few, SAME)).unionAll(
        answered(entries.join(few.select(*SAME), SAME, "left_anti").join(many, SAME, "left"))
    )
