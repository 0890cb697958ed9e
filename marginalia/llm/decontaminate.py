"""Benchmark decontamination by an exact, prefix-filtered set join.

Every item is cut into windows of ten words, one if it is shorter. A window can
only occur where its rarest word does, so that word is the necessary prefix:
document words are joined with it, the window's length and the word's place in
it bound where it may start, and what is left is compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import BROADCAST_ROWS, ascii_lower, free_name, kept

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Parts a frequent prefix word is cut into.
SALTS = 64


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words of a whole text; empty for NULL."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def text_key(text: Column) -> Column:
    """Sixteen bytes that stand for a text; equal texts are judged once."""
    return F.unhex(F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8")))


def windows_of(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words), and which items each belongs to (window_id, item_class).

    Items of equal words form one class, so that repeated items cost nothing.
    """
    # One written row per class of equal items, with the ids of its items.
    listed = items.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")).filter(
        F.col("item").isNotNull() & (F.size("words") > 0)
    )
    classes = kept(
        listed.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("item_class", text_key(F.array_join("words", " "))),
        "items",
    )
    size = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(size - window + 1, F.lit(1)))
    cut = classes.select("item_class", F.explode(F.transform(starts, lambda s: F.slice("words", s, F.least(F.lit(window), size)))).alias("words"))
    return classes, cut.withColumn("window_id", text_key(F.array_join("words", " ")))


def rarity(words: DataFrame, vocabulary: DataFrame, few: bool) -> DataFrame:
    """How often each word of the vocabulary occurs in all documents; absent ones are missing.

    A short vocabulary sorts words out inside the scan. Otherwise words are
    counted first, in tasks and then by word, and only counts meet the vocabulary.
    """
    each = words.select(F.explode("words").alias("word"))
    count = F.count(F.lit(1)).alias("rows")
    if few:
        return each.join(F.broadcast(vocabulary), "word").groupBy("word").agg(count)
    return each.groupBy("word").agg(count).join(vocabulary, "word", "left_semi")


def hot_keys(rows: DataFrame) -> DataFrame:
    """Values of ``key`` that hold over a thousandth of all rows; these are less than a thousand."""
    counted = kept(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")), "key-sizes")
    total = counted.agg(F.sum("rows")).first()[0] or 0
    return counted.filter(F.col("rows") * 1000 > total).select("key")


def candidates(each: DataFrame, prefix: DataFrame, fits: Column) -> DataFrame:
    """Places (key, n, start) where a window's prefix word and length fit, words of frequent prefixes salted."""
    total = prefix.select("word", "rows").distinct().agg(F.sum("rows")).first()[0]
    hot = kept(prefix.filter(F.col("rows") * 1000 > total).select("word").distinct(), "hot-words").withColumn("hot", F.lit(True))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("key", "at"), F.lit(SALTS))).otherwise(F.lit(0))
    left = each.join(F.broadcast(hot), "word", "left").withColumn("salt", salt.cast("int")).drop("hot")
    copies = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = prefix.drop("rows").join(F.broadcast(hot), "word", "left").withColumn("salt", F.explode(copies)).drop("hot")
    met = left.join(right, ["word", "salt"]).filter(fits)
    return met.select("key", (F.col("at") - F.col("offset")).alias("start"), "size", "window_id", "window_words").dropDuplicates(["key", "start", "window_id"])


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Where windows occur: (key, start, size, window_id, item_class), and the classes with their items."""
    classes, cut = windows_of(items, window)
    cut = kept(cut, "windows")
    windows = cut.select("window_id", "words").dropDuplicates(["window_id"])
    texts = docs.select(text_key(F.col("text")).alias("key"), words_of(F.col("text")).alias("words"))
    vocabulary = kept(cut.select(F.explode("words").alias("word")).distinct(), "vocabulary")
    few = vocabulary.count() <= BROADCAST_ROWS
    counted = kept(rarity(texts, vocabulary, few), "rarity")
    # The rarest word of each window and its place; a window with an absent word cannot occur.
    placed = windows.select("window_id", "words", F.posexplode("words").alias("offset", "word")).join(counted, "word", "left")
    prefix = kept(
        placed.groupBy("window_id")
        .agg(
            F.min(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "word", "offset")).alias("rare"),
            F.first("words").alias("window_words"),
        )
        .filter(F.col("rare.rows") > 0)
        .select("window_id", "rare.word", "rare.offset", "rare.rows", "window_words", F.size("window_words").alias("size")),
        "prefixes",
    )
    start = F.col("at") - F.col("offset")
    fits = (start >= 0) & (start + F.col("size") <= F.col("n"))
    same = F.slice("words", F.col("start") + 1, F.col("size")) == F.col("window_words")
    each = texts.select("key", "words", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    if prefix.count() <= BROADCAST_ROWS:
        # The documents stream past the prefixes; nothing of them is shuffled.
        hits = each.join(F.broadcast(prefix), "word").filter(fits).withColumn("start", start).filter(same).select("key", "start", "size", "window_id")
    else:
        # Too many prefixes to hold: join narrow rows first, and fetch words only for texts with candidates.
        likely = candidates(each.select("key", "n", "at", "word"), prefix, fits)
        hits = likely.join(texts.dropDuplicates(["key"]), "key").filter(same).select("key", "start", "size", "window_id")
    found = kept(hits.distinct(), "hits")
    return found.join(cut.select("window_id", "item_class").distinct(), "window_id"), classes


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per distinct text with a hit: key, n_hit, n_items, items (sorted item ids).

    ``docs`` has text, ``items`` item_id and text; other columns are ignored.
    Items with a NULL id, a NULL text or no word take no part; an id counts
    once, however many of its rows occur.
    """
    found, classes = occurrences(docs, items, window)
    spans = found.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("spans"))

    def covered(state: Column, x: Column) -> Column:
        more = F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], state["upto"]))
        return F.struct(F.greatest(state["upto"], x["end"]).alias("upto"), (state["n"] + more).alias("n"))

    n_hit = F.aggregate("spans", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), covered, lambda s: s["n"])
    named = (
        found.select("key", "item_class")
        .distinct()
        .join(classes.select("item_class", "items"), "item_class")
        .groupBy("key")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )
    return spans.select("key", n_hit.cast("long").alias("n_hit")).join(named, "key").select("key", "n_hit", F.size("items").cast("long").alias("n_items"), "items")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A NULL text has no words. Repeated rows and rows with a NULL doc_id get an
    answer each.
    """
    hit = kept(contamination(docs, items, window).withColumn("digest", F.sha2(F.array_join("items", ","), 256)).drop("items"), "contaminated")
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    nothing = F.sha2(F.lit(""), 256)
    if hit.count() <= BROADCAST_ROWS:
        judged = rows.join(F.broadcast(hit), "key", "left")
    else:
        # Copies of one text, and texts without words, would meet in one task.
        hot = F.broadcast(kept(hot_keys(rows.select("key")).join(hit, "key", "left"), "hot-texts"))
        rest = rows.join(hot.select("key"), "key", "left_anti").join(hit, "key", "left")
        judged = rows.join(hot, "key").unionByName(rest)
    return judged.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("digest", nothing).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of any item."""
    hit = kept(contamination(docs, items, window).select("key"), "contaminated")
    key = free_name(docs.columns, "_text_key")
    marked = docs.withColumn(key, text_key(F.col("text")))
    named = lambda keys: keys.withColumnRenamed("key", key)
    if hit.count() <= BROADCAST_ROWS:
        return marked.join(F.broadcast(named(hit)), key, "left_anti").select(*docs.columns)
    # Hot texts are judged by short lists; what is left has no hot key.
    hot = hot_keys(docs.select(text_key(F.col("text")).alias("key")))
    clean = named(kept(hot.join(hit, "key", "left_anti"), "hot-clean"))
    stained = named(kept(hot.join(hit, "key", "left_semi"), "hot-contaminated"))
    easy = marked.join(F.broadcast(clean), key, "left_semi")
    rest = marked.join(F.broadcast(clean.unionByName(stained)), key, "left_anti").join(named(hit), key, "left_anti")
    return easy.unionByName(rest).select(*docs.columns)
