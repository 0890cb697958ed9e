"""Secret scan: fixed forms, and strings that look random to a character Markov model.

Everything is column expressions. Positions of all matches of a form come from
the lengths of the gaps between them. Two first-order Markov models, of random
strings and of ordinary identifiers, are counted from labelled samples; a long
token whose log-likelihood ratio reaches the threshold is a span as well.
"""

from __future__ import annotations

import math
import random as chance
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import bounded_sample, free_name, kept, let

KINDS = ("assign", "access", "hex", "markov")
# The fixed forms. For access and hex the least length is part of the form,
# which finds the same spans as dropping short matches afterwards.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
STATES = len(ALPHABET) + 1  # one more for the start
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
WORD = r"[A-Za-z0-9+/_=-]{6,}"
SMOOTHING = 0.5
# Nats by which the random model must win.
THRESHOLD = 12.0
# Bounds of the labelled samples.
RANDOM_ROWS, WORD_DOCS, WORD_ROWS = 5_000, 2_000, 50_000
# Generated strings of the random class, so that it never depends on the table alone.
MADE_ROWS, MADE_LENGTH, MADE_SEED = 1_000, 24, 17

SPAN = "struct<start:int,kind:int,end:int,value:string>"
# Code points of one piece of a text that is masked.
PIECE = 4_096


def in_blocks(items: Column, zero: Column, none: Column, total: Callable, join: Callable, step: Callable) -> Column:
    """What a running state gives item by item, as one array.

    ``step(state, item)`` returns the next state and the values to append. An
    array that grows by one is copied every time, so the items are cut into
    about as many blocks as a block has items: ``total(block)`` and ``join``
    give the state each block starts from, and n items cost n^1.5 copies.
    """

    def cut(all_items: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(all_items).cast("double"))).cast("int"), F.lit(16))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(all_items), F.lit(1)), width)
        return F.transform(firsts, lambda at: F.slice(all_items, at, width))

    def states(blocks: Column) -> Column:
        def more(held: Column, block: Column) -> Column:
            now = join(F.element_at(held, -1), total(block))
            return F.concat(held, F.array(now))

        return F.aggregate(blocks, F.array(zero), more)

    def walked(block: Column, state: Column) -> Column:
        def one(held: Column, item: Column) -> Column:
            now, out = step(held["state"], item)
            return F.struct(now.alias("state"), F.concat(held["out"], out).alias("out"))

        return F.aggregate(block, F.struct(state.alias("state"), none.alias("out")), one, lambda held: held["out"])

    # One state more than blocks: the last one belongs to no block.
    return let(let(items, cut), lambda blocks: F.flatten(F.zip_with(blocks, F.slice(states(blocks), F.lit(1), F.size(blocks)), walked)))


def below(ordered: Column, value: Column) -> Column:
    """How many values of an ascending array are smaller than ``value``, by halving."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(ordered).cast("double") + 1)).cast("int"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        less = (span["low"] < span["high"]) & (F.get(ordered, middle) < value)
        low = F.when(less, middle + 1).otherwise(span["low"])
        return F.struct(low.alias("low"), F.when(less | (span["low"] >= span["high"]), span["high"]).otherwise(middle).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.size(ordered).alias("high"))
    return F.aggregate(rounds, start, halve, lambda span: span["low"])


def found(text: Column, pattern: str, kind: int, likely: Column, value_group: int = 0, least: int = 0) -> Column:
    """Spans of all leftmost non-overlapping matches; ``likely``: a cheap test that no text with a match fails."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else hits
    steps = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))

    def length(x: Column) -> Column:
        return F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))

    none = F.array().cast(f"array<{SPAN}>")

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start, end = at + F.length(x["gap"]), at + length(x)
        one = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value")))
        wanted = F.length(x["value"]) >= least if least else x["hit"].isNotNull()
        return end, F.when(wanted, one).otherwise(none)

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda n, x: n + length(x))

    spans = in_blocks(steps, F.lit(0), none, total, lambda a, b: a + b, step)
    return F.when(likely & text.rlike(pattern), spans).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the fixed forms by start, then kind."""
    assign = found(text, ASSIGN, 0, text.contains("=") | text.contains(":"), 2, ASSIGN_VALUE)
    return F.array_sort(F.concat(assign, found(text, ACCESS, 1, text.contains("AKIA")), found(text, HEX, 2, F.lit(True))))


class MarkovPair:
    """Log-likelihood ratios of all transitions, random against ordinary."""

    def __init__(self, counts: dict[tuple[int, int, int], int]):
        totals: dict[tuple[int, int], int] = {}
        for (label, a, _), n in counts.items():
            totals[label, a] = totals.get((label, a), 0) + n

        def log_chance(label: int, a: int, b: int) -> float:
            return math.log((counts.get((label, a, b), 0) + SMOOTHING) / (totals.get((label, a), 0) + SMOOTHING * STATES))

        self.trained = all(any(key[0] == label for key in counts) for label in (0, 1))
        self.ratios = [log_chance(1, a, b) - log_chance(0, a, b) for a in range(STATES) for b in range(STATES)]

    def ratio(self, token: str) -> float:
        """Of one token, outside Spark."""
        states = [0, *(ALPHABET.index(c) + 1 for c in token)]
        return sum(self.ratios[a * STATES + b] for a, b in zip(states, states[1:]))

    def score(self, token: Column) -> Column:
        """The same as a column expression; every transition is one look-up."""
        table = F.split(F.lit(",".join(f"{r:.6g}" for r in self.ratios)), ",").cast("array<double>")
        states = states_of(token)
        pairs = F.zip_with(states, F.slice(states, F.lit(2), F.size(states)), lambda a, b: a * STATES + b)
        return F.aggregate(pairs, F.lit(0.0), lambda total, at: total + F.when(at.isNull(), F.lit(0.0)).otherwise(F.element_at(table, at + 1)))


def states_of(token: Column) -> Column:
    """Start state and the state of every character."""
    of_code = [0] * 128
    for i, c in enumerate(ALPHABET):
        of_code[ord(c)] = i + 1
    codes = F.array(*map(F.lit, of_code))
    chars = F.filter(F.split(token, ""), lambda c: c != "")
    return F.concat(F.array(F.lit(0)), F.transform(chars, lambda c: F.element_at(codes, F.ascii(c) + 1)))


def made_counts() -> dict[tuple[int, int, int], int]:
    """Transitions of the generated random strings over the alphabet."""
    draw, counts = chance.Random(MADE_SEED), {}
    for _ in range(MADE_ROWS):
        states = [0, *(draw.randrange(1, STATES) for _ in range(MADE_LENGTH))]
        for a, b in zip(states, states[1:]):
            counts[1, a, b] = counts.get((1, a, b), 0) + 1
    return counts


def train(docs: DataFrame) -> MarkovPair:
    """Count transitions of labelled tokens.

    Random: MADE_ROWS generated strings, and the values that fixed forms find
    in all documents, RANDOM_ROWS of them by hash at most. Ordinary: the words of WORD_DOCS documents by hash of doc_id,
    fixed forms taken out, WORD_ROWS of their occurrences at most by hash of token,
    document and place.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = docs.select(F.explode(base_spans(text)).alias("_span"))
    values = kept(spans.select(F.col("_span.value").alias("token"), F.monotonically_increasing_id().alias("_row")), "secret-values")
    random = bounded_sample(values, RANDOM_ROWS, [F.col("token"), F.col("_row")], values.count()).select(F.lit(1).alias("label"), "token")
    draw = [F.col("doc_id").cast("string"), F.col("text")] if "doc_id" in docs.columns else [F.col("text")]
    some = kept(bounded_sample(docs, WORD_DOCS, draw, docs.count()).select(text.alias("text"), F.xxhash64(*draw).alias("_doc")), "word-documents")
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = some.select("_doc", F.posexplode(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))).alias("_at", "token"))
    words = bounded_sample(words, WORD_ROWS, [F.col("token"), F.col("_doc"), F.col("_at")], words.count()).select(F.lit(0).alias("label"), "token")
    states = random.unionByName(words).select("label", states_of(F.col("token")).alias("s"))
    pairs = F.arrays_zip(F.slice("s", F.lit(1), F.size("s") - 1).alias("a"), F.slice("s", F.lit(2), F.size("s") - 1).alias("b"))
    rows = states.select("label", F.explode(pairs).alias("p")).groupBy("label", "p.a", "p.b").count().collect()
    counts = made_counts()
    for r in rows:
        key = (r["label"], r["a"], r["b"])
        counts[key] = counts.get(key, 0) + r["count"]
    return MarkovPair(counts)


def scan(docs: DataFrame, model: MarkovPair | None = None, base: str = "base_spans", spans: str = "spans") -> DataFrame:
    """Adds two columns to ``docs`` (text and any others): the base spans, and all spans.

    A span is struct(start, kind, end, value): code points, end exclusive, kind
    a position in KINDS. Tokens that touch a base span add nothing. A NULL text
    is empty. Without an ordinary word to learn from no token is added. Columns
    of these names in ``docs`` are replaced.
    """
    model = model or train(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumn(base, base_spans(text))
    if not model.trained:
        return df.withColumn(spans, F.col(base))
    tokens = found(text, TOKEN, 3, F.lit(True))

    # A span that begins before the token's end, but does not end by its start, touches it.
    bounds = F.struct(
        F.transform(base, lambda b: b["start"]).alias("starts"),
        F.array_sort(F.transform(base, lambda b: b["end"])).alias("ends"),
    )

    def random_ones(edge: Column) -> Column:
        def wanted(m: Column) -> Column:
            clear = (F.size(edge["starts"]) == 0) | (below(edge["starts"], m["end"]) == below(edge["ends"], m["start"] + 1))
            return clear & (model.score(m["value"]) >= THRESHOLD)

        return F.filter(tokens, wanted)

    return df.withColumn(spans, F.array_sort(F.concat(F.col(base), let(bounds, random_ones))))


def described(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame, model: MarkovPair | None = None) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans (text)."""

    def number(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return scan(docs.select("doc_id", "text"), model).select(
        "doc_id",
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(F.encode(described("base_spans"), "UTF-8"), 256).alias("base_sha256"),
        described("spans").alias("spans"),
    )


def masked(docs: DataFrame, mark: str = "[secret]", model: MarkovPair | None = None) -> DataFrame:
    """The rows of ``docs`` with every span of text replaced by ``mark``; n_chars, if there, follows.

    Spans that overlap are replaced as one. Rows without a span stay as they are.
    """
    names = docs.columns
    base, spans = free_name(names, "_base_spans"), free_name(names, "_all_spans")
    df = scan(docs, model, base, spans)
    text = F.col("text")
    none = F.array().cast("array<struct<first:int,after:int>>")

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        gap = F.array(F.struct(at.alias("first"), x["start"].alias("after")))
        return F.greatest(at, x["end"]), F.when(x["start"] >= at, gap).otherwise(none)

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda at, x: F.greatest(at, x["end"]))

    # Text between the spans; the last gap goes on to the end.
    last = F.struct(F.array_max(F.transform(spans, lambda x: x["end"])).alias("first"), F.length(text).alias("after"))
    gaps = F.concat(in_blocks(F.col(spans), F.lit(0), none, total, F.greatest, step), F.array(last))
    # Counting code points from the start of a long text for every gap would be quadratic.
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def part(held: Column, gap: Column) -> Column:
        first = F.floor(gap["first"] / PIECE).cast("int")
        some = F.slice(held, first + 1, F.floor(gap["after"] / PIECE).cast("int") - first + 1)
        return F.substring(F.array_join(some, ""), gap["first"] - first * PIECE + 1, gap["after"] - gap["first"])

    clean = let(pieces, lambda held: F.array_join(F.transform(gaps, lambda gap: part(held, gap)), mark))
    df = df.withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(text))
    if "n_chars" in names:
        df = df.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return df.select(*names)
