"""Language identification with a string kernel.

Two texts are as alike as the sets of character n-grams (one to three letters)
that occur in them: a blended-spectrum kernel of presence bits, normalised by
the set sizes. Nystrom landmarks turn the kernel into a short feature vector,
one-versus-rest kernel ridge regression is solved on it, and whole batches of
texts are scored by two matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import kept, small_side
from marginalia.operators.topk import top_k_per_group

GRAMS = (1, 2, 3)
CELL_BITS = 20
# Bounds of the training sample: landmarks in all, and training rows per language and in all.
LANDMARKS = 192
ROWS_PER_LANGUAGE = 500
ROWS = 20_000
RIDGE = 1e-3
# Texts scored together, at most, by number and by characters.
TEXTS_AT_ONCE = 64
CHARS_AT_ONCE = 1 << 20
UNKNOWN = "und"


def cells(points: np.ndarray) -> Iterator[np.ndarray]:
    """For each n: the hash cells of all n-grams of a sequence of code points."""
    points = points.astype(np.uint64) + np.uint64(1)
    code = np.zeros(len(points), np.uint64)
    for n in GRAMS:
        if len(points) < n:
            return
        code = code[: len(points) - n + 1] * np.uint64(0x1000193B) + points[n - 1 :]
        spread = (code + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15)
        yield (spread >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def present(text: str) -> np.ndarray:
    """The distinct cells of a whole text."""
    parts = list(cells(code_points(text)))
    return np.unique(np.concatenate(parts)).astype(np.int32) if parts else np.empty(0, np.int32)


@dataclass
class LanguageModel:
    languages: list[str]
    column: np.ndarray  # by cell: its column among the n-grams of the landmarks, or their number
    landmarks: np.ndarray  # n-grams x landmarks, each landmark of length one
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        """Regression values, one row per text and one column per language."""
        width = len(self.landmarks)
        bits = np.zeros((len(texts), width + 1), np.float32)
        points = [code_points(text) for text in texts]
        sizes = [len(p) for p in points]
        # Whole batch in one go; a private mark between texts keeps n-grams apart.
        gap = np.array([0x110000, 0x110001], np.uint32)
        row = np.repeat(np.arange(len(texts)), np.array(sizes) + 2)
        joined = np.concatenate([x for p in points for x in (p, gap)])
        for found in cells(joined):
            bits[row[: len(found)], self.column[found]] = 1.0
        bits = bits[:, :width]
        norm = np.sqrt(np.maximum(bits.sum(axis=1), 1.0))
        return (bits @ self.landmarks / norm[:, None]) @ self.weights + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        wanted = [i for i, text in enumerate(texts) if has_letter(text)]
        while wanted:
            some, chars = [], 0
            while wanted and len(some) < TEXTS_AT_ONCE and (not some or chars + len(texts[wanted[0]]) <= CHARS_AT_ONCE):
                some.append(wanted.pop(0))
                chars += len(texts[some[-1]])
            values = self.score([texts[i] for i in some])
            best = values.argmax(axis=1)
            shares = np.clip(values, 0.0, None)
            total = shares.sum(axis=1)
            for j, i in enumerate(some):
                names[i] = self.languages[best[j]]
                scores[i] = float(min(1.0, shares[j, best[j]] / total[j])) if total[j] > 0 else 0.0
        return names, scores


def solve(languages: list[str], landmark_cells: list[np.ndarray], rows: list[tuple[str, np.ndarray]]) -> LanguageModel:
    """Nystrom features of the training rows and one ridge regression per language."""
    column_count = 1 << CELL_BITS
    known = np.unique(np.concatenate([np.empty(0, np.int32), *landmark_cells]))
    column = np.full(column_count, len(known), np.int32)
    column[known] = np.arange(len(known))

    def unit(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), len(known) + 1), np.float32)
        for i, s in enumerate(sets):
            out[i, column[s]] = 1.0
        out = out[:, :-1]
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1.0))

    marks = unit(landmark_cells)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    use = values > 1e-6 * max(1.0, values.max(initial=1.0))
    half = vectors[:, use] / np.sqrt(values[use])
    gram, cross = np.zeros((use.sum() + 1,) * 2), np.zeros((use.sum() + 1, len(languages)))
    for first in range(0, len(rows), 512):
        some = rows[first : first + 512]
        features = unit([s for _, s in some]) @ marks.T @ half
        features = np.hstack([features, np.ones((len(some), 1))])
        target = np.array([[float(name == language) for language in languages] for name, _ in some])
        gram += features.T @ features
        cross += features.T @ target
    ridge = RIDGE * len(rows) * np.eye(len(gram))
    ridge[-1, -1] = 0.0
    weights = np.linalg.solve(gram + ridge + 1e-9 * np.eye(len(gram)), cross)
    return LanguageModel(languages, column, np.ascontiguousarray(marks.T), (half @ weights[:-1]).astype(np.float32), weights[-1].astype(np.float32))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text, rank in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "rank"))):
            if has_letter(text):
                yield pa.RecordBatch.from_pydict({"lang": [lang], "rank": [rank], "cells": [present(text).tobytes()]}, pa.schema([("lang", pa.string()), ("rank", pa.int32()), ("cells", pa.binary())]))


def train(labelled: DataFrame) -> LanguageModel:
    """Fit on the columns doc_id, text, lang; rows with a NULL text or lang teach nothing.

    The sample is bounded: per language the rows with the smallest hashes of
    doc_id, ROWS_PER_LANGUAGE at most and ROWS in all. The landmarks are the
    first of them. Without any row the model knows no language.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "text", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40)).alias("_draw"), F.xxhash64("text").alias("_tie")
    )
    # About twice the rows wanted pass by their hash, so what meets per language is bounded.
    share = F.least(F.lit(1.0), F.lit(2.0 * ROWS_PER_LANGUAGE) / F.count(F.lit(1)))
    # The share of each language is written and counted first: as a small side it lets the texts stay where they are.
    shares = small_side(kept(rows.groupBy("lang").agg((share * (1 << 40)).alias("_upto")), "shares"))
    drawn = top_k_per_group(
        rows.join(shares, "lang").filter(F.col("_draw") < F.col("_upto")).drop("_upto"), ["lang"], [F.col("_draw"), F.col("_tie")], ROWS_PER_LANGUAGE
    )
    first = drawn.orderBy("rank", "lang", "_draw", "_tie").limit(ROWS).select("lang", "text", "rank")
    sample = sorted((r["rank"], r["lang"], r["cells"]) for r in first.mapInArrow(_sets, "lang string, rank int, cells binary").collect())
    languages = sorted({lang for _, lang, _ in sample})
    sets = [(lang, np.frombuffer(raw, np.int32)) for _, lang, raw in sample]
    return solve(languages, [s for _, s in sets[:LANDMARKS]], sets)


def predicted(text: Column, model: LanguageModel, df: DataFrame) -> Column:
    """struct(lang, score) of every whole text; ``und`` and 0 for NULL and for texts without a letter."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = shared.value.predict(texts.tolist())
            yield pd.DataFrame({"lang": names, "score": scores})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "lang string, score double")(text)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; such rows are never learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang; others are ignored): doc_id, held_out, lang_pred, score.

    Without a model, one is trained from the rows that are not held out. A NULL
    doc_id is not held out. Equal regression values go to the language that is
    first in the alphabet. Repeated rows get equal answers. With nothing to
    learn from every answer is ``und``.
    """
    if model is None:
        model = train(docs.filter(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.withColumn("_found", predicted(F.col("text"), model, docs)).select(
        "doc_id", "held_out", F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score")
    )


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a language; all their columns stay as they are.

    With nothing to learn from, every text with a letter stays.
    """
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return docs.filter(predicted(F.col("text"), model, docs)["lang"] != UNKNOWN)
