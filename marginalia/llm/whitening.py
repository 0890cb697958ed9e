"""Whitening of vectors from exact sums and the exact characteristic polynomial of their scatter.

Tasks add up whole numbers, so the scatter n * sum(x x') - S S' is exact. Its
characteristic polynomial is found modulo primes in tasks and joined by Chinese
remaindering; isolated roots and null-space inverse iteration, again a task per
root, give the components.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import realroots
from marginalia.llm.wholes import NARROW, finite, largest, long_or_null, partial_rows, total, vector_matrix

# Primes whose residues one task finds together.
PRIMES_PER_TASK = 16
# Doubles add whole numbers exactly below this.
EXACT = 1 << 53

ROW_SCHEMA = "vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double"


@dataclass(frozen=True)
class Fit:
    """Count and sums of the fit list, and its components by falling eigenvalue of the covariance."""

    n: int
    sums: list[int]  # of the shifted whole numbers
    components: np.ndarray  # components x width, unit vectors
    scaled: np.ndarray  # the same over the root of the eigenvalue
    explained: list[float]


def gram(matrix: np.ndarray) -> np.ndarray:
    """X'X as Python integers, by products of doubles as long as these are exact."""
    width = matrix.shape[1]
    out = np.zeros((width, width), object)
    square = largest(matrix) ** 2
    if square >= EXACT:
        wide = matrix.astype(object)
        return out + wide.T @ wide
    step = max(1, (EXACT - 1) // max(1, square))
    for a in range(0, len(matrix), step):
        part = matrix[a : a + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64)
    return out


def _sums(width: int, scale: int):
    """Key 0: sums of the rows and of the upper triangle of X'X."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(width)
        n, first, second = 0, np.zeros(width, object), np.zeros(len(upper[0]), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = vector_matrix(batch.column("vector"), width, scale)
            n += len(matrix)
            narrow = matrix.dtype != object and largest(matrix) * len(matrix) < NARROW
            first += (matrix if narrow else matrix.astype(object)).sum(axis=0)
            second += gram(matrix)[upper]
        if n:
            yield partial_rows({0: (n, [*first, *second])})

    return run


def polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """e_0 .. e_d of the characteristic polynomial; each task takes some of the primes."""
    primes = realroots.primes_below(1 << 31, realroots.coefficient_bound(matrix))
    shared = spark.sparkContext.broadcast(matrix)  # width x width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("prime").to_pylist()
            for a in range(0, len(own), PRIMES_PER_TASK):
                some = own[a : a + PRIMES_PER_TASK]
                rests = realroots.residues(shared.value, some)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(rests.tolist(), pa.list_(pa.int64()))], names=["prime", "rest"])

    given = spark.createDataFrame([(q,) for q in primes], "prime long").repartition(-(-len(primes) // PRIMES_PER_TASK))
    rows = given.mapInArrow(run, "prime long, rest array<long>").collect()
    return realroots.joined({row["prime"]: row["rest"] for row in rows})


def components_of(spark: SparkSession, matrix: np.ndarray, roots: list[realroots.Root], count: int) -> list[tuple[int, list[str]]]:
    """(place of the root, unit vector) for the first ``count`` components, in order; a task per root."""
    shared = spark.sparkContext.broadcast(matrix)
    asked, left = [], count
    for place, root in enumerate(roots):
        take = min(root.times, left)
        asked.append((place, str(root.low), str(root.high), root.bits, root.times, take))
        left -= take

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                root = realroots.Root(int(row["low"]), int(row["high"]), row["bits"], row["times"])
                for i, vector in enumerate(realroots.null_vectors(shared.value, root, row["take"])):
                    values = [format(+v, ".40e") for v in vector]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["place"]], pa.int32()), pa.array([i], pa.int32()), pa.array([values])], names=["place", "i", "vector"]
                    )

    given = spark.createDataFrame(asked, "place int, low string, high string, bits int, times int, take int").repartition(max(1, len(asked)))
    rows = given.mapInArrow(run, "place int, i int, vector array<string>").collect()
    return [(row["place"], row["vector"]) for row in sorted(rows, key=lambda row: (row["place"], row["i"]))]


def fit(vectors: DataFrame, count: int, scale: int, shift: int) -> Fit | None:
    """Exact sums and the leading components of ``vectors`` (id, vector); None without rows."""
    spark = vectors.sparkSession
    width = vectors.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return None
    n, sums = total(vectors.mapInArrow(_sums(width, scale), "key int, n long, sums array<string>"))[0]
    first, upper = sums[:width], sums[width:]
    products = np.zeros((width, width), object)
    products[np.triu_indices(width)] = upper
    products = np.where(np.tri(width, k=-1, dtype=bool), products.T, products)
    # The shift of the entries cancels here, so the smaller unshifted ones serve.
    scatter = n * products - np.outer(np.array(first, object), np.array(first, object))
    shifted = [s + n * shift for s in first]
    part = math.gcd(*(int(v) for v in scatter.ravel())) if width else 0
    if not part:
        return Fit(n, shifted, np.zeros((0, width)), np.zeros((0, width)), [])
    scatter = scatter // part
    roots = realroots.top_roots(polynomial(spark, scatter), count)
    found = components_of(spark, scatter, roots, min(count, sum(r.times for r in roots)))
    trace = sum(int(scatter[i, i]) for i in range(width))
    scaled = []
    with decimal.localcontext(decimal.Context(prec=60)):
        for place, vector in found:
            value = roots[place].value * part / (n * n)
            root = (decimal.Decimal(value.numerator) / decimal.Decimal(value.denominator)).sqrt()
            scaled.append([float(decimal.Decimal(v) / root) for v in vector])
    return Fit(
        n,
        shifted,
        np.array([[float(v) for v in vector] for _, vector in found]).reshape(len(found), width),
        np.array(scaled).reshape(len(found), width),
        [float(roots[place].value / Fraction(trace)) for place, _ in found],
    )


def _projected(batch: pa.RecordBatch, model: Fit, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S as whole numbers, and the whitened rows."""
    x = vector_matrix(batch.column("vector"), len(model.sums), scale)
    bound = model.n * (largest(x) + shift) + max([0, *map(abs, model.sums)])
    exact = np.int64 if bound < NARROW else object
    gap = x.astype(exact) * model.n - np.array([s - model.n * shift for s in model.sums], exact)
    centred = (gap / model.n).astype(np.float64)
    return gap, centred @ model.scaled.T


def _rows(shared, scale: int, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.scaled)
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            gap, white = _projected(batch, model, scale, shift)
            if gap.dtype == object or gap.shape[1] * largest(gap) ** 2 >= NARROW:
                gap = gap.astype(object)
            deviation = np.repeat((gap * gap).sum(axis=1), k)
            narrow = deviation.dtype != object
            exact = deviation if narrow else [decimal.Decimal(int(v)) if v < 10**38 else None for v in deviation]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(np.repeat(np.arange(len(gap)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(gap))),
                    pa.array(np.full(len(gap) * k, model.n, np.int64)),
                    long_or_null(deviation),
                    pa.array(exact, pa.int64()).cast(pa.decimal128(38, 0)) if narrow else pa.array(exact, pa.decimal128(38, 0)),
                    pa.array(white.ravel()),
                ],
                names=["vec_id", "component", "n", "deviation", "deviation_exact", "whitened"],
            )

    return run


def _moments(shared, scale: int, shift: int):
    """Per task: sums of the whitened rows and of their products, one row per entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.scaled)
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                white = _projected(batch, model, scale, shift)[1]
                first += white.sum(axis=0)
                second += white.T @ white
        both = np.concatenate([first[:, None], second], axis=1)
        i, j = np.indices(both.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(both.ravel())], names=["i", "j", "s"]
        )

    return run


def whiten(
    vectors: DataFrame, count: int = 8, scale: int = 1024, shift: int = 100_000, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Every vector on the leading components of the covariance of x = floor(scale * c) + shift.

    Rows whose vector is NULL or holds NULL or non-finite entries are left out;
    repeated rows count each, a NULL id is reported as NULL, other columns are
    ignored whatever their names. A vector shorter than the longest ends in
    zeros (x = shift). ``scale`` is a power of two. Components number ``count``
    or as many as have a positive eigenvalue: equal vectors, a single one or an
    empty table give no rows. Components of one multiple eigenvalue are an
    orthonormal basis of its space.

    Result per row and component: vec_id, component, n, deviation (sum of
    (n*x-S)**2; NULL beyond a long), deviation_exact (the same as a decimal,
    NULL beyond 38 digits), whitened, explained, identity_error (as measured on
    all whitened rows).

    The table is read three times by narrow stages (sums, check, result); what
    meets are sums of a size set by the width of the vectors.
    """
    if count < 1:
        raise ValueError("count must be at least 1")
    spark = vectors.sparkSession
    usable = vectors.filter(finite(vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    model = fit(usable, count, scale, shift)
    if model is None or not len(model.scaled):
        return spark.createDataFrame([], ROW_SCHEMA + ", explained double, identity_error double")
    shared = spark.sparkContext.broadcast(model)  # components x width
    held = usable.mapInArrow(_moments(shared, scale, shift), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    k = len(model.scaled)
    both = np.zeros((k, k + 1))
    for row in held:
        both[row["i"], row["j"]] = row["s"] / model.n
    mean = both[:, 0]
    error = float(np.abs(both[:, 1:] - np.outer(mean, mean) - np.eye(k)).max())
    explained = F.element_at(F.array(*map(F.lit, model.explained)), F.col("component"))
    rows = usable.mapInArrow(_rows(shared, scale, shift), ROW_SCHEMA)
    return rows.withColumn("explained", explained).withColumn("identity_error", F.lit(error))
