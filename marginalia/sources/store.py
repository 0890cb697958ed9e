"""Stored tables of a corpus: manifest JSON, documents, vectors, BM25 indexes.

A store never overwrites what a reader may be using. Each write goes to a new
version folder; a row in the ``versions`` table, appended last, publishes it.
Vectors and BM25 indexes grow: a version adds a part and names, in its
snapshot, the parts and the deletions (row positions) that belong to it.
Readers of an older version are not disturbed.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from marginalia.functions.text import TOKENIZER_ID
from marginalia.operators import bm25
from marginalia.operators import postings as blocks_of
from marginalia.operators.bm25 import INDEX_VERSION, Bm25Index
from marginalia.operators.topk import BROADCAST_ROWS
from marginalia.session import shared_folder

# A writer that has not published after this many seconds is taken for dead.
CLAIM_SECONDS = 24 * 3600

DELETED_SCHEMA = "position long, deleted_utc timestamp"
TERM_SCHEMA = "term string, df long, v int, slot int"

MANIFEST_ENTRY = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("slug", T.StringType()),
        T.StructField("orig_name", T.StringType()),
        T.StructField("pages", T.IntegerType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("chunk_count", T.IntegerType()),
        T.StructField("meta_path", T.StringType()),
        T.StructField("doc_path", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("collections", T.ArrayType(T.StringType())),
        T.StructField("source_agent", T.StringType()),
    ]
)
MANIFEST = T.StructType(
    [
        T.StructField("created_utc", T.StringType()),
        T.StructField("updated_utc", T.StringType()),
        T.StructField("docs", T.ArrayType(MANIFEST_ENTRY)),
    ]
)


class StoreError(RuntimeError):
    """A stored table that is missing, incomplete or of another format."""


def _visible(spark: SparkSession, path: str) -> str:
    """Spark does not read files whose names start with ``_`` or ``.``; such a
    file is copied by the file system under another name in the shared folder."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if not name.startswith(("_", ".")):
        return path
    hadoop = spark._jvm.org.apache.hadoop.fs
    settings = spark._jsc.hadoopConfiguration()
    source = hadoop.Path(path)
    target = hadoop.Path(f"{shared_folder(spark)}/read-{uuid.uuid4().hex}-{name.lstrip('_.')}")
    hadoop.FileUtil.copy(
        source.getFileSystem(settings), source, target.getFileSystem(settings), target, False, settings
    )
    return target.toString()


def read_manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest file; entries without the required fields fail."""
    reader = spark.read.schema(MANIFEST).option("multiLine", True).option("mode", "FAILFAST")
    raw = reader.json(_visible(spark, path))
    listed = F.when(F.col("docs").isNotNull(), F.col("docs")).otherwise(F.raise_error(F.lit("manifest without docs")))
    return _complete(raw.select(F.inline(listed)))


def _complete(entries: DataFrame) -> DataFrame:
    complete = F.col("doc_id").isNotNull() & F.col("slug").isNotNull() & F.col("orig_name").isNotNull()
    checked = F.when(complete, F.col("doc_id")).otherwise(
        F.raise_error(F.lit("manifest entry without doc_id, slug or orig_name"))
    )
    return entries.withColumn("doc_id", checked)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Entries as JSON lines in manifest order; NULL fields are left out.

    One entry per line, so that no task writes the whole manifest; read it back
    with ``read_manifest``."""
    manifest.orderBy("slug", "doc_id").write.mode("error").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries that ``write_manifest`` wrote, with the same checks as a manifest file."""
    return _complete(spark.read.schema(MANIFEST_ENTRY).option("mode", "FAILFAST").json(path))


def _versions(spark: SparkSession, root: str) -> int | None:
    try:
        return spark.read.parquet(f"{root}/versions").agg(F.max("version")).first()[0]
    except AnalysisException:
        return None


def current(spark: SparkSession, root: str) -> str:
    """Folder of the published version."""
    version = _versions(spark, root)
    if version is None:
        raise StoreError(f"nothing is stored at {root}")
    return f"{root}/v={version}"


@dataclass(frozen=True)
class Snapshot:
    """What one version of a growing store consists of."""

    version: int
    parts: list[int]
    deletions: list[int]
    figures: dict


def _claim(spark: SparkSession, root: str, version: int):
    """The right to write a version: a file that names its writer.

    A claim older than CLAIM_SECONDS without a published version belongs to a
    dead writer. Moving it aside decides which of several heirs goes on.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    claim = hadoop.Path(f"{root}/claims/v={version}")
    files = claim.getFileSystem(spark._jsc.hadoopConfiguration())
    owner = f"{spark.sparkContext.applicationId} {uuid.uuid4().hex}"
    for _ in range(2):
        try:
            out = files.create(claim, False)
        except Py4JJavaError:
            age = time.time() - files.getFileStatus(claim).getModificationTime() / 1000 if files.exists(claim) else 0.0
            if age < CLAIM_SECONDS:
                break
            aside = hadoop.Path(f"{root}/claims/dead-{uuid.uuid4().hex}")
            if not files.rename(claim, aside):
                break
            continue
        out.write(bytearray(owner, "utf-8"))
        out.close()
        return files, claim
    raise StoreError(f"version {version} of {root} is being written by another writer")


def _publish(spark: SparkSession, root: str, write) -> str | None:
    """Write and publish the next version; ``write(folder, version)`` may return
    False to publish nothing. What a failed or dead writer left is removed."""
    version = (_versions(spark, root) or 0) + 1
    folder = f"{root}/v={version}"
    files, claim = _claim(spark, root, version)
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    try:
        files.delete(place, True)
        wanted = write(folder, version)
    except BaseException:
        files.delete(place, True)
        files.delete(claim, False)
        raise
    if wanted is False:
        files.delete(place, True)
        files.delete(claim, False)
        return None
    spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return folder


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot | None:
    """Parts of a published version (the last one by default); None if nothing is stored."""
    version = _versions(spark, root) if version is None else version
    if version is None:
        return None
    row = spark.read.parquet(f"{root}/snapshots/v={version}").first().asDict()
    return Snapshot(version, row.pop("parts"), row.pop("deletions"), row)


def _write_snapshot(spark: SparkSession, root: str, version: int, parts: list[int], deletions: list[int], **figures) -> None:
    row = spark.createDataFrame([(parts, deletions)], "parts array<int>, deletions array<int>")
    row.withColumns({k: F.lit(v) for k, v in figures.items()}).coalesce(1).write.mode("overwrite").parquet(f"{root}/snapshots/v={version}")


def _parts(spark: SparkSession, root: str, numbers: list[int], schema: str | None = None) -> DataFrame:
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", len(numbers) > 1)
    return reader.parquet(*[f"{root}/v={n}" for n in numbers])


def deleted_rows(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """position, deleted_utc of a version's deleted rows; the first deletion counts."""
    held = snapshot(spark, root, version)
    if held is None or not held.deletions:
        return spark.createDataFrame([], DELETED_SCHEMA)
    rows = spark.read.schema(DELETED_SCHEMA).parquet(*[f"{root}/deleted/v={n}" for n in held.deletions])
    return rows.groupBy("position").agg(F.min("deleted_utc").alias("deleted_utc"))


def part_deletions(spark: SparkSession, root: str, version: int) -> DataFrame | None:
    """Rows a version deleted itself, None if it deleted none."""
    if version not in snapshot(spark, root, version).deletions:
        return None
    return spark.read.schema(DELETED_SCHEMA).parquet(f"{root}/deleted/v={version}")


def part_rows(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Rows a version of a vector store added itself."""
    held = snapshot(spark, root, version)
    if version in held.parts:
        return _parts(spark, root, [version]).drop("v")
    return _parts(spark, root, held.parts).drop("v").limit(0)


def without(rows: DataFrame, dead: DataFrame, key: str) -> DataFrame:
    """Rows whose position was not deleted. The deletions are counted: a short
    list is broadcast, so the rows stay where they are."""
    gone = dead.select(F.col("position").alias(key))
    return rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, key, "left_anti")


def _write_deleted(deleted: DataFrame, root: str, version: int) -> None:
    deleted.select("position", "deleted_utc").write.mode("overwrite").parquet(f"{root}/deleted/v={version}")


def write_documents(documents: DataFrame, root: str, by: str = "collection") -> str:
    """Documents or chunks, partitioned so that slices prune by folder."""
    return _publish(documents.sparkSession, root, lambda folder, _: documents.write.partitionBy(by).parquet(folder))


def _vector_part(vectors: DataFrame, root: str, old: Snapshot | None, deleted: DataFrame | None, stamp: int) -> str | None:
    """Publish vectors as one more part of ``old``, or alone; dimensions are checked on the way out."""
    spark = vectors.sparkSession
    width = F.size("embedding")

    def write(folder: str, version: int) -> bool:
        seen = Observation()
        shape = vectors.observe(seen, F.min(width).alias("low"), F.max(width).alias("high"), F.count(F.lit(1)).alias("n"))
        shape.write.partitionBy("agent").parquet(folder)
        low, high, n = (seen.get[name] for name in ("low", "high", "n"))
        if n == 0 and deleted is None:
            return False
        dim = old.figures.get("dim") if old is not None else None
        if n and low != high:
            raise StoreError(f"vectors of {low} and {high} dimensions cannot share an index")
        if n and dim is not None and low != dim:
            raise StoreError(f"vectors of {low} dimensions cannot join an index of {dim}")
        if deleted is not None:
            _write_deleted(deleted, root, version)
        parts = [*(old.parts if old is not None else []), *([version] if n else [])]
        deletions = [*(old.deletions if old is not None else []), *([version] if deleted is not None else [])]
        _write_snapshot(spark, root, version, parts, deletions, dim=low if n else dim, stamp=stamp)
        return True

    return _publish(spark, root, write)


def write_vectors(vectors: DataFrame, root: str, stamp: int = -1) -> str | None:
    """Vectors partitioned by agent, as a version of their own. All must have
    one dimension; an empty input publishes nothing. ``stamp`` is a number of the
    caller's that the snapshot keeps, such as that of a streaming batch."""
    return _vector_part(vectors, root, None, None, stamp)


def append_vectors(spark: SparkSession, root: str, fresh: DataFrame, deleted: DataFrame | None = None, stamp: int = -1) -> str | None:
    """A version with one more part, and with more deleted rows (position,
    deleted_utc). What is stored already is neither read nor written again."""
    old = snapshot(spark, root)
    if old is None:
        raise StoreError(f"nothing is stored at {root}")
    return _vector_part(fresh, root, old, deleted, stamp)


def read_vectors(spark: SparkSession, root: str, agent: str | None = None, check: bool = True, version: int | None = None) -> DataFrame:
    """Published vectors of one agent (pruned to its folder) or of all, deleted ones too.

    The check reads the whole index: positions must be 0..n-1, each once, and
    dimensions equal. Searches skip it; writing has checked dimensions before."""
    held = snapshot(spark, root, version)
    if held is None:
        raise StoreError(f"nothing is stored at {root}")
    vectors = _parts(spark, root, held.parts).drop("v")
    if agent is not None:
        vectors = vectors.filter(F.col("agent") == agent)
    if not check:
        return vectors
    # Distinct positions are counted without meeting in one task: Spark groups by (agent, position) first.
    bad = (
        vectors.groupBy("agent")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("embedding_index").alias("distinct"),
            F.min("embedding_index").alias("first"),
            F.max("embedding_index").alias("last"),
            F.min(F.size("embedding")).alias("low"),
            F.max(F.size("embedding")).alias("high"),
        )
        .filter("n <> last + 1 OR first <> 0 OR n <> distinct OR low <> high")
        .first()
    )
    if bad is not None:
        raise StoreError(f"index of agent {bad['agent']} is inconsistent")
    return vectors


def _bm25_part(
    index: Bm25Index, root: str, old: Snapshot | None, deleted: DataFrame | None, tokenizer: str, index_version: int, stamp: int
) -> str | None:
    """Blocks, terms and keys of one part, and figures of all parts together."""
    spark = index.docs.sparkSession

    def write(folder: str, version: int) -> bool:
        blocks_of.write_blocks(index.blocks if index.blocks is not None else blocks_of.block_rows(index.docs), f"{root}/blocks/v={version}")
        blocks = spark.read.schema(blocks_of.BLOCK_SCHEMA).parquet(f"{root}/blocks/v={version}")
        frequencies, figures = bm25.block_statistics(blocks)
        n = figures.first()["n_docs"]
        if n == 0 and deleted is None and old is None:
            return False
        frequencies.repartition("slot").sortWithinPartitions("slot", "term").write.mode("overwrite").partitionBy("slot").parquet(f"{root}/terms/v={version}")
        index.docs.select("bm25_index", "chunk_id", "doc_id").write.mode("overwrite").parquet(f"{root}/keys/v={version}")
        if deleted is not None:
            _write_deleted(deleted, root, version)
        parts = [*(old.parts if old is not None else []), version]
        deletions = [*(old.deletions if old is not None else []), *([version] if deleted is not None else [])]
        if old is not None:
            before = spark.createDataFrame([(old.figures["n_docs"], old.figures["avgdl"])], "n_docs long, avgdl double")
            figures = bm25.joined_figures(before, figures)
        _, meta = bm25.term_statistics(_frequencies(spark, root, parts), figures)
        row = meta.first()
        _write_snapshot(
            spark, root, version, parts, deletions, n_docs=row["n_docs"], avgdl=row["avgdl"], avg_idf=row["avg_idf"], tokenizer=tokenizer, index_version=index_version, stamp=stamp
        )
        return True

    return _publish(spark, root, write)


def _frequencies(spark: SparkSession, root: str, parts: list[int]) -> DataFrame:
    """slot, term, df over all parts; a filter on slot or term reaches the scans."""
    return _parts(spark, f"{root}/terms", parts, TERM_SCHEMA).groupBy("slot", "term").agg(F.sum("df").alias("df"))


def write_bm25(index: Bm25Index, root: str, stamp: int = -1) -> str | None:
    """An index as a version of its own. Blocks and terms lie in folders by a
    hash of the term and sorted by term, so a search reads little more than its terms."""
    gone = index.docs.filter(F.col("deleted_utc").isNotNull()).select(F.col("bm25_index").alias("position"), "deleted_utc")
    made_by = index.meta.select("tokenizer", "version").first()
    return _bm25_part(index, root, None, gone if not gone.isEmpty() else None, made_by["tokenizer"], made_by["version"], stamp)


def append_bm25(spark: SparkSession, root: str, chunks: DataFrame, deleted: DataFrame | None = None, stamp: int = -1) -> str | None:
    """A version with the blocks of chunks(bm25_index, chunk_id, doc_id, text) as one
    more part and more deleted rows. Frequencies add up; no old text or posting is read."""
    old = snapshot(spark, root)
    if old is None:
        raise StoreError(f"nothing is stored at {root}")
    docs = bm25.forward_side(chunks)
    fresh = Bm25Index(docs, bm25.document_frequencies(docs), bm25.corpus_figures(docs))
    return _bm25_part(fresh, root, old, deleted, old.figures["tokenizer"], old.figures["index_version"], stamp)


def read_bm25(spark: SparkSession, root: str, version: int | None = None) -> Bm25Index | None:
    """Published index, None if there is none; another format is an error."""
    held = snapshot(spark, root, version)
    if held is None:
        return None
    made_by = held.figures["tokenizer"], held.figures["index_version"]
    if made_by != (TOKENIZER_ID, INDEX_VERSION):
        raise StoreError(f"index at {root} was built with {made_by[0]} version {made_by[1]}")
    dead = deleted_rows(spark, root, held.version)
    keys = _parts(spark, f"{root}/keys", held.parts, "bm25_index long, chunk_id string, doc_id string, v int").drop("v")
    docs = keys.join(dead.withColumnRenamed("position", "bm25_index"), "bm25_index", "left")
    figures = {k: held.figures[k] for k in ("n_docs", "avgdl", "avg_idf")}
    meta = spark.createDataFrame(
        [(*figures.values(), *made_by)], "n_docs long, avgdl double, avg_idf double, tokenizer string, version int"
    )
    terms = bm25.with_idf(_frequencies(spark, root, held.parts), F.lit(held.figures["n_docs"]), F.lit(held.figures["avg_idf"]))
    blocks = _parts(spark, f"{root}/blocks", held.parts, blocks_of.BLOCK_SCHEMA.replace("slot int", "v int, slot int"))
    return Bm25Index(docs, terms, meta, blocks, dead.select(F.col("position").alias("bm25_index")))


def read_postings(spark: SparkSession, root: str) -> DataFrame:
    index = read_bm25(spark, root)
    if index is None:
        raise StoreError(f"nothing is stored at {root}")
    return blocks_of.flat_postings(index.blocks)


def publish_pair(spark: SparkSession, root: str, vectors: str, lexical: str | None) -> None:
    """Name the versions of both indexes that belong together, after both are written."""
    held = (snapshot(spark, vectors).version, None if lexical is None else snapshot(spark, lexical).version)
    row = spark.createDataFrame([held], "vectors int, bm25 int").coalesce(1)
    _publish(spark, root, lambda folder, _: row.write.parquet(folder))


def published_pair(spark: SparkSession, root: str) -> tuple[int | None, int | None]:
    """Versions that belong together; (None, None) where none were named: the last of each."""
    version = _versions(spark, root)
    if version is None:
        return None, None
    row = spark.read.schema("vectors int, bm25 int").parquet(f"{root}/v={version}").first()
    return row["vectors"], row["bm25"]
