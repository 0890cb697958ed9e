"""Staging folder to corpus, as one Structured Streaming query.

The stream's checkpoint replaces a lock and a list of handled files. Each
micro-batch owns one partition folder of every log it writes and overwrites it
when retried, so a lost driver or executor never doubles a document.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from marginalia.functions import hashing, text
from marginalia.operators import routing
from marginalia.operators.dense import query_blocks
from marginalia.operators.topk import last_per_key
from marginalia.session import checkpointed
from marginalia.sources.files import DIRECT_SUFFIXES, PARSED_SUFFIXES, split_by_size
from marginalia.sources.parsers import TYPED, parse_files
from marginalia.streaming.settled import SettledFiles

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"

# Paths handed to one read; a longer backlog is worked off block by block.
PATH_BLOCK = 10_000

# Errors that a batch's report names.
REPORTED_ERRORS = 20

# Numbers from here on belong to OCR passes, those below to batches of the stream.
OCR_BATCHES = 1_000_000_000_000

DOCUMENT_SCHEMA = (
    "doc_id string, slug string, source string, collection string, file_sha1 string, content_hash string, "
    f"markdown string, typed {TYPED}, status string, error string, batch long"
)


def staged_files(spark: SparkSession, root: str) -> DataFrame:
    """Supported files below the staging root, as a stream. The extension test
    repeats in the router, which also sees unsupported ones."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .load(root)
    )


def documents_log(spark: SparkSession, corpus: str) -> DataFrame:
    """All document rows ever written, with their batch."""
    try:
        return spark.read.schema(DOCUMENT_SCHEMA).parquet(f"{corpus}/documents")
    except AnalysisException:
        return spark.createDataFrame([], DOCUMENT_SCHEMA)


def current_documents(spark: SparkSession, corpus: str) -> DataFrame:
    """Latest successful row per slug; a re-ingest supersedes the old id."""
    good = documents_log(spark, corpus).filter("status = 'success'")
    return last_per_key(good, ["slug"], [F.col("batch"), F.col("doc_id")])


RUN_SCHEMA = "files long, routes map<string,long>, documents long, succeeded long, failed long, collisions long, errors array<string>, batch long"


def ingest_batch(
    files: DataFrame, batch: int, corpus: str, ocr_mode: str = "off", ocr=None, progress: Callable[[dict], None] | None = None
) -> None:
    """Route one micro-batch and append its documents, routes and figures to the logs.

    The figures are observed while the logs are written, so they cost no other
    pass; ``progress`` is called with them once the batch is done.
    """
    spark = files.sparkSession
    measured = files.withColumn("suffix", text.file_suffix(F.col("path"))).withColumn(
        "name", F.element_at(F.split("path", "/"), -1)
    )
    # The size test reaches the source, so contents beyond a Spark value's limit are never read.
    small, large = split_by_size(measured.filter(F.col("suffix").isin(*PARSED_SUFFIXES, *DIRECT_SUFFIXES)))
    read = parse_files(small, ocr_mode, ocr).withColumn("markdown", text.normalize_markdown(text.join_blocks(F.col("elements"))))
    # Parsed (and OCRed) once, although the routes need it before the documents do.
    parsed = checkpointed(read.select("path", "name", "file_sha1", "markdown", "typed", "status", "error"))
    lengths = parsed.select("path", F.coalesce(F.length("markdown"), F.lit(0)).alias("text_length"))
    sized = measured.select("path", "length").join(lengths, "path", "left").fillna(0, ["text_length"])
    earlier = documents_log(spark, corpus).filter((F.col("batch") < batch) & (F.col("status") == "success"))
    routes = routing.route(sized, earlier)
    routed, written = Observation(), Observation()
    per_route = [F.count_if(F.col("route") == name).alias(name) for name in routing.ROUTES]
    routes.select("path", "collection", "name", "slug", "route").observe(routed, F.count(F.lit(1)).alias("files"), *per_route).write.mode(
        "overwrite"
    ).parquet(f"{corpus}/routes/batch={batch}")
    chosen = routes.filter(F.col("route").isin("parse", "direct")).select("path", "collection", "slug")
    documents = parsed.join(chosen, "path").select(
        hashing.sha1(F.col("markdown")).alias("doc_id"),
        "slug",
        F.col("name").alias("source"),
        "collection",
        "file_sha1",
        hashing.content_hash(F.col("markdown")).alias("content_hash"),
        "markdown",
        "typed",
        "status",
        "error",
    )
    failed = large.join(routes.select("path", "collection", "slug"), "path").select(
        F.lit(None).cast("string").alias("doc_id"),
        "slug",
        F.col("name").alias("source"),
        "collection",
        *[F.lit(None).cast("string").alias(c) for c in ("file_sha1", "content_hash", "markdown")],
        F.lit(None).cast(TYPED).alias("typed"),
        "status",
        "error",
    )
    good = F.col("status") == "success"
    told = documents.unionByName(failed).observe(
        written, F.count(F.lit(1)).alias("documents"), F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed")
    )
    told.write.mode("overwrite").parquet(f"{corpus}/documents/batch={batch}")
    log = spark.read.schema(DOCUMENT_SCHEMA).parquet(f"{corpus}/documents/batch={batch}")
    # Two files of one content share an id; a few errors stand for all in the report.
    double = log.filter(good).groupBy("doc_id").count().filter("count > 1").count()
    errors = [f"{row['source']}: {row['error']}" for row in log.filter(~good).orderBy("source").limit(REPORTED_ERRORS).collect()]
    figures = {
        "files": routed.get["files"],
        "routes": {name: routed.get[name] for name in routing.ROUTES},
        **{name: written.get[name] for name in ("documents", "succeeded", "failed")},
        "collisions": double,
        "errors": errors,
    }
    row = spark.createDataFrame([tuple(figures.values())], RUN_SCHEMA.removesuffix(", batch long"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{corpus}/runs/batch={batch}")
    if progress is not None:
        progress({**figures, "batch": batch})


def run_totals(spark: SparkSession, corpus: str) -> DataFrame:
    """One row: what all batches so far took, and the same as text."""
    runs = spark.read.schema(RUN_SCHEMA).parquet(f"{corpus}/runs")
    counts = ("files", "documents", "succeeded", "failed", "collisions")
    routes = [F.coalesce(F.sum(F.col("routes")[name]), F.lit(0)).alias(name) for name in routing.ROUTES]
    total = runs.agg(F.count(F.lit(1)).alias("batches"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts], *routes)
    parts = [F.concat(F.col(name).cast("string"), F.lit(f" {name}")) for name in ("files", "succeeded", "failed", "collisions")]
    ways = [F.when(F.col(name) > 0, F.concat(F.lit(f"{name} "), F.col(name).cast("string"))) for name in routing.ROUTES]
    return total.withColumn("summary", F.concat(F.concat_ws(", ", *parts), F.lit(" ("), F.concat_ws(", ", *ways), F.lit(")")))


def settled_files(spark: SparkSession, root: str, plans: str, settle: float) -> DataFrame:
    """Names of files at collection/file that nothing has changed for ``settle`` seconds, as a stream."""
    spark.dataSource.register(SettledFiles)
    return spark.readStream.format("settled_files").option("plans", plans).option("settle", str(settle)).load(root)


def with_contents(names: DataFrame) -> DataFrame:
    """The named files as the binary source reads them, block by block of names."""
    spark = names.sparkSession
    parts = [spark.read.format("binaryFile").load([row["path"] for row in block]) for block in query_blocks(names.select("path"), PATH_BLOCK)]
    if not parts:
        return spark.createDataFrame([], FILE_SCHEMA)
    return reduce(DataFrame.unionAll, parts)


def run_staging(
    spark: SparkSession, staging: str, corpus: str, checkpoint: str, ocr_mode: str = "off", ocr=None, settle: float | None = None,
    progress: Callable[[dict], None] | None = None,
) -> StreamingQuery:
    """Work off what is staged now, then stop; schedule it or loop as needed.

    ``settle`` leaves files alone until nothing has changed them for so many
    seconds and takes only those at collection/file; without it every file
    below the folder is taken as the binary source lists it. ``progress`` gets
    the figures of each finished batch.
    """
    if settle is None:
        files, contents = staged_files(spark, staging), lambda batch: batch
    else:
        files, contents = settled_files(spark, staging, f"{corpus}/plans", settle), with_contents
    return (
        files.writeStream.foreachBatch(lambda batch, number: ingest_batch(contents(batch), number, corpus, ocr_mode, ocr, progress))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def retry_ocr(spark: SparkSession, corpus: str, batch: int, ocr) -> None:
    """Second pass over files that waited for OCR and have no text yet; junk
    without a PDF head is left in the routes log as it is. Passes are numbered
    from OCR_BATCHES on, so no stream batch can meet their folders. A rerun
    goes on after the blocks of files that are already written."""
    done = documents_log(spark, corpus).filter("status = 'success'").select("collection", F.col("source").alias("name"))
    waiting = (
        spark.read.parquet(f"{corpus}/routes")
        .filter("route = 'ocr'")
        .join(done, ["collection", "name"], "left_anti")
        .select("path")
        .distinct()
    )
    for block in query_blocks(waiting, PATH_BLOCK):
        files = spark.read.format("binaryFile").load([row["path"] for row in block])
        measured = files.filter(routing.is_pdf(F.col("content"))).select(
            "*", text.file_suffix(F.col("path")).alias("suffix"), F.element_at(F.split("path", "/"), -1).alias("name")
        )
        parsed = parse_files(measured, "on", ocr).withColumn(
            "markdown", text.normalize_markdown(text.join_blocks(F.col("elements")))
        )
        parsed.select(
            hashing.sha1(F.col("markdown")).alias("doc_id"),
            routing.staged_slug(F.col("name")).alias("slug"),
            F.col("name").alias("source"),
            F.element_at(F.split("path", "/"), -2).alias("collection"),
            "file_sha1",
            hashing.content_hash(F.col("markdown")).alias("content_hash"),
            "markdown",
            "typed",
            "status",
            "error",
        ).write.mode("append").parquet(f"{corpus}/documents/batch={OCR_BATCHES + batch}")
