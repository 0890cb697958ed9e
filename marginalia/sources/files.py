"""Document folders as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.text import file_suffix

# Extensions of the two ingest paths.
PARSED_SUFFIXES = (".pdf", ".epub")
DIRECT_SUFFIXES = (".md", ".docx", ".doc")

# A Spark value holds at most 2 GB; larger files are listed as failed.
MAX_BYTES = 2_000_000_000


def read_files(spark: SparkSession, folder: str, suffixes=PARSED_SUFFIXES, recursive: bool = False) -> DataFrame:
    """path, name, suffix, length, modified, content of supported files.

    The content column is read only where a plan uses it, so listings and
    size filters stay cheap. A missing folder is an error.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    )
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        file_suffix(F.col("path")).alias("suffix"),
        "length",
        F.col("modificationTime").alias("modified"),
        "content",
    ).filter(F.col("suffix").isin(*suffixes))


def listing(files: DataFrame) -> DataFrame:
    """Names without contents, by case-folded name."""
    return files.select("path", "name", "suffix", "length").orderBy(F.lower("name"), "path")


def split_by_size(files: DataFrame, limit: int = MAX_BYTES) -> tuple[DataFrame, DataFrame]:
    """(readable, too large): the second side carries status and error."""
    small = files.filter(F.col("length") <= limit)
    large = files.filter(F.col("length") > limit).select(
        "path", "name", "length", F.lit("failed").alias("status"), F.lit("file too large").alias("error")
    )
    return small, large


def file_sha1(content: Column) -> Column:
    return F.sha1(content)


def read_chunk_files(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk files below a corpus folder: path, slug, file text."""
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "ch_*.md")
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("file"))
    )
    return files.withColumn("slug", F.element_at(F.split("path", "/"), -3))


def grep(spark: SparkSession, folder: str, pattern: str, limit: int = 50, glob: str = "*") -> DataFrame:
    """First matching lines by file and line number; the limit is the feature."""
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\n")).alias("i", "line"))
    )
    return (
        files.filter(F.col("line").rlike(pattern))
        .select("path", (F.col("i") + 1).alias("line_number"), "line")
        .orderBy("path", "line_number")
        .limit(limit)
    )
