"""Corpus, side files and run reports as trees of files in a place that all workers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.sources.tree import NAME, FileTree

# Names of a document's music files by format.
MUSIC_FILES = {"musicxml": "music.musicxml", "abc": "music.abc", "midi": "music.mid"}
# Suffixes of formula files by format.
FORMULA_SUFFIXES = {"latex": "tex", "mathml": "mathml"}


def write_tree(files: DataFrame, root: str, dry_run: bool = False) -> None:
    """Write files(relative_path, content) below ``root``, a path or a URI.

    Either all files of the call appear, each whole, or none; files that were
    there under the same names are replaced. Two files of one name are an error.
    """
    if dry_run:
        return
    spark = files.sparkSession
    # One name written twice would make the result depend on the order of moves; only names are read here.
    double = files.groupBy("relative_path").count().filter("count > 1").first()
    if double is not None:
        raise ValueError(f"two files of one job are named {double['relative_path']}")
    spark.dataSource.register(FileTree)
    content = F.col("content") if dict(files.dtypes)["content"] == "binary" else F.encode(F.col("content"), "UTF-8")
    files.select(F.col("relative_path"), content.alias("content")).write.format(NAME).mode("append").option("path", root).save()


def _files(rows: DataFrame, folder: Column, name: Column) -> DataFrame:
    content = F.col("content") if dict(rows.dtypes)["content"] == "binary" else F.encode(F.col("content"), "UTF-8")
    known = rows.withColumns({"_folder": folder, "_name": name}).filter(F.col("_name").isNotNull() & F.col("content").isNotNull())
    return known.select(F.concat_ws("/", "_folder", "_name").alias("relative_path"), content.alias("content"))


def music_files(outputs: DataFrame) -> DataFrame:
    """outputs(collection, slug, format, content): music files beside their document; other formats are left out."""
    names = F.create_map(*[F.lit(x) for pair in MUSIC_FILES.items() for x in pair])
    return _files(outputs, F.concat_ws("/", "collection", "slug"), F.try_element_at(names, F.col("format")))


def formula_files(outputs: DataFrame) -> DataFrame:
    """outputs(collection, slug, format, formula_id, content): one file per formula and format in ``formulas/``."""
    suffixes = F.create_map(*[F.lit(x) for pair in FORMULA_SUFFIXES.items() for x in pair])
    suffix = F.try_element_at(suffixes, F.col("format"))
    return _files(outputs, F.concat_ws("/", "collection", "slug", F.lit("formulas")), F.concat("formula_id", F.lit("."), suffix))


def run_files(run_id: str, figures: DataFrame, lines: DataFrame) -> DataFrame:
    """Both reports of an evaluation run: ``<run>.json`` from the one row of
    figures, ``<run>.md`` from lines(place, line), a report of bounded length."""
    data = figures.limit(1).select(F.lit(f"{run_id}.json").alias("relative_path"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("content"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("place", "line"))), lambda x: x["line"])
    text = lines.agg(F.concat(F.array_join(ordered, "\n"), F.lit("\n")).alias("content"))
    return data.unionByName(text.select(F.lit(f"{run_id}.md").alias("relative_path"), "content"))
