"""The corpus pipeline: language, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginalia.llm import decontaminate, language, ngramjoin, packing, secrets
from marginalia.llm.common import kept, table
from marginalia.session import apply_settings


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language (NULL, or no letter) go."""
    return language.known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group whose five-word runs are 80 percent alike, the smallest doc_id stays."""
    return ngramjoin.one_of_each(docs, 5, 80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item (or a whole shorter one) go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 4,096 words without two pieces of one source or of equal texts."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Kernel scores and sequential packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    apply_settings(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = kept(docs, name)
    return docs
