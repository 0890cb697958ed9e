"""Content hashes and identifiers derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.text import strip_front_matter

HASH_ALGORITHMS = ("sha256", "blake3")


def sha1(text: Column) -> Column:
    return F.sha1(text.cast("binary"))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def short_id(full_sha1: Column, width: int = 8) -> Column:
    """Leading characters of a 40-digit SHA-1; anything else is an error."""
    return F.when(F.length(full_sha1) == 40, F.substring(full_sha1, 1, width)).otherwise(
        F.raise_error(F.lit("a full SHA-1 hex digest has 40 characters"))
    )


def content_hash(text: Column, algorithm: str = "blake3") -> Column:
    """Digest of a text. BLAKE3 needs a native module, so SHA-256 stands in;
    :func:`hash_algorithm_used` says which one a column really holds."""
    if algorithm not in HASH_ALGORITHMS:
        raise ValueError(f"unknown hash algorithm {algorithm!r}")
    return sha256(text)


def hash_algorithm_used(algorithm: str = "blake3") -> Column:
    if algorithm not in HASH_ALGORITHMS:
        raise ValueError(f"unknown hash algorithm {algorithm!r}")
    return F.lit("sha256")


def document_hashes(text: Column) -> Column:
    digest = sha256(text)
    return F.create_map(F.lit("blake3"), digest, F.lit("sha256"), digest)


def chunk_hash(text: Column, skip_front_matter: bool = True) -> Column:
    return content_hash(strip_front_matter(text) if skip_front_matter else text)


def chunk_id(doc_id: Column, chunk_index: Column) -> Column:
    """``<doc>-NNNN`` with a 1-based index; wider numbers keep all digits."""
    return F.format_string("%s-%04d", doc_id, chunk_index.cast("long"))


def embedding_id(doc_id: Column, chunk_index: Column) -> Column:
    """The id form the embeddings command writes."""
    return F.format_string("%s_ch_%04d", doc_id, chunk_index.cast("long"))
