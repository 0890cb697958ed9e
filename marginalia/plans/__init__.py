"""Named queries over the given tables, each with the SQL that checks it."""

from marginalia.plans import corpus, ingest, notation, retrieval, scoring, serving, textual  # noqa: F401  register their queries
from marginalia.plans.registry import CHECK_SQL, QUERIES

__all__ = ["CHECK_SQL", "QUERIES"]
