"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query runs to completion into the no-op sink, so nothing is pruned that
a real sink would need. One short query warms up the JVM and Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

from marginalia.plans import QUERIES
from marginalia.session import local_session

HEADLINE = (
    "dense_topk_batched",
    "dense_tombstoned",
    "bm25_terms",
    "bm25_topk",
    "hybrid_rrf",
    "eval_aggregate",
    "baseline_gate",
    "tokenize_docs",
    "chunk_documents",
    "chunk_provenance",
    "heading_stack",
    "format_documents",
    "agent_filter",
    "manifest_merge",
    "slug_resolution",
    "incremental_apply",
    "html_to_text",
    "route_files",
    "formula_merge",
    "music_abc",
    "phrase_segments",
    "context_format",
    "tool_call_parse",
    "rerank_pool",
    "chunk_trace",
    "bm25_append_stats",
    "music_description",
    "tool_results",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["dense_topk"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spent = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
