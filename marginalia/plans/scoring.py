"""Evaluation of dense retrieval: one item per label, hits share the label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import render
from marginalia.operators import evaluation as ev
from marginalia.operators.dense import search_dense
from marginalia.plans import relations as rel
from marginalia.plans.registry import query, table
from marginalia.session import checkpointed

TOP_K = 10


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as items. By label modulo 4: no citation, a page, a range, a section."""
    labels = table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("item_id")).distinct()
    kind = F.col("item_id") % 4
    page = F.when(kind.isin(1, 2), F.col("item_id") * 3)
    return labels.select(
        "item_id",
        F.format_string("what is\nlabel %d | like", "item_id").alias("query"),
        page.alias("expected_page_start"),
        F.when(kind == 1, page).when(kind == 2, page + 20).alias("expected_page_end"),
        F.when((kind == 3) | (F.col("item_id") == 6), "S1").alias("expected_section"),
    )


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("long").alias("item_id"), F.col("vec_id").alias("doc_id")
    )


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    parity = F.when(F.col("item_id") % 2 == 0, "even").otherwise("odd")
    size = F.when(F.col("item_id") < 9, "small").otherwise("large")
    return _items(spark, sf_dir).select("item_id", F.explode(F.array(parity, size)).alias("tag"))


def _retrieved(spark: SparkSession, sf_dir: str, without_label: int | None = None) -> DataFrame:
    vectors = rel.vectors(spark, sf_dir)
    asked = rel.label_queries(spark, sf_dir)
    if without_label is not None:
        vectors = vectors.filter(F.col("label") != without_label)
    found = search_dense(vectors, asked, TOP_K)
    return found.select(
        F.col("query_id").alias("item_id"),
        "rank",
        F.col("embedding_index").alias("doc_id"),
        (F.col("embedding_index") % 7).alias("chunk_index"),
        (F.col("embedding_index") % 30).alias("page_start"),
        (F.col("embedding_index") % 30 + F.col("embedding_index") % 3).alias("page_end"),
        F.concat(F.lit("S"), (F.col("embedding_index") % 3).cast("string")).alias("section_heading"),
    )


def _results(spark: SparkSession, sf_dir: str, without_label: int | None = None) -> DataFrame:
    return ev.item_results(
        _items(spark, sf_dir), _retrieved(spark, sf_dir, without_label), _expected(spark, sf_dir)
    )


ITEMS_SQL = f"""
{rel.CENTROID_SQL}, {rel.DISTANCE_SQL},
items AS (
  SELECT label AS item_id, 'what is' || chr(10) || 'label ' || label || ' | like' AS query,
         CASE WHEN label % 4 IN (1, 2) THEN label * 3 END AS p1,
         CASE label % 4 WHEN 1 THEN label * 3 WHEN 2 THEN label * 3 + 20 END AS p2,
         CASE WHEN label % 4 = 3 OR label = 6 THEN 'S1' END AS sec
  FROM (SELECT DISTINCT label FROM embeddings)
)"""


def _run_sql(where: str = "true", tail: str = "") -> str:
    return f"""
hits{tail} AS (
  SELECT query_id AS item_id, vec_id, label = query_id AS hit,
         row_number() OVER (PARTITION BY query_id ORDER BY exact, vec_id) AS rank
  FROM dist WHERE {where} QUALIFY rank <= 10
),
res{tail} AS (
  SELECT i.*, (SELECT min(rank) FROM hits{tail} h WHERE h.item_id = i.item_id AND hit) AS first_hit_rank,
         coalesce((SELECT sum(1 / log2(rank + 1)) FROM hits{tail} h WHERE h.item_id = i.item_id AND hit), 0)
         / (SELECT sum(1 / log2(r + 1)) FROM range(1, 11) t(r)
            WHERE r <= (SELECT count(*) FROM embeddings e WHERE e.label = i.item_id)) AS ndcg,
         (SELECT vec_id FROM hits{tail} h WHERE h.item_id = i.item_id AND rank = 1) AS top
  FROM items i
),
cited{tail} AS (
  SELECT *, CASE WHEN p1 IS NULL AND sec IS NULL THEN NULL
    WHEN (p1 IS NULL OR (top % 30 <= p2 AND p1 <= top % 30 + top % 3)) AND (sec IS NULL OR 'S' || (top % 3) = sec) THEN 1.0
    ELSE 0.0 END AS cit FROM res{tail}
),
tagged{tail} AS (
  SELECT unnest([CASE WHEN item_id % 2 = 0 THEN 'even' ELSE 'odd' END, CASE WHEN item_id < 9 THEN 'small' ELSE 'large' END]) AS tag,
         first_hit_rank FROM res{tail}
),
agg{tail} AS (
  SELECT count(*) AS n_items, avg((coalesce(first_hit_rank, 99) <= 1)::INT) AS recall_at_1,
         avg((coalesce(first_hit_rank, 99) <= 3)::INT) AS recall_at_3, avg((coalesce(first_hit_rank, 99) <= 5)::INT) AS recall_at_5,
         avg((coalesce(first_hit_rank, 99) <= 10)::INT) AS recall_at_10, avg(coalesce(1.0::DOUBLE / first_hit_rank, 0)) AS mrr,
         avg(ndcg) AS ndcg_at_10, avg(cit::DOUBLE) AS citation_accuracy, count(cit) AS n_citation_items FROM cited{tail}
),
tags{tail} AS (
  SELECT tag, avg((coalesce(first_hit_rank, 99) <= 5)::INT) AS recall_at_5, avg(coalesce(1.0::DOUBLE / first_hit_rank, 0)) AS mrr,
         count(*) AS n_items, count(*) < 2 AS low_sample FROM tagged{tail} GROUP BY tag
),
metrics{tail} AS (
  SELECT '' AS tag, ordinal, metric, value FROM (
    SELECT unnest(range(0, 7)) AS ordinal,
      unnest(['recall_at_1','recall_at_3','recall_at_5','recall_at_10','mrr','ndcg_at_10','citation_accuracy']) AS metric,
      unnest([recall_at_1, recall_at_3, recall_at_5, recall_at_10, mrr, ndcg_at_10, citation_accuracy]) AS value FROM agg{tail})
  UNION ALL SELECT tag, 100, 'per_tag.' || tag || '.recall_at_5', recall_at_5 FROM tags{tail}
  UNION ALL SELECT tag, 101, 'per_tag.' || tag || '.mrr', mrr FROM tags{tail}
)"""


def _results_sql() -> str:
    return f"{ITEMS_SQL}, {_run_sql()}"


@query(
    "eval_first_hit",
    f"WITH {_results_sql()} SELECT item_id, coalesce(first_hit_rank, 0) AS first_hit_rank, round(ndcg, 6) AS ndcg FROM res",
)
def eval_first_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir).select(
        "item_id",
        F.coalesce("first_hit_rank", F.lit(0)).alias("first_hit_rank"),
        F.round("ndcg", 6).alias("ndcg"),
    )


@query(
    "eval_strict_hit",
    f"""
WITH {_results_sql()}
SELECT item_id, min(rank) AS strict_first_hit_rank FROM hits WHERE hit AND vec_id % 7 = 2 GROUP BY item_id
""",
)
def eval_strict_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only chunk 2 of an expected document counts."""
    wanted = _expected(spark, sf_dir).withColumn("chunk_index", F.lit(2).cast("long"))
    return ev.strict_first_hit(_retrieved(spark, sf_dir), wanted)


@query(
    "eval_recall",
    f"""
WITH {_results_sql()}
SELECT round(recall_at_1, 6) AS recall_at_1, round(recall_at_3, 6) AS recall_at_3, round(recall_at_5, 6) AS recall_at_5,
       round(recall_at_10, 6) AS recall_at_10 FROM agg
""",
)
def eval_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"recall_at_{k}" for k in (1, 3, 5, 10)]
    return ev.aggregate(_results(spark, sf_dir)).select(*[F.round(n, 6).alias(n) for n in names])


@query("eval_mrr", f"WITH {_results_sql()} SELECT round(mrr, 6) AS mrr FROM agg")
def eval_mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.aggregate(_results(spark, sf_dir)).select(F.round("mrr", 6).alias("mrr"))


@query("eval_ndcg", f"WITH {_results_sql()} SELECT round(ndcg_at_10, 6) AS ndcg_at_10 FROM agg")
def eval_ndcg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.aggregate(_results(spark, sf_dir)).select(F.round("ndcg_at_10", 6).alias("ndcg_at_10"))


@query(
    "eval_citation",
    f"""
WITH {_results_sql()}
SELECT item_id, coalesce(cit, -1.0)::DOUBLE AS citation_correct FROM cited
""",
)
def eval_citation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item; -1 marks items without citation expectations."""
    return _results(spark, sf_dir).select(
        "item_id", F.coalesce(ev.citation_correct(), F.lit(-1.0)).alias("citation_correct")
    )


@query(
    "eval_aggregate",
    f"""
WITH {_results_sql()}
SELECT n_items, round(recall_at_5, 6) AS recall_at_5, round(mrr, 6) AS mrr, round(ndcg_at_10, 6) AS ndcg_at_10,
       round(citation_accuracy, 6) AS citation_accuracy, n_citation_items FROM agg
""",
)
def eval_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = ev.aggregate(_results(spark, sf_dir))
    rounded = ["recall_at_5", "mrr", "ndcg_at_10", "citation_accuracy"]
    return row.select("n_items", "n_citation_items", *[F.round(n, 6).alias(n) for n in rounded])


@query(
    "eval_per_tag",
    f"""
WITH {_results_sql()}
SELECT tag, round(recall_at_5, 6) AS recall_at_5, round(mrr, 6) AS mrr, n_items, low_sample FROM tags
""",
)
def eval_per_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ev.per_tag(_results(spark, sf_dir), _tags(spark, sf_dir))
    return rows.select("tag", F.round("recall_at_5", 6).alias("recall_at_5"), F.round("mrr", 6).alias("mrr"), "n_items", "low_sample")


@query(
    "eval_skipped",
    """
WITH ex AS (SELECT doc_id % (SELECT count(*) FROM benchmark) AS item_id, doc_id FROM labels WHERE quality = 1),
man AS (SELECT doc_id FROM documents WHERE lang IN ('en', 'fr', 'es'))
SELECT item_id, item_id IN (SELECT item_id FROM ex WHERE doc_id NOT IN (FROM man)) AS skipped FROM benchmark
""",
)
def eval_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose expected documents are not all in the manifest (no German)."""
    items = table(spark, sf_dir, "benchmark").select("item_id")
    n = items.agg(F.count(F.lit(1)).alias("n"))
    expected = table(spark, sf_dir, "labels").filter("quality = 1").select(
        (F.col("doc_id") % n.scalar()).alias("item_id"), "doc_id"
    )
    manifest = table(spark, sf_dir, "documents").filter(F.col("lang").isin("en", "fr", "es"))
    runnable, skipped = ev.split_items(items, expected, manifest)
    return runnable.withColumn("skipped", F.lit(False)).unionByName(skipped.withColumn("skipped", F.lit(True)))


def _metric_rows(spark: SparkSession, sf_dir: str, without_label: int | None = None) -> DataFrame:
    # One row per item, read twice below: retrieval must not run twice.
    results = checkpointed(_results(spark, sf_dir, without_label))
    return ev.metric_rows(ev.aggregate(results), ev.per_tag(results, _tags(spark, sf_dir)))


DIFF_SQL = f"""
WITH {_results_sql()}, {_run_sql("label <> 3", "_b")},
diff AS (
  SELECT c.tag, c.ordinal, c.metric, c.value - b.value AS delta, greatest(b.value - c.value, 0) AS drop
  FROM metrics_b c JOIN metrics b USING (metric) WHERE c.value IS NOT NULL AND b.value IS NOT NULL
)"""


@query(
    "baseline_diff",
    DIFF_SQL
    + """
SELECT metric, round(delta, 6) + 0.0 AS delta, round(drop, 6) AS drop,
       CASE WHEN abs(delta) < 1e-6 THEN '=' WHEN delta > 0 THEN '↑' || format('{:.3f}', abs(delta))
            ELSE '↓' || format('{:.3f}', abs(delta)) END AS shown FROM diff
""",
)
def baseline_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full index as baseline, the index without label 3 as current run."""
    diff = ev.baseline_diff(_metric_rows(spark, sf_dir, 3), _metric_rows(spark, sf_dir))
    return diff.select(
        "metric",
        (F.round("delta", 6) + F.lit(0.0)).alias("delta"),
        F.round("drop", 6).alias("drop"),
        render.delta_arrow(F.col("delta")).alias("shown"),
    )


@query(
    "baseline_gate",
    DIFF_SQL
    + """
SELECT round(max(drop), 6) AS worst_drop, max(drop) <= 0.05 AS passes,
       (SELECT metric FROM diff ORDER BY round(drop, 9) DESC, tag, ordinal LIMIT 1) AS worst_drop_metric FROM diff
""",
)
def baseline_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    diff = ev.baseline_diff(_metric_rows(spark, sf_dir, 3), _metric_rows(spark, sf_dir))
    return ev.gate(checkpointed(diff), 0.05).withColumn("worst_drop", F.round("worst_drop", 6))


@query(
    "eval_report_rows",
    f"""
WITH {_results_sql()}
SELECT item_id, '| ' || item_id || ' | what is label ' || item_id || ' \\| like | '
       || coalesce(first_hit_rank::VARCHAR, '-') || ' | '
       || (SELECT string_agg(vec_id::VARCHAR, ', ' ORDER BY rank) FROM hits h WHERE h.item_id = cited.item_id AND rank <= 3)
       || ' | p.' || (top % 30) || CASE WHEN top % 3 = 0 THEN '' ELSE '–' || (top % 30 + top % 3) END || ', §S' || (top % 3) || ' |' AS line
FROM cited
""",
)
def eval_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the per-item report table."""
    retrieved = _retrieved(spark, sf_dir)
    top3 = (
        retrieved.filter("rank <= 3")
        .groupBy("item_id")
        .agg(F.sort_array(F.collect_list(F.struct("rank", F.col("doc_id").cast("string").alias("d")))).alias("t"))
        .select("item_id", F.array_join(F.transform("t", lambda r: r["d"]), ", ").alias("top3"))
    )
    rows = _results(spark, sf_dir).join(top3, "item_id", "left")
    return rows.select("item_id", render.report_line().alias("line"))


@query(
    "eval_metric_table",
    DIFF_SQL
    + """
SELECT ordinal::BIGINT AS ordinal, '| ' || ['recall@1', 'recall@3', 'recall@5', 'recall@10', 'MRR', 'nDCG@10', 'citation_accuracy'][ordinal + 1] || ' | '
  || format('{:.3f}', round(m.value, 9)) || ' | ' || CASE WHEN abs(d.delta) < 1e-6 THEN '=' WHEN d.delta > 0 THEN '↑' || format('{:.3f}', round(abs(d.delta), 9))
     ELSE '↓' || format('{:.3f}', round(abs(d.delta), 9)) END || ' |' AS line
FROM diff d JOIN metrics_b m USING (metric, ordinal) WHERE d.tag = ''
""",
)
def eval_metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the aggregate table of a report, with the change to a baseline."""
    diff = ev.baseline_diff(_metric_rows(spark, sf_dir, 3), _metric_rows(spark, sf_dir)).filter("tag = ''")
    return diff.select(F.col("ordinal").cast("long").alias("ordinal"), render.metric_line().alias("line"))


@query(
    "eval_skipped_lines",
    """
WITH ex AS (SELECT doc_id % (SELECT count(*) FROM benchmark) AS item_id, doc_id FROM labels WHERE quality = 1)
SELECT DISTINCT '- `' || item_id || '`' AS line FROM ex JOIN documents USING (doc_id) WHERE lang = 'de'
""",
)
def eval_skipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List of skipped items as it appears in a report."""
    skipped = eval_skipped(spark, sf_dir).filter("skipped")
    return skipped.select(F.concat(F.lit("- `"), F.col("item_id").cast("string"), F.lit("`")).alias("line"))
