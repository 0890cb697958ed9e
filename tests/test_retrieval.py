import math
import random
import re

import pytest
from pyspark.sql import functions as F

from marginalia.operators import bm25, hybrid, models
from marginalia.operators import dense as dense_module
from marginalia.operators.dense import fetch_size, search_dense


def channel(spark, ranked, column="distance"):
    rows = [(1, c, f"d-{c}", r, float(r)) for r, c in enumerate(ranked, start=1)]
    return spark.createDataFrame(rows, f"query_id long, chunk_id string, doc_id string, rank int, {column} double")


def order(frame):
    return [r["chunk_id"] for r in frame.orderBy("rank").collect()]


def test_fusion_worked_example(spark):
    fused = hybrid.fuse(channel(spark, "ABCD"), channel(spark, "BEA", "score"), 5)
    assert order(fused) == ["B", "A", "E", "C", "D"]
    top = fused.filter("chunk_id = 'B'").first()
    assert top["rrf_score"] == pytest.approx(1 / 62 + 1 / 61, abs=1e-12)
    assert (top["dense_rank"], top["bm25_rank"]) == (2, 1)
    assert fused.filter("chunk_id = 'E'").first()["dense_rank"] is None


def test_fusion_breaks_ties_by_chunk_id(spark):
    fused = hybrid.fuse(channel(spark, "ZA"), channel(spark, "AZ", "score"), 2)
    assert order(fused) == ["A", "Z"]


def test_fusion_drops_chunks_deleted_in_either_channel(spark):
    dead = spark.createDataFrame([("B",)], "chunk_id string")
    fused = hybrid.fuse(channel(spark, "ABCD"), channel(spark, "BEA", "score"), 5, tombstones=dead)
    assert "B" not in order(fused)


def test_dense_only_is_flagged(spark):
    rows = hybrid.dense_only(channel(spark, "ABC"), 2)
    assert order(rows) == ["A", "B"]
    assert all(r["hybrid_degraded"] and r["bm25_rank"] is None for r in rows.collect())


def test_rrf_rejects_bad_constant():
    with pytest.raises(ValueError):
        hybrid.rrf_term(F.lit(1), 0)


def test_fetch_size_rule():
    assert fetch_size(10, 100, 0) == 12
    assert fetch_size(10, 100, 50) == 17
    assert fetch_size(10, 5, 0) == 5
    assert fetch_size(10, 0, 0) == 0


@pytest.fixture(scope="module")
def vector_rows():
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(4)]) for i in range(300)]
    return rows


def nearest(rows, query, k, dead=()):
    scored = [(sum((a - b) ** 2 for a, b in zip(v, query)), i) for i, v in rows if i not in dead]
    return [i for _, i in sorted(scored)[:k]]


def test_dense_equals_brute_force_with_ties(spark, vector_rows, monkeypatch):
    monkeypatch.setattr(dense_module, "QUERY_BLOCK", 2)
    vectors = spark.createDataFrame(vector_rows, "embedding_index long, embedding array<float>").repartition(7)
    asked = [(q, vector_rows[q * 11][1]) for q in range(5)]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    found = search_dense(vectors, queries, 9)
    for q, vector in asked:
        got = [r["embedding_index"] for r in found.filter(F.col("query_id") == q).orderBy("rank").collect()]
        assert got == nearest(vector_rows, vector, 9)


def test_dense_tells_apart_what_digits_do_not(spark):
    rows = [(0, [1.0002, 0.0]), (1, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "embedding_index long, embedding array<double>")
    queries = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert search_dense(vectors, queries, 1).first()["embedding_index"] == 1


def scans(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")


def test_many_query_blocks_take_one_scan(spark, vector_rows, monkeypatch):
    monkeypatch.setattr(dense_module, "QUERY_BLOCK", 3)
    monkeypatch.setattr(bm25, "QUERY_BLOCK", 1)
    vectors = spark.createDataFrame(vector_rows, "embedding_index long, embedding array<float>")
    asked = spark.createDataFrame([(q, vector_rows[q][1]) for q in range(20)], "query_id long, embedding array<double>")
    found = search_dense(vectors, asked, 4)
    assert scans(found) == 1 and found.count() == 80
    words = spark.createDataFrame([(q, t) for q, t in enumerate(["cat", "dog sky", "bird", "the"])], "query_id long, text string")
    listed = bm25.search_bm25(index_of(spark, BODIES), words, 2)
    assert scans(listed) == 1 and listed.count() == 8
    monkeypatch.setattr(dense_module, "PASS_CELLS", 20)
    assert sorted(map(tuple, search_dense(vectors, asked, 4).collect())) == sorted(map(tuple, found.collect()))


def test_dense_leaves_out_deleted_rows(spark, vector_rows):
    dead = set(range(0, 300, 3))
    vectors = spark.createDataFrame(vector_rows, "embedding_index long, embedding array<float>").withColumn(
        "deleted_utc", F.when(F.col("embedding_index") % 3 == 0, F.to_timestamp(F.lit("2024-01-01")))
    )
    queries = spark.createDataFrame([(0, vector_rows[1][1])], "query_id long, embedding array<double>")
    got = [r["embedding_index"] for r in search_dense(vectors, queries, 12).orderBy("rank").collect()]
    assert got == nearest(vector_rows, vector_rows[1][1], 12, dead)


def test_dense_rejects_other_dimensions(spark):
    vectors = spark.createDataFrame([(0, [1.0, 2.0])], "embedding_index long, embedding array<float>")
    queries = spark.createDataFrame([(0, [1.0, 2.0, 3.0])], "query_id long, embedding array<double>")
    with pytest.raises(Exception, match="dimension"):
        search_dense(vectors, queries, 1).collect()


def test_empty_inputs_give_no_rows(spark):
    vectors = spark.createDataFrame([], "embedding_index long, embedding array<float>")
    queries = spark.createDataFrame([(0, [1.0])], "query_id long, embedding array<double>")
    assert search_dense(vectors, queries, 3).count() == 0
    assert search_dense(vectors, queries.limit(0), 3).count() == 0


BODIES = [
    "the cat sat on the mat",
    "the dog and the cat",
    "",
    "a bird in the sky",
    "The CAT, the cat; the cat!",
    "nothing here",
]


def index_of(spark, bodies, deleted=()):
    rows = [(i, f"c{i}", f"d{i}", b) for i, b in enumerate(bodies)]
    chunks = spark.createDataFrame(rows, "bm25_index long, chunk_id string, doc_id string, text string")
    dead = F.when(F.col("bm25_index").isin(list(deleted)), F.to_timestamp(F.lit("2024-01-01"))) if deleted else F.lit(None).cast("timestamp")
    return bm25.build_index(chunks.withColumn("deleted_utc", dead).repartition(3))


def brute_bm25(bodies, query):
    docs = [re.findall(r"\w+", b.lower()) for b in bodies]
    n, avgdl = len(docs), sum(map(len, docs)) / len(docs)
    df = {t: sum(t in d for d in docs) for t in {t for d in docs for t in d}}
    raw = {t: math.log(n - f + 0.5) - math.log(f + 0.5) for t, f in df.items()}
    mean = sum(raw.values()) / len(raw)
    idf = {t: v if v >= 0 else 0.25 * mean for t, v in raw.items()}
    out = []
    for d in docs:
        s = 0.0
        for t in re.findall(r"\w+", query.lower()):
            tf = d.count(t)
            s += idf.get(t, 0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(d) / avgdl))
        out.append(round(s, 6))
    return out


@pytest.mark.parametrize("query", ["cat", "the cat cat", "bird unknown", "unknown words"])
def test_bm25_equals_brute_force(spark, query):
    queries = spark.createDataFrame([(7, query)], "query_id long, text string")
    rows = bm25.search_bm25(index_of(spark, BODIES), queries, 6).orderBy("rank").collect()
    scores = brute_bm25(BODIES, query)
    want = sorted(range(len(BODIES)), key=lambda i: (-scores[i], i))
    assert [r["bm25_index"] for r in rows] == want
    assert [r["score"] for r in rows] == pytest.approx([scores[i] for i in want], abs=2e-6)


def test_bm25_query_without_tokens_is_empty(spark):
    queries = spark.createDataFrame([(1, "?!"), (2, "cat")], "query_id long, text string")
    rows = bm25.search_bm25(index_of(spark, BODIES), queries, 3).collect()
    assert {r["query_id"] for r in rows} == {2}


def test_bm25_statistics_count_deleted_chunks(spark):
    plain = index_of(spark, BODIES).terms.orderBy("term").collect()
    dead = index_of(spark, BODIES, deleted=[0, 4])
    assert dead.terms.orderBy("term").collect() == plain
    queries = spark.createDataFrame([(1, "cat")], "query_id long, text string")
    assert not {0, 4} & {r["bm25_index"] for r in bm25.search_bm25(dead, queries, 6).collect()}


def test_bm25_postings_search_agrees_on_matches(spark):
    index = index_of(spark, BODIES)
    queries = spark.createDataFrame([(1, "the cat cat bird")], "query_id long, text string")
    full = bm25.search_bm25(index, queries, 6).filter("score > 0").orderBy("rank").collect()
    listed = bm25.search_postings(bm25.postings(index.docs), index.terms, index.meta, queries, 6).filter("score > 0")
    assert listed.orderBy("rank").collect() == full


def test_tokenizer_equals_python(spark, small):
    from marginalia.functions.text import tokenize

    docs = spark.read.parquet(f"{small}/documents.parquet")
    for row in docs.select("text", tokenize(F.col("text")).alias("tokens")).collect():
        assert row["tokens"] == re.findall(r"\w+", row["text"].lower())


def test_rerank_is_stable_and_truncates(spark):
    rows = [(1, "red fox", 1, "fox"), (1, "red fox", 2, "red fox"), (1, "red fox", 3, "a fox"), (1, "red fox", 4, "none")]
    pool = spark.createDataFrame(rows, "query_id long, query string, rank int, text string")
    ranked = models.rerank(pool, models.overlap_scorer, 3).orderBy("rank").collect()
    assert [r["pool_rank"] for r in ranked] == [2, 1, 3]
    with pytest.raises(KeyError):
        models.rerank(pool, models.overlap_scorer, 3, text="missing")


def test_embedding_is_unit_length_and_skips_blanks(spark):
    chunks = spark.createDataFrame([("a",), ("  \n",), ("b c",)], "text string")
    rows = models.embed(chunks, models.digest_embedder()).collect()
    assert len(rows) == 2
    assert all(sum(x * x for x in r["embedding"]) == pytest.approx(1.0, abs=1e-5) for r in rows)


def test_chunks_by_language_without_shuffling_texts(spark, tmp_path):
    from collections import Counter

    from marginalia.plans import relations as rel

    rows = [(1, "a", "en"), (2, "b", "de"), (3, "c", None), (None, "d", "en"), (None, "e", "de")]
    twice = [(4, "f", "en"), (4, "g", "de"), (4, "h", None), (5, "i", "en"), (5, "j", "en"), (6, "k", "de"), (6, None, "fr")]
    for name, table in {"single": rows, "twice": rows + twice}.items():
        folder = str(tmp_path / name)
        docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
        docs.write.parquet(f"{folder}/documents.parquet")
        parts = rel.english_and_others(spark, folder)
        # As the join of texts with the languages of their id gives them.
        joined = docs.select("doc_id", "text").join(docs.select("doc_id", "lang"), "doc_id").collect()
        for part, wanted in zip(parts, (True, False)):
            assert Counter((r["bm25_index"], r["text"]) for r in part.collect()) == Counter((r["doc_id"], r["text"]) for r in joined if (r["lang"] == "en") is wanted)
            assert part.columns == ["bm25_index", "chunk_id", "doc_id", "text"]
            assert "SortMergeJoin" not in part._jdf.queryExecution().executedPlan().toString()
