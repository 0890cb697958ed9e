"""Agents' indexes and frequencies that grow with the stream, and files that come to rest."""

import os
import time

from pyspark.sql import functions as F

from marginalia.operators import bm25, models
from marginalia.sources import store
from marginalia.streaming import indexing, settled, staging

NAMES = (
    "doc_id string, slug string, source string, collection string, file_sha1 string, content_hash string, "
    "markdown string, status string, error string"
)
BATCHES = [
    [("id1", "s1", "law", "old words about law\n"), ("id2", "s2", "food", "soup and bread\n")],
    [("id3", "s1", "law", "new words about contracts\n"), ("id1", "s3", "law", "old words about law\n")],
    [("id4", "s4", "food", "bread and more bread\n"), ("id2", "s2", "food", "soup and bread\n")],
]


def test_three_batches_equal_a_batch_build(spark, tmp_path):
    corpus = str(tmp_path)
    agents = spark.createDataFrame([("lawyer", "law"), ("chef", "food"), ("all", "law"), ("all", "food")], "agent string, collection string")
    versions = []
    for batch, rows in enumerate(BATCHES):
        full = [(d, s, f"{s}.md", c, "h", "x", t, "success", None) for d, s, c, t in rows]
        spark.createDataFrame(full, NAMES).write.parquet(f"{corpus}/documents/batch={batch}")
        indexing.run_indexing(spark, corpus, f"{corpus}/cp1", models.digest_embedder(8), agents).awaitTermination()
        indexing.run_term_counts(spark, corpus, f"{corpus}/cp2", agents).awaitTermination()
        versions.append({a: store.published_pair(spark, f"{corpus}/agents/pairs/{a}") for a in ("lawyer", "chef", "all")})
    # Only touched agents change: the second batch has no food, the third no law.
    assert versions[0]["chef"] == versions[1]["chef"] == (1, 1) and versions[2]["chef"] == (2, 2)
    assert versions[1]["lawyer"] == versions[2]["lawyer"] == (2, 2) and versions[2]["all"] == (3, 3)

    terms, figures = indexing.term_counts(spark, corpus)
    log = indexing.vectors_log(spark, corpus)
    first = log.groupBy("slug", "doc_id").agg(F.min("batch").alias("batch"))
    for agent, slice_ in (("lawyer", ["law"]), ("chef", ["food"]), ("all", ["law", "food"])):
        rows = log.join(first, ["slug", "doc_id", "batch"]).filter(F.col("collection").isin(slice_))
        built = bm25.build_index(rows.select(F.col("embedding_index").alias("bm25_index"), "chunk_id", "doc_id", "text"))
        want = {r["term"]: r["df"] for r in built.terms.collect()}
        assert {r["term"]: r["df"] for r in terms.filter(F.col("agent") == agent).collect()} == want
        stored = store.read_bm25(spark, f"{corpus}/agents/bm25/{agent}")
        assert {r["term"]: r["df"] for r in stored.terms.collect()} == want
        meta, streamed = built.meta.first(), figures.filter(F.col("agent") == agent).first()
        for got in (stored.meta.first(), streamed):
            assert got["n_docs"] == meta["n_docs"] and abs(got["avgdl"] - meta["avgdl"]) < 1e-12

    # The superseded document is not found any more.
    asked = spark.createDataFrame([(1, "words law contracts")], "query_id long, text string")
    stored = store.read_bm25(spark, f"{corpus}/agents/bm25/lawyer")
    hits = bm25.search_bm25(stored, asked, 5).join(stored.docs, "bm25_index").collect()
    assert sorted((r["doc_id"], r["chunk_id"]) for r in hits) == [("id1", "id1-0001"), ("id3", "id3-0001")]
    # A retried batch changes nothing.
    again = staging.documents_log(spark, corpus).filter("batch = 2")
    indexing.refresh_agents(again, 2, corpus, agents)
    assert store.published_pair(spark, f"{corpus}/agents/pairs/chef") == (2, 2)


def put(root, name, content, age=10.0):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(content)
    os.utime(path, (time.time() - age,) * 2)


def test_only_files_at_rest_are_planned_and_none_twice(tmp_path):
    root, plans = str(tmp_path / "in"), str(tmp_path / "plans")
    put(root, "law/a.md", b"a")
    put(root, "law/growing.md", b"g", age=0.0)
    put(root, "law/deep/b.md", b"b")
    put(root, "top.md", b"t")
    put(root, ".hidden/c.md", b"c")
    reader = settled.SettledReader(root, plans, 3.0)
    end = reader.latestOffset()
    names = [r[0] for p in reader.partitions(reader.initialOffset(), end) for r in reader.read(p)]
    assert end == {"plan": 1} and names == [f"{root}/law/a.md"]
    # A new reader goes on from the plans; an old time stamp does not hide a new file.
    put(root, "law/growing.md", b"grown")
    put(root, "law/moved.md", b"m", age=100_000.0)
    other = settled.SettledReader(root, plans, 3.0)
    later = other.latestOffset()
    assert [r[0] for p in other.partitions(end, later) for r in other.read(p)] == [f"{root}/law/growing.md", f"{root}/law/moved.md"]
    assert other.latestOffset() == later == settled.SettledReader(root, plans, 3.0).latestOffset()


def test_staging_from_settled_files(spark, tmp_path):
    root, corpus = str(tmp_path / "in"), str(tmp_path / "corpus")
    put(root, "law/First Paper.md", b"# First\n\nalpha beta\n")
    put(root, "law/late.md", b"late\n", age=-3600.0)
    put(root, "law/deep/x.md", b"x\n")

    def ingest():
        staging.run_staging(spark, root, corpus, str(tmp_path / "cp"), settle=3.0).awaitTermination()
        return sorted(r["slug"] for r in staging.current_documents(spark, corpus).collect())

    assert ingest() == ["first-paper"]
    put(root, "law/late.md", b"late\n")
    assert ingest() == ["first-paper", "late"] and ingest() == ["first-paper", "late"]
    assert staging.documents_log(spark, corpus).count() == 2
    indexing.run_indexing(spark, corpus, str(tmp_path / "cp2"), models.digest_embedder(8)).awaitTermination()
    log = {r["slug"]: (r["section_heading"], r["page_start"]) for r in indexing.vectors_log(spark, corpus).collect()}
    assert log == {"first-paper": ("First", None), "late": (None, None)}
