"""A stored index that grows, against one built anew."""

import os
import time

import pytest
from pyspark.sql import functions as F

from marginalia import api
from marginalia.operators import models
from marginalia.operators.splitter import ChunkConfig
from marginalia.sources import store

EMBED = models.digest_embedder(16)
CONFIG = ChunkConfig(60, 10)
OLD = {"a": "alpha attention heads in transformers", "b": "bootstrap interval of small samples " * 3, "c": "common words and common sense"}
NEW = {"a": OLD["a"], "b": "bootstrap replaced by jackknife estimates", "d": "delta method and common words"}


def documents(spark, texts):
    rows = [(f"doc-{k}", k, f"{k}.pdf", t) for k, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id string, slug string, source string, text string")


def asked(spark):
    return spark.createDataFrame([(1, "common words"), (2, "jackknife bootstrap"), (3, "interval of samples")], "query_id long, text string")


def found(spark, root, mode, columns=("query_id", "rank", "doc_id", "text")):
    rows = api.search(spark, root, "x", asked(spark), 4, mode, embedder=EMBED)
    return sorted(map(tuple, rows.select(*columns).collect()))


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    """An updated corpus (never compacted, and compacted) and one built anew."""
    kept, compact, anew = (str(tmp_path_factory.mktemp(n)) for n in ("kept", "compact", "anew"))
    plans = {}
    for root, share in ((kept, 2.0), (compact, 0.0)):
        api.index_agent(documents(spark, OLD), "x", root, EMBED, CONFIG)
        plans[root] = api.update_agent(documents(spark, NEW), "x", root, EMBED, CONFIG, compact_from=share)
    api.index_agent(documents(spark, NEW), "x", anew, EMBED, CONFIG)
    return kept, compact, anew, plans


def test_changes_are_reported(roots):
    plan = {r["doc_id"]: (r["change"], r["action"]) for r in roots[3][roots[0]].collect()}
    assert plan == {"doc-a": ("same", "skip"), "doc-b": ("updated", "process"), "doc-c": ("deleted", "tombstone"), "doc-d": ("new", "process")}


def test_hits_name_their_files(spark, roots):
    entries = spark.createDataFrame([("doc-a", "late", 5), ("doc-a", "first", 2), ("doc-a", "", 1), ("doc-b", "b", 3)], "doc_id string, slug string, pos long")
    rows = api.search(spark, roots[0], "x", asked(spark), 4, "hybrid", embedder=EMBED, entries=entries).collect()
    plain = api.search(spark, roots[0], "x", asked(spark), 4, "hybrid", embedder=EMBED)
    assert len(rows) == plain.count() and "slug" not in plain.columns
    seen = {(r.doc_id, r.slug) for r in rows}
    assert seen == {("doc-a", "first"), ("doc-b", "b"), ("doc-d", None)}
    for r in rows:
        assert r.chunk_path == (f"{r.slug}/chunks/ch_{r.chunk_id[-4:]}.md" if r.slug else None)


@pytest.mark.parametrize("mode", ["dense", "bm25", "hybrid"])
def test_a_compacted_index_equals_a_new_one(spark, roots, mode):
    _, compact, anew, _ = roots
    extra = {"dense": ["distance"], "bm25": ["score"], "hybrid": ["rrf_score", "dense_rank", "bm25_rank"]}[mode]
    columns = ("query_id", "rank", "embedding_index", "chunk_id", "doc_id", "text", *extra)
    assert found(spark, compact, mode, columns) == found(spark, anew, mode, columns)


def test_a_grown_index_finds_what_a_new_one_finds(spark, roots):
    kept, _, anew, _ = roots
    # Distances do not depend on other rows; BM25 statistics go on counting deleted chunks.
    assert found(spark, kept, "dense", ("query_id", "doc_id", "text", "distance")) == found(spark, anew, "dense", ("query_id", "doc_id", "text", "distance"))
    for mode in ("bm25", "hybrid"):
        texts = {t for _, _, _, t in found(spark, kept, mode)}
        assert texts and not texts & {OLD["c"]} and not any("interval" in t for t in texts)
    held = store.snapshot(spark, f"{kept}/vectors/x")
    assert held.parts == [1, 2] and held.deletions == [2]
    live = store.without(store.read_vectors(spark, f"{kept}/vectors/x"), store.deleted_rows(spark, f"{kept}/vectors/x"), "embedding_index")
    assert {r["doc_id"] for r in live.collect()} == {"doc-a", "doc-b", "doc-d"}


def test_old_versions_can_still_be_read(spark, roots):
    for root in roots[:2]:
        old = store.read_vectors(spark, f"{root}/vectors/x", version=1)
        assert {r["doc_id"] for r in old.select("doc_id").collect()} == {"doc-a", "doc-b", "doc-c"}
        assert store.read_bm25(spark, f"{root}/bm25/x", 1).meta.first()["n_docs"] == old.count()


def test_an_update_without_changes_publishes_nothing(spark, roots):
    before = store.published_pair(spark, f"{roots[0]}/pairs/x")
    plan = api.update_agent(documents(spark, NEW), "x", roots[0], EMBED, CONFIG).collect()
    assert {r["action"] for r in plan} == {"skip"}
    assert store.published_pair(spark, f"{roots[0]}/pairs/x") == before


def test_a_document_outside_the_slice_stays(spark, tmp_path):
    root = str(tmp_path)
    api.update_agent(documents(spark, OLD), "x", root, EMBED, CONFIG)
    slice_now = documents(spark, {"a": OLD["a"]})
    manifest = api._file_sha1(documents(spark, OLD)).filter("doc_id <> 'doc-b'").select("doc_id", "file_sha1")
    api.update_agent(slice_now, "x", root, EMBED, CONFIG, manifest=manifest, compact_from=2.0)
    assert {d for _, _, d, _ in found(spark, root, "bm25")} == {"doc-a", "doc-c"}


def test_dimensions_must_agree(spark, tmp_path):
    rows = "agent string, embedding_index long, doc_id string, embedding array<float>"
    store.write_vectors(spark.createDataFrame([("x", 0, "d", [1.0, 0.0])], rows), str(tmp_path))
    with pytest.raises(store.StoreError, match="dimensions"):
        store.append_vectors(spark, str(tmp_path), spark.createDataFrame([("x", 1, "e", [1.0])], rows))
    assert store.read_vectors(spark, str(tmp_path)).count() == 1
    double = spark.createDataFrame([("x", i, "d", [1.0, 0.0]) for i in (0, 2, 2)], rows)
    store.write_vectors(double, str(tmp_path / "double"))
    with pytest.raises(store.StoreError, match="inconsistent"):
        store.read_vectors(spark, str(tmp_path / "double"))


def test_a_dead_writers_claim_expires(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store._claim(spark, root, 1)
    docs = spark.createDataFrame([("c", "d")], "collection string, doc_id string")
    with pytest.raises(store.StoreError, match="another writer"):
        store.write_documents(docs, root)
    os.makedirs(f"{root}/v=1")
    monkeypatch.setattr(store, "CLAIM_SECONDS", 0.5)
    time.sleep(0.6)
    store.write_documents(docs, root)
    assert spark.read.parquet(store.current(spark, root)).count() == 1
