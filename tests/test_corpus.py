import pytest
from pyspark.sql import functions as F

from marginalia.operators import agents, manifest, routing, staleness

DOCS = [
    (1, "a", ["science"]),
    (2, "b", ["science", "math"]),
    (3, "c", []),
    (4, "d", None),
    (5, "e", ["music"]),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, slug string, collections array<string>")


CASES = [
    (None, None, None, [1, 2, 3, 4, 5]),
    (["a", "d"], None, None, [1, 4]),
    (None, ["science"], None, [1, 2]),
    (["c"], ["music"], None, [3, 5]),
    (["a"], ["math"], ["b"], [1]),
    (None, None, ["a"], [2, 3, 4, 5]),
    ([], [], [], [1, 2, 3, 4, 5]),
    (["zzz"], None, None, []),
    (["a"], None, ["a"], []),
]


@pytest.mark.parametrize("slugs,wanted,excluded,result", CASES)
def test_agent_predicate(docs, slugs, wanted, excluded, result):
    keep = agents.agent_predicate(F.col("slug"), F.col("collections"), slugs, wanted, excluded)
    assert [r["doc_id"] for r in docs.filter(keep).orderBy("doc_id").collect()] == result


def test_all_agents_at_once_agree_with_each_alone(spark, docs):
    names = [f"agent{n}" for n in range(len(CASES))]

    def pairs(position, column):
        rows = [(name, v) for name, case in zip(names, CASES) for v in case[position] or []]
        return spark.createDataFrame(rows, f"agent string, {column} string")

    members = agents.agent_documents(
        docs, spark.createDataFrame([(n,) for n in names], "agent string"),
        pairs(1, "collection"), pairs(0, "slug"), pairs(2, "slug"),
    )
    got = {}
    for row in members.collect():
        got.setdefault(row["agent"], []).append(row["doc_id"])
    assert {n: sorted(got.get(n, [])) for n in names} == {n: case[3] for n, case in zip(names, CASES)}


def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([("1", "a", 0), ("2", "b", 0)], "doc_id string, slug string, version long")
    new = spark.createDataFrame([("2", "x", 1), ("2", "y", 2), ("3", "c", 1)], "doc_id string, slug string, version long")
    rows = manifest.in_manifest_order(manifest.upsert(old, new)).collect()
    assert [(r["doc_id"], r["slug"]) for r in rows] == [("1", "a"), ("3", "c"), ("2", "y")]


def test_collisions_name_the_first_document(spark):
    rows = [(0, "a", "x", "h1"), (1, "b", "x", "h1"), (2, "c", "x", "h2"), (3, "d", "y", "h3")]
    docs = spark.createDataFrame(rows, "pos int, slug string, doc_id string, doc_sha1 string")
    found = manifest.doc_id_collisions(docs).collect()
    assert [tuple(r) for r in found] == [("x", "a", "h1", "c", "h2")]


CORPORA = "agent string, pos int, slug string, doc_id string, doc_path string"


def test_slugs_resolve_with_id_or_agent_suffix(spark):
    rows = [
        ("B", 0, "intro", "bbbbbbbb99", "intro/doc.md"),
        ("A", 0, "intro", "aaaaaaaa", "intro/doc.md"),
        ("Composer", 0, "intro", None, "intro/doc.md"),
        ("A", 1, "solo", "cccccccc", "solo/doc.md"),
    ]
    resolved = manifest.resolve_slugs(spark.createDataFrame(rows, CORPORA))
    got = {(r["agent"], r["pos"]): r["target_slug"] for r in resolved.collect()}
    assert got == {("A", 0): "intro", ("B", 0): "intro-bbbbbbbb", ("Composer", 0): "intro-composer", ("A", 1): "solo"}


def test_merge_keeps_first_of_each_id_and_moves_paths(spark):
    rows = [
        ("A", 0, "intro", "id1", "intro/doc.md"),
        ("B", 0, "intro", "id2", "intro/doc.md"),
        ("B", 1, "other", "id1", "other/doc.md"),
        ("C", 0, "intro", None, "intro/doc.md"),
    ]
    merged = manifest.merge_manifests(manifest.resolve_slugs(spark.createDataFrame(rows, CORPORA)))
    got = sorted((r["agent"], r["doc_id"], r["slug"], r["doc_path"]) for r in merged.collect())
    assert got == [
        ("A", "id1", "other", "other/doc.md"),
        ("B", "id2", "intro-id2", "intro-id2/doc.md"),
        ("C", None, "intro-c", "intro-c/doc.md"),
    ]


INDEX = "embedding_index long, chunk_id string, doc_id string, file_sha1 string, deleted_utc timestamp"


@pytest.fixture()
def index(spark):
    rows = [
        (0, "same-0001", "same", "h", False),
        (1, "old-0001", "old", None, False),
        (2, "old-0002", "old", "h0", False),
        (3, "gone-0001", "gone", "h", False),
        (4, "dead-0001", "dead", "h", True),
        (5, "nohash-0001", "nohash", None, False),
    ]
    frame = spark.createDataFrame(rows, "embedding_index long, chunk_id string, doc_id string, file_sha1 string, dead boolean")
    return frame.withColumn("deleted_utc", F.when(F.col("dead"), F.to_timestamp(F.lit("2024-01-01")))).drop("dead")


@pytest.fixture()
def listed(spark):
    rows = [("same", "s", "h"), ("old", "o", "h1"), ("new", "n", "h"), ("dead", "d", "h"), ("nohash", "x", "h")]
    return spark.createDataFrame(rows, "doc_id string, slug string, file_sha1 string")


def test_changes(index, listed):
    got = {r["doc_id"]: r["change"] for r in staleness.changes(listed, index).collect()}
    assert got == {"same": "same", "old": "updated", "gone": "deleted", "new": "new", "dead": "new", "nohash": "same"}


def test_indexed_documents_and_ratio(index):
    assert {r["doc_id"] for r in staleness.indexed_documents(index).collect()} == {"same", "old", "gone", "nohash"}
    assert staleness.indexed_documents(index, include_tombstoned=True).count() == 5
    row = staleness.tombstone_ratio(index).first()
    assert (row["total"], row["tombstoned"], row["advice"]) == (6, 1, "ok")
    assert staleness.tombstone_ratio(index.limit(0)).first()["ratio"] == 0.0


@pytest.mark.parametrize("dead,advice", [(2, "ok"), (3, "warn"), (4, "rebuild")])
def test_ratio_thresholds_are_strict(spark, dead, advice):
    rows = spark.range(10).withColumn("deleted_utc", F.when(F.col("id") < dead, F.current_timestamp()))
    assert staleness.tombstone_ratio(rows).first()["advice"] == advice


def test_tombstone_is_idempotent(spark, index):
    gone = spark.createDataFrame([("old",), ("dead",)], "doc_id string")
    once = staleness.tombstone(index, gone, F.to_timestamp(F.lit("2024-06-01")))
    assert once.filter("newly_deleted").count() == 2
    again = staleness.tombstone(once.drop("newly_deleted"), gone, F.to_timestamp(F.lit("2024-07-01")))
    assert again.filter("newly_deleted").count() == 0
    days = {r["doc_id"]: str(r["d"]) for r in again.select("doc_id", F.to_date("deleted_utc").alias("d")).collect()}
    assert days["old"] == "2024-06-01" and days["dead"] == "2024-01-01"


def test_incremental_run(spark, index, listed):
    fresh = listed.select(F.concat("doc_id", F.lit("-0001")).alias("chunk_id"), "doc_id", "file_sha1", F.lit(None).cast("timestamp").alias("deleted_utc"))
    after = staleness.apply_changes(index, listed, fresh, F.to_timestamp(F.lit("2024-06-01")), ["doc_id"])
    rows = after.orderBy("embedding_index").collect()
    assert [r["embedding_index"] for r in rows] == list(range(9))
    assert [r["doc_id"] for r in rows[6:]] == ["dead", "new", "old"]
    assert {r["chunk_id"] for r in rows if r["deleted_utc"] is None} == {"same-0001", "nohash-0001", "dead-0001", "new-0001", "old-0001"}


def test_plan_keeps_documents_that_left_the_slice(spark, index, listed):
    inside = spark.createDataFrame([("new",), ("same",)], "doc_id string")
    got = {r["doc_id"]: r["action"] for r in staleness.plan_for_agent(staleness.changes(listed, index), inside).collect()}
    assert got == {"new": "process", "same": "skip", "gone": "tombstone"}


def test_routes(spark):
    mb = 1048576
    rows = [
        ("/s/law/Known File.pdf", 5, mb), ("/s/law/scan.PDF", 10, mb), ("/s/law/good.pdf", 5000, mb), ("/s/law/b.epub", 0, 1),
        ("/s/law/n.md", 1, 1), ("/s/law/x.txt", 1, 1), ("/s/.hidden/n.md", 1, 1), ("/s/law/edge.pdf", 1100, mb),
    ]
    files = spark.createDataFrame(rows, "path string, text_length int, length long")
    corpus = spark.createDataFrame([("known-file",)], "slug string")
    got = {r["name"]: r["route"] for r in routing.route(files, corpus).collect()}
    assert got == {
        "Known File.pdf": "originals", "scan.PDF": "ocr", "good.pdf": "parse", "b.epub": "parse", "n.md": "direct",
        "x.txt": "skipped", "edge.pdf": "parse",
    }
    paths = spark.createDataFrame([("/s/a/f.pdf",), ("/s/f.pdf",), ("/s/a/b/f.pdf",), ("/s/a/f.PDF",)], "p string")
    assert [r[0] for r in paths.select(routing.is_staged_path(F.col("p"), "/s/")).collect()] == [True, False, False, False]
