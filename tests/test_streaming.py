from pyspark.sql import functions as F

from marginalia.operators import models
from marginalia.operators.dense import search_dense
from marginalia.streaming import indexing, staging


def put(root, collection, name, content):
    folder = root / collection
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content)


def test_staging_and_indexing(spark, tmp_path):
    staged, corpus = tmp_path / "staging", str(tmp_path / "corpus")
    put(staged, "law", "First Paper.md", b"# First\n\nalpha beta\n")
    put(staged, "law", "notes.txt", b"unsupported")
    put(staged, "law", "scan.pdf", b"%PDF-1.4 no text")
    put(staged, ".hidden", "x.md", b"hidden")

    def ingest():
        staging.run_staging(spark, str(staged), corpus, str(tmp_path / "cp1")).awaitTermination()
        indexing.run_indexing(spark, corpus, str(tmp_path / "cp2"), models.digest_embedder(8)).awaitTermination()

    ingest()
    routes = {r["name"]: r["route"] for r in spark.read.parquet(f"{corpus}/routes").collect()}
    assert routes == {"First Paper.md": "direct", "notes.txt": "skipped", "scan.pdf": "ocr"}
    assert [r["slug"] for r in staging.current_documents(spark, corpus).collect()] == ["first-paper"]
    before = indexing.live_vectors(spark, corpus).collect()
    assert [r["embedding_index"] for r in before] == [0]

    put(staged, "law", "Second.md", b"gamma delta\n")
    put(staged, "law", "First_Paper.md", b"already there\n")
    ingest()
    latest = spark.read.parquet(f"{corpus}/routes").filter("batch > 0").collect()
    assert {r["name"]: r["route"] for r in latest} == {"Second.md": "direct", "First_Paper.md": "originals"}
    live = indexing.live_vectors(spark, corpus).orderBy("embedding_index").collect()
    assert [(r["slug"], r["embedding_index"]) for r in live] == [("first-paper", 0), ("second", 1)]

    for batch in (100, 100, 2):  # a finished file is not read again, and no batch of the stream is touched
        staging.retry_ocr(spark, corpus, batch, lambda content: ["text from the scan"])
    assert staging.documents_log(spark, corpus).filter("source = 'scan.pdf' AND status = 'success'").count() == 1
    current = {r["slug"]: r["markdown"] for r in staging.current_documents(spark, corpus).collect()}
    assert current["scan"] == "text from the scan\n"

    indexing.run_indexing(spark, corpus, str(tmp_path / "cp2"), models.digest_embedder(8)).awaitTermination()
    assert [r["slug"] for r in indexing.live_vectors(spark, corpus).orderBy("embedding_index").collect()] == ["first-paper", "second", "scan"]

    agents = spark.createDataFrame([("lawyer", "law"), ("chef", "food")], "agent string, collection string")
    touched = indexing.affected_slices(staging.current_documents(spark, corpus), agents)
    assert [r["agent"] for r in touched.collect()] == ["lawyer"]

    asked = indexing.live_vectors(spark, corpus).filter("slug = 'second'").select(
        F.lit(1).cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    found = search_dense(indexing.live_vectors(spark, corpus), asked, 1).first()
    assert found["embedding_index"] == 1 and found["distance"] == 0.0


def test_a_retried_batch_does_not_double_documents(spark, tmp_path):
    corpus = str(tmp_path / "corpus")
    put(tmp_path / "in", "c", "a.md", b"alpha\n")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "in"))
    for _ in range(2):
        staging.ingest_batch(files, 0, corpus)
        indexing.index_batch(staging.documents_log(spark, corpus), 0, corpus, models.digest_embedder(8))
    assert staging.documents_log(spark, corpus).count() == 1
    assert indexing.vectors_log(spark, corpus).count() == 1


def test_superseded_documents_lose_their_vectors(spark, tmp_path):
    corpus = str(tmp_path / "corpus")
    rows = [("id1", "s", "s.md", "c", "h1", "x", "old text\n", "success", None)]
    names = "doc_id string, slug string, source string, collection string, file_sha1 string, content_hash string, markdown string, status string, error string"
    for batch, doc in enumerate(("id1", "id2")):
        frame = spark.createDataFrame([(doc, *rows[0][1:])], names)
        frame.write.parquet(f"{corpus}/documents/batch={batch}")
        indexing.index_batch(frame.withColumn("batch", F.lit(batch)), batch, corpus, models.digest_embedder(8))
    assert indexing.vectors_log(spark, corpus).count() == 2
    assert [r["doc_id"] for r in indexing.live_vectors(spark, corpus).collect()] == ["id2"]
