"""Figures of ingested batches: counts, failures, skips and collisions."""

from marginalia.streaming import staging
from test_streaming import put


def test_batches_report_what_they_took(spark, tmp_path):
    root, corpus, seen = tmp_path / "in", str(tmp_path / "corpus"), []
    put(root, "law", "one.md", b"alpha\n")
    put(root, "law", "two.md", b"alpha\n")
    put(root, "law", "broken.epub", b"no archive")
    put(root, "law", "notes.txt", b"unsupported")

    def ingest():
        staging.run_staging(spark, str(root), corpus, str(tmp_path / "cp"), progress=seen.append).awaitTermination()

    ingest()
    put(root, "law", "One.md", b"again\n")
    ingest()
    first, second = seen
    assert (first["batch"], first["files"], first["documents"], first["succeeded"], first["failed"], first["collisions"]) == (0, 4, 3, 2, 1, 1)
    assert first["routes"] == {"parse": 1, "direct": 2, "ocr": 0, "originals": 0, "skipped": 1}
    assert len(first["errors"]) == 1 and first["errors"][0].startswith("broken.epub: BadZipFile")
    assert second["routes"]["originals"] == 1 and second["documents"] == 0
    total = staging.run_totals(spark, corpus).first()
    assert (total["batches"], total["files"], total["failed"], total["originals"]) == (2, 5, 1, 1)
    assert total["summary"] == "5 files, 2 succeeded, 1 failed, 1 collisions (parse 1, direct 2, originals 1, skipped 1)"
