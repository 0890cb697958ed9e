import hashlib
import random

from marginalia.llm import dedup
from marginalia.llm.queries import QUERIES


def brute(rows, pick=max):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for i, text in rows:
        group = groups[text or ""]
        known = [g for g in group if g is not None]
        best = pick(known) if known else None
        out.append((i, best, len(group), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def told(got):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr)


def test_equals_brute_force(frame):
    rng = random.Random(5)
    rows = [(i, f"text {min(rng.randrange(60), rng.randrange(60))}") for i in range(500)]
    rows += [(1000 + i, "hot") for i in range(250)] + [(2000, None), (2001, ""), (2002, "é" * 200_000), (2003, "é" * 200_000)]
    for keep, pick in (("largest", max), ("smallest", min)):
        got = dedup.deduplicate(frame(rows, "doc_id long, text string", 7), keep=keep).collect()
        assert told(got) == brute(rows, pick)
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_odd_rows(frame, spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, "c")]
    got = dedup.deduplicate(frame(rows, "doc_id long, text string")).collect()
    assert told(got) == brute(rows)
    # One row of each group stays, repeated ids and ids that are all NULL included.
    kept = sorted((r.text_sha256, r.doc_id) for r in got if r.kept)
    assert len(kept) == 3 and [i for _, i in kept if i is not None].count(1) == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup.deduplicate(empty).count() == 0
    extra = frame([(1, "a", 9, 9, True, "x")], "doc_id long, text string, run int, n int, kept boolean, digest string")
    assert told(dedup.deduplicate(extra).collect()) == brute([(1, "a")])


def test_several_rounds_merge_many_runs(frame, monkeypatch):
    monkeypatch.setattr(dedup, "BITS", 1)
    monkeypatch.setattr(dedup, "FAN_IN", 2)
    rows = [(i, f"text {i % 37}") for i in range(400)]
    df = frame(rows, "doc_id long, text string", 13)
    assert dedup.rounds_of(13) == 4
    assert told(dedup.deduplicate(df).collect()) == brute(rows)
    # Every level leaves one entry per slot and text, and the last one entry per text.
    entries = dedup.text_entries(df, "doc_id", "text")
    left = [dedup.merged_runs(entries, places=p) for p in range(5)]
    sizes = [x.count() for x in left]
    assert sizes[0] == 400 and sizes == sorted(sizes, reverse=True) and sizes[4] == 37


def test_entries_with_equal_digest_but_other_text_stay_apart(spark):
    rows = [(0, 0, 5, bytearray(b"d" * 32), 4, 1), (1, 1, 6, bytearray(b"d" * 32), 4, 2), (1, 2, 7, bytearray(b"d" * 32), 4, 2)]
    entries = spark.createDataFrame(rows, "run long, row long, id long, digest binary, bytes long, second long")
    got = sorted((r.second, r.best_id, r.n) for r in dedup.merged_runs(entries).collect())
    assert got == [(1, 5, 1), (2, 7, 2)]


def test_no_python_in_the_plan_and_no_text_is_shuffled(frame):
    df = frame([(1, "a"), (2, "a")], "doc_id long, text string")
    plan = dedup.merged_runs(dedup.text_entries(df, "doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortAggregate" in plan


def test_query_on_given_documents(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert told(QUERIES["op13_exact_dedup"](spark, small).collect()) == brute(rows)
