import random
import zlib
from collections import Counter, defaultdict

import pytest

from marginalia.llm import sharding
from marginalia.llm.queries import QUERIES


def laws(rows, shards, docs):
    """The row law, gapless slots, sizes and checksums."""
    counts = Counter(r.shard for r in rows)
    assert len(rows) == len(docs)
    assert max(counts[s] for s in range(shards)) - min(counts[s] for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert (r.law, r.grown_shard) == ("rows", None)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def cuts(rows, docs):
    """Pairs of equal texts in different shards."""
    text = dict(docs)
    per = defaultdict(Counter)
    for r in rows:
        if text[r.doc_id] is not None:
            per[text[r.doc_id]][r.shard] += 1
    return sum((sum(c.values()) ** 2 - sum(n * n for n in c.values())) // 2 for c in per.values())


def test_groups_stay_together(frame):
    docs = [(i, f"text {i}" if i % 3 else f"copy {i % 60}") for i in range(600)]
    rows = sharding.shard_rows(frame(docs, "doc_id long, text string"), 16).collect()
    laws(rows, 16, docs)
    assert cuts(rows, docs) == 0


def test_hot_group_fills_whole_shards(frame):
    docs = [(i, "hot" if i % 3 == 0 else f"text {i}") for i in range(1600)]
    rows = sharding.shard_rows(frame(docs, "doc_id long, text string"), 16).collect()
    laws(rows, 16, docs)
    spread = Counter(r.shard for r in rows if r.doc_id % 3 == 0)
    # 534 of 1,600 rows need six shards of 100; a few units may lie apart.
    assert sum(n for _, n in spread.most_common(6)) >= 480
    random = Counter(i % 16 for i in range(534))
    assert cuts(rows, docs) < (534**2 - sum(n * n for n in random.values())) // 2


@pytest.mark.parametrize("n", [0, 1, 5, 17])
def test_few_rows(frame, spark, n):
    docs = [(i, "same") for i in range(n)]
    df = frame(docs, "doc_id long, text string") if n else spark.createDataFrame([], "doc_id long, text string")
    laws(sharding.shard_rows(df, 16).collect(), 16, docs)


def test_odd_rows(frame):
    docs = [(None, "a"), (None, "a"), (1, None), (1, None), (2, ""), (2, ""), (3, "é" * 40_000), (4, "x")] * 3
    df = frame([(*d, 9, 9) for d in docs], "doc_id long, text string, shard int, slot int")
    laws(sharding.shard_rows(df, 3).collect(), 3, docs)
    with pytest.raises(ValueError):
        sharding.shard_rows(df, 0)


def test_given_documents(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op6_sharding"](spark, small).collect()
    laws(rows, 16, docs)
    assert cuts(rows, docs) == 0


def cut_groups(rows, docs, quota):
    """Texts whose rows fit one shard but lie in several, and the pieces of each larger text."""
    text = dict(docs)
    per = defaultdict(Counter)
    for r in rows:
        per[text[r.doc_id]][r.shard] += 1
    fits = [t for t, c in per.items() if sum(c.values()) <= quota and len(c) > 1]
    return fits, {t: len(c) for t, c in per.items() if sum(c.values()) > quota}


def test_a_third_in_one_group_beside_others(frame):
    names = ["hot"] * 2133 + [f"large {i % 10}" for i in range(2000)] + [f"small {i % 100}" for i in range(1000)]
    docs = [(i, names[i] if i < len(names) else f"text {i}") for i in range(6400)]
    rows = sharding.shard_rows(frame(docs, "doc_id long, text string"), 16).collect()
    laws(rows, 16, docs)
    # Shards of 400: five full ones and a part of one more for the hot text.
    assert cut_groups(rows, docs, 400) == ([], {"hot": 6})


def test_nearly_all_rows_linked(frame):
    docs = [(i, f"copy {i // 7}" if i < 3199 else f"text {i}") for i in range(3205)]
    rows = sharding.shard_rows(frame(docs, "doc_id long, text string"), 16).collect()
    laws(rows, 16, docs)
    # 457 groups of seven in shards of 200 or 201 rows: 28 fit whole, so nine of them must be cut.
    assert len(cut_groups(rows, docs, 200)[0]) == 457 - 16 * 28


def test_rounds_move_documents_to_their_neighbours(spark, frame):
    names = ["hot"] * 900 + [f"group {i % 40}" for i in range(800)] + [f"pair {i % 200}" for i in range(400)]
    part = random.Random(1).randrange
    rows = [(bytearray(name.encode().ljust(16)), part(64)) for name in names]
    rows += [(None, part(64)) for _ in range(300)]
    nodes = frame(rows, "link binary, part int")
    units, whole, pieces, cuts = sharding.label_groups(nodes, [300] * 8)
    # Edges cut before the first round and after each: they only fall.
    assert len(cuts) > 2 and all(a >= b for a, b in zip(cuts, cuts[1:])) and cuts[0] > 5000 and cuts[-1] == 0
    labels = defaultdict(set)
    for r in units.collect():
        labels[bytes(r["link"])].add(r["label"])
    assert all(len(v) == 1 for v in labels.values()) and len(labels) == 241
    assert [sum(n for _, n in own) for own in pieces] == [900] and len(pieces[0]) == 3
    assert sum(whole) == 1200 and max(whole) <= 300


def test_the_rounds_are_joins(spark, frame, monkeypatch):
    plans = []
    real = sharding.kept

    def noted(df, kind):
        plans.append((kind, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, kind)

    monkeypatch.setattr(sharding, "kept", noted)
    groups = frame([(bytearray([i]), 4) for i in range(6)], "link binary, n long")
    votes = frame([(bytearray([i]), s, 2) for i in range(6) for s in (i % 3, (i + 1) % 3)], "link binary, shard int, votes long")
    outcome = sharding.propagate(groups, votes, [8, 8, 8])
    assert sorted(Counter(r["shard"] for r in outcome.settled.collect()).items()) == [(0, 2), (1, 2), (2, 2)]
    assert outcome.cut_edges[0] == 24 and outcome.cut_edges[-1] == 0 and not outcome.homeless
    assert all("Join" in plan and "ArrowEval" not in plan for kind, plan in plans if kind == "wishes")
    # Who moved has gone where neighbours were, as long as there was room.
    first = {bytes(r["link"])[0]: r["shard"] for r in outcome.settled.collect()}
    assert sum(first[i] in (i % 3, (i + 1) % 3) for i in range(6)) >= 4
