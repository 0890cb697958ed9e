import random
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from marginalia.llm import packing
from marginalia.llm.queries import QUERIES


def plain_best_fit(sizes, sources, clusters, capacity):
    """The rule, said directly: of all compatible bins that with least room."""
    bins, where = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        best = None
        for b, (room, s, c) in enumerate(bins):
            if room >= sizes[i] and sources[i] not in s and clusters[i] not in c and (best is None or room < bins[best][0]):
                best = b
        if best is None:
            bins.append([capacity, set(), set()])
            best = len(bins) - 1
        bins[best][0] -= sizes[i]
        bins[best][1] |= {sources[i]} - {None}
        bins[best][2] |= {clusters[i]} - {None}
        where[i] = best
    return bins


@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, "p", "q", "r", "s"])), max_size=60))
def test_is_best_fit(items):
    sizes, sources, clusters = ([x[k] for x in items] for k in range(3))
    where, slot, filled = packing.pack(sizes, sources, clusters, 20)
    # Ties between bins of equal room may fall differently; the rule and the bounds hold.
    per = defaultdict(list)
    for i, b in enumerate(where):
        per[b].append(i)
    for b, members in per.items():
        assert sum(sizes[i] for i in members) == filled[b] <= 20
        assert sorted(slot[i] for i in members) == list(range(len(members)))
        for values in (sources, clusters):
            held = [values[i] for i in members if values[i] is not None]
            assert len(held) == len(set(held))


def test_equals_plain_rule_without_ties():
    random.seed(13)
    sizes = random.sample(range(1, 5000), 400)
    sources = [random.choice("abcdefgh") if i % 3 else "hot" for i in range(400)]
    clusters = [random.randrange(300) for _ in range(400)]
    where, _, filled = packing.pack(sizes, sources, clusters, 10_000)
    bins = plain_best_fit(sizes, sources, clusters, 10_000)
    assert sorted(10_000 - b[0] for b in bins) == sorted(filled.values())


def check(rows, docs, capacity):
    """Whole texts are covered once, and no bin breaks a bound."""
    per, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        per[r.cell, r.bin].append(r)
        pieces[r.doc_id].append((r.first_word, r.n_words))
    for members in per.values():
        assert sum(r.n_words for r in members) == members[0].bin_words <= capacity
        held = [r.source for r in members if r.source is not None]
        assert len(held) == len(set(held))
    want = defaultdict(list)
    for doc, text, *_ in docs:
        n = max(1, len((text or "").split()))
        want[doc] += [(a, min(capacity, n - a)) for a in range(0, n, capacity)]
    assert {d: sorted(v) for d, v in pieces.items()} == {d: sorted(v) for d, v in want.items()}


def test_documents(frame):
    random.seed(14)
    docs = [(i, "w " * random.randint(0, 250), "hot" if i % 3 == 0 else f"s{i % 17}") for i in range(300)]
    docs += [(400, None, None), (401, "", "s1"), (None, "a b", None), (None, "c", "s2"), (402, "x " * 5000, "s3"), (5, docs[5][1], docs[5][2])]
    df = frame([(*d, 1, "y") for d in docs], "doc_id long, text string, source string, bin int, cell string")
    check(packing.pack_documents(df, 100).collect(), docs, 100)


def test_many_cells(frame, monkeypatch):
    monkeypatch.setattr(packing, "CELL_ITEMS", 20)
    docs = [(i, "w " * (i % 40), f"s{i % 5}") for i in range(200)]
    rows = packing.pack_documents(frame(docs, "doc_id long, text string, source string"), 60).collect()
    assert len({r.cell for r in rows}) > 5
    check(rows, docs, 60)


def test_clusters_apart(frame):
    docs = [(i, "Same  text" if i % 2 else "same text", f"s{i}") for i in range(10)]
    rows = packing.pack_documents(frame(docs, "doc_id long, text string, source string"), 100).collect()
    assert len({(r.cell, r.bin) for r in rows}) == 10
    named = frame([(i, "a", f"s{i}", None) for i in range(10)], "doc_id long, text string, source string, c int")
    assert len({(r.cell, r.bin) for r in packing.pack_documents(named, 100, "c").collect()}) == 1


def test_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_given_documents(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "source").collect()]
    check(QUERIES["op2_packing"](spark, small).collect(), docs, packing.CAPACITY)
