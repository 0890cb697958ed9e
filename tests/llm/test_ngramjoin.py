import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from marginalia.llm import ngramjoin


def grams(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs, size, percent):
    sets = [grams(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, len(s), ids.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def cases(seed, n=160):
    random.seed(seed)
    pool = [f"w{i}" for i in range(400)]
    passage = " ".join(random.choices(pool, k=30))
    docs = []
    for i in range(n):
        kind = i % 4
        if kind == 0 or not docs:
            body = " ".join(random.choices(pool, k=random.randint(1, 90)))
        elif kind == 1:
            body = passage + " " + " ".join(random.choices(pool, k=random.randint(0, 40)))
        else:
            w = (random.choice(docs)[1] or "").split()
            for _ in range(random.randint(0, 1 + len(w) // 25)):
                if w:
                    w[random.randrange(len(w))] = random.choice(pool)
            body = " ".join(w)
        docs.append((i, body))
    docs += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One\ttwo"), (905, "é É"), (906, "é é"), (3, docs[3][1]), (None, docs[0][1]), (None, "lone words here now")]
    docs += [(907, " ".join(random.choices(pool, k=20_000)))]
    docs += [(908, docs[-1][1].upper() + " end")]
    return docs


def run(df, size, percent):
    return sorted(map(tuple, ngramjoin.near_duplicates(df, size, percent).collect()), key=str)


def test_equals_brute_force(frame):
    docs = cases(8)
    df = frame([(*d, 1, "x") for d in docs], "doc_id long, text string, sig int, n string")
    assert run(df, 4, 85) == brute(docs, 4, 85)
    assert run(df, 5, 80) == brute(docs, 5, 80)


def test_chunked_columns(frame, monkeypatch):
    # Frequent columns are cut into many chunks; the groups stay the same.
    docs = cases(9, 200)
    monkeypatch.setattr(ngramjoin, "CHUNK_ROWS", 3)
    monkeypatch.setattr(ngramjoin, "FREQUENT_ROWS", 2)
    monkeypatch.setattr(ngramjoin, "FREQUENT_IN_TASK", 1)
    assert run(frame(docs, "doc_id long, text string"), 3, 60) == brute(docs, 3, 60)


def test_long_columns(frame, monkeypatch):
    # All columns are paired inside tasks, in small blocks; sizes differ widely at 40 percent.
    monkeypatch.setattr(ngramjoin, "PAIRED_ROWS", 1)
    monkeypatch.setattr(ngramjoin, "BLOCK_ROWS", 4)
    monkeypatch.setattr(ngramjoin, "MEETINGS", 0)
    docs = cases(12, 120)
    df = frame(docs, "doc_id long, text string")
    assert run(df, 4, 85) == brute(docs, 4, 85)
    assert run(df, 3, 40) == brute(docs, 3, 40)


def test_overlap_bounds(frame, monkeypatch):
    # Overlaps are the exact counts of common prefix columns, and no pair that is alike is discarded.
    docs = [d for d in cases(21, 120) if d[1] and d[0] is not None and d[0] < 900]
    df = frame(docs, "doc_id long, text string")
    for paired in (64, 2):
        monkeypatch.setattr(ngramjoin, "PAIRED_ROWS", paired)
        monkeypatch.setattr(ngramjoin, "BLOCK_ROWS", 5)
        join = ngramjoin.NGramJoin(df, 3, 60)
        rows = join.columns().select("shingle", "sig", "n", "place").distinct().collect()
        columns, sizes = {}, {}
        for r in rows:
            columns.setdefault(r.sig, {})[r.shingle] = r.place
            sizes[r.sig] = r.n
        single = join.columns().select("shingle", "sig", "n", "place", ngramjoin.F.col("sig").alias("root")).distinct()
        got = {(r.a, r.b): r for r in join.overlapping(single).collect()}
        by_id = {r.doc_id: r.sig for r in join.rows.collect()}
        sets = {by_id[d]: grams(t, 3) for d, t in docs}
        discarded = 0
        for a in sorted(columns):
            for b in (x for x in columns if x > a):
                both = len(sets[a] & sets[b])
                alike = 100 * both >= 60 * len(sets[a] | sets[b])
                if alike:
                    assert got[a, b].possible
                if (a, b) in got:
                    common = len(columns[a].keys() & columns[b].keys())
                    assert got[a, b].overlap == common or (not alike and got[a, b].overlap < common)
                    discarded += not got[a, b].possible
        assert discarded > 0


def test_chain_of_links(frame):
    # Each text drops the first word of the one before: neighbours link, the ends do not.
    words = [f"x{i}" for i in range(140)]
    docs = [(i, " ".join(words[i * 2 : i * 2 + 60])) for i in range(40)]
    got = run(frame(docs, "doc_id long, text string"), 4, 85)
    assert got == brute(docs, 4, 85) and {r[2] for r in got} == {0}


def test_empty(spark):
    assert ngramjoin.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_of_each(frame):
    docs = cases(10)
    df = frame([(*d, 1) for d in docs], "doc_id long, text string, component_id int")
    got = ngramjoin.one_of_each(df)
    assert got.columns == df.columns
    groups = {c for d, n, c in brute(docs, 5, 80) if n}
    wordless = [d for d, n, c in brute(docs, 5, 80) if not n]
    kept = [r.doc_id for r in got.collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [*groups, *wordless]))
    clashing = frame([(*d, "x", 1, 2, 3) for d in docs], "doc_id long, text string, _id string, _HASH int, _text_hash int, _salt int")
    got = ngramjoin.one_of_each(clashing)
    assert got.columns == clashing.columns and sorted(str(r.doc_id) for r in got.collect()) == sorted(map(str, kept))
    nameless = frame([(None, "one two three four five"), (None, "other words stand in here"), (None, "one two three four five")], "doc_id long, text string")
    assert ngramjoin.one_of_each(nameless).count() == 2


def test_components(spark):
    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(160)] + [(1000, i) for i in range(1001, 1100)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    got = dict(ngramjoin.components(spark.createDataFrame(edges, "a long, b long")).collect())
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        assert got[node] == min(seen)
    assert set(got) == set(near)


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=200))
def test_parity_bound(x, y):
    a, b = (np.array(sorted(s), np.uint64) for s in (x, y))
    assert ngramjoin.least_difference(ngramjoin.parity(a), ngramjoin.parity(b)) <= len(x ^ y)
