import hashlib
import random
import re

from marginalia.llm import decontaminate
from marginalia.llm.queries import CHECK_SQL, QUERIES

SEPARATOR = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SEPARATOR.split(low) if w]


def brute(docs, items, window=10):
    wanted = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            size = min(window, len(w))
            for s in range(len(w) - size + 1):
                wanted.setdefault(tuple(w[s : s + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in wanted}:
            for s in range(len(w) - size + 1):
                if names := wanted.get(tuple(w[s : s + size])):
                    hit |= set(range(s, s + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def run(docs, items):
    return sorted(map(tuple, decontaminate.decontaminate(docs, items).collect()), key=str)


def cases():
    random.seed(7)
    pool = [f"w{i}" for i in range(25)]
    text = lambda n: " ".join(random.choices(pool, k=n))
    items = [(i, text(random.randint(1, 25))) for i in range(40)] + [(100, None), (101, "?!"), (None, text(12)), (7, text(11)), (102, "Über ß 10")]
    items += [(200 + i, items[3][1]) for i in range(5)]
    docs = []
    for i in range(120):
        body = text(random.randint(0, 60))
        if i % 3 == 0:
            body += " ... " + (random.choice(items)[1] or "").upper() + "! " + text(5)
        docs.append((i, body))
    docs += [(500, None), (501, ""), (None, items[0][1]), (1, docs[1][1]), (502, "über ß 10"), (503, "ÜBER ß 10"), (504, text(30_000))]
    return docs, items


def test_equals_brute_force(frame):
    docs, items = cases()
    df = frame([(*d, "k", 1) for d in docs], "doc_id long, text string, words string, n_hit int")
    other = frame([(*i, "k") for i in items], "item_id long, text string, item string")
    assert run(df, other) == brute(docs, items)


def test_without_broadcast(frame, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    docs, items = cases()
    assert run(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")) == brute(docs, items)


def test_hot_texts_and_names_without_broadcast(frame, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    docs, items = cases()
    # A contaminated text, a clean one and one without words hold most rows.
    docs += [(2_000 + i, "start " + items[3][1]) for i in range(150)] + [(3_000 + i, f"x{i % 2}") for i in range(150)] + [(4_000 + i, None) for i in range(150)]
    df, other = frame([(*d, "k") for d in docs], "doc_id long, text string, _text_key string"), frame(items, "item_id long, text string")
    assert run(df, other) == brute(docs, items)
    got = decontaminate.clean_documents(df, other)
    assert got.columns == df.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(d[0]) for d in brute(docs, items) if not d[5])


def test_hot_keys_are_those_above_a_thousandth(frame):
    rows = frame([("hot",)] * 20 + [(f"k{i}",) for i in range(3_000)], "key string")
    assert [r.key for r in decontaminate.hot_keys(rows).collect()] == ["hot"]


def test_empty_tables(frame, spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), frame([(1, "a b")], "doc_id long, text string")
    no_items, item = spark.createDataFrame([], "item_id long, text string"), frame([(1, "a")], "item_id long, text string")
    assert run(none, item) == []
    assert run(some, no_items) == brute([(1, "a b")], [])
    assert decontaminate.clean_documents(some, no_items).count() == 1


def test_clean_documents_keeps_columns(frame):
    docs, items = cases()
    df = frame([(*d, "k") for d in docs], "doc_id long, text string, key string")
    got = decontaminate.clean_documents(df, frame(items, "item_id long, text string"))
    assert got.columns == df.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(d[0]) for d in brute(docs, items) if not d[5])


def test_query_has_sql_and_no_python(spark, small):
    assert "op4_decontaminate" in CHECK_SQL
    plan = QUERIES["op4_decontaminate"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
