import random
import zlib

from marginalia.llm import language
from marginalia.llm.queries import QUERIES

SOUNDS = {"aa": ["ba", "ko", "mi", "tu"], "bb": ["sch", "ein", "ung", "lich"], "cc": ["que", "oi", "eau", "tion"]}


def text(lang, n=30):
    return " ".join("".join(random.choices(SOUNDS[lang], k=3)) for _ in range(n))


def corpus(n=300):
    random.seed(11)
    langs = list(SOUNDS)
    return [(i, text(langs[i % 3]), langs[i % 3]) for i in range(n)]


def test_learns_and_answers_odd_rows(frame):
    docs = corpus() + [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !", None), (903, text("bb", 30_000), None), (None, text("cc"), None), (5, corpus()[5][1], "cc"), (904, "Ж", None)]
    df = frame([(*d, 1, "x") for d in docs], "doc_id long, text string, lang string, score int, held_out string")
    got = language.identify(df).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    by = {r.doc_id: r.lang_pred for r in got}
    assert (by[900], by[901], by[902], by[903], by[None]) == ("und", "und", "und", "bb", "cc")
    assert by[904] in SOUNDS
    assert all(by[d] == lang for d, t, lang in docs[:300])


def test_held_out_labels_teach_nothing(frame):
    docs = corpus()
    wrong = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 3 == 1 else lang) for d, t, lang in docs]
    a, b = (sorted(map(tuple, language.identify(frame(x, "doc_id long, text string, lang string")).collect())) for x in (docs, wrong))
    assert a == b and "zz" not in {r[2] for r in a}


def test_nothing_to_learn(frame, spark):
    got = language.identify(frame([(1, "words", None)], "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert language.identify(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_nothing_to_learn_drops_no_language(frame):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1)
    for lang, doc_id in ((None, 1), ("aa", held)):
        docs = [(doc_id, t, lang) for t in ("words", "Ж 1", "\n中\n", "12 34 !", "", None)]
        got = language.known_language(frame(docs, "doc_id long, text string, lang string")).collect()
        assert sorted(r.text for r in got) == sorted(["words", "Ж 1", "\n中\n"])


def test_kernel_is_the_presence_kernel():
    random.seed(12)
    texts = [text(lang, 5) for lang in SOUNDS for _ in range(4)]
    sets = [language.present(t) for t in texts]
    model = language.solve(["aa"], sets, [("aa", s) for s in sets])
    model.weights, model.bias = language.np.eye(len(texts), dtype="float32"), language.np.zeros(len(texts), "float32")
    got = model.score(texts)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            want = len(set(x) & set(y)) / (len(x) * len(y)) ** 0.5
            assert abs(got[i, j] - want) < 1e-3


def test_accuracy_on_held_out_documents(spark, small):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op5_language_id"](spark, small).collect()
    assert len(got) == len(langs)
    held = [r for r in got if r.held_out and langs[r.doc_id]]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)
