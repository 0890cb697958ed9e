import pytest
from pyspark.sql import functions as F

from marginalia.operators import elements, music, provenance

SCHEMA = "doc_id string, pos int, text string, category string, page_number int, category_depth int"


@pytest.fixture(scope="module")
def titled(spark):
    rows = [
        ("a", 0, "Intro", "Title", 1, 0),
        ("a", 1, "First paragraph.  \r\n", "NarrativeText", 1, None),
        ("a", 2, "Background", "Title", 2, 1),
        ("a", 3, "   ", "NarrativeText", 2, None),
        ("a", 4, "Deep", "Header", 2, 2),
        ("a", 5, "Text", "NarrativeText", 3, None),
        ("a", 6, "Methods\nsubtitle", "Title", 4, None),
        ("a", 7, "End", "NarrativeText", None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_stacks_spans_and_pages(titled):
    rows = elements.element_map(titled).orderBy("pos").collect()
    assert [r["heading_stack"] for r in rows] == [
        ["Intro"], ["Intro"], ["Intro", "Background"], ["Intro", "Background", "Deep"],
        ["Intro", "Background", "Deep"], ["Methods"], ["Methods"],
    ]
    assert [(r["char_start"], r["char_end"]) for r in rows][:3] == [(0, 5), (7, 23), (25, 35)]
    assert [r["page_number"] for r in rows] == [1, 1, 2, 2, 3, 4, None]


def test_markdown_matches_its_map(titled):
    row = elements.format_documents(titled, {"b": F.lit(1), "a": F.lit("x")}).first()
    assert row["markdown"].startswith("---\na: x\nb: 1\n---\n\nIntro\n\nFirst paragraph.\n\nBackground")
    assert row["markdown"].endswith("End\n")
    assert [row["markdown"][e["char_start"] : e["char_end"]] for e in row["elements"]][-2:] == ["Methods\nsubtitle", "End"]
    assert elements.uncovered(elements.format_documents(titled)).count() == 0


def test_plain_text_headings(spark):
    lines = ["# One", "body", "## Two  ", "####### seven", "# A\nB", "#", "#x", "### T #"]
    frame = spark.createDataFrame([("a", i, t, None, 9, None) for i, t in enumerate(lines)], SCHEMA)
    rows = elements.classify(frame).orderBy("pos").collect()
    assert [(r["level"], r["heading"]) for r in rows] == [
        (1, "One"), (None, None), (2, "Two"), (None, None), (None, None), (None, None), (None, None), (3, "T #"),
    ]
    assert all(r["page_number"] is None for r in rows)


def test_provenance_cases(spark):
    mapped = spark.createDataFrame(
        [("d", 0, 10, 1, ["A"]), ("d", 12, 30, 2, ["A", "B"]), ("d", 32, 50, None, []), ("d", 52, 9000, 5, ["C"])],
        "doc_id string, char_start long, char_end long, page_number int, heading_stack array<string>",
    )
    chunks = spark.createDataFrame(
        [("d", 1, 0, 20), ("d", 2, 10, 12), ("d", 3, 33, 40), ("d", 4, 25, 60), ("d", 5, 8000, 9100), ("e", 1, 0, 5)],
        "doc_id string, chunk_index int, char_start int, char_end int",
    )
    got = {
        (r["doc_id"], r["chunk_index"]): (r["page_start"], r["page_end"], r["section_heading"])
        for r in provenance.add_provenance(chunks, mapped).collect()
    }
    assert got == {
        ("d", 1): (1, 2, "A"),
        ("d", 2): (None, None, "A"),
        ("d", 3): (None, None, "B"),
        ("d", 4): (2, 5, "B"),
        ("d", 5): (5, 5, "C"),
        ("e", 1): (None, None, None),
    }


MUSIC = (
    "doc_id string, pos long, element_type string, measure_number long, pitch string, duration double, "
    "sharps int, time_signature string"
)


def piece(spark, rows):
    return spark.createDataFrame([("p", i, *r) for i, r in enumerate(rows)], MUSIC)


def test_abc_and_summary(spark):
    rows = [
        ("key_sig", 1, None, None, 1, None),
        ("time_sig", 1, None, None, None, "3/4"),
        ("note", 1, "C4", 1.0, None, None),
        ("note", 1, "C5", 0.5, None, None),
        ("rest", 2, None, 2.0, None, None),
        ("note", 2, "F#4", 2.0, None, None),
        ("note", 3, "G3", 1.5, None, None),
        ("note", 3, None, 1.0, None, None),
    ]
    abc = music.to_abc(piece(spark, rows)).first()["abc"]
    assert abc == "X:1\nT:Untitled\nM:3/4\nL:1/4\nK:G\nCc/2|z2^F2|G,|\n"
    summary = music.summarize(piece(spark, rows)).first()
    assert (summary["n_notes"], summary["n_rests"], summary["n_measures"], summary["key"]) == (5, 1, 3, "G Major")


def walked(rests):
    """The segmentation rule as a walk over measures."""
    out, start = [], 1
    for i, (measure, rest) in enumerate(rests):
        last = i == len(rests) - 1
        if (rest or last) and (measure > start or last):
            out.append((start, measure, "rest" if rest else "measure_group"))
            start = measure + 1
    return out


@pytest.mark.parametrize(
    "rests",
    [[0, 0, 1, 0], [1, 1, 1, 1, 0], [0, 1, 1, 1, 1, 1], [1], [0], [1, 0, 1, 1, 0, 1], [0, 0, 1, 1], [1, 1]],
)
@pytest.mark.parametrize("first", [1, 0, 3])
def test_phrases_equal_the_walk(spark, rests, first):
    measures = [(first + i, bool(r)) for i, r in enumerate(rests)]
    rows = [("rest" if r else "note", m, None if r else "C4", 1.0, None, None) for m, r in measures]
    got = music.phrases(piece(spark, rows)).orderBy("phrase_num").collect()
    assert [(r["start_measure"], r["end_measure"], r["boundary_type"]) for r in got] == walked(measures)


def test_phrases_sort_a_piece_once(spark):
    rows = [("rest", 1, None, 1.0, None, None)]
    plan = music.phrases(piece(spark, rows).repartition(3, "doc_id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1


def test_headings_are_found_without_matching_whole_blocks(spark):
    blocks = ["# One  ", "####### seven", "###### six #", "#tag", "#", "## \u3000two\u2003", "# a\nb", "# a\n", "#\n\nnext", "#\r\nnext", " # in", "\x1f\u2028", "##\u2028x", "plain  \n  \nmore \r"]
    frame = spark.createDataFrame([(1, i, b, None, None, None) for i, b in enumerate(blocks)], "doc_id int, pos int, text string, category string, page_number int, category_depth int")
    got = {r["pos"]: (r["text"], r["level"], r["heading"]) for r in elements.classify(frame).collect()}
    assert got == {
        0: ("# One", 1, "One"), 1: ("####### seven", None, None), 2: ("###### six #", 6, "six #"), 3: ("#tag", None, None), 4: ("#", None, None),
        5: ("## \u3000two", 2, "two"), 6: ("# a\nb", None, None), 7: ("# a", 1, "a"), 8: ("#\n\nnext", 1, "next"), 9: ("#\nnext", 1, "next"),
        10: (" # in", None, None), 12: ("##\u2028x", 2, "x"), 13: ("plain\n\nmore", None, None),
    }
    # No pattern runs over a whole block to find its heading or its blanks.
    plan = elements.classify(frame)._jdf.queryExecution().executedPlan().toString()
    assert "+?" not in plan and r"]+\z" not in plan


def test_heading_stack_of_any_depth(spark):
    depths = [0, 3, 8, 6, 8, 0, 10]
    rows = [(1, i, f"h{i}", "Title", 1, d) for i, d in enumerate(depths)] + [(1, 99, "body", "NarrativeText", 2, 0), (2, 0, "alone", "NarrativeText", 1, 0)]
    frame = spark.createDataFrame(rows, "doc_id int, pos int, text string, category string, page_number int, category_depth int")
    got = {(r["doc_id"], r["pos"]): r["heading_stack"] for r in elements.element_map(frame).collect()}
    assert [got[1, i] for i in (*range(7), 99)] == [
        ["h0"], ["h0", "h1"], ["h0", "h1", "h2"], ["h0", "h1", "h3"], ["h0", "h1", "h3", "h4"], ["h5"], ["h5", "h6"], ["h5", "h6"],
    ]
    assert got[2, 0] == []


def test_front_matter_from_the_document_table(spark):
    frame = spark.createDataFrame(
        [("a", 0, "One", "NarrativeText", 1, 0), ("a", 1, "Two", "NarrativeText", 1, 0), ("b", 0, "  ", "NarrativeText", 1, 0)],
        "doc_id string, pos int, text string, category string, page_number int, category_depth int",
    )
    docs = spark.createDataFrame([("a", "x.pdf"), ("b", "y.pdf"), ("c", "z.pdf")], "doc_id string, source string")
    formatted = elements.format_documents(frame, {"source": F.col("source")}, docs)
    got = {r["doc_id"]: r["markdown"] for r in formatted.collect()}
    assert got["a"].startswith("---\nsource: x.pdf\n---\n\n") and got["a"].endswith("\n\nOne\n\nTwo\n")
    assert got["b"] == "---\nsource: y.pdf\n---\n\n" and got["c"] == "---\nsource: z.pdf\n---\n\n"
    assert elements.uncovered(formatted, F.lit(len("---\nsource: x.pdf\n---\n\n"))).count() == 0
    assert elements.uncovered(elements.format_documents(frame)).count() == 0
    broken = elements.format_documents(frame).withColumn("markdown", F.regexp_replace("markdown", "One\n", "One"))
    assert [r["doc_id"] for r in elements.uncovered(broken).collect()] == ["a"]
