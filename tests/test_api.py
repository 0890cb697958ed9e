import pytest
from pyspark.sql import functions as F

from marginalia import api
from marginalia.operators import models, music
from marginalia.operators.splitter import ChunkConfig
from marginalia.sources.musicxml import musicxml_elements

TEXTS = {
    "alpha": "quantum mechanics transformer attention heads alpha",
    "beta": "bootstrap confidence interval small sample beta",
    "gamma": "falsifiability popper philosophical demarcation gamma",
}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    rows = [(f"doc-{k}", k, f"{k}.pdf", t) for k, t in TEXTS.items()]
    docs = spark.createDataFrame(rows, "doc_id string, slug string, source string, text string")
    api.index_agent(docs, "mini", root, models.digest_embedder(16), ChunkConfig(40, 10))
    return root


def queries(spark):
    return spark.createDataFrame([(1, "popper philosophical"), (2, "confidence interval")], "query_id long, text string")


@pytest.mark.parametrize("mode", ["dense", "bm25", "hybrid"])
def test_search_modes(spark, corpus, mode):
    found = api.search(spark, corpus, "mini", queries(spark), 2, mode, embedder=models.digest_embedder(16)).collect()
    assert sorted((r["query_id"], r["rank"]) for r in found) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    if mode == "bm25":
        best = {r["query_id"]: r for r in found if r["rank"] == 1}
        assert best[1]["doc_id"] == "doc-gamma" and best[1]["citation"] == "[gamma]"
        assert best[2]["doc_id"] == "doc-beta"


def test_search_reranks(spark, corpus):
    found = api.search(
        spark, corpus, "mini", queries(spark), 1, "hybrid", embedder=models.digest_embedder(16),
        scorer=models.overlap_scorer,
    ).collect()
    assert {r["query_id"]: r["doc_id"] for r in found} == {1: "doc-gamma", 2: "doc-beta"}
    with pytest.raises(ValueError):
        api.search(spark, corpus, "mini", queries(spark), mode="other")


def test_pages_and_sections_reach_the_citation(spark, tmp_path):
    docs = spark.createDataFrame([("d1", "deep-paper", "deep.pdf"), ("d2", "empty", "empty.pdf")], "doc_id string, slug string, source string")
    rows = [("d1", 0, "Methods", "Title", 3, 0), ("d1", 1, "Bootstrap", "Title", 3, 1), ("d1", 2, "resampling with replacement", "NarrativeText", 4, 0), ("d2", 0, " ", "NarrativeText", 1, 0)]
    parsed = spark.createDataFrame(rows, "doc_id string, pos int, text string, category string, page_number int, category_depth int")
    stored = api.index_agent(docs, "deep", str(tmp_path), models.digest_embedder(16), parsed=parsed)
    assert [(r["page_start"], r["page_end"], r["section_heading"]) for r in stored.collect()] == [(3, 4, "Methods")]
    asked = spark.createDataFrame([(1, "resampling")], "query_id long, text string")
    for mode in ("dense", "bm25", "hybrid"):
        found = api.search(spark, str(tmp_path), "deep", asked, 1, mode, embedder=models.digest_embedder(16)).collect()
        assert [r["citation"] for r in found] == ["[deep, p.3–4, §Methods]"]


def test_an_update_leaves_neither_old_text_nor_double_ranks(spark, tmp_path):
    from marginalia.operators import bm25
    from marginalia.sources import store

    embed = models.digest_embedder(16)
    texts = spark.createDataFrame([(0, "c-1", "old words", "2024-01-01"), (1, "c-1", "new words", None)], "embedding_index long, chunk_id string, text string, at string")
    rows = models.embed(texts, embed).select(
        "*", F.lit("d").alias("doc_id"), F.lit("s.pdf").alias("source"), F.lit("up").alias("agent"), F.to_timestamp("at").alias("deleted_utc")
    )
    store.write_vectors(rows, f"{tmp_path}/vectors/up")
    store.write_bm25(
        bm25.build_index(rows.select(F.col("embedding_index").alias("bm25_index"), "chunk_id", "doc_id", "text", "deleted_utc"), materialize=True), f"{tmp_path}/bm25/up"
    )
    asked = spark.createDataFrame([(1, "words")], "query_id long, text string")
    for mode in ("dense", "bm25", "hybrid"):
        found = api.search(spark, str(tmp_path), "up", asked, 3, mode, embedder=embed).collect()
        assert [(r["rank"], r["text"]) for r in found] == [(1, "new words")]
    with pytest.raises(store.StoreError):
        store.write_vectors(rows, f"{tmp_path}/vectors/none")
        api.search(spark, str(tmp_path), "none", asked, 1, "bm25", embedder=embed)


def test_agents_are_listed(spark, corpus):
    assert [r["agent"] for r in api.list_agents(spark, corpus).collect()] == ["mini"]


def test_evaluate(spark, corpus):
    found = api.search(spark, corpus, "mini", queries(spark), 3, "bm25").select(
        F.col("query_id").cast("string").alias("item_id"), "rank", "doc_id"
    )
    none = F.lit(None).cast("int")
    items = spark.createDataFrame([("1",), ("2",), ("3",)], "item_id string").select(
        "item_id", none.alias("expected_page_start"), none.alias("expected_page_end"), F.lit(None).cast("string").alias("expected_section")
    )
    expected = spark.createDataFrame([("1", "doc-gamma"), ("2", "doc-beta"), ("3", "gone")], "item_id string, doc_id string")
    tags = spark.createDataFrame([("1", "t")], "item_id string, tag string")
    manifest = spark.createDataFrame([(f"doc-{k}",) for k in TEXTS], "doc_id string")
    run = api.evaluate(found, {"items": items, "expected": expected, "tags": tags}, manifest)
    row = run["aggregate"].first()
    assert (row["n_items"], row["recall_at_1"], row["mrr"]) == (2, 1.0, 1.0)
    assert [r["item_id"] for r in run["skipped"].collect()] == ["3"]
    assert run["per_tag"].first()["low_sample"]


def test_musicxml(spark):
    xml = """<score-partwise><part id="P1">
      <measure number="1"><attributes><divisions>2</divisions><key><fifths>1</fifths></key><time><beats>3</beats><beat-type>4</beat-type></time></attributes>
        <note><pitch><step>F</step><alter>1</alter><octave>4</octave></pitch><duration>2</duration></note>
        <note><rest/><duration>4</duration></note></measure>
      <measure number="2"><note><pitch><step>C</step><octave>5</octave></pitch><duration>1</duration></note></measure>
    </part></score-partwise>"""
    elements = musicxml_elements(spark.createDataFrame([("p", xml)], "doc_id string, xml string"))
    assert music.to_abc(elements).first()["abc"] == "X:1\nT:Untitled\nM:3/4\nL:1/4\nK:G\n^Fz2|c/2|\n"


def write_docx(path, paragraphs):
    import zipfile

    word = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(f'<w:p><w:pPr><w:pStyle w:val="{style}"/></w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>' for style, text in paragraphs)
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("word/document.xml", f"<w:document {word}><w:body>{body}</w:body></w:document>")


def test_files_are_cited_by_page_and_section(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "corpus")
    folder.mkdir()
    write_docx(folder / "Guide.docx", [("Heading1", "Methods"), ("Heading2", "Bootstrap"), ("Normal", "resampling with replacement")])
    (folder / "scan.pdf").write_bytes(b"%PDF scan")
    (folder / "copy.md").write_bytes(b"plain words\n")
    (folder / "same.md").write_bytes(b"plain words\n")
    (folder / "bad.epub").write_bytes(b"no archive")

    def ocr(content):
        return [("Results", "Title", 7, 0), ("coverage of intervals", "NarrativeText", 8, None)]

    embed = models.digest_embedder(16)
    outcome = {r["path"].rsplit("/", 1)[1]: r for r in api.ingest_files(spark, str(folder), "f", root, embed, ocr_mode="on", ocr=ocr).collect()}
    assert {n: (r["status"], r["action"]) for n, r in outcome.items()} == {
        "Guide.docx": ("success", "process"), "scan.pdf": ("success", "process"), "copy.md": ("success", "process"),
        "same.md": ("success", "duplicate"), "bad.epub": ("failed", None),
    }
    asked = spark.createDataFrame([(1, "resampling"), (2, "coverage"), (3, "plain")], "query_id long, text string")
    found = api.search(spark, root, "f", asked, 1, "bm25", embedder=embed).collect()
    assert {r["query_id"]: r["citation"] for r in found} == {1: "[guide, §Methods]", 2: "[scan, p.7–8, §Results]", 3: "[copy]"}
    again = api.ingest_files(spark, str(folder), "f", root, embed, ocr_mode="on", ocr=ocr).filter("status = 'success'")
    assert {r["action"] for r in again.collect()} == {"skip", "duplicate"}
