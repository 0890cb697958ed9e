import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from marginalia.operators import bm25
from marginalia.sources import configs, export, files, parsers, store

WORD = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(paragraphs):
    body = "".join(
        f'<w:p><w:pPr><w:pStyle w:val="{style}"/></w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>' for style, text in paragraphs
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("word/document.xml", f"<w:document {WORD}><w:body>{body}</w:body></w:document>")
    return out.getvalue()


def epub(pages):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for n, page in enumerate(pages):
            archive.writestr(f"c{n}.xhtml", page)
    return out.getvalue()


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "b.EPUB").write_bytes(epub(["<p>One</p><p>Two &amp; 3</p>", "<script>x</script>", "<h1>Last</h1>"]))
    (tmp_path / "A.docx").write_bytes(docx([("Heading1", "Title"), ("Normal", "Body"), ("Normal", " "), ("Heading2", "Sub")]))
    (tmp_path / "c.md").write_text("# Hi\n\ntext")
    (tmp_path / "bad.epub").write_bytes(b"not a zip")
    (tmp_path / "scan.pdf").write_bytes(b"%PDF-1.4 nothing")
    (tmp_path / "skip.txt").write_text("no")
    return tmp_path


def test_scan_sorts_and_filters(spark, folder):
    rows = files.listing(files.read_files(spark, str(folder))).collect()
    assert [r["name"] for r in rows] == ["b.EPUB", "bad.epub", "scan.pdf"]
    with pytest.raises(Exception):
        files.read_files(spark, str(folder / "missing")).count()


def test_size_limit_reports_instead_of_dropping(spark, folder):
    small, large = files.split_by_size(files.read_files(spark, str(folder)), 12)
    assert [r["name"] for r in small.collect()] == ["bad.epub"]
    assert {r["name"]: r["status"] for r in large.collect()} == {"b.EPUB": "failed", "scan.pdf": "failed"}


def test_parsers_keep_errors_in_the_row(spark, folder):
    source = files.read_files(spark, str(folder), files.PARSED_SUFFIXES + files.DIRECT_SUFFIXES)
    got = {r["name"]: r for r in parsers.parse_files(source, "off").collect()}
    assert got["b.EPUB"]["elements"] == ["One\n\nTwo & 3", "Last"]
    assert got["A.docx"]["elements"] == ["# Title\n\nBody\n\n## Sub"]
    assert got["c.md"]["elements"] == ["# Hi\n\ntext"]
    assert got["bad.epub"]["status"] == "failed" and got["bad.epub"]["elements"] is None
    assert "OCR" in got["scan.pdf"]["error"]
    ocr = parsers.parse_files(source.filter("suffix = '.pdf'"), "on", lambda content: ["read by ocr"]).first()
    assert ocr["elements"] == ["read by ocr"]
    with pytest.raises(ValueError):
        parsers.parse_files(source, "sometimes")


def test_grep_and_chunk_files(spark, tmp_path):
    export.write_tree(
        spark.createDataFrame(
            [("doc-a/chunks/ch_0001.md", "---\na: 1\n---\n\nalpha\nbeta"), ("doc-a/doc.md", "alpha")],
            "relative_path string, content string",
        ),
        str(tmp_path / "corpus"),
    )
    rows = files.grep(spark, str(tmp_path / "corpus"), "^(alpha|beta)$").collect()
    assert [(r["path"].rsplit("/", 1)[1], r["line_number"]) for r in rows] == [("ch_0001.md", 5), ("ch_0001.md", 6), ("doc.md", 1)]
    assert [r["slug"] for r in files.read_chunk_files(spark, str(tmp_path / "corpus")).collect()] == ["doc-a"]
    assert not list((tmp_path / "corpus").rglob("*.tmp"))


def test_manifest_json(spark, tmp_path):
    entry = {"doc_id": "1", "slug": "a", "orig_name": "a.pdf", "chunk_count": 2, "collections": ["x"]}
    good = tmp_path / "_index.json"
    good.write_text(json.dumps({"created_utc": "t", "updated_utc": "t", "docs": [entry]}, indent=2))
    row = store.read_manifest_json(spark, str(good)).first()
    assert (row["doc_id"], row["chunk_count"], row["collections"]) == ("1", 2, ["x"])
    good.write_text(json.dumps({"created_utc": "t", "updated_utc": "t", "docs": [{"doc_id": "1", "slug": "a"}]}))
    with pytest.raises(Exception, match="manifest entry"):
        store.read_manifest_json(spark, str(good)).collect()
    store.write_manifest(spark.createDataFrame([("1", "b"), ("2", "a")], "doc_id string, slug string"), str(tmp_path / "out"))
    assert [r["slug"] for r in spark.read.json(str(tmp_path / "out")).collect()] == ["a", "b"]
    with pytest.raises(Exception, match="orig_name"):
        store.read_manifest(spark, str(tmp_path / "out")).collect()
    with pytest.raises(Exception, match="without docs"):
        store.read_manifest_json(spark, str(tmp_path / "out")).collect()
    whole = spark.createDataFrame([("1", "b", "b.pdf", 3), ("2", "a", "a.pdf", 4)], "doc_id string, slug string, orig_name string, chunk_count int")
    store.write_manifest(whole, str(tmp_path / "again"))
    assert [(r["slug"], r["chunk_count"]) for r in store.read_manifest(spark, str(tmp_path / "again")).collect()] == [("a", 4), ("b", 3)]


VECTORS = "agent string, embedding_index long, chunk_id string, doc_id string, embedding array<float>"


def test_vector_store_versions(spark, tmp_path):
    root = str(tmp_path / "vectors")
    first = spark.createDataFrame([("x", 0, "c0", "d", [1.0, 0.0]), ("y", 0, "c0", "d", [0.0, 1.0])], VECTORS)
    store.write_vectors(first, root)
    store.append_vectors(spark, root, spark.createDataFrame([("x", 1, "c1", "e", [0.5, 0.5])], VECTORS))
    assert store.read_vectors(spark, root).count() == 3
    assert store.read_vectors(spark, root, "x").count() == 2
    assert store.write_vectors(first.limit(0), str(tmp_path / "none")) is None
    mixed = first.unionByName(spark.createDataFrame([("x", 1, "c", "d", [1.0])], VECTORS))
    with pytest.raises(store.StoreError, match="dimensions"):
        store.write_vectors(mixed, root)
    gap = spark.createDataFrame([("x", 5, "c", "d", [1.0, 1.0])], VECTORS)
    store.write_vectors(gap, str(tmp_path / "gap"))
    with pytest.raises(store.StoreError, match="inconsistent"):
        store.read_vectors(spark, str(tmp_path / "gap"))
    with pytest.raises(store.StoreError, match="nothing"):
        store.read_vectors(spark, str(tmp_path / "missing"))


def test_bm25_store(spark, tmp_path):
    root = str(tmp_path / "bm25")
    assert store.read_bm25(spark, root) is None
    chunks = spark.createDataFrame(
        [(0, "c0", "d0", "red fox"), (1, "c1", "d1", "blue fox"), (2, "c2", "d2", "green tree")],
        "bm25_index long, chunk_id string, doc_id string, text string",
    )
    built = bm25.build_index(chunks)
    store.write_bm25(built, root)
    read = store.read_bm25(spark, root)
    queries = spark.createDataFrame([(1, "red fox")], "query_id long, text string")
    assert bm25.search_bm25(read, queries, 3).collect() == bm25.search_bm25(built, queries, 3).collect()
    listed = bm25.search_postings(store.read_postings(spark, root), read.terms, read.meta, queries, 3)
    assert [r["bm25_index"] for r in listed.orderBy("rank").collect()] == [0, 1]
    other = bm25.Bm25Index(built.docs, built.terms, built.meta.withColumn("tokenizer", F.lit("other")))
    store.write_bm25(other, root)
    with pytest.raises(store.StoreError, match="other"):
        store.read_bm25(spark, root)


AGENT = """
name: mini
description: test agent
corpus_filter:
  collections: [science]
  exclude_slugs: [gamma]
persona: {icon: x}
"""

FIXTURE = {
    "agent": "mini",
    "version": 1,
    "items": [
        {"id": "one", "query": "q", "expected": {"doc_ids": ["a", "b"], "chunk_ids": ["a/ch_0002"], "page": [5, 6], "section": "S"}, "tags": ["t"]},
        {"id": "two", "query": "q", "expected": {"doc_ids": ["c"], "page": 3}},
    ],
}


def test_agents(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "mini.yaml").write_text(AGENT)
    agent = configs.load_agent("mini", tmp_path)
    assert (agent.slugs, agent.collections, agent.exclude_slugs) == (None, ["science"], ["gamma"])
    tables = configs.agent_relations(spark, [agent])
    assert [t.count() for t in tables] == [1, 1, 0, 1]
    (tmp_path / "open.yaml").write_text("name: open\ncorpus_filter: none\n")
    assert configs.load_agent("open", tmp_path).collections is None
    (tmp_path / "bad.yaml").write_text("description: x\n")
    for name in ("bad", "missing"):
        with pytest.raises(configs.ConfigError):
            configs.load_agent(name, tmp_path)


def test_personas(tmp_path):
    pytest.importorskip("yaml")
    nobody = configs.load_persona("ghost", tmp_path)
    assert nobody == {"name": "ghost", "style": "", "expertise": [], "greeting": ""}
    nobody["expertise"].append("x")
    assert configs.load_persona("ghost", tmp_path)["expertise"] == []
    (tmp_path / "sage.yaml").write_text("name: sage\ndescription: Knows\npersona:\n  style: dry\n  expertise: [owls]\n  icon: o\n  mood: calm\n")
    sage = {"name": "sage", "description": "Knows", "style": "dry", "expertise": ["owls"], "greeting": "", "icon": "o"}
    assert configs.load_persona("sage", tmp_path) == sage
    (tmp_path / "bare.yaml").write_text("name: bare\npersona:\n")
    assert configs.load_persona("bare", tmp_path) == {**nobody, "name": "bare", "expertise": [], "description": "", "icon": ""}
    (tmp_path / "list.yaml").write_text("- a\n")
    with pytest.raises(configs.ConfigError):
        configs.load_persona("list", tmp_path)


def test_run_options():
    options = configs.run_options(ocr_mode="ON", parser="hybrid", music_embeddings=True)
    assert (options["ocr_mode"], options["parser"], options["vector_db"], options["formula_format"]) == ("on", "hybrid", "faiss", "latex")
    for wrong in ({"parser": "magic"}, {"ocr_mode": "maybe"}, {"vector_db": "chroma"}, {"colour": "red"}, {"music_embeddings": True}, {"chunk_overlap": 1200}):
        with pytest.raises(configs.ConfigError):
            configs.run_options(**wrong)
    with pytest.raises(configs.ConfigError, match="parser.*chunk_overlap"):
        configs.run_options(chunk_size=10, chunk_overlap=10, parser="x")


def test_fixture_relations(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "f.yaml"
    path.write_text(json.dumps(FIXTURE))
    tables = configs.load_fixture(spark, path)
    rows = {r["item_id"]: r for r in tables["items"].collect()}
    assert (rows["one"]["expected_page_start"], rows["one"]["expected_page_end"], rows["one"]["expected_section"]) == (5, 6, "S")
    assert (rows["two"]["expected_page_start"], rows["two"]["expected_page_end"]) == (3, 3)
    assert tables["expected"].count() == 3 and tables["tags"].count() == 1
    assert tuple(tables["expected_chunks"].first()) == ("one", "a", 2)
    with pytest.raises(configs.ConfigError):
        configs.load_fixture(spark, path, tmp_path)
    (tmp_path / f"{FIXTURE['agent']}.yaml").write_text(json.dumps({"name": FIXTURE["agent"]}))
    assert configs.load_fixture(spark, path, tmp_path)["items"].count() == tables["items"].count()


@pytest.mark.parametrize(
    "change",
    [
        {"agent": ""}, {"version": 2}, {"version": True}, {"items": []}, {"items": "x"},
        {"items": [{"id": "", "query": "q", "expected": {"doc_ids": ["a"]}}]},
        {"items": [{"id": "x", "query": " ", "expected": {"doc_ids": ["a"]}}]},
        {"items": [{"id": "x", "query": "q"}]},
        {"items": [{"id": "x", "query": "q", "expected": {"doc_ids": []}}]},
        {"items": [{"id": "x", "query": "q", "expected": {"doc_ids": ["a"], "chunk_ids": ["a_ch_1"]}}]},
        {"items": [{"id": "x", "query": "q", "expected": {"doc_ids": ["a"], "page": True}}]},
        {"items": [{"id": "x", "query": "q", "expected": {"doc_ids": ["a"], "page": 0}}]},
        {"items": [{"id": "x", "query": "q", "expected": {"doc_ids": ["a"], "page": [6, 5]}}]},
        {"items": [{"id": "x", "query": "q", "expected": {"doc_ids": ["a"], "page": [1]}}]},
        {"items": [{"id": "x", "query": "q", "expected": {"doc_ids": ["a"], "section": ""}}]},
        {"items": [{"id": "x", "query": "q", "expected": {"doc_ids": ["a"]}, "tags": "t"}]},
        {"items": [{"id": "x", "query": "q", "expected": {"doc_ids": ["a"]}}] * 2},
    ],
)
def test_fixture_errors(spark, tmp_path, change):
    pytest.importorskip("yaml")
    path = tmp_path / "f.yaml"
    path.write_text(json.dumps(FIXTURE | change))
    with pytest.raises(configs.ConfigError):
        configs.load_fixture(spark, path)


def test_baselines(tmp_path):
    path = tmp_path / "b.json"
    path.write_text(json.dumps({"format_version": 1, "agent": "a", "aggregate": {"mrr": 1.0}}))
    assert configs.load_baseline(path) == {"citation_accuracy": None, "n_citation_items": 0, "mrr": 1.0}
    for raw in ("{", "[]", json.dumps({"format_version": 3, "agent": "a", "aggregate": {}}), json.dumps({"format_version": 2})):
        path.write_text(raw)
        with pytest.raises(configs.ConfigError):
            configs.load_baseline(path)


def test_retrieval_settings(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "c.yaml"
    path.write_text("retrieval: {hybrid: {enabled: true, pool_size: 80}}")
    settings = configs.load_retrieval(path)
    assert configs.resolve(configs.DEFAULT_HYBRID, settings, "hybrid", k_rrf=10) == {"enabled": True, "pool_size": 80, "k_rrf": 10}
    assert configs.load_retrieval(None) == configs.load_retrieval(tmp_path / "no.yaml") == {}
    path.write_text("retrieval: [")
    assert configs.load_retrieval(path) == {}
    with pytest.raises(configs.ConfigError):
        configs.resolve(configs.DEFAULT_HYBRID, {}, "hybrid", pool_size=0)
