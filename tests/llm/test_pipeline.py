"""The stages of the pipeline against brute force, each on its own input."""

import corpus_pipeline
from marginalia.llm.common import kept
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_ngramjoin import brute as groups
from tests.llm.test_packing import check
from tests.llm.test_secrets import base

def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "decontamination", "secrets", "packing"]

    def rows(df):
        return sorted(map(tuple, df.select("doc_id", "text").collect()))

    before = rows(docs)
    docs = kept(stages["language"](spark, docs, small), "t")
    assert docs.columns == columns
    assert rows(docs) == [r for r in before if any(map(str.isalpha, r[1] or ""))]

    before = rows(docs)
    docs = kept(stages["near_duplicates"](spark, docs, small), "t")
    least = {c for _, _, c in groups(before, 5, 80)}
    assert docs.columns == columns and rows(docs) == [r for r in before if r[0] in least]

    before = rows(docs)
    docs = kept(stages["decontamination"](spark, docs, small), "t")
    clean = {r[0] for r in contaminated(before, items) if not r[5]}
    assert docs.columns == columns and rows(docs) == [r for r in before if r[0] in clean]

    before = dict(rows(docs))
    docs = kept(stages["secrets"](spark, docs, small), "t")
    after = dict(rows(docs))
    assert docs.columns == columns and after.keys() == before.keys()
    for doc, text in before.items():
        assert not base(after[doc])
        assert after[doc] == text if not base(text) else "[secret]" in after[doc]

    packed = stages["packing"](spark, docs, small).collect()
    check(packed, [tuple(r) for r in docs.select("doc_id", "text", "source").collect()], 4096)

def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0
