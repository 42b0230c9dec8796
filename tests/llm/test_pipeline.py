"""The pipeline on the smallest tables, stage by stage against plain Python."""

import os
import re

import pytest

import corpus_pipeline
from holdlens.llm.common import table, written

FOLDER = "/root/testdata/sf0.001"


def test_empty_documents(spark, tmp_path):
    """Every stage on a table without rows: the columns of documents, or of pieces, and no rows."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, 1), (2, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), f"test-{name}")
        assert docs.count() == 0
        if name != "packing":
            assert [f.name for f in docs.schema] == [c.split()[0] for c in schema.split(", ")]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
def test_stages(spark):
    from test_operators import components, norm

    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = written(stage(spark, docs, FOLDER), f"test-{name}")
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        ids = {r["doc_id"] for r in after}
        if name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in table(spark, FOLDER, "labels").collect()}
            assert sum(i not in ids for i in before if labels.get(i) == 0) == 0
        if name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(norm(before[i]), i)
            assert ids == set(first.values())
        if name == "ngram_join":
            order = sorted(before)
            assert ids == {order[c] for _, c in components([before[i] for i in order]).values()}
        if name == "secret_scan":
            assert ids == set(before) and not any(re.search(r"AKIA[0-9A-Z]{16}", r["text"]) for r in after)
        if name == "packing":
            assert ids == set(before)
        out[name] = len(ids)
    assert out["toxicity"] >= out["exact_dedup"] >= out["ngram_join"] == out["secret_scan"] == out["packing"]
