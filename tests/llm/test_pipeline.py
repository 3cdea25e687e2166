"""The pipeline stage by stage against what each stage promises."""

import re

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from threadlens.llm import quality_rules
from threadlens.llm.common import staged

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names, given, frames = [n for n, _ in P.STAGES], docs, {}
    for name, stage in P.STAGES[:-1]:
        out = staged(stage(spark, given, SF_SMALL), "stage-test")
        assert out.columns == docs.columns
        frames[name], given = out, out
    original = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in frames["quality rules"].collect()}
    assert good < set(original)
    assert all(len(WORD.findall(original[i].text)) >= 50 for i in good)
    exact = {r.doc_id for r in frames["exact dedup"].collect()}
    by_text = {}
    for i in good:
        by_text.setdefault(original[i].text.encode().lower(), []).append(i)
    assert exact == {max(ids) for ids in by_text.values()}
    near = {r.doc_id for r in frames["near dedup"].collect()}
    assert near <= exact and len(near) > 0.8 * len(exact)
    mixed = frames["mixing"].collect()
    size = sum(len(WORD.findall(original[i].text)) for i in near)
    assert abs(sum(len(WORD.findall(r.text)) for r in mixed) - 1.5 * size) < 0.02 * size
    assert all(original[r.doc_id].text.startswith(r.text) and r.n_chars == len(r.text) for r in mixed)
    pieces = P.STAGES[-1][1](spark, given, SF_SMALL).collect()
    assert sum(r.start == 0 for r in pieces) == len(mixed)
    assert names == ["quality rules", "exact dedup", "near dedup", "mixing", "packing"]


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    kept = {r.doc_id for r in P.quality(spark, docs, SF_SMALL).collect()}
    clean = quality_rules.text_statistics(docs).filter(~quality_rules.base_failed()).join(labels.filter("quality = 1"), "doc_id")
    assert {r.doc_id for r in clean.select("doc_id").collect()} <= kept


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
