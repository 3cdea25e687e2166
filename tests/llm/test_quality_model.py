"""Flattened trees against a walk of one row at a time; held-out accuracy; edge cases."""

import numpy as np

from tests.conftest import SF_SMALL
from threadlens.llm import quality_model as Q


def walk_one(model, row):
    total = model.base
    for t in range(len(model.leaf)):
        k = 0
        while k < model.feature.shape[1]:
            k = 2 * k + (2 if row[model.feature[t, k]] > model.cut[t, k] else 1)
        total += model.leaf[t, k - model.feature.shape[1]]
    return total


def test_flat_trees_equal_row_walks():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] + x[:, 1] * x[:, 2]) > 0).astype(float)
    model = Q.fit_arrays(x, y, trees=60, depth=3)
    got = Q.margins(model, x)
    assert np.allclose(got, [walk_one(model, r) for r in x])
    assert ((got > 0) == (y > 0)).mean() > 0.85
    constant = Q.fit_arrays(x[:5], y[:5])
    assert len(constant.leaf) == 0 and np.allclose(Q.margins(constant, x), constant.base)


def test_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    extra = spark.createDataFrame([(-1, None, "x"), (-2, "", "x"), (-3, "a " * 30000, "x")], docs.schema)
    model = Q.fit(docs, labels.unionByName(labels))  # repeated label rows average
    out = Q.score(docs.unionByName(extra).withColumn("f_chars", docs.doc_id), model).toPandas()
    assert len(out) == docs.count() + 3 and out.score.between(0, 1).all()
    assert set(out.columns) == {"doc_id", "held_out", "score", "predicted"}
    lab = labels.toPandas().groupby("doc_id").quality.mean().reset_index()
    held = out.merge(lab, on="doc_id").query("held_out")
    assert len(held) > 10 and ((held.score >= 0.7) == (held.quality >= 0.5)).mean() >= 0.8
    assert (out.predicted == (out.score >= 0.7)).all()


def test_no_labels_gives_a_constant(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = Q.score(docs, Q.fit(docs, labels)).collect()
    assert len(out) == 2 and len({r.score for r in out}) == 1
    assert Q.score(docs.limit(0), Q.fit(docs, labels)).count() == 0
