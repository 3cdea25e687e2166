"""Targets against a plain water-filling loop; takings near the targets."""

import random
import re

import pytest

from tests.conftest import SF_SMALL
from threadlens.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights, share, epochs):
    """By source: clamp, share the rest by weight, until none is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    cap, capped, total = {s: epochs * n for s, n in sizes.items()}, set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(cap[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] >= cap[s]}
        if not over:
            return {s: cap[s] if s in capped else level * weight[s] for s in order}
        capped |= over


def check(docs, share=1.5, epochs=2):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = targets(sizes, (3, 1, 2), share, epochs)
    mixed = M.mix(docs, share=share, max_epochs=epochs)
    got = mixed.select("doc_id", "text", "source", "_m_size", "_p_size", "_p_target", "_m_taken").collect()
    assert sorted((r[0], r[1], r[2]) for r in got if r[0] is not None) == sorted(r for r in rows if r[0] is not None) and len(got) == len(rows)
    taken, docs_of = {}, {}
    for r in got:
        assert r._m_size == len(WORD.findall(r.text or "")) and r._p_size == sizes[r.source]
        assert r._p_target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r._m_taken <= epochs * r._m_size
        taken[r.source] = taken.get(r.source, 0) + r._m_taken
        docs_of[r.source] = docs_of.get(r.source, 0) + 1
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1 + 0.002 * want[s] + min(docs_of[s], 3), (s, n, want[s])
    again = M.mix(docs.repartition(3), share=share, max_epochs=epochs)
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(again.select("doc_id", "text", "_m_taken").collect(), key=key) == sorted(mixed.select("doc_id", "text", "_m_taken").collect(), key=key)
    copies = M.repeat(mixed, docs.columns)
    assert copies.columns == docs.columns
    words = {}
    for r in copies.collect():
        words[r.source] = words.get(r.source, 0) + len(WORD.findall(r.text))
    assert {s: n for s, n in taken.items() if n} == words


def test_documents(spark):
    check(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))


def test_small_and_odd(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(0, 90))), rng.choice(["a", "b", "é", "zz", "", None]), 1) for i in range(300)]
    rows += [(900, None, "only null", 2), (901, "x" * 50_000, "one", 3), (902, "w\n " * 60_000, "long", 3), (5, "dup", "a", 1), (5, "dup", "a", 1), (None, "a b c", "a", 0)]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string, size int"))


def test_all_capped(spark):
    check(spark.createDataFrame([(1, "a b", "x"), (2, "c", "y")], "doc_id long, text string, source string"), share=2.5)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(docs).count() == 0
    assert M.mix(spark.createDataFrame([(1, " ", "a")], docs.schema)).first()["_m_taken"] == 0
