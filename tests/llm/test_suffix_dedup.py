"""Removed bytes against a table of all 200-byte strings."""

import random

import pytest

from tests.conftest import SF_SMALL
from threadlens.llm import suffix_dedup as S


def slow(texts):
    seen = {}
    for t in texts:
        for i in range(len(t) - 199):
            w = t[i : i + 200]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        runs = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def check(docs, **options):
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, slow([(r.text or "").encode() for r in rows]))]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(docs, **options).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return sum(x[2] for x in want)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8))) for _ in range(n))


def planted(rng):
    passage, other = words(rng, 90), words(rng, 60)
    texts = [words(rng, rng.randrange(0, 200)) for _ in range(40)]
    for i in range(0, 30, 2):
        at = rng.randrange(len(texts[i]) + 1)
        texts[i] = texts[i][:at] + passage[rng.randrange(60) : len(passage) - rng.randrange(60)] + texts[i][at:]
    for i in range(1, 20, 3):
        texts[i] = other + texts[i] + other
    exact = words(rng, 41)
    exact = exact[: 200 - (len(exact.encode()) - len(exact))]
    return texts + [texts[3], texts[3], "x" * 500, "xy" * 300, "yx" * 150, "q" + exact, exact + "z", exact[:-1] + "!", "short", "", None, "x" * 199, "ab" * 100]


@pytest.mark.parametrize("max_stretches", [3, 50_000])
def test_planted(spark, max_stretches):
    texts = planted(random.Random(11))
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(4, texts[4], "b"), (4, texts[7], "c"), (None, texts[9], "d"), (None, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, packed string")
    assert check(docs, max_stretches=max_stretches) > 5000


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("length(text) < 6000")
    assert check(docs) > 0


def test_small_chunks_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 150)
    monkeypatch.setattr(S, "FLUSH_WINDOWS", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(spark.createDataFrame(list(enumerate(planted(random.Random(12)))), "doc_id long, text string"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
