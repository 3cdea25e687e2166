"""Token counts, the id store and packing against the library and simple loops."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from threadlens.llm import packing, token_counts, token_store
from threadlens.session import scratch_path

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
CASES = [None, "", " ", "a<|endoftext|>b", "é 日本", "x" * 20_000, "word " * 30_000, "a", "a"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(CASES)] + [(3, "again", "y", 2), (None, "no id", "y", 2), (None, None, None, None)]
    small = spark.createDataFrame(rows, "doc_id long, text string, id string, task int")
    return small.unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id + 100 doc_id", "text", "lang id", "3 task"))


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sort(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_counts(spark, docs):
    library = Tokenizer.from_file(BYTES)
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()]
    assert sort(tuple(r) for r in token_counts.token_counts(docs, BYTES).collect()) == sort(want)
    assert token_counts.token_counts(docs.limit(0), BYTES).count() == 0


def test_caches_do_not_change_counts(spark, docs, monkeypatch):
    want = sort(tuple(r) for r in token_counts.token_counts(docs, BYTES).collect())
    for name, value in (("CACHE_SIZE", 3), ("TASK_KEYS", 10), ("TASK_TOP", 2)):
        monkeypatch.setattr(token_counts, name, value)
    assert sort(tuple(r) for r in token_counts.token_counts(docs, BYTES).collect()) == want


@pytest.mark.parametrize("record_ids", [50, 4_000_000])
def test_store_round_trip(spark, docs, record_ids):
    path = scratch_path(spark, "store-test")
    token_store.write_store(docs.repartition(5), path, BYTES, 0, record_ids=record_ids)
    rows = token_store.read_store(spark, path).collect()
    library = Tokenizer.from_file(BYTES)
    want = sort((r.doc_id, len(ids := [*library.encode(r.text or "", add_special_tokens=False).ids, 0]), crc(ids)) for r in docs.collect())
    assert sort((r.id, r.n_tokens, r.ids_crc32) for r in rows) == want
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows]).tolist()[:-1]]
    ids = [-1 if r.id is None else r.id for r in rows]
    assert ids == sorted(ids)


def test_empty_store(spark, docs):
    path = scratch_path(spark, "store-empty")
    token_store.write_store(docs.limit(0), path, BYTES, 0)
    assert token_store.read_store(spark, path).count() == 0


def test_boundaries():
    rng = random.Random(3)
    for n, top in ((1, 1), (1, 10**9), (5, 5), (1000, 1003), (1000, 10**7), (130, 2**40)):
        values = np.sort(np.array([rng.randrange(1, top + 1) for _ in range(n)], np.int64))
        code = token_store.Boundaries.encode(values)
        assert code.decode().tolist() == values.tolist() == [code.select(i) for i in range(n)]
        size = 8 * (code.low.nbytes + code.high.nbytes)
        assert size <= n * (2 + max(0, np.log2(top / n))) + n + 64


def test_pack(spark, docs):
    rows = packing.pack(docs, WORDS, 2).collect()
    library = Tokenizer.from_file(WORDS)
    want = {}
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        for start in range(0, len(ids), 4096):
            piece = (r.doc_id, start, len(ids[start : start + 4096]), crc(ids[start : start + 4096]), len(ids))
            want[piece] = want.get(piece, 0) + 1
    got = {}
    for r in rows:
        piece = (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
        got[piece] = got.get(piece, 0) + 1
    assert got == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert sorted(sequences) == list(range(len(sequences)))
    assert len(sequences) <= -(-sum(r.length for r in rows) // 4096) + 1
    assert packing.pack(docs.limit(0), WORDS, 2).count() == 0


def test_plan_uses_each_piece_once_and_fills_well():
    rng = random.Random(1)
    for trial in range(20):
        window = rng.choice([8, 50, 4096])
        counts = {}
        for _ in range(rng.randrange(1, 400)):
            n = rng.randrange(1, window)
            counts[n] = counts.get(n, 0) + rng.choice([1, 1, 1, 50])
        used, bins = {}, 0
        for times, copies in packing.plan(counts, window):
            assert times >= 1 and sum(n * c for n, c in copies.items()) <= window
            bins += times
            for n, c in copies.items():
                used[n] = used.get(n, 0) + c * times
        assert used == counts
        total = sum(n * c for n, c in counts.items())
        assert bins <= -(-total // window) * 1.3 + 2


def test_closest_is_best():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(5)}
        room = rng.randrange(1, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= room}
        chosen = packing._closest(counts, sorted(counts, reverse=True), room)
        assert sum(n * k for n, k in chosen.items()) == max(sums) and all(k <= counts[n] for n, k in chosen.items())
