"""Fingerprints, links and components against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from threadlens.llm import simhash as S
from threadlens.llm.components import components


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Smallest key reachable, by print."""
    label = {f: f for f in prints}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ordered = np.array(sorted(prints), np.uint64)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :][np.bitwise_count(ordered[i + 1 :] ^ a) <= 3]:
            x, y = root(int(a)), root(int(b))
            label[max(x, y)] = min(x, y)
    return {f: root(f) for f in prints}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def flips(rng, x, n):
    for b in rng.sample(range(64), n):
        x ^= 1 << b
    return x


def expected(rows):
    prints = {}
    for doc_id, text in rows:
        prints.setdefault(slow_print(text), []).append(doc_id)
    roots = slow_components(list(prints))
    first = {}
    for f, r in roots.items():
        ids = [i for i in prints[f] if i is not None]
        first.setdefault(r, []).extend(ids)
    return sorted(((i, f"{f:016x}", min(first[roots[f]], default=None)) for f, ids in prints.items() for i in ids), key=str)


def test_documents(spark):
    near = "the quick brown fox jumps over the lazy dog and runs away from all of the angry bees near a river " * 3
    extra = [(None, ""), (5000, None), (5001, " \t"), (5002, "One two"), (5003, "one  TWO"), (5004, near), (5005, near + "x"), (5006, "É é"), (5004, "again"), (None, "lone")]
    docs = spark.createDataFrame(extra, "doc_id long, text string").union(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"))
    docs = docs.withColumn("component", F.lit(1)).withColumn("fp", F.lit("x"))
    got = S.near_groups(docs).select("doc_id", S.as_hex(F.col("fp")), "component").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected([(r.doc_id, r.text) for r in docs.collect()])
    stay = S.drop_near_duplicates(docs)
    assert stay.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in stay.collect()]
    groups = {c for _, _, c in expected([(r.doc_id, r.text) for r in docs.collect()]) if c is not None}
    assert {i for i, _ in kept if i is not None} == groups and len(kept) == len(groups) + 2 and (None, "lone") in kept


@pytest.mark.parametrize("max_cell", [4, 40, 20_000])
def test_links_connect_like_all_pairs(spark, max_cell):
    rng = random.Random(7)
    center = rng.getrandbits(64)
    prints = {flips(rng, center, rng.randrange(0, 7)) for _ in range(700)}  # one dense ball
    for _ in range(150):
        x = rng.getrandbits(64)
        prints |= {x} | {flips(rng, x, rng.randrange(1, 6)) for _ in range(rng.randrange(4))}
    chain = rng.getrandbits(64)
    for _ in range(60):
        chain = flips(rng, chain, 3)
        prints.add(chain)
    prints = sorted(prints)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    labels = {r.node & (2**64 - 1): r.label for r in components(S.links(frame, max_cell)).collect()}
    got = {}
    for p in prints:
        got.setdefault(labels.get(p, signed(p)), set()).add(p)
    want = {}
    for p, r in slow_components(prints).items():
        want.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_grids_find_every_pair():
    rng = random.Random(9)
    unary = lambda x: int(S._unary(np.array([x], np.uint64))[0])
    for _ in range(300):
        a = rng.getrandbits(64)
        b = flips(rng, a, rng.randrange(1, 4))
        assert (unary(a) ^ unary(b)).bit_count() <= (a ^ b).bit_count()
        assert any(unary(a) & m == unary(b) & m for m in S.masks(6))
        assert all(any(a & m == b & m for m in S.masks(g)) for g in (12, 24))


def test_components_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(500)] + [(1000, 1000 + i) for i in range(1, 300)] + [(-5, -9), (-9, -5), (3000, 3000)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(501)}, **{1000 + i: 1000 for i in range(300)}, -5: -9, -9: -9, 3000: 3000}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_groups(docs).count() == 0 and S.drop_near_duplicates(docs).count() == 0


def test_small_graph_leaves_few_files_a_round(spark, monkeypatch):
    from threadlens.llm import components as C

    cores, cuts = spark.sparkContext.defaultParallelism, []
    cut = C.cut_lineage

    def watched(df):
        out = cut(df)
        cuts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(C, "cut_lineage", watched)
    edges = [(i, i + 1) for i in range(1, 300) if i % 50]
    rows = spark.createDataFrame(edges, "a long, b long").repartition(40 * cores)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 10 * cores)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.node: r.label for r in components(rows).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: (i - 1) // 50 * 50 + 1 for i in range(1, 301)}
    assert cuts and max(cuts) <= 2 * cores
