"""The near stage against all pairs of exact shingle sets."""

import random

import pytest

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from threadlens.llm import shingle_join as J, simhash

WORDS = [f"w{i}" for i in range(3000)]


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def slow_kept(rows):
    """Smallest id of each group that pairs of Jaccard 0.8 or more connect."""
    rows, sets = sorted(rows), {i: shingle_set(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and 5 * len(a & b) >= 4 * len(a | b):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return {root(i) for i in sets}


def edited(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = rng.choice(WORDS)
    return " ".join(words)


def planted():
    rng = random.Random(3)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(60, 300))) for _ in range(60)]
    texts += [edited(rng, t, rng.randrange(1, 9)) for t in texts for _ in range(3)]
    crowd = " ".join(rng.choices(WORDS, k=200))  # one large group, chains and near misses within
    texts += [edited(rng, crowd, rng.randrange(1, 9)) for _ in range(150)]
    chain = crowd
    for _ in range(12):
        chain = edited(rng, chain, 3)
        texts.append(chain)
    notice = " ".join(rng.choices(WORDS, k=40))  # a passage of many texts that are no copies
    texts += [notice + " " + " ".join(rng.choices(WORDS, k=rng.randrange(20, 90))) for _ in range(60)]
    texts += ["", " \t", "one two", "One  two", "one two three", None]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("max_cell", [3, 32])
def test_planted_copies_against_all_pairs(spark, max_cell):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.doc_id for r in J.drop_near_duplicates(docs, max_cell=max_cell).collect()]
    assert sorted(got) == sorted(slow_kept(rows))


def test_stage_drops_copies_with_a_few_words_changed(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in P.near(spark, docs, SF_SMALL).collect()} == slow_kept(rows)


def test_stage_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("n_chars > 300")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id for r in P.near(spark, docs, SF_SMALL).collect()} == slow_kept(rows)


def test_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (7, "A b c"), (7, "x"), (None, "lone")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.text) for r in J.drop_near_duplicates(docs).collect()) == [(False, "A b c"), (False, "x"), (True, "lone")]
    assert J.drop_near_duplicates(docs.limit(0)).count() == 0


def test_stage_confirms_what_the_fingerprint_grid_proposes(spark, monkeypatch):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked, checked = [], J._checked
    monkeypatch.setattr(J, "_checked", lambda pairs, *a: (asked.append(pairs), checked(pairs, *a))[1])
    assert {r.doc_id for r in P.near(spark, docs, SF_SMALL).collect()} == slow_kept(rows)
    assert len(asked) > 1 and asked[0].count() > 0
    assert not asked[0].join(asked[1], ["a", "b"]).count()  # the join looks at other pairs


def test_sketch_keeps_all_similar_pairs_and_few_others():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(8)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(5, 900))) for _ in range(30)]
    texts += [edited(rng, t, rng.randrange(1, 2 + len(t.split()) // 30)) for t in texts] + ["", "one two"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.encode() for t in texts])], ["key", "t"])
    (out,) = J._sketches(5)([batch])
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    a, b = (np.array(x) for x in zip(*pairs))
    n, s = out.column(1), out.column(2)
    (kept,) = J._alike((4, 5))([pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), n.take(a), n.take(b), s.take(a), s.take(b)], ["a", "b", "nx", "ny", "x", "y"])])
    kept, sets = {(r["a"], r["b"]) for r in kept.to_pylist()}, [shingle_set(t) for t in texts]
    similar = {(i, j) for i, j in pairs if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert similar and similar <= kept and len(kept) < len(pairs) / 20


def crowd_below_the_similarity(n):
    """Texts that share a passage and are no copies of each other, but every tenth has a copy with one word changed."""
    rng = random.Random(11)
    passage = " ".join(rng.choices(WORDS, k=110))
    texts = [passage + " " + " ".join(rng.choices(WORDS, k=17)) for _ in range(n)]
    texts += [edited(rng, t, 1) for t in texts[::10]]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_rows_do_not_grow_with_the_pairs_of_a_cell(spark, monkeypatch):
    import numpy as np

    rows = crowd_below_the_similarity(250)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts, staged = [], J.staged
    monkeypatch.setattr(J, "staged", lambda df, name, *a: (counts.append((name, (out := staged(df, name, *a)).count())), out)[1])
    monkeypatch.setattr(J, "_common", lambda *_: (np.zeros(0, np.int64), np.zeros(0, np.int64)))  # the passage's cells meet all texts
    assert {r.doc_id for r in J.drop_near_duplicates(docs).collect()} == slow_kept(rows)
    cells = dict(counts)["shingle-cells"]
    assert max(c for _, c in counts) == cells < len(rows) ** 2 / 4, counts


@pytest.mark.parametrize("block, span", [(8, 16), (64, 40)])
def test_large_cells_in_tiles_against_all_pairs(spark, monkeypatch, block, span):
    import numpy as np

    rows = planted() + [(1000 + i, t) for i, t in crowd_below_the_similarity(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "SPAN", span, raising=False)
    monkeypatch.setattr(J, "_common", lambda *_: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    assert {r.doc_id for r in J.drop_near_duplicates(docs, max_cell=4).collect()} == slow_kept(rows)


def test_stage_looks_at_all_pairs_of_the_groups_that_fingerprints_make(spark, monkeypatch):
    """Without cells of shingles, what is left are the similar pairs within op 1's groups: those, and all of those."""
    rows = sorted(planted() + [(1000 + i, t) for i, t in crowd_below_the_similarity(60)])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    group = {r.doc_id: r.component for r in simhash.near_groups(docs).collect()}
    sets, label = {i: shingle_set(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and group[i] == group[j] and 5 * len(a & b) >= 4 * len(a | b):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    monkeypatch.setattr(J, "_shared", lambda rows, bounds: iter(()))
    assert {r.doc_id for r in P.near(spark, docs, SF_SMALL).collect()} == {root(i) for i in sets}
