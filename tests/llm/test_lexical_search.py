"""Ranked search against a plain scoring loop over every document, edge cases included."""

import math
import random
import re

from threadlens.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, top=20):
    toks = [(d, TERM.findall(low(t))) for d, t in docs]
    toks = [(d, t) for d, t in toks if t]
    big_n, big_l = len(toks), sum(len(t) for _, t in toks)
    df = {}
    for _, t in toks:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in sorted({i for i, _ in items} and items, key=lambda r: (r[0] is None, r[0] or 0)):
        q = TERM.findall(low(text))
        scored = []
        for d, t in toks:
            m = 75 + (25 * len(t) * big_n) // big_l
            s = 0
            for w in q:
                tf = t.count(w)
                if tf:
                    s += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if s > 0:
                scored.append((-s, d if d is not None else -(1 << 63), d, s))
        scored.sort()
        out += [(item, r + 1, d, s) for r, (_, _, d, s) in enumerate(scored[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, top=20):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in S.search(d, i, top).collect()), key=str)


def test_equals_scoring_every_document(spark):
    rng = random.Random(3)
    vocab = ["alpha", "Beta", "gamma", "délta", "x1", "the", "a", "of"]
    docs = [(n, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 60 if n % 7 else 400)))) for n in range(120)]
    docs += [(200, None), (201, ""), (202, "!!! ..."), (5, docs[5][1])]  # null, empty, no terms, a repeated id
    items = [(0, "alpha beta"), (1, "THE the gamma"), (2, "nothing-here"), (3, None), (None, "x1 délta")]
    assert run(spark, docs, items, top=5) == brute(docs, items, top=5)
    assert run(spark, docs, items) == brute(docs, items)


def test_ties_by_doc_id_and_edges(spark):
    docs = [(9, "red fish"), (4, "red fish"), (7, "red fish"), (1, "blue")]
    got = run(spark, docs, [(0, "red")], top=2)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == [4, 7]
    assert run(spark, [], [(0, "red")]) == []
    assert run(spark, docs, []) == []


def test_other_columns_are_ignored(spark):
    d = spark.createDataFrame([(1, "red fish", 5, "x")], "doc_id bigint, text string, m bigint, term string")
    i = spark.createDataFrame([(0, "fish", 3)], "item_id bigint, text string, qn bigint")
    assert [tuple(r)[:3] for r in S.search(d, i).collect()] == [(0, 1, 1)]


def test_shuffled_joins_give_the_same_ranking(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    docs = [(n, " ".join(["alpha", "beta", "the"][: 1 + n % 3] * (1 + n % 5))) for n in range(40)]
    items = [(0, "alpha the"), (1, "beta")]
    assert run(spark, docs, items, top=7) == brute(docs, items, top=7)


def test_postings_and_scores_are_not_staged_row_by_row(spark, monkeypatch):
    held, staged = [], S.staged
    monkeypatch.setattr(S, "staged", lambda df, *a: (held.append(out := staged(df, *a)), out)[1])
    vocab = [f"w{i}" for i in range(40)]
    docs = [(n, " ".join(vocab)) for n in range(300)]
    items = [(i, " ".join(vocab[i:])) for i in range(10)]
    assert run(spark, docs, items, top=5) == brute(docs, items, top=5)
    assert sum(df.count() for df in held) < 300 * 40  # one row a document, not one a posting


def test_slices_hold_few_cells(spark, monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(S, "CELLS", 50)
    vocab = [f"w{i}" for i in range(30)]
    docs = [(n if n % 9 else None, " ".join(rng.choices(vocab, k=rng.randrange(1, 90)))) for n in range(200)]
    items = [(i, " ".join(rng.choices(vocab, k=6))) for i in range(12)] + [(None, "w1 w1 w2")]
    assert [r[:2] + r[3:] for r in run(spark, docs, items, top=4)] == [r[:2] + r[3:] for r in brute(docs, items, top=4)]
