"""Quality statistics against a loop over the text, and the learned list on held-out labels."""

import re
from collections import Counter

import pytest

from tests.conftest import SF_SMALL
from threadlens.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def figures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


CASES = ["", None, " \t\n", "one", "a b c", "a b c a b c", "a a a a a a", "x y\nx y\n\n \nx  y", "é€𝄞 ## |\x0b\x0cß\x85y\xa0z", "a b c d a b c d e a b", "w " * 5000]


def test_statistics_match_a_loop(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(CASES)], "doc_id long, text string, rule string").union(
        spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id + 100", "text", "source")
    )
    rows = Q.text_statistics(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == figures(r.text), r.text


def test_empty_table_and_no_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    stats = Q.text_statistics(empty)
    assert Q.learn_rules(empty, labels) == []
    assert Q.judge(stats, []).count() == 0


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    stats = Q.text_statistics(docs)
    rules = Q.learn_rules(docs, labels.filter("doc_id % 2 = 0"))
    assert 1 <= len(rules) <= Q.MAX_RULES and all(len(r) <= Q.MAX_CONDITIONS for r in rules)
    judged = Q.judge(stats, rules).filter("not base_failed").join(labels.filter("doc_id % 2 = 1"), "doc_id")
    counts = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    good, bad = counts[1, True] + counts.get((1, False), 0), counts.get((0, False), 0) + counts.get((0, True), 0)
    assert counts.get((1, False), 0) <= 0.01 * good
    assert counts[0, False] >= 0.8 * bad
    print(rules, counts)


@pytest.mark.parametrize("bad_share", [0.0, 1.0])
def test_one_sided_labels(bad_share):
    row = {f: 1.0 for f in Q.FEATURES}
    assert Q.cover([(row, bool(bad_share))] * 60) in ([], [[]])
