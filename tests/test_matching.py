"""Greedy matching against a direct simulation, on both paths."""

import random

import pytest
from pyspark.sql import functions as F

from threadlens.operators import matching, qa

SCHEMA = "post_id string, comment_id string, parent_id string, score bigint, is_question boolean"


def simulate(rows):
    """Straight reading of the rules: O(questions x answers)."""
    out = []
    for post in sorted({r[0] for r in rows}):
        ranked = sorted((r for r in rows if r[0] == post), key=lambda r: (-r[3], r[1]))
        used = set()
        for q in (r for r in ranked if r[4]):
            free = [a for a in ranked if not a[4] and a[1] not in used]
            tiers = [
                [a for a in free if a[2] == q[1]],
                [a for a in free if q[2] and q[2] != post and a[2] == q[2]],
                free,
            ]
            for tier, found in enumerate(tiers, 1):
                if found:
                    used.add(found[0][1])
                    out.append((post, q[1], found[0][1], tier))
                    break
    return sorted(out)


def thread(rng, post, n, asks, top, hot):
    rows = []
    for i in range(n):
        u = rng.random()
        if i == 0 or u < top:
            parent = post
        elif u < top + hot:
            parent = f"{post}_c0"
        elif u < top + hot + 0.03:
            parent = rng.choice([None, "", "gone", f"{post}_c{i}"])
        else:
            parent = f"{post}_c{rng.randrange(i)}"
        rows.append((post, f"{post}_c{i}", parent, rng.randrange(12), rng.random() < asks))
    return rows


def collected(df):
    return sorted(tuple(r) for r in df.select("post_id", "question_comment_id", "answer_comment_id", "tier").collect())


def test_taken_direct_reply(spark):
    rows = [("p", "c1", "p", 10, True), ("p", "c2", "p", 5, True), ("p", "c3", "c2", 8, False), ("p", "c4", "p", 1, False)]
    expected = [("p", "c1", "c3", 3), ("p", "c2", "c4", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert simulate(rows) == expected
    assert collected(matching.match_grouped(df)) == expected
    assert collected(matching.match_rounds(df, max_rows=0, block=2)) == expected


def mixed(seed):
    rng = random.Random(seed)
    shapes = [(0.3, 0.3, 0.0), (0.5, 0.1, 0.5), (0.8, 0.2, 0.3), (0.2, 0.0, 0.0), (0.6, 0.3, 0.3), (1.0, 0.5, 0.0), (0.0, 0.5, 0.0)]
    return [r for i in range(28) for r in thread(rng, f"p{i}", rng.randint(1, 60), *shapes[i % len(shapes)])]


def test_grouped_equals_simulation(spark):
    rows = mixed(1)
    got = collected(matching.match_grouped(spark.createDataFrame(rows, SCHEMA)))
    assert got == simulate(rows)
    assert {t for *_, t in got} == {1, 2, 3}


@pytest.mark.parametrize("max_rows, block", [(0, 3), (1000, 7)])
def test_rounds_equal_simulation(spark, max_rows, block):
    rows = mixed(2)
    got = collected(matching.match_rounds(spark.createDataFrame(rows, SCHEMA), max_rows=max_rows, block=block))
    assert got == simulate(rows)
    assert {t for *_, t in got} == {1, 2, 3}


def test_hot_and_cold_posts_together(spark):
    rng = random.Random(3)
    rows = thread(rng, "big", 150, 0.5, 0.2, 0.4) + mixed(4)[:300]
    df = spark.createDataFrame(rows, SCHEMA)
    text = F.when(F.col("is_question"), "why?").otherwise("because")
    comments = df.withColumn("body", text).drop("is_question")
    posts = df.select("post_id").distinct().filter("post_id <> 'p3'")
    expected = [m for m in simulate(rows) if m[0] != "p3"]
    assert collected(qa.match_answers(comments, posts, max_rows=100, block=10)) == expected
    assert collected(qa.match_answers(comments, posts)) == expected


def test_rounds_build_no_table_in_the_driver(spark):
    rows = mixed(4)
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1b")  # any broadcast fails
    try:
        assert collected(matching.match_rounds(spark.createDataFrame(rows, SCHEMA))) == simulate(rows)
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
