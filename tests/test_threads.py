"""Trees, ranks and documents against plain Python, on ordinary and hot groups."""

import json
import random

import pytest
from pyspark.sql import functions as F

from threadlens.operators import reads, report, threads
from threadlens.plans.skew import lookup_join, rank_in_group, running

SCHEMA = "post_id string, comment_id string, parent_id string, body string, score bigint"


def forest(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        post = "big" if rng.random() < 0.5 else f"p{rng.randrange(4)}"
        mine = [r[1] for r in rows if r[0] == post]
        u = rng.random()
        parent = post if u < 0.2 or not mine else mine[-1] if u < 0.5 else mine[0] if u < 0.75 else rng.choice(mine)
        if rng.random() < 0.05:
            parent = rng.choice([None, "gone", f"c{i}"])
        rows.append((post, f"c{i}", parent, f'say "{i}"\n\té', None if rng.random() < 0.1 else rng.randrange(5)))
    rows += [("big", "x1", "x3", "loop", 1), ("big", "x2", "x1", "loop", 1), ("big", "x3", "x2", "loop", 1), ("big", "x4", "x3", "under", 1)]
    return rows


def walk(rows):
    """{post: nested nodes} in sibling order."""
    kids = {}
    for r in rows:
        kids.setdefault((r[0], r[2]), []).append(r)

    def node(r, depth):
        return {
            "comment_id": r[1], "post_id": r[0], "parent_id": r[2], "body": r[3], "score": r[4], "depth": depth,
            "replies": [node(k, depth + 1) for k in order(r[0], r[1])],
        }

    def order(post, parent):
        return sorted(kids.get((post, parent), []), key=lambda r: (-(r[4] or 0), r[1]))

    return {p: [node(r, 0) for r in order(p, p)] for p in sorted({r[0] for r in rows})}


def flat(nodes):
    for n in nodes:
        yield n
        yield from flat(n["replies"])


@pytest.mark.parametrize("max_rows", [None, 10])
def test_tree(spark, max_rows):
    rows = forest(5)
    expected = walk(rows)
    comments = spark.createDataFrame(rows, SCHEMA)
    tree = threads.build_tree(comments, max_rows)
    order = threads.flatten_tree(tree, max_rows).orderBy("post_id", "preorder").collect()
    pairs = {p: [(n["comment_id"], n["depth"]) for n in flat(nodes)] for p, nodes in expected.items()}
    for post, nodes in pairs.items():
        assert [(r.comment_id, r.depth) for r in order if r.post_id == post] == nodes
    assert len(order) == sum(map(len, pairs.values()))

    docs = {}
    for r in threads.thread_documents(tree, comments, max_rows).orderBy("post_id", "preorder").collect():
        docs[r.post_id] = docs.get(r.post_id, "") + r.fragment
    assert {p: json.loads(d) for p, d in docs.items()} == {p: n for p, n in expected.items() if n}

    records = {}
    for r in threads.threads(tree, max_rows).orderBy("post_id", "thread_id", "position").collect():
        records.setdefault((r.post_id, r.thread_id), []).append(r.comment_id)
    assert records == {(p, n["comment_id"]): [m["comment_id"] for m in flat([n])] for p, nodes in expected.items() for n in nodes}

    kids = {}
    for r in threads.children(comments, max_rows).orderBy("sibling_rank").collect():
        kids.setdefault((r.post_id, r.parent_id), []).append(r.child)
    assert {k: v for k, v in kids.items() if k[0] == k[1]} == {
        (p, p): [n["comment_id"] for n in nodes] for p, nodes in expected.items() if nodes
    }
    tops = {r.post_id: r.top_level for r in threads.root_counts(comments).collect()}
    assert tops == {p: len(nodes) for p, nodes in expected.items() if nodes}


def test_rank_in_group_with_null_and_hot_groups(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, s int, i int")
    expected = {}
    for g in {r[0] for r in rows}:
        for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            expected[r[2]] = n
    for limit in (None, 150, 0):
        got = rank_in_group(df, ["g"], [F.col("s").desc(), F.col("i")], "n", limit)
        assert {r.i: r.n for r in got.collect()} == expected


def test_running_blocks_equal_one_window(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), p, rng.randrange(100)) for p in range(200)]
    df = spark.createDataFrame(rows, "g string, p bigint, v int")
    aggs = {"total": (F.sum, F.col("v")), "most": (F.max, F.col("v"))}
    for inclusive in (True, False):
        whole = sorted(map(tuple, running(df, ["g"], "p", aggs, inclusive=inclusive).collect()))
        assert sorted(map(tuple, running(df, ["g"], "p", aggs, inclusive=inclusive, block=9).collect())) == whole


def test_lookup_join_with_hot_and_null_keys(spark):
    left = spark.createDataFrame([("a", i) for i in range(40)] + [("b", 1), ("c", 2), (None, 3)] + [(None, i) for i in range(20)], "k string, i int")
    right = spark.createDataFrame([("a", "A"), ("b", "B"), (None, "N")], "k string, v string")
    for how in ("left", "inner", "left_semi"):
        plain = sorted(map(str, left.join(right, "k", how).collect()))
        assert sorted(map(str, lookup_join(left, right, ["k"], how, max_rows=10).collect())) == plain


def test_reports(spark):
    df = spark.createDataFrame([("x" * 5, "y" * 20, "z" * 60, 0)], "a string, b string, c string, n int")
    widths = {r.column_name: r.width for r in report.column_widths(df).collect()}
    assert widths == {"a": 12, "b": 23, "c": 50, "n": 12}
    nested = spark.sql("select 1 a, named_struct('c', 2, 'd', named_struct('e', 3)) b")
    flat_cols = report.flatten_struct(nested)
    assert flat_cols.columns == ["a", "b_c", "b_d_e"] and tuple(flat_cols.first()) == (1, 2, 3)
    times = spark.sql("select timestamp'2024-01-02 03:04:05.6' t, cast(null as string) s")
    assert tuple(report.format_cells(times).first()) == ("2024-01-02 03:04:05", "")


def test_posts_by_ids(spark):
    posts = spark.createDataFrame([(f"p{i}",) for i in range(5)], "post_id string")
    ids = [f"p{i}" for i in range(3, 2000)]
    assert sorted(r.post_id for r in reads.posts_by_ids(posts, ids).collect()) == ["p3", "p4"]
    assert reads.posts_by_ids(posts, []).isEmpty()


@pytest.mark.parametrize("seed", [5, 11])
def test_euler_walk_equals_plain_walk(spark, seed):
    rows = forest(seed)
    want = {}
    for post, top in walk(rows).items():
        for i, n in enumerate(flat(top), 1):
            thread = next(t["comment_id"] for t in top if n in flat([t]))
            want[(post, n["comment_id"])] = (thread, n["depth"], i)
    got = threads.euler_walk(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.post_id, r.comment_id): (r.thread_id, r.depth, r.preorder) for r in got} == want
    assert len(got) == len(want)


def test_euler_walk_long_chain_beside_a_cycle(spark):
    n = 20_000
    chain = [("p", "c0", "p", "x", 1)] + [("p", f"c{i}", f"c{i - 1}", "x", 1) for i in range(1, n)]
    cycle = [("p", "y0", "y2", "x", 1), ("p", "y1", "y0", "x", 1), ("p", "y2", "y1", "x", 1), ("p", "y3", "y1", "x", 1)]
    got = threads.euler_walk(spark.createDataFrame(chain + cycle, SCHEMA))
    assert got.count() == n
    last = got.filter("comment_id = 'c19999'").first()
    assert (last.depth, last.preorder, last.thread_id) == (n - 1, n, "c0")


def test_euler_walk_of_large_threads_and_odd_posts(spark):
    rows = forest(8, 400)
    plain = threads.euler_walk(spark.createDataFrame(rows, SCHEMA)).collect()
    want = {(r.post_id, r.comment_id): tuple(r)[2:] for r in plain}
    assert len(want) == len(plain)
    # post "odd" names a comment twice: it is ranked as a list, the others are not touched by that
    odd = [("odd", "o1", "odd", "x", 1), ("odd", "o2", "o1", "x", 1), ("odd", "o3", "gone", "x", 1), ("odd", "o3", "gone", "x", 1), ("odd", None, "o2", "x", 1)]
    got = threads.euler_walk(spark.createDataFrame(rows + odd + [(None, "n", "n", "x", 1)], SCHEMA), 10).collect()
    assert {(r.post_id, r.comment_id): tuple(r)[2:] for r in got if r.post_id != "odd"} == want
    assert ("odd", "o1", "o1", 0, 1, 1) in {tuple(r) for r in got}
    records = threads.threads(threads.euler_walk(spark.createDataFrame(rows, SCHEMA), 10)).collect()
    assert {(r.post_id, r.comment_id): (r.thread_id, r.depth, r.position) for r in records} == {k: (v[0], v[1], v[3]) for k, v in want.items()}


def test_euler_walk_jobs_follow_depth_not_rows(spark):
    def jobs(n):
        wide = [("p", f"c{i}", "p", "x", i) for i in range(n)] + [("p", f"d{i}", f"c{i}", "x", i) for i in range(n)]
        group = f"walk-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert threads.euler_walk(spark.createDataFrame(wide, SCHEMA)).count() == 2 * n
        finally:
            spark.sparkContext.setJobGroup("tests", "tests")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert abs(jobs(3000) - jobs(30)) <= 5


def test_walk_and_documents_build_no_table_in_the_driver(spark):
    comments = spark.createDataFrame(forest(9), SCHEMA)
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1b")  # any broadcast fails
    try:
        with pytest.raises(Exception, match="broadcast"):
            comments.join(F.broadcast(comments.select("post_id").distinct()), "post_id").count()
        tree = threads.euler_walk(comments)
        assert threads.thread_documents(tree, comments).count() == tree.count() == threads.threads(tree).count()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
