"""Normalisation rules, first-wins loading, caps, stored tables and the file stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from threadlens.operators import ingest as ing, maintain
from threadlens.plans import workflow
from threadlens.plans.skew import top_n
from threadlens.schemas import PAIR_DEFAULTS, RAW_COLUMNS, SCHEMAS, empty_table
from threadlens.session import scratch_path
from threadlens.sources.items import read_items
from threadlens.sources.tables import Tables
from threadlens.streaming.ingest_stream import ingest_stream

NOW = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def raw(spark, rows):
    schema = ", ".join(f"`{c}` string" for c in RAW_COLUMNS)
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], schema)


def now():
    return F.lit("2025-01-01 00:00:00").cast("timestamp")


def test_parent_and_depth_rules(spark):
    cases = [
        ({}, "t3_p1", 0),
        ({"parentId": "p1"}, "t3_p1", 0),
        ({"parentId": "c9"}, "t1_c9", 1),
        ({"parentId": "t3_other"}, "t3_other", 0),
        ({"parentId": "", "parent_id": "c2", "commentDepth": "3"}, "t1_c2", 3),
        ({"parentId": "t1_c9", "depth": "x"}, "t1_c9", 0),
        ({"parentId": "t1_c9", "depth": "3.7"}, "t1_c9", 0),
        ({"replyToId": "c4", "parentCommentId": "c5"}, "t1_c4", 1),
    ]
    rows = [{"dataType": "comment", "id": f"{i}", "postId": "p1", **c} for i, (c, _, _) in enumerate(cases)]
    got = {r.comment_id: (r.parent_id, r.depth) for r in ing.normalize_comments(raw(spark, rows), now()).collect()}
    assert got == {f"t1_{i}": (parent, depth) for i, (_, parent, depth) in enumerate(cases)}


def test_comment_without_post(spark):
    row = ing.normalize_comments(raw(spark, [{"id": "t1_a"}]), now()).first()
    assert (row.post_id, row.parent_id, row.depth, row.author, row.score, row.body) == ("", "", 0, "unknown", 0, "")


def test_post_aliases_and_times(spark):
    rows = [
        {"id": "a", "parsedCommunityName": "r/r/x", "communityName": "no", "authorName": "n", "upVotes": "5", "score": "9",
         "title": "T &amp; submitted by me [link]", "createdAt": "2024-03-01T10:00:00Z"},
        {"id": "t3_b", "subredditName": "y", "author": "z", "score": "7", "numComments": "2", "createdAt": "",
         "crawledAt": "2024-03-01T10:00:00.250+02:00"},
        {"parsedId": "c", "createdAt": "1700000000"},
        {"id": "d", "createdAt": "2024-03-01"},
    ]
    got = {r.post_id: r for r in ing.normalize_posts(raw(spark, rows), now()).withColumn("t", F.col("created_utc").cast("string")).collect()}
    a, b, c, d = (got[f"t3_{k}"] for k in "abcd")
    assert (a.subreddit, a.author, a.score, a.title, a.t) == ("r/x", "n", 5, "T &", "2024-03-01 10:00:00")
    assert (b.subreddit, b.author, b.score, b.num_comments, b.t) == ("y", "z", 7, 2, "2024-03-01 08:00:00.25")
    assert (c.t, d.t) == ("2025-01-01 00:00:00", "2024-03-01 00:00:00")


def test_numbers(spark):
    values = ["12", "12.0", "-3.000", "1e3", "3.7", "many", "", None, "9" * 30, " 5"]
    rows = raw(spark, [{"id": str(i), "postId": "p", "upVotes": v, "depth": v} for i, v in enumerate(values)])
    got = {int(r.comment_id[3:]): (r.score, r.depth) for r in ing.normalize_comments(rows, now()).collect()}
    assert [got[i][0] for i in range(len(values))] == [12, 12, -3, 1000, 0, 0, 0, 0, 0, 5]
    assert [got[i][1] for i in (0, 1, 3, 4, 5)] == [12, 12, 1000, 0, 0]


def test_insert_ignore(spark):
    batch = spark.createDataFrame(
        [("k1", 2, "b"), ("k1", 1, "z"), ("k2", 1, "a"), ("k2", 1, None), (None, 1, "n"), ("k3", 5, "c")], "k string, o int, v string"
    )
    stored = batch.filter("k = 'k3'")
    fresh = ing.insert_ignore(stored, batch, ["k"], ["o"])
    assert sorted(map(tuple, fresh.collect())) == [("k1", 1, "z"), ("k2", 1, None)]
    assert ing.insert_ignore(stored.unionByName(fresh), batch, ["k"], ["o"]).isEmpty()


def test_large_limits_by_cutoff(spark, monkeypatch):
    monkeypatch.setattr("threadlens.plans.skew.MAX_LIMIT_ROWS", 3)
    rows = [(i, None if i % 7 == 0 else i % 5, dt.datetime(2024, 1, 1 + i % 9)) for i in range(100)]
    df = spark.createDataFrame(rows, "i int, s int, t timestamp")
    for order in ([("s", "desc"), ("t", "desc"), ("i", "asc")], [("s", "asc"), ("t", "asc"), ("i", "desc")]):
        cols = [F.col(c).desc() if w == "desc" else F.col(c).asc() for c, w in order]
        ranked = [r.i for r in df.orderBy(*cols).collect()]
        for n in (4, 15, 50, 99, 100, 500):
            assert [r.i for r in top_n(df, n, order).collect()] == ranked[:n]


def test_maintenance(spark):
    df = spark.createDataFrame([(1, "x")], "id int, match_type string")
    once = maintain.ensure_columns(df, PAIR_DEFAULTS)
    assert once.first().match_type == "x" and once.first().confidence_score == 0.5
    assert maintain.ensure_columns(once, PAIR_DEFAULTS).columns == once.columns
    comments = spark.createDataFrame([("a", "&amp;amp;"), ("b", "ok"), ("c", None)], "comment_id string, body string")
    first = maintain.reclean(comments, "comments")
    assert [(r.body, r.changed) for r in first.orderBy("comment_id").collect()] == [("&amp;", True), ("ok", False), ("", True)]
    assert maintain.reclean(first.drop("changed"), "comments").filter("changed").count() == 1  # one more layer
    calls = []
    meta = maintain.run_once(empty_table(spark, "db_metadata"), "flag", lambda: calls.append(1))
    maintain.run_once(meta, "flag", lambda: calls.append(2))
    maintain.run_once(meta, "flag", lambda: calls.append(3), force=True)
    assert calls == [1, 3]


ITEMS = [
    {"dataType": "post", "id": "p1", "title": "Is &quot;this&quot; it?", "body": "b", "createdAt": "2024-01-01T00:00:00Z"},
    {"dataType": "post", "title": "lost"},
    {"dataType": "user", "id": "u"},
    {"dataType": "comment", "id": "c1", "postId": "p1", "body": "Why is that?", "upVotes": 3},
    {"dataType": "comment", "id": "c2", "postId": "p1", "parentId": "c1", "body": "Because it is good", "upVotes": 2},
    {"dataType": "comment", "id": "c2", "postId": "p1", "parentId": "c1", "body": "later copy", "upVotes": 2},
    {"dataType": "comment", "id": "c3", "postId": "gone", "body": "orphan &amp;amp; scam"},
]


def write_lines(spark, lines):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_read_items(spark):
    lines = write_lines(spark, [*map(json.dumps, ITEMS), "{broken"])
    items = read_items(spark, lines)
    assert items.count() == 8
    bad = {(r.kind, r.reason) for r in ing.reject_items(items).collect()}
    assert bad == {("post", "missing id"), ("unknown", "malformed JSON")}
    array = write_lines(spark, [json.dumps(ITEMS)])
    assert read_items(spark, array, multiline=True).filter("id is not null").count() == 6


def test_stored_tables_end_to_end(spark):
    tables = Tables(spark, scratch_path(spark, "tables"))
    assert {n: tables.read(n).count() for n in SCHEMAS} == dict.fromkeys(SCHEMAS, 0)
    items = read_items(spark, write_lines(spark, [*map(json.dumps, ITEMS), "{broken"]))
    assert tuple(workflow.ingest(tables, items, "fresh", NOW).first()) == (1, 3)
    assert tuple(workflow.ingest(tables, items, "update", NOW).first()) == (0, 0)
    assert tables.read("rejects").count() == 4
    assert tuple(workflow.generate_qa(tables).first()) == (1, 1)
    pair = tables.read("qa_pairs").first()
    assert (pair.question_comment_id, pair.match_type, pair.score_signal) == ("t1_c1", "direct_reply", 5)
    assert tuple(workflow.generate_qa(tables, ["t3_none"]).first()) == (0, 0)  # a subset run clears all pairs
    assert tuple(workflow.generate_qa(tables, []).first()) == (1, 1)  # an empty list means all
    assert tuple(workflow.run_enrichment(tables).first()) == (1, 3)
    labels = {r.comment_id: (r.sentiment_label, r.keywords) for r in tables.read("comments").collect()}
    assert labels["t1_c2"][0] == "positive" and labels["t1_c3"] == ("negative", "orphan, scam")
    workflow.clean_stored(tables)
    workflow.clean_stored(tables)
    assert tables.read("comments").filter("comment_id = 't1_c3'").first().body == "orphan & scam"
    counts = {r.table_name: r.n for r in workflow.view(tables)["statistics"].collect()}
    assert counts == {"posts": 1, "comments": 3, "qa_pairs": 1}
    out = scratch_path(spark, "export")
    assert {r.sheet: r.n for r in workflow.export(tables, out).collect()} == counts
    sheet = spark.read.option("header", True).csv(f"{out}/posts")
    assert sheet.columns[:3] == ["Post Id", "Subreddit", "Title"] and sheet.count() == 1
    tables.clear()
    assert tables.read("posts").count() == 0 and tables.read("db_metadata").count() == 1
    tables.drop("posts")
    assert not tables.exists("posts")


def test_stream_replay_adds_nothing(spark):
    tables = Tables(spark, scratch_path(spark, "tables"))
    dump = write_lines(spark, map(json.dumps, ITEMS))
    first, again = scratch_path(spark, "cp"), scratch_path(spark, "cp")
    ingest_stream(tables, dump, first, ingest_ts=NOW).awaitTermination()
    before = sorted(map(tuple, tables.read("comments").collect()))
    assert len(before) == 3
    ingest_stream(tables, dump, first, ingest_ts=NOW).awaitTermination()  # nothing new
    ingest_stream(tables, dump, again, ingest_ts=NOW).awaitTermination()  # the same files as a new stream
    assert sorted(map(tuple, tables.read("comments").collect())) == before
    workflow.load_batch(tables, read_items(spark, dump), 1, NOW)  # a load run twice replaces itself
    assert sorted(map(tuple, tables.read("comments").collect())) == before


def test_loads_do_not_touch_each_other(spark):
    tables = Tables(spark, scratch_path(spark, "tables"))
    dump, checkpoint = scratch_path(spark, "dump"), scratch_path(spark, "cp")

    def item(name):
        return json.dumps({"dataType": "comment", "id": name, "postId": "p"})

    def arrive(name, *more):
        spark.createDataFrame([(x,) for x in (item(name), *more)], "value string").coalesce(1).write.mode("append").text(dump)
        ingest_stream(tables, dump, checkpoint, ingest_ts=NOW).awaitTermination()

    arrive("s1", "{broken 1")
    for text in ("{broken 2", "{broken 3"):  # loads of nothing but rejects
        workflow.ingest(tables, read_items(spark, write_lines(spark, [item("m") if text[-1] == "2" else text, text])), "update", NOW)
    arrive("s2", "{broken 4")
    ids = lambda: sorted(r.comment_id for r in tables.read("comments").collect())
    raws = lambda: sorted(r.raw for r in tables.read("rejects").collect())
    assert ids() == ["t1_m", "t1_s1", "t1_s2"]
    assert raws() == ["{broken 1", "{broken 2", "{broken 3", "{broken 3", "{broken 4"]
    assert tables.new_load(f"stream:{checkpoint}#0") == 1 and tables.new_load("other") == 5
    workflow.load_batch(tables, read_items(spark, write_lines(spark, ["{}"])), 1, NOW)  # a load replaced by an empty one
    assert ids() == ["t1_m", "t1_s2"] and "{broken 1" not in raws()
    workflow.ingest(tables, read_items(spark, write_lines(spark, [item("f")])), "fresh", NOW)
    assert ids() == ["t1_f"] and raws() == []


def test_lost_table_raises(spark):
    tables = Tables(spark, scratch_path(spark, "tables"))
    tables.overwrite("db_metadata", spark.createDataFrame([("a", "b")], "key string, value string"))
    tables._remove(tables.path("db_metadata"))
    with pytest.raises(FileNotFoundError):
        tables.read("db_metadata")


def test_caps(spark):
    posts = spark.createDataFrame([(f"p{i}", dt.datetime(2024, 1, 1 + i)) for i in range(5)], "post_id string, created_utc timestamp")
    rows = [(f"c{i:03}", f"p{i % 5}", i % 17, i % 9) for i in range(600)]
    comments = spark.createDataFrame(rows, "comment_id string, post_id string, score bigint, depth int")
    kept, some = ing.cap_per_post(posts, comments, 2, max_rows=20)
    assert sorted(r.post_id for r in kept.collect()) == ["p3", "p4"]
    assert {r.post_id: r["count"] for r in some.groupBy("post_id").count().collect()} == {"p3": 50, "p4": 50}
    best = sorted((r for r in rows if r[1] in ("p3", "p4") and r[3] <= 5), key=lambda r: (-r[2], r[0]))[:40]
    assert sorted(r.comment_id for r in ing.cap_total(posts, comments, 2)[1].collect()) == sorted(r[0] for r in best)


def test_loads_beside_each_other(spark):
    from concurrent.futures import ThreadPoolExecutor

    def comment(i, n):
        return json.dumps({"dataType": "comment", "id": f"c{i}", "postId": "p", "body": f"from {n}"})

    for threads in (2, 8):
        tables = Tables(spark, scratch_path(spark, "tables"))

        def load(n):
            rows = [comment(i, n) for i in range(n % 3, 12, 1 + n % 2)] + [f"{{broken {n}"]
            return workflow.ingest(tables, read_items(spark, write_lines(spark, rows)), "update", NOW).first()

        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(load, range(threads)))
        ids = [r.comment_id for r in tables.read("comments").collect()]
        assert sorted(ids) == sorted(f"t1_c{i}" for i in range(12))  # each key once
        rejects = tables.read("rejects").collect()
        assert len(rejects) == threads and len({r.batch_id for r in rejects}) == threads  # one number a load
        assert len(tables.commits()) == threads

    # a load beside a rewrite of the same tables keeps its rows
    with ThreadPoolExecutor(2) as pool:
        rewrite = pool.submit(workflow.run_enrichment, tables)
        late = pool.submit(lambda: workflow.ingest(tables, read_items(spark, write_lines(spark, [comment(99, 0)])), "update", NOW).first())
        rewrite.result(), late.result()
    assert "t1_c99" in {r.comment_id for r in tables.read("comments").collect()}
    assert tables.read("comments").count() == 13


def test_dump_is_compressed_and_whole(spark, tmp_path):
    import glob

    from workload import queries

    path = queries._dump(spark, "/root/testdata/sf0.001")
    files = glob.glob(f"{path.removeprefix('file:')}/load_no=*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    raw = queries._raw(spark, "/root/testdata/sf0.001", "posts").unionByName(queries._raw(spark, "/root/testdata/sf0.001", "comments"))
    for load in (1, 2):
        assert queries._items(spark, "/root/testdata/sf0.001", load).count() == raw.filter(f"load_no = {load}").count()
