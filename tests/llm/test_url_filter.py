"""Rules against a loop, trees on held-out URLs."""

import re

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from threadlens.llm import boosting, url_filter as U
from threadlens.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http://A.Org", "http://org/", "http://x.ORG/es/", "https://example.org/es/1", "https://www.example.org/en/12?x=1&y=2",
    "https://badexample.org/en/1", "ftp://x.com/fr/", "http://x.com/de/#a://b", "http://x.com?/de/", "http://x.com#/de/", "a://b://c/d", "http://X.É.com/de/x", "http://net/a\nb?c", "x" * 40_000 + "://y.com/de/", "http://y.com/" + "z" * 40_000,
]


def slow(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.place), default=None)
    return host, path, best and best.place, best and best.action


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(3, "http://", "y")], "page_id long, url string, host string")
    pages = pages.unionByName(spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", F.lit("z").alias("host")))
    rows = U.judge(pages, URL_RULES, U.fit(U.labelled_by_words(pages))).collect()
    assert len(rows) == pages.count()
    for r in rows:
        host, path, place, action = slow(r.url)
        assert (r._u_host, r._u_path, r._u_rule) == (host, path, place), r.url
        assert r._u_verdict == action or action is None and r._u_verdict in ("allow", "block")
        assert host or r._u_verdict == "allow"


def test_held_out_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    labelled = U.labelled_by_words(pages).withColumn("part", F.pmod(F.xxhash64("url", F.lit(1)), F.lit(2)))
    model = U.fit(labelled.filter("part = 0"))
    held = U.judge(labelled.filter("part = 1"), [], model).groupBy("unwanted", "_u_verdict").count().collect()
    n = {(r.unwanted, r._u_verdict): r["count"] for r in held}
    caught, missed, wrong = n.get((1, "block"), 0), n.get((1, "allow"), 0), n.get((0, "block"), 0)
    assert caught >= 0.8 * (caught + missed) and caught >= 0.9 * (caught + wrong)


def test_no_labels_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert U.fit(U.labelled_by_words(pages)) is None and U.fit(U.labelled_by_words(pages.limit(0))) is None
    assert U.judge(pages, [], None).first()._u_verdict == "allow"
    assert U.judge(pages.limit(0), URL_RULES, None).count() == 0


def test_expression_equals_trees(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)).round(2)
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    model = boosting.fit(x, y)
    assert ((boosting.scores(model, x) > 0) == y).mean() > 0.97
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    got = [r[0] for r in frame.select(boosting.expression(model, lambda i: F.col("abcd"[i]))).collect()]
    assert np.allclose(got, boosting.scores(model, x))
    assert boosting.fit(x, np.ones(400)) is None
    assert boosting.calibrate(np.array([3.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 1]), 0.9) == 1.5
    assert boosting.calibrate(np.array([1.0, 1.0]), np.array([0, 0]), 0.9) is None


def test_fit_counts_every_labelled_row(spark):
    """A suffix that only a few rows in many have: a fit on 20,000 rows picked by a hash has next to no figure for it."""
    many = spark.range(60_000).select(F.concat(F.lit("http://h"), "id", F.lit(".good.org/p")).alias("url"), (F.col("id") % 50 == 0).cast("int").alias("unwanted"))
    rare = spark.range(600).select(F.concat(F.lit("http://r"), "id", F.lit(".rare.net/p")).alias("url"), F.lit(1).alias("unwanted"))
    rows = many.unionByName(rare)
    model = U.fit(rows)
    part = F.pmod(F.xxhash64("url", F.lit(U.PARTS)), F.lit(U.PARTS))
    n = rare.filter(part < U.PARTS // 2).count()
    mean = rows.agg(F.avg("unwanted")).first()[0]
    p = (n + 10 * mean) / (n + 10)
    assert n > 200 and abs(model.suffixes["rare.net"] - np.log(p / (1 - p))) < 1e-9


def test_frame_fit_tells_what_the_table_fit_tells(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 4)).round(2)
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(int)
    frame = spark.createDataFrame([(*map(float, r), int(l)) for r, l in zip(x, y)], "a double, b double, c double, d double, y int")
    model = boosting.fit_frame(frame, list("abcd"))
    assert ((boosting.scores(model, x) > 0) == y).mean() > 0.97
    assert boosting.fit_frame(frame.filter("y = 1"), list("abcd")) is None
    scored = spark.createDataFrame([(3.0, 1), (2.0, 1), (1.0, 0), (0.0, 1)], "score double, y int")
    assert 1.0 < boosting.calibrate_frame(scored, 0.9) < 2.0
    assert boosting.calibrate_frame(scored.filter("y = 0"), 0.9) is None


def test_every_suffix_has_a_figure(spark, monkeypatch):
    """400 suffixes, every fifth unwanted: nothing but the suffix tells which."""
    k = F.col("id") % 400
    rows = spark.range(9600).select(
        F.concat(F.lit("http://h"), F.col("id") + 10_000, F.lit(".s"), 1000 + 7 * k, F.lit(".net/p")).alias("url"), (k % 5 == 3).cast("int").alias("unwanted")
    )
    model = U.fit(rows)
    parts = rows.filter(F.pmod(F.xxhash64("url", F.lit(U.PARTS)), F.lit(U.PARTS)) < U.PARTS // 2)
    counted = parts.groupBy(F.regexp_extract("url", r"s\d+\.net", 0).alias("suffix")).agg(F.sum("unwanted").alias("bad"), F.count(F.lit(1)).alias("n")).collect()
    assert len(counted) == 400
    for name, bad, n in sorted(map(tuple, counted))[::80]:
        p = (bad + 2) / (n + 10)
        assert abs(model.suffixes[name] - np.log(p / (1 - p))) < 1e-9
    new = [("http://h10000.unseen.net/p", 0), (None, 0), ("no scheme", 0)]
    pages = rows.unionByName(spark.createDataFrame(new, "url string, unwanted int")).withColumn("suffix", F.lit("x"))
    told = []
    for broadcast in (100_000, 0):  # by a broadcast and by a shuffle
        monkeypatch.setattr(U, "BROADCAST_SUFFIXES", broadcast)
        judged = U.judge(pages, [], model)
        assert judged.columns == [*pages.columns, "_u_host", "_u_path", "_u_rule", "_u_verdict"]
        told.append(sorted(map(tuple, judged.select("url", "unwanted", "_u_verdict").collect()), key=str))
    assert told[0] == told[1] and len(told[0]) == 9603
    right = sum(bad and verdict == "block" for _, bad, verdict in told[0])
    wrong = sum(not bad and verdict == "block" for _, bad, verdict in told[0])
    assert right > 0.9 * 1920 and wrong < 0.05 * right
