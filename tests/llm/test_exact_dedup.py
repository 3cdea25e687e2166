"""Content sort against a dictionary."""

import hashlib
import random

from pyspark.sql import functions as F

from threadlens.llm import exact_dedup as X


def normal(text):
    return (text or "").encode().lower()


def check(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(normal(r.text), []).append(r.doc_id)
    top = {n: max((i for i in ids if i is not None), default=None) for n, ids in groups.items()}
    got = X.duplicate_groups(docs).collect()
    by_sha = {hashlib.sha256(n).hexdigest(): n for n in groups}
    assert len(got) == len(rows)
    for g in got:
        norm = by_sha[g.text_sha256]
        assert g.keep_id == top[norm] and g.group_size == len(groups[norm])
    kept = [(by_sha[g.text_sha256], g.doc_id) for g in got if g.kept]
    assert sorted(kept, key=str) == sorted(top.items(), key=str)
    stay = X.drop_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted(((normal(r.text), r.doc_id) for r in stay.collect()), key=str) == sorted(top.items(), key=str)


def test_small_cases(spark):
    texts = ["a", "A", "ä", "Ä", "", None, "b" * 300_000, "B" * 300_000, "b" * 299_999, "a ", "İ", "i̇", "a"]
    rows = [(i, t, "s", i) for i, t in enumerate(texts)] + [(3, "Ä", "s", 1), (None, "a", "s", 2), (None, "null id", None, 3)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, sha string, rank int"))


def test_hot_group_over_partitions(spark):
    rng = random.Random(5)
    rows = [(i, "Same Text" if i % 3 == 0 else ("x" * rng.randrange(4)).upper() + str(rng.randrange(40))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert X.duplicate_groups(docs).count() == 0 and X.drop_duplicates(docs).count() == 0


def test_extra_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a", [1, 2], {"k": 1.5}), (2, "a", None, None)], "doc_id long, text string, keep array<int>, n map<string,double>")
    assert [r.doc_id for r in X.drop_duplicates(docs.withColumn("pid", F.lit(0))).collect()] == [2]
