"""Registered queries: each operator over the whole given tables or the overlay views derived from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from threadlens.functions import text as tx
from threadlens.operators import enrich, ingest as ing, maintain, qa, reads, report, threads
from threadlens.plans import workflow
from threadlens.schemas import ENRICHMENT_DEFAULTS, KEYS, PAIR_DEFAULTS, RAW_COLUMNS, empty_table
from threadlens.session import scratch_path
from threadlens.sources.items import read_items
from threadlens.sources.tables import Tables
from threadlens.streaming.ingest_stream import ingest_stream
from workload.overlays import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INGEST_TS = "2025-01-01 00:00:00"
VALENCES = [("the", 0.4), ("and", -0.3), ("die", -1.2), ("best", 2.0), ("good", 1.9), ("scam", -2.1)]
HOT_ROWS = 400  # makes the largest post of the overlay take the path for hot groups already on small data


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _now():
    return F.lit(INGEST_TS).cast("timestamp")


def _iso(df: DataFrame) -> DataFrame:
    return df.withColumn("created_utc", tx.iso(F.col("created_utc"))) if "created_utc" in df.columns else df


def _raw(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    df = load(spark, sf, f"raw_{kind}_fx")
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS], "load_no"
    )


_DUMPS: dict[tuple[str, str], str] = {}
DUMP_ROWS = 50_000  # items of a dump file


@contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)



def _dump(spark: SparkSession, sf: str) -> str:
    """Raw items of both kinds as a JSON dump, one folder per load; written once per session and data folder.

    Files are compressed and bounded, since a reader cannot split them. Both loads are written side by side, so that a
    task need not sort (and spill) its items by load first.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _DUMPS:
        path = scratch_path(spark, "dump")
        both = _raw(spark, sf, "posts").unionByName(_raw(spark, sf, "comments"))
        with _conf(spark, "spark.sql.maxConcurrentOutputFileWriters", "8"):
            both.write.partitionBy("load_no").options(compression="gzip", maxRecordsPerFile=DUMP_ROWS).json(path)
        _DUMPS[key] = path
    return _DUMPS[key]


def _items(spark: SparkSession, sf: str, load_no: int | str = "*") -> DataFrame:
    return read_items(spark, f"{_dump(spark, sf)}/load_no={load_no}").drop("_corrupt_record")


def _comments(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "comments_fx")


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "posts_fx")


def _pairs(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return qa.generate_qa(_posts(spark, sf), _comments(spark, sf), **kw)


# ---- sources, ingest, normalisation ----

_SHOWN = ["dataType", "id", "parsedId", "body", "author", "username", "score", "createdAt"]


@query
def read_items_dump(spark, sf):
    return _items(spark, sf).select(*_SHOWN)


@query
def split_posts(spark, sf):
    return ing.split_items(_items(spark, sf))[0].select(*_SHOWN)


@query
def split_comments(spark, sf):
    return ing.split_items(_items(spark, sf))[1].select(*_SHOWN)


@query
def normalize_posts(spark, sf):
    return _iso(ing.normalize_posts(ing.split_items(_items(spark, sf))[0], _now()))


@query
def normalize_comments(spark, sf):
    return _iso(ing.normalize_comments(ing.split_items(_items(spark, sf))[1], _now()))


@query
def rejects(spark, sf):
    return ing.reject_items(_items(spark, sf)).select("kind", "reason", F.get_json_object("raw", "$.body").alias("body"))


def _loads(spark: SparkSession, sf: str, table: str) -> tuple[DataFrame, DataFrame]:
    """First and second load of one table, each as the rows it inserts."""
    normalize = {"posts": ing.normalize_posts, "comments": ing.normalize_comments}[table]
    stored, loads = empty_table(spark, table), []
    for number in (1, 2):
        raw = ing.split_items(_items(spark, sf, number))[0 if table == "posts" else 1]
        batch = normalize(raw, _now(), number)
        loads.append(ing.insert_ignore(stored, batch, KEYS[table], workflow.ARRIVAL))
        stored = loads[-1]
    return loads[0], loads[1]


@query
def insert_ignore_posts(spark, sf):
    return _iso(_loads(spark, sf, "posts")[1])


@query
def update_load_posts(spark, sf):
    first, second = _loads(spark, sf, "posts")
    return _iso(first.unionByName(second))


@query
def update_load_comments(spark, sf):
    first, second = _loads(spark, sf, "comments")
    return _iso(first.unionByName(second))


@query
def ingest_summary(spark, sf):
    p, c = _loads(spark, sf, "posts"), _loads(spark, sf, "comments")
    return ing.ingest_summary(p[0].unionByName(p[1]), c[0].unionByName(c[1]))


@query
def fresh_load(spark, sf):
    """A fresh load over stored tables: what was stored before is gone."""
    tables = Tables(spark, scratch_path(spark, "tables"))
    at = dt.datetime.fromisoformat(INGEST_TS)
    workflow.ingest(tables, _items(spark, sf, 1), "fresh", at)
    workflow.ingest(tables, _items(spark, sf), "fresh", at)
    return _iso(tables.read("comments"))


@query
def stream_load(spark, sf):
    """The same dump as a file stream of several micro-batches, in two runs of one checkpoint."""
    tables = Tables(spark, scratch_path(spark, "tables"))
    dump, checkpoint = scratch_path(spark, "dump"), scratch_path(spark, "stream")
    at = dt.datetime.fromisoformat(INGEST_TS)
    for number in (1, 2):
        _items(spark, sf, number).write.mode("append").json(dump, compression="gzip")
        ingest_stream(tables, dump, checkpoint, files_per_batch=5, ingest_ts=at).awaitTermination()
    ids = tables.read("posts").select(F.col("post_id").alias("comment_id"))
    return tables.read("comments").select("comment_id").unionByName(ids)


@query
def parallel_loads(spark, sf):
    """Three loads at once on one root: both loads of the dump and the first again. Each key is stored once."""
    from concurrent.futures import ThreadPoolExecutor

    tables = Tables(spark, scratch_path(spark, "tables"))
    at = dt.datetime.fromisoformat(INGEST_TS)
    with ThreadPoolExecutor(3) as pool:
        runs = [pool.submit(workflow.ingest, tables, _items(spark, sf, n), "update", at) for n in (1, 2, 1)]
        [run.result() for run in runs]
    ids = tables.read("posts").select(F.col("post_id").alias("comment_id"))
    return tables.read("comments").select("comment_id").unionByName(ids)


def _mixed_loads(spark: SparkSession, sf: str) -> Tables:
    """The first load as a stream, the second as a batch, then the stream again with nothing new: none touches another."""
    tables = Tables(spark, scratch_path(spark, "tables"))
    dump, checkpoint = scratch_path(spark, "dump"), scratch_path(spark, "stream")
    at = dt.datetime.fromisoformat(INGEST_TS)
    _items(spark, sf, 1).write.json(dump, compression="gzip")
    ingest_stream(tables, dump, checkpoint, ingest_ts=at).awaitTermination()
    workflow.ingest(tables, _items(spark, sf, 2), "update", at)
    ingest_stream(tables, dump, checkpoint, ingest_ts=at).awaitTermination()
    return tables


@query
def mixed_loads_posts(spark, sf):
    return _iso(_mixed_loads(spark, sf).read("posts"))


@query
def mixed_loads_comments(spark, sf):
    return _iso(_mixed_loads(spark, sf).read("comments"))


@query
def cap_per_post(spark, sf):
    return ing.cap_per_post(_posts(spark, sf), _comments(spark, sf), 900)[1].select("comment_id", "post_id", "score")


@query
def cap_total(spark, sf):
    return ing.cap_total(_posts(spark, sf), _comments(spark, sf), 900)[1].select("comment_id", "post_id", "score")


# ---- table maintenance ----


@query
def ensure_columns(spark, sf):
    return maintain.ensure_columns(load(spark, sf, "documents"), {**ENRICHMENT_DEFAULTS, **PAIR_DEFAULTS, "lang": "xx"})


@query
def reclean_posts(spark, sf):
    return maintain.reclean(_posts(spark, sf), "posts").select("post_id", "title", "body", "changed")


@query
def reclean_comments(spark, sf):
    return maintain.reclean(_comments(spark, sf), "comments").select("comment_id", "body", "changed")


@query
def reclean_pairs(spark, sf):
    c = _comments(spark, sf)
    pairs = c.select(
        F.col("comment_id").alias("question_comment_id"), F.col("parent_id").alias("answer_comment_id"),
        F.col("body").alias("question"), F.concat(F.lit(" "), "author").alias("answer"),
    )
    return maintain.reclean(pairs, "qa_pairs")


def _meta(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).cast("string").alias("value"))


@query
def metadata_upsert(spark, sf):
    posts = _posts(spark, sf)
    fresh = _meta(posts.filter("score > 60"), "subreddit").unionByName(_meta(_comments(spark, sf), "author"))
    return maintain.upsert(_meta(posts, "subreddit"), fresh)


@query
def iso_times(spark, sf):
    return load(spark, sf, "events").select("event_id", tx.iso(F.col("ts")).alias("ts_iso"))


@query
def apply_enrichment(spark, sf):
    c = _comments(spark, sf)
    updates = enrich.analyze(c.filter("batch_id = 2"), "comment_id", "body")
    out = maintain.apply_enrichment(c, updates, "comment_id")
    return out.select("comment_id", "sentiment_score", "sentiment_label", "keywords")


@query
def insert_pairs(spark, sf):
    """Pairs of two runs; the second only adds combinations that are not stored."""
    stored = qa.match_answers(_comments(spark, sf)).drop("tier")
    again = qa.direct_replies(_comments(spark, sf)).unionByName(qa.fallback_replies(_comments(spark, sf)))
    keys = KEYS["qa_pairs"]
    return maintain.ensure_columns(ing.insert_ignore(stored, again.select(*stored.columns), keys), PAIR_DEFAULTS)


# ---- reads ----


@query
def post_ids(spark, sf):
    return reads.post_ids(_posts(spark, sf))


@query
def scan_posts(spark, sf):
    return _iso(_posts(spark, sf))


@query
def posts_by_ids(spark, sf):
    ids = _comments(spark, sf).select("post_id").distinct()
    return reads.posts_by_ids(_posts(spark, sf), ids).select("post_id", "title", "score")


@query
def posts_by_id_list(spark, sf):
    return reads.posts_by_ids(_posts(spark, sf), ["t3_0", "t3_7", "t3_150", "t3_none"]).select("post_id", "title", "score")


@query
def ranked_comments(spark, sf):
    return reads.ranked_comments(_comments(spark, sf)).select("post_id", "comment_id", "score", "rank")


@query
def ranked_comments_hot(spark, sf):
    return reads.ranked_comments(_comments(spark, sf), HOT_ROWS).select("post_id", "comment_id", "score", "rank")


@query
def table_counts(spark, sf):
    return report.statistics(_posts(spark, sf), _comments(spark, sf), _pairs(spark, sf))


def _latest(df: DataFrame, table: str) -> DataFrame:
    return _iso(reads.latest(df, 3, reads.LATEST[table]))


@query
def latest_posts(spark, sf):
    return _latest(_posts(spark, sf), "posts")


@query
def latest_comments(spark, sf):
    return _latest(_comments(spark, sf), "comments")


@query
def latest_pairs(spark, sf):
    return _latest(_pairs(spark, sf), "qa_pairs").select(*report.SHEETS["qa_pairs"])


# ---- threads and trees ----


@query
def children(spark, sf):
    return threads.children(_comments(spark, sf))


@query
def sibling_rank(spark, sf):
    return threads.sibling_rank(_comments(spark, sf)).select("post_id", "parent_id", "comment_id", "sibling_rank")


def _flat_path(tree: DataFrame) -> DataFrame:
    return tree.withColumn("path", F.array_join(F.col("path").cast("array<string>"), "."))


@query
def tree_depth(spark, sf):
    return _flat_path(threads.build_tree(_comments(spark, sf)))


@query
def tree_depth_hot(spark, sf):
    return _flat_path(threads.build_tree(_comments(spark, sf), max_rows=HOT_ROWS // 8))


@query
def preorder(spark, sf):
    tree = threads.euler_walk(_comments(spark, sf))
    return tree.select("post_id", "comment_id", "preorder")


@query
def preorder_hot(spark, sf):
    tree = threads.euler_walk(_comments(spark, sf), HOT_ROWS)
    return tree.select("post_id", "comment_id", "preorder")


@query
def thread_records(spark, sf):
    return threads.threads(threads.euler_walk(_comments(spark, sf)))


@query
def thread_documents(spark, sf):
    c = _comments(spark, sf).select("comment_id", "post_id", "parent_id", "author", "body", "score", "depth")
    return threads.thread_documents(threads.euler_walk(c), c)


@query
def root_counts(spark, sf):
    return threads.root_counts(_comments(spark, sf))


# ---- question-answer pairing ----


@query
def valid_text(spark, sf):
    return qa.flag_text(_comments(spark, sf)).select("comment_id", "is_valid")


@query
def questions(spark, sf):
    return qa.flag_text(_comments(spark, sf)).select("comment_id", "is_question")


@query
def qa_candidates(spark, sf):
    return qa.qa_candidates(_comments(spark, sf)).select("post_id", "comment_id", "rank", "is_question")


@query
def to_comment(spark, sf):
    return _iso(qa.to_comment(_comments(spark, sf).drop("author")))


@query
def direct_replies(spark, sf):
    return qa.direct_replies(_comments(spark, sf))


@query
def sibling_replies(spark, sf):
    return qa.sibling_replies(_comments(spark, sf))


@query
def fallback_replies(spark, sf):
    return qa.fallback_replies(_comments(spark, sf))


@query
def match_answers(spark, sf):
    return qa.match_answers(_comments(spark, sf))


@query
def match_answers_hot(spark, sf):
    return qa.match_answers(_comments(spark, sf), max_rows=HOT_ROWS, block=HOT_ROWS)


@query
def qa_pairs(spark, sf):
    return _pairs(spark, sf).select(*report.SHEETS["qa_pairs"])


@query
def qa_subset(spark, sf):
    ids = _posts(spark, sf).filter("score >= 30").select("post_id")
    return _pairs(spark, sf, post_ids=ids).select(*report.SHEETS["qa_pairs"])


@query
def qa_summary(spark, sf):
    return qa.qa_summary(_posts(spark, sf), _pairs(spark, sf))


# ---- text enrichment ----


@query
def clean_pages(spark, sf):
    return load(spark, sf, "pages").select("page_id", tx.clean_comment_text(F.col("html")).alias("cleaned"))


@query
def lexicon_sentiment(spark, sf):
    return enrich.lexicon_sentiment(_comments(spark, sf), "comment_id", "body")


@query
def lexicon_sentiment_documents(spark, sf):
    return enrich.lexicon_sentiment(load(spark, sf, "documents"), "doc_id", "text")


@query
def valence_sentiment(spark, sf):
    lexicon = spark.createDataFrame(VALENCES, "word string, valence double")
    return enrich.valence_sentiment(load(spark, sf, "documents"), "doc_id", "text", lexicon)


@query
def sentiment_label(spark, sf):
    return enrich.label_sentiment(enrich.lexicon_sentiment(_comments(spark, sf), "comment_id", "body"))


@query
def entities(spark, sf):
    out = enrich.entity_lists(load(spark, sf, "documents"), "doc_id", "text")
    return out.select("doc_id", F.array_join("entities", "|").alias("entities"))


@query
def top_keywords(spark, sf):
    out = enrich.top_keywords(load(spark, sf, "documents"), "doc_id", "text")
    return out.select("doc_id", F.array_join("top_words", " ").alias("top_words"))


@query
def keywords(spark, sf):
    docs = load(spark, sf, "documents").withColumn("_t", tx.clean_comment_text(F.col("text")))
    return enrich.with_keywords(docs, "_t").select("doc_id", "keywords")


@query
def analyze(spark, sf):
    return enrich.analyze(load(spark, sf, "documents"), "doc_id", "text")


@query
def enrich_posts(spark, sf):
    out = enrich.enrich_posts(_posts(spark, sf))
    return out.select("post_id", "sentiment_score", "sentiment_label", "keywords")


@query
def enrich_comments(spark, sf):
    out = enrich.enrich_comments(_comments(spark, sf))
    return out.select("comment_id", "sentiment_score", "sentiment_label", "keywords")


@query
def enrich_summary(spark, sf):
    return enrich.enrich_summary(_posts(spark, sf), _comments(spark, sf))


# ---- reporting and export ----


@query
def preview_posts(spark, sf):
    return report.previews(enrich.enrich_posts(_posts(spark, sf)), "posts")


@query
def preview_comments(spark, sf):
    return report.previews(enrich.enrich_comments(_comments(spark, sf)), "comments")


@query
def preview_pairs(spark, sf):
    return report.previews(_pairs(spark, sf), "qa_pairs")


@query
def export_latest(spark, sf):
    """The latest 12,000 orders as cells, numbered in the order they come."""
    rows = reads.latest(load(spark, sf, "orders"), 12_000, ["o_orderdate", "o_orderkey"])
    rows = rows.withColumn("_n", F.monotonically_increasing_id())
    rows = rows.withColumn("place", F.row_number().over(W.orderBy("_n")))
    return report.format_cells(rows.select("place", "o_orderkey", "o_totalprice", "o_orderdate"))


@query
def export_posts(spark, sf):
    return report.export_frame(enrich.enrich_posts(_posts(spark, sf)), "posts")


@query
def export_comments(spark, sf):
    return report.export_frame(enrich.enrich_comments(_comments(spark, sf)), "comments")


@query
def export_pairs(spark, sf):
    return report.export_frame(_pairs(spark, sf), "qa_pairs")


@query
def export_files(spark, sf):
    """The comments sheet written as CSV and read back."""
    path = scratch_path(spark, "export")
    report.write_export(report.export_frame(_comments(spark, sf), "comments"), path)
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.select(F.col("Comment Id").alias("comment_id"), F.col("Body").alias("body"), F.col("Created Utc").alias("created"))


@query
def format_cells(spark, sf):
    return report.format_cells(load(spark, sf, "events"))


@query
def flatten_struct(spark, sf):
    docs = load(spark, sf, "documents")
    inner = F.struct(F.col("source").alias("name"), F.struct("n_chars", "lang").alias("stats"))
    return report.flatten_struct(docs.select("doc_id", inner.alias("origin")))


@query
def column_widths(spark, sf):
    return report.column_widths(_posts(spark, sf))


@query
def column_widths_orders(spark, sf):
    return report.column_widths(load(spark, sf, "orders"))


@query
def export_summary(spark, sf):
    return report.export_summary(posts=_posts(spark, sf), comments=_comments(spark, sf), qa_pairs=_pairs(spark, sf))
