"""Scans, lookups, rankings, counts and latest-N reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from threadlens.plans.skew import rank_in_group, top_n

MAX_LITERAL_IDS = 1_000

# Order of "latest" rows per table, newest first and total. Pairs enter post by post in the order of the posts, and within
# a post by falling score of the question, ties by its id: the last one in is the latest.
LATEST = {
    "posts": ["batch_id", "created_utc", "post_id"],
    "comments": ["batch_id", "created_utc", "comment_id"],
    "qa_pairs": ["post_batch", "post_created", "post_id", ("question_score", "asc"), "question_comment_id", "answer_comment_id"],
}


def by_score() -> list[Column]:
    """Best comment first; ties by id, missing score counts as 0."""
    return [F.coalesce("score", F.lit(0)).desc(), F.col("comment_id").asc()]


def post_ids(posts: DataFrame) -> DataFrame:
    return posts.select("post_id")


def posts_by_ids(posts: DataFrame, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Posts whose id is listed: a pushed-down IN for short lists, a semi-join for frames or long lists."""
    if not isinstance(ids, DataFrame):
        if len(ids) <= MAX_LITERAL_IDS:
            return posts.filter(F.col("post_id").isin(list(ids)))
        ids = posts.sparkSession.createDataFrame([(i,) for i in ids], "post_id string")
    return posts.join(ids.select("post_id").distinct(), "post_id", "left_semi")


def ranked_comments(comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """All comments with their `rank` by score within the post."""
    return rank_in_group(comments, ["post_id"], by_score(), "rank", max_rows)


def table_counts(**tables: DataFrame) -> DataFrame:
    """One (table_name, n) row per table; a metadata-only count on Parquet."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("table_name"), "n") for k, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def latest(df: DataFrame, n: int, order: Sequence[str | tuple[str, str]]) -> DataFrame:
    """The last `n` rows by `order`, newest first; a name alone means its largest values are the newest."""
    return top_n(df, n, [(c, "desc") if isinstance(c, str) else c for c in order])
