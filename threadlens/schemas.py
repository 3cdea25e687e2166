"""Table and raw-item schemas with their column defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

STR, LONG, INT, DBL, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


POSTS = _struct(
    ("post_id", STR), ("subreddit", STR), ("title", STR), ("body", STR), ("author", STR), ("score", LONG),
    ("url", STR), ("created_utc", TS), ("num_comments", LONG), ("sentiment_score", DBL),
    ("sentiment_label", STR), ("keywords", STR), ("batch_id", LONG),
)
COMMENTS = _struct(
    ("comment_id", STR), ("post_id", STR), ("parent_id", STR), ("body", STR), ("author", STR), ("score", LONG),
    ("depth", INT), ("created_utc", TS), ("sentiment_score", DBL), ("sentiment_label", STR), ("keywords", STR),
    ("batch_id", LONG),
)
QA_PAIRS = _struct(
    ("question_comment_id", STR), ("answer_comment_id", STR), ("post_id", STR), ("question", STR), ("answer", STR),
    ("score_signal", LONG), ("match_type", STR), ("verification_status", STR), ("confidence_score", DBL),
    # arrival: pairs enter post by post, the best question of a post first
    ("post_batch", LONG), ("post_created", TS), ("question_score", LONG),
)
METADATA = _struct(("key", STR), ("value", STR))
REJECTS = _struct(("raw", STR), ("kind", STR), ("reason", STR), ("batch_id", LONG))

SCHEMAS = {"posts": POSTS, "comments": COMMENTS, "qa_pairs": QA_PAIRS, "db_metadata": METADATA, "rejects": REJECTS}
KEYS = {
    "posts": ["post_id"],
    "comments": ["comment_id"],
    "qa_pairs": ["question_comment_id", "answer_comment_id"],
    "db_metadata": ["key"],
}

# Defaults of the columns that later schema versions added.
ENRICHMENT_DEFAULTS = {"sentiment_score": 0.0, "sentiment_label": "neutral", "keywords": ""}
PAIR_DEFAULTS = {
    "score_signal": 0,
    "match_type": "unverified",
    "verification_status": "unverified_best_effort",
    "confidence_score": 0.5,
}
DEFAULTS = {"posts": ENRICHMENT_DEFAULTS, "comments": ENRICHMENT_DEFAULTS, "qa_pairs": PAIR_DEFAULTS}

# Every alias a raw item may use; all read as text and cast later.
RAW_COLUMNS = [
    "dataType", "id", "parsedId", "postId", "post_id", "parentId", "parent_id", "replyToId", "parentCommentId",
    "depth", "commentDepth", "parsedCommunityName", "communityName", "subredditName", "title", "body",
    "authorName", "username", "author", "upVotes", "score", "postUrl", "url",
    "commentsCount", "numberOfComments", "numComments", "createdAt", "crawledAt",
]
RAW = T.StructType([T.StructField(c, STR) for c in RAW_COLUMNS + ["_corrupt_record"]])


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])

