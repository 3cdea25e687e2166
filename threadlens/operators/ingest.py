"""Raw items to typed posts and comments; first-wins loading; crawl caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from threadlens.functions import text as tx
from threadlens.operators.reads import by_score
from threadlens.plans.skew import lookup_join, rank_in_group, top_n
from threadlens.schemas import COMMENTS, ENRICHMENT_DEFAULTS, POSTS

# ISO date, optional time with optional seconds and fraction, optional offset.
ISO_TIME = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"

# The two crawl request variants, per requested post.
PER_POST_COMMENTS, TOTAL_PER_POST, ITEMS_PER_POST, CRAWL_DEPTH = 50, 20, 25, 5


def split_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts, comments) by dataType; every other kind is dropped."""
    return items.filter(F.col("dataType") == "post"), items.filter(F.col("dataType") == "comment")


def _chain(*names: str, default: str | None = None) -> Column:
    return F.coalesce(*[F.col(n) for n in names], F.lit(default))


def _truthy(*names: str) -> Column:
    """First alias that is neither missing, empty nor zero."""
    return F.coalesce(*[F.when(~F.col(n).isin("", "0"), F.col(n)) for n in names])


def _whole(text: Column) -> Column:
    """A whole number, also one written with an empty fraction or an exponent (`12.0`, `1e3`); NULL for anything else."""
    exact = text.try_cast("decimal(38,9)")
    return F.coalesce(text.try_cast("bigint"), F.when(exact == F.floor(exact), exact.try_cast("bigint")))


def _number(*names: str) -> Column:
    return F.coalesce(_whole(_chain(*names)), F.lit(0).cast("bigint"))


def _prefixed(col: Column, prefix: str) -> Column:
    return F.when(col.startswith(prefix), col).otherwise(F.concat(F.lit(prefix), col))


def _bare_id() -> Column:
    """`id`, else `parsedId`; NULL when there is nothing to build a key from."""
    return F.nullif(_chain("id", "parsedId"), F.lit(""))


def _time(ingest_ts: Column) -> Column:
    """First non-empty time alias when it is ISO text, else the ingest time."""
    raw = F.coalesce(F.nullif(F.col("createdAt"), F.lit("")), F.col("crawledAt"))
    return F.coalesce(F.when(raw.rlike(ISO_TIME), F.translate(raw, ",", ".").try_cast("timestamp")), ingest_ts)


def _author() -> Column:
    return _chain("authorName", "username", "author", default="unknown")


def reject_items(items: DataFrame, batch_id: int = 0) -> DataFrame:
    """Items that cannot be loaded, in one scan: posts and comments without any id, and lines that are no JSON."""
    corrupt = F.col("_corrupt_record") if "_corrupt_record" in items.columns else F.lit(None).cast("string")
    named = F.col("dataType").isin("post", "comment") & _bare_id().isNull()
    names = [c for c in items.columns if c != "_corrupt_record"]
    return items.filter(corrupt.isNotNull() | named).select(
        F.coalesce(corrupt, F.to_json(F.struct(*names))).alias("raw"),
        F.when(corrupt.isNotNull(), "unknown").otherwise(F.col("dataType")).alias("kind"),
        F.when(corrupt.isNotNull(), "malformed JSON").otherwise("missing id").alias("reason"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def _enrichment(batch_id: int) -> list[Column]:
    cols = [F.lit(v).alias(c) for c, v in ENRICHMENT_DEFAULTS.items()]
    return [*cols, F.lit(batch_id).cast("bigint").alias("batch_id")]


def normalize_posts(raw: DataFrame, ingest_ts: Column, batch_id: int = 0) -> DataFrame:
    """Typed posts; those without any id go to `reject_items`."""
    raw = raw.withColumn("_k_id", _bare_id())
    community = F.regexp_replace(_chain("parsedCommunityName", "communityName", "subredditName", default=""), "^r/", "")
    good = raw.filter(F.col("_k_id").isNotNull()).select(
        _prefixed(F.col("_k_id"), "t3_").alias("post_id"),
        community.alias("subreddit"),
        tx.clean_post_text(F.col("title")).alias("title"),
        tx.clean_post_text(F.col("body")).alias("body"),
        _author().alias("author"),
        _number("upVotes", "score").alias("score"),
        _chain("postUrl", "url", default="").alias("url"),
        _time(ingest_ts).alias("created_utc"),
        _number("commentsCount", "numberOfComments", "numComments").alias("num_comments"),
        *_enrichment(batch_id),
    )
    return good.select(*POSTS.names)


def normalize_comments(raw: DataFrame, ingest_ts: Column, batch_id: int = 0) -> DataFrame:
    """Typed comments; those without any id go to `reject_items`, an empty post id is kept."""
    raw = raw.withColumn("_k_id", _bare_id()).withColumn("_k_post", _chain("postId", "post_id", default=""))
    post = F.when(F.col("_k_post") == "", "").otherwise(_prefixed(F.col("_k_post"), "t3_"))
    parent = F.coalesce(_truthy("parentId", "parent_id", "replyToId", "parentCommentId"), F.col("_k_post"))
    rows = raw.withColumn("_k_post", post).withColumn("_k_parent", parent)
    plain = F.col("_k_parent")
    rows = rows.withColumn(
        "_k_parent",
        F.when((plain == "") | plain.startswith("t1_") | plain.startswith("t3_"), plain)
        .when(plain == F.replace(F.col("_k_post"), F.lit("t3_"), F.lit("")), F.concat(F.lit("t3_"), plain))
        .otherwise(F.concat(F.lit("t1_"), plain)),
    )
    declared = _chain("depth", "commentDepth")
    top = (F.col("_k_parent") == F.col("_k_post")) | F.col("_k_parent").startswith("t3_")
    depth = F.when(declared.isNull(), F.when(top, 0).otherwise(1)).otherwise(
        F.coalesce(_whole(tx.strip(declared)).try_cast("int"), F.lit(0))
    )
    good = rows.filter(F.col("_k_id").isNotNull()).select(
        _prefixed(F.col("_k_id"), "t1_").alias("comment_id"),
        F.col("_k_post").alias("post_id"),
        F.col("_k_parent").alias("parent_id"),
        tx.clean_comment_text(F.col("body")).alias("body"),
        _author().alias("author"),
        _number("upVotes", "score").alias("score"),
        depth.alias("depth"),
        _time(ingest_ts).alias("created_utc"),
        *_enrichment(batch_id),
    )
    return good.select(*COMMENTS.names)


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the least by `order` then by the remaining columns; copies are combined before the shuffle."""
    rest = [c for c in batch.columns if c not in keys and c not in order]
    present = batch.na.drop(subset=list(keys))
    row = F.struct(*[c for c in order if c not in keys], *rest)
    first = present.groupBy(*keys).agg(F.min(row).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in batch.columns])


def insert_ignore(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of `batch` to append: first per key, key complete and not stored yet.

    Stored keys are first cut down to those of the batch, so a small batch is broadcast and the table not shuffled. Both
    joins see each batch key once, however many copies came in.
    """
    keys = list(keys)
    first = first_per_key(batch, keys, order)
    known = existing.select(*keys).join(first.select(*keys), keys, "left_semi")
    return first.join(known, keys, "left_anti").select(*batch.columns)


def ingest_summary(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Inserted posts and comments."""
    zero = F.lit(0).cast("bigint")
    p = posts.agg(F.count(F.lit(1)).alias("posts_inserted"), zero.alias("comments_inserted"))
    c = comments.agg(zero.alias("posts_inserted"), F.count(F.lit(1)).alias("comments_inserted"))
    return p.unionByName(c).agg(
        F.sum("posts_inserted").alias("posts_inserted"), F.sum("comments_inserted").alias("comments_inserted")
    )


def cap_threads(
    posts: DataFrame,
    comments: DataFrame,
    max_posts: int,
    per_post: int | None = None,
    max_depth: int | None = None,
    total_comments: int | None = None,
    max_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The crawl limits as a report: newest posts and their top comments by score within every given limit."""
    kept = top_n(posts, max_posts, [("created_utc", "desc"), ("post_id", "asc")])
    if max_depth is not None:
        comments = comments.filter(F.col("depth") <= max_depth)
    comments = lookup_join(comments, kept.select("post_id"), ["post_id"], "left_semi", max_rows)
    if per_post is not None:
        ranked = rank_in_group(comments, ["post_id"], by_score(), "_rank", max_rows)
        comments = ranked.filter(F.col("_rank") <= per_post).drop("_rank")
    if total_comments is not None:
        scored = comments.withColumn("_score", F.coalesce("score", F.lit(0)))
        comments = top_n(scored, total_comments, [("_score", "desc"), ("comment_id", "asc")]).drop("_score")
    return kept, comments


def cap_per_post(posts: DataFrame, comments: DataFrame, n: int, max_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Request variant with a comment limit per post and in total."""
    return cap_threads(posts, comments, n, per_post=PER_POST_COMMENTS, total_comments=n * PER_POST_COMMENTS, max_rows=max_rows)


def cap_total(posts: DataFrame, comments: DataFrame, n: int, max_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Request variant with a depth limit, a total comment limit and a limit on all items."""
    total = min(n * TOTAL_PER_POST, n * ITEMS_PER_POST - n)
    return cap_threads(posts, comments, n, max_depth=CRAWL_DEPTH, total_comments=total, max_rows=max_rows)
