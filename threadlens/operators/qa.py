"""Question detection, answer tiers and question-answer pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from threadlens.functions import text as tx
from threadlens.functions.vocab import TIERS
from threadlens.operators.matching import match_grouped, match_rounds
from threadlens.operators.reads import posts_by_ids, ranked_comments
from threadlens.plans.skew import BLOCK_ROWS, hot_keys, lookup_join, split_hot
from threadlens.session import cut_lineage


def to_comment(df: DataFrame) -> DataFrame:
    """Comment projection with defaults for missing columns and values."""
    defaults = {
        "comment_id": F.lit(""), "post_id": F.lit(""), "parent_id": F.lit(None).cast("string"),
        "author": F.lit("unknown"), "body": F.lit(""), "score": F.lit(0).cast("bigint"), "depth": F.lit(0),
        "created_utc": F.lit(None).cast("timestamp"),
    }
    return df.select(*[(F.coalesce(c, d) if c in df.columns else d).alias(c) for c, d in defaults.items()])


def flag_text(comments: DataFrame) -> DataFrame:
    """Adds `is_valid` and `is_question`."""
    flagged = comments.withColumn("_t", tx.clean_comment_text(F.col("body")))
    return flagged.withColumns(
        {"is_valid": tx.is_valid_text(F.col("_t")), "is_question": tx.is_question(F.col("_t"))}
    ).drop("_t")


def _candidates(comments: DataFrame) -> DataFrame:
    """Valid comments on slim columns with `is_question`; bodies end here.

    The generator drops invalid rows after cleaning; a filter would be pushed below and run the unescaping twice.
    """
    slim = comments.select(
        "post_id", "comment_id", "parent_id", F.coalesce("score", F.lit(0)).alias("score"),
        tx.clean_comment_text(F.col("body")).alias("_t"),
    )
    flag = F.when(tx.is_valid_text(F.col("_t")), F.array(tx.is_question(F.col("_t"))))
    return slim.select("post_id", "comment_id", "parent_id", "score", F.explode(flag).alias("is_question"))


def qa_candidates(comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Valid comments with `rank` by score within the post and `is_question`."""
    return ranked_comments(_read_once(comments), max_rows)


def _read_once(comments: DataFrame) -> DataFrame:
    """Candidates on disk: texts are cleaned once, and counts of keys and both join sides read the slim rows."""
    return cut_lineage(_candidates(comments))


def _best(answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Best answer per key, combined before the shuffle."""
    pick = F.struct((-F.col("score")).alias("s"), "comment_id")
    best = answers.groupBy(*keys).agg(F.min(pick).alias("_b"))
    return best.select(*keys, F.col("_b.comment_id").alias("answer_comment_id"))


def _tier(df: DataFrame) -> DataFrame:
    return df.select("post_id", F.col("comment_id").alias("question_comment_id"), "answer_comment_id")


def direct_replies(comments: DataFrame) -> DataFrame:
    """Best direct reply of each question, without the no-reuse rule."""
    c = _read_once(comments)
    best = _best(c.filter("not is_question"), ["post_id", "parent_id"])
    best = best.withColumnRenamed("parent_id", "comment_id")
    return _tier(c.filter("is_question").join(best, ["post_id", "comment_id"]))


def sibling_replies(comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Best non-question under the same parent comment, without the no-reuse rule."""
    c = _read_once(comments)
    best = _best(c.filter("not is_question"), ["post_id", "parent_id"])
    asks = c.filter("is_question and parent_id <> '' and parent_id <> post_id")
    return _tier(lookup_join(asks, best, ["post_id", "parent_id"], "inner", max_rows))


def fallback_replies(comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Best non-question of the post, without the no-reuse rule."""
    c = _read_once(comments)
    best = _best(c.filter("not is_question"), ["post_id"])
    return _tier(lookup_join(c.filter("is_question"), best, ["post_id"], "inner", max_rows))


def match_answers(
    comments: DataFrame, posts: DataFrame | None = None, max_rows: int | None = None, block: int = BLOCK_ROWS
) -> DataFrame:
    """post_id, question_comment_id, answer_comment_id, tier by greedy matching without reuse.

    `posts` (unique post_id) restricts the posts. The restriction is an inner join on slim columns: a semi-join would
    be pushed below the text flags and shuffle the bodies. Its exchange on post_id also serves the matching.
    """
    hot = hot_keys(comments, ["post_id"], max_rows)
    cold, big = (comments, None) if hot is None else split_hot(comments, ["post_id"], hot)
    ids = None if posts is None else posts.select("post_id")
    candidates = _candidates(cold)
    matches = match_grouped(candidates if ids is None else candidates.join(ids, "post_id"))
    if big is None:
        return matches
    candidates = _candidates(big)
    if ids is not None:
        candidates = candidates.join(F.broadcast(ids.join(F.broadcast(hot), "post_id", "left_semi")), "post_id")
    return matches.unionByName(match_rounds(candidates, max_rows, block))


def _by_tier(field: int) -> Column:
    col = F.lit(None)
    for tier, values in TIERS.items():
        col = F.when(F.col("tier") == tier, values[field]).otherwise(col)
    return col


def qa_pairs(matches: DataFrame, comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Pairs with cleaned texts, summed score, tier labels, and what their order of arrival depends on.

    Both ends are stacked so that the texts are fetched by one join on comment_id, unique on both sides; only texts that
    belong to a pair travel on to the second shuffle.
    """
    ends = matches.select(
        "post_id", "question_comment_id", "answer_comment_id", "tier",
        F.explode(F.array("question_comment_id", "answer_comment_id")).alias("comment_id"),
    )
    texts = comments.select("comment_id", "body", F.coalesce("score", F.lit(0)).alias("score"))
    both = ends.join(texts, "comment_id").withColumn("_t", tx.clean_comment_text(F.col("body")))
    asks = F.col("comment_id") == F.col("question_comment_id")
    pairs = both.groupBy("question_comment_id", "answer_comment_id").agg(
        F.first("post_id").alias("post_id"),
        F.first("tier").alias("tier"),
        F.max(F.when(asks, F.col("_t"))).alias("question"),
        F.max(F.when(~asks, F.col("_t"))).alias("answer"),
        F.sum("score").alias("score_signal"),
        F.max(F.when(asks, F.col("score"))).alias("question_score"),
    )
    arrival = posts.select("post_id", F.col("batch_id").alias("post_batch"), F.col("created_utc").alias("post_created"))
    return pairs.join(arrival, "post_id", "left").select(
        "question_comment_id", "answer_comment_id", "post_id", "question", "answer", "score_signal",
        _by_tier(0).alias("match_type"), _by_tier(1).alias("verification_status"),
        _by_tier(2).cast("double").alias("confidence_score"), "post_batch", "post_created", "question_score",
    )


def generate_qa(
    posts: DataFrame,
    comments: DataFrame,
    post_ids: Sequence[str] | DataFrame | None = None,
    max_rows: int | None = None,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of all stored posts, or of the listed ones; an empty list means all. Orphan comments take no part."""
    whole = post_ids is None or (not isinstance(post_ids, DataFrame) and not len(post_ids))
    chosen = posts if whole else posts_by_ids(posts, post_ids)
    return qa_pairs(match_answers(comments, chosen, max_rows, block), comments, chosen)


def qa_summary(posts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Posts processed, including those without comments, and pairs generated."""
    zero = F.lit(0).cast("bigint")
    p = posts.agg(F.count(F.lit(1)).alias("posts_processed"), zero.alias("qa_pairs_generated"))
    q = pairs.agg(zero.alias("posts_processed"), F.count(F.lit(1)).alias("qa_pairs_generated"))
    return p.unionByName(q).agg(
        F.sum("posts_processed").alias("posts_processed"), F.sum("qa_pairs_generated").alias("qa_pairs_generated")
    )
