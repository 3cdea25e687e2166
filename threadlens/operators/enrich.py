"""Sentiment, entities and keywords. Everything but the lexicon-table join is row-local: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadlens.functions import text as tx
from threadlens.functions.vocab import MAX_ENTITIES, MAX_KEYWORDS
from threadlens.plans.skew import lookup_join

MAX_BROADCAST_WORDS = 200_000


def _with_lexicon_score(df: DataFrame, cleaned: str) -> DataFrame:
    """Adds `sentiment_score`: (positive - negative) / (positive + negative), 0 without a hit.

    Each step is a column of its own, so that no array is built twice.
    """
    df = df.withColumn("_h", tx.lexicon_hits(F.col(cleaned)))
    df = df.withColumns({"_all": F.size("_h"), "_good": tx.positive_count(F.col("_h"))})
    df = df.withColumn("_x", F.when(F.col("_all") > 0, (2 * F.col("_good") - F.col("_all")) / F.col("_all")).otherwise(0.0))
    return df.withColumn("sentiment_score", tx.round4(F.col("_x"))).drop("_h", "_all", "_good", "_x")


def lexicon_sentiment(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, sentiment_score by the built-in word lists."""
    cleaned = df.select(id_col, tx.clean_comment_text(F.col(text_col)).alias("_t"))
    return _with_lexicon_score(cleaned, "_t").drop("_t")


def label_sentiment(df: DataFrame, score: str = "sentiment_score") -> DataFrame:
    return df.withColumn("sentiment_label", tx.sentiment_label(F.col(score)))


def valence_sentiment(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame) -> DataFrame:
    """id, sentiment_score from a (word, valence) table: the summed valence squashed to [-1, 1] by x / sqrt(x^2 + 15).

    Only (id, word) leaves the scan, and partial sums leave one row per text and map task. The lexicon is broadcast
    after its size is checked; a larger one is joined by shuffling distinct (id, word) counts.
    """
    words = lexicon.select(F.col("word").alias("_w"), F.col("valence").cast("decimal(18,6)").alias("_v"))
    small = lexicon.limit(MAX_BROADCAST_WORDS + 1).count() <= MAX_BROADCAST_WORDS
    cleaned = df.select(id_col, tx.clean_comment_text(F.col(text_col)).alias("_t"))
    tokens = cleaned.select(id_col, F.explode_outer(tx.word_tokens(F.col("_t"))).alias("_w"))
    if small:
        hits = tokens.join(F.broadcast(words), "_w", "left").withColumn("_n", F.lit(1))
    else:
        hits = lookup_join(tokens.groupBy(id_col, "_w").agg(F.count(F.lit(1)).alias("_n")), words, ["_w"], "left")
    x = F.coalesce(F.sum(F.col("_v") * F.col("_n")), F.lit(0)).cast("double")
    sums = hits.groupBy(id_col).agg(x.alias("_x"))
    scores = sums.withColumn("_y", F.col("_x") / F.sqrt(F.col("_x") * F.col("_x") + 15))
    return scores.select(id_col, tx.round4(F.col("_y")).alias("sentiment_score"))


def _with_top_words(df: DataFrame, tokens: Column, k: int) -> DataFrame:
    """Adds `_top`: the k most frequent tokens, ties by first position.

    All tokens are sorted within the row, which gives the start of each run of equal words. The distinct words, numbered
    by first appearance and sorted too, line up with those runs.
    """
    df = df.withColumn("_k", tokens)
    numbered = F.transform(F.array_distinct("_k"), lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    df = df.withColumns({"_s": F.sort_array("_k"), "_d": F.sort_array(numbered)})
    starts = F.transform("_s", lambda w, p: F.when((p == 0) | (F.get(F.col("_s"), p - 1) != w), p))
    df = df.withColumns({"_n": F.size("_s"), "_p": F.filter(starts, lambda p: p.isNotNull())})

    def counted(word: Column, j: Column) -> Column:
        end = F.coalesce(F.get(F.col("_p"), j + 1), F.col("_n"))
        return F.struct((F.get(F.col("_p"), j) - end).alias("c"), word["i"].alias("i"), word["w"].alias("w"))

    top = F.slice(F.sort_array(F.transform("_d", counted)), 1, k)["w"]
    return df.withColumn("_top", top).drop("_k", "_s", "_d", "_n", "_p")


def with_keywords(df: DataFrame, cleaned: str, k: int = MAX_KEYWORDS) -> DataFrame:
    """Adds `keywords` from the cleaned text column: up to 4 entities, then top words that are no entity."""
    df = _with_top_words(df, tx.keyword_tokens(F.col(cleaned)), k)
    df = df.withColumn("_e", tx.entities(F.col(cleaned)))
    df = df.withColumn("_el", F.transform("_e", F.lower))
    rest = F.filter("_top", lambda w: ~F.array_contains(F.col("_el"), w))
    mixed = F.slice(F.concat(F.slice("_e", 1, MAX_ENTITIES), rest), 1, k)
    return df.withColumn("keywords", F.array_join(mixed, ", ")).drop("_top", "_e", "_el")


def top_keywords(df: DataFrame, id_col: str, text_col: str, k: int = MAX_KEYWORDS) -> DataFrame:
    """id, top_words array."""
    cleaned = df.select(id_col, tx.clean_comment_text(F.col(text_col)).alias("_t"))
    return _with_top_words(cleaned, tx.keyword_tokens(F.col("_t")), k).select(id_col, F.col("_top").alias("top_words"))


def entity_lists(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, entities array."""
    cleaned = df.select(id_col, tx.clean_comment_text(F.col(text_col)).alias("_t"))
    return cleaned.select(id_col, tx.entities(F.col("_t")).alias("entities"))


def with_analysis(df: DataFrame, text: Column) -> DataFrame:
    """Overwrites sentiment_score, sentiment_label and keywords from `text`, row by row."""
    df = df.drop("sentiment_score", "sentiment_label", "keywords").withColumn("_t", tx.clean_comment_text(text))
    df = with_keywords(_with_lexicon_score(df, "_t"), "_t")
    return label_sentiment(df).drop("_t")


def analyze(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, sentiment_score, sentiment_label, keywords."""
    out = with_analysis(df.select(id_col, F.col(text_col).alias("_raw")), F.col("_raw"))
    return out.select(id_col, "sentiment_score", "sentiment_label", "keywords")


def enrich_posts(posts: DataFrame) -> DataFrame:
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit("")))
    return with_analysis(posts, text).select(*posts.columns)


def enrich_comments(comments: DataFrame) -> DataFrame:
    return with_analysis(comments, F.col("body")).select(*comments.columns)


def enrich_summary(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Rows enriched per table; every stored row is, so the counts need no text."""
    p = posts.agg(F.count(F.lit(1)).alias("posts_enriched"), F.lit(0).cast("bigint").alias("comments_enriched"))
    c = comments.agg(F.lit(0).cast("bigint").alias("posts_enriched"), F.count(F.lit(1)).alias("comments_enriched"))
    return p.unionByName(c).agg(
        F.sum("posts_enriched").alias("posts_enriched"), F.sum("comments_enriched").alias("comments_enriched")
    )
