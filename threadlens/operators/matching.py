"""Greedy answer matching without reuse, exact for posts of any size.

Questions are served in rank order. Each takes the best unused answer among (1) its direct replies, (2) the replies to
its parent unless that is the post, (3) all answers of the post. The result depends on the order, so the tiers cannot
be joined independently.

Posts of ordinary size are matched in one grouped map on slim columns. A hot post is matched by parallel rounds:

* Answers with one parent form a queue that is only ever taken from its front, whichever tier takes. Fallback takes
  move a pointer forward through all answers of the post.
* Suppose the pointer position before each question is known. Then the i-th request on a queue finds
  `i - 1 + max(0, max over earlier and own requests m of passed_m - (m - 1))` of its answers gone, where `passed_m` is
  the number of queue members the pointer had passed at request m. That is a count, a prefix maximum and an equi-join.
* Requests beyond the queue length fall through to the next tier. The k-th fallback question takes the k-th answer that
  no queue request took, which gives the next guess of the pointer.

Each outcome depends on earlier questions only, so every round settles at least a longer prefix of the questions and a
round without change is the greedy result. In practice a few rounds settle a post.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from threadlens.operators.reads import by_score
from threadlens.plans.skew import BLOCK_ROWS, hot_keys, rank_in_group, running
from threadlens.session import stage

MATCHES = "post_id string, question_comment_id string, answer_comment_id string, tier int"
_END = 1 << 61  # pointer position once a post has no answer left


def _match_post(pdf: pd.DataFrame) -> pd.DataFrame:
    """One post, any row order; queues are lists of answer numbers with a forward-only cursor each."""
    pdf = pdf.sort_values("rank")
    post = pdf["post_id"].iloc[0]
    asks = pdf[pdf["is_question"]]
    replies = pdf[~pdf["is_question"]]
    answers = replies["comment_id"].tolist()
    queues: dict = {None: list(range(len(answers)))}
    for number, parent in enumerate(replies["parent_id"]):
        if parent is not None:
            queues.setdefault(parent, []).append(number)
    cursors = dict.fromkeys(queues, 0)
    used = bytearray(len(answers))

    def front(key):
        queue, at = queues.get(key, ()), cursors.get(key, 0)
        while at < len(queue) and used[queue[at]]:
            at += 1
        cursors[key] = at
        return queue[at] if at < len(queue) else None

    rows = []
    for question, parent in zip(asks["comment_id"], asks["parent_id"]):
        keys = [(1, question)]
        if parent and parent != post:
            keys.append((2, parent))
        for tier, key in [*keys, (3, None)]:
            best = front(key)
            if best is not None:
                used[best] = 1
                rows.append((post, question, answers[best], tier))
                break
        else:
            break
    return pd.DataFrame(rows, columns=["post_id", "question_comment_id", "answer_comment_id", "tier"])


def match_grouped(candidates: DataFrame) -> DataFrame:
    """Matches of posts that fit one task each: post_id, question_comment_id, answer_comment_id, tier.

    `candidates`: valid comments with post_id, comment_id, parent_id, score, is_question. Window and grouped map share
    one exchange on post_id; posts without both kinds never reach Python.
    """
    post = W.partitionBy("post_id")
    ranked = candidates.select(
        "post_id",
        "comment_id",
        "parent_id",
        "is_question",
        F.row_number().over(post.orderBy(*by_score())).alias("rank"),
        F.max("is_question").over(post).alias("_asks"),
        F.min("is_question").over(post).alias("_only_asks"),
    )
    ranked = ranked.filter("_asks and not _only_asks").drop("_asks", "_only_asks")
    return ranked.groupBy("post_id").applyInPandas(_match_post, MATCHES)


def match_rounds(candidates: DataFrame, max_rows: int | None = None, block: int = BLOCK_ROWS) -> DataFrame:
    """The same matches for hot posts, by rounds.

    Their joins are merge joins by hint: both sides grow with the posts, and sides that adaptive execution still takes for
    small, by their compressed bytes, would be built as hash tables in the driver, several a round.
    """
    one = F.lit(1).cast("bigint")
    queue = ["post_id", "g"]
    ranked = stage(
        rank_in_group(candidates, ["post_id"], by_score(), "pos", max_rows).select(
            "post_id", "comment_id", "parent_id", "is_question", "pos"
        ),
        "match-ranked",
    )
    answers = ranked.filter("not is_question").select("post_id", F.col("parent_id").alias("g"), "pos", "comment_id")
    # queues are cut into blocks only where some parent is hot itself; posts always are
    queue_block = None if hot_keys(ranked, ["post_id", "parent_id"], max_rows) is None else block
    queued = running(answers.filter(F.col("g").isNotNull()), queue, "pos", {"j": (F.sum, one)}, block=queue_block)
    queued = stage(queued, "match-queues")
    sizes = queued.groupBy("post_id", "g").agg(F.count(F.lit(1)).alias("size"))

    asks = ranked.filter("is_question").select(
        "post_id",
        F.col("comment_id").alias("question"),
        F.when((F.col("parent_id") != "") & (F.col("parent_id") != F.col("post_id")), F.col("parent_id")).alias("g2"),
        F.col("pos").alias("t"),
    )
    own = sizes.select("post_id", F.col("g").alias("question"), F.col("size").alias("size1"))
    side = sizes.select("post_id", F.col("g").alias("g2"), F.col("size").alias("size2"))
    asks = asks.join(own.hint("merge"), ["post_id", "question"], "left").join(side.hint("merge"), ["post_id", "g2"], "left")
    state = stage(
        asks.select(
            "post_id", "question", "g2", "t", "size1", "size2",
            F.when(F.col("size1").isNotNull(), 1).when(F.col("size2").isNotNull(), 2).otherwise(3).alias("tier"),
            F.lit(0).cast("bigint").alias("pointer"),
            F.lit(None).cast("string").alias("answer"),
        ),
        "match-state",
    )
    # only queues that some question may ask for take part in the rounds
    wanted = (
        state.filter("size1 is not null").select("post_id", F.col("question").alias("g"))
        .unionByName(state.filter("size2 is not null").select("post_id", F.col("g2").alias("g")))
        .distinct()
    )
    queued = stage(queued.join(wanted.hint("merge"), ["post_id", "g"], "left_semi"), "match-queues")
    while True:
        requests = state.filter("size1 is not null").select(
            "post_id", F.col("question").alias("g"), "t", F.lit(1).alias("kind"), "pointer", F.col("size1").alias("size")
        ).unionByName(
            state.filter("tier <> 1 and size2 is not null").select(
                "post_id", F.col("g2").alias("g"), "t", F.lit(2).alias("kind"), "pointer", F.col("size2").alias("size")
            )
        )
        # queue members passed by the pointer, counted for the first request at each pointer position; the count never
        # falls, so a running maximum hands it to the later requests at the same position
        marks = requests.groupBy(*queue, F.col("pointer").alias("pos")).agg(F.min("t").alias("t"))
        merged = queued.select(*queue, "pos", F.lit(None).cast("bigint").alias("t"), F.lit(0).alias("_mark"))
        merged = merged.unionByName(marks.withColumn("_mark", F.lit(1)))
        passed = (
            running(merged, queue, "pos", {"_passed": (F.sum, 1 - F.col("_mark"))}, ties=["_mark"], block=queue_block)
            .filter("_mark = 1")
            .select(*queue, "t", "_passed")
        )
        requests = requests.join(passed.hint("merge"), [*queue, "t"], "left")
        requests = running(
            requests, queue, "t", {"i": (F.sum, one), "passed": (F.max, F.col("_passed"))}, ties=["kind"], block=queue_block
        )
        ahead = F.col("passed") - F.col("i") + 1
        requests = running(requests, queue, "t", {"_most": (F.max, ahead)}, ties=["kind"], block=queue_block)
        served = (
            requests.withColumn("j", F.col("i") + F.greatest("_most", F.lit(0)))
            .filter("j <= size")
            .join(queued.hint("merge"), [*queue, "j"])
            .select("post_id", "t", "kind", "pos", "comment_id")
        )
        served = stage(served, "match-served")
        got = served.groupBy("post_id", "t").agg(F.min(F.struct("kind", "comment_id")).alias("_got"))
        nxt = state.join(got.hint("merge"), ["post_id", "t"], "left").select(
            *state.columns,
            F.coalesce("_got.kind", F.lit(3)).alias("tier_new"),
            F.col("_got.comment_id").alias("taken"),
        )
        fallback = running(
            nxt.filter("tier_new = 3").select("post_id", "t"), ["post_id"], "t", {"k": (F.sum, one)}, block=block
        )
        free = answers.join(served.select("post_id", "pos").hint("merge"), ["post_id", "pos"], "left_anti")
        free = running(free, ["post_id"], "pos", {"k": (F.sum, one)}, block=block)
        free = free.select("post_id", "k", "pos", F.col("comment_id").alias("free"))
        falls = fallback.join(free.hint("merge"), ["post_id", "k"], "left")
        falls = stage(falls.select("post_id", "t", "free", F.coalesce("pos", F.lit(_END)).alias("_moved")), "match-falls")
        nxt = nxt.join(falls.hint("merge"), ["post_id", "t"], "left")
        nxt = running(nxt, ["post_id"], "t", {"_pointer": (F.max, F.col("_moved"))}, inclusive=False, block=block)
        nxt = nxt.withColumn("pointer_new", F.coalesce("_pointer", F.lit(0).cast("bigint")))
        nxt = nxt.withColumn("answer_new", F.coalesce("taken", "free"))
        moved = (
            (F.col("tier") != F.col("tier_new"))
            | (F.col("pointer") != F.col("pointer_new"))
            | ~F.col("answer").eqNullSafe(F.col("answer_new"))
        )
        nxt = stage(
            nxt.select(
                "post_id", "question", "g2", "t", "size1", "size2",
                F.col("tier_new").alias("tier"), F.col("pointer_new").alias("pointer"), F.col("answer_new").alias("answer"),
                moved.alias("moved"),
            ),
            "match-state",
        )
        settled = nxt.filter("moved").isEmpty()
        state = nxt.drop("moved")
        if settled:
            break
    return state.filter("answer is not null").select(
        "post_id",
        F.col("question").alias("question_comment_id"),
        F.col("answer").alias("answer_comment_id"),
        F.col("tier").cast("int").alias("tier"),
    )
