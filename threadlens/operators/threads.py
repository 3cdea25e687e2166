"""Reply trees: children, depth and path, pre-order, thread records and nested documents.

Results have one row per comment at every size: no parent, thread or post ever has to fit into one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from threadlens.operators.reads import by_score
from threadlens.plans.skew import BLOCK_ROWS, rank_in_group, running
from threadlens.session import stage

THREAD_ROWS = 100_000  # threads above are not walked inside one task


def sibling_rank(comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Adds `sibling_rank`: order by score among the children of one parent."""
    return rank_in_group(comments, ["post_id", "parent_id"], by_score(), "sibling_rank", max_rows)


def children(comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """post_id, parent_id, sibling_rank, child: the children of each parent in sibling order, one row each."""
    slim = comments.select("post_id", "parent_id", "comment_id", "score")
    return sibling_rank(slim, max_rows).select("post_id", "parent_id", "sibling_rank", F.col("comment_id").alias("child"))


def build_tree(comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Comments reachable from their post, with recomputed `depth`, `thread_id` (top-level ancestor) and `path`.

    `path` holds the sibling ranks from the root down, so sorting by it is a pre-order walk. Ancestor pointers double
    each round: depth d needs about log2(d) joins instead of d. A comment whose chain meets a missing parent drops out
    at once; a round that settles nobody leaves only cycles, which drop out too. The joins of this module are merge joins
    by hint: by its compressed bytes a side of a million ids passes for small, and would be built in the driver.
    """
    slim = comments.select("post_id", "comment_id", "parent_id", "score")
    ranked = sibling_rank(slim, max_rows)
    nodes = stage(
        ranked.select(
            "post_id",
            "comment_id",
            F.col("parent_id").alias("anc"),
            F.array("sibling_rank").alias("path"),
            F.col("comment_id").alias("thread_id"),
            F.coalesce(F.col("parent_id") == F.col("post_id"), F.lit(False)).alias("done"),
        ),
        "tree",
    )
    settled, pending = nodes.filter("done"), nodes.filter("not done")
    left = pending.count()
    while left:
        known = settled.unionByName(pending).select(
            "post_id",
            F.col("comment_id").alias("anc"),
            F.col("anc").alias("_anc"),
            F.col("path").alias("_path"),
            F.col("thread_id").alias("_thread"),
            F.col("done").alias("_done"),
        )
        step = pending.join(known.hint("merge"), ["post_id", "anc"])
        step = stage(
            step.select(
                "post_id",
                "comment_id",
                F.col("_anc").alias("anc"),
                F.concat("_path", "path").alias("path"),
                F.col("_thread").alias("thread_id"),
                F.col("_done").alias("done"),
            ),
            "tree",
        )
        settled, pending = settled.unionByName(step.filter("done")), step.filter("not done")
        rest = pending.count()
        if rest == left:
            break
        left = rest
    return settled.select("post_id", "comment_id", "thread_id", "path", (F.size("path") - 1).alias("depth"))


def _tour(comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """post_id, comment_id, thread_id, depth, preorder of the comments reachable from their post, by list ranking.

    Every comment is two elements of an Euler tour: going down to it and coming back up. Down leads to its first child,
    or else back up; up leads to its next sibling, or else up from its parent; up from the last top-level comment ends
    the tour. Ranking this list by pointer jumping gives every element the sums of its successors (downs for the
    pre-order number, +1 and -1 for the depth) in about log2 of the post's rows rounds of one join each, over rows of
    fixed width. Lists that end elsewhere (a missing parent) or never end (a cycle: still unfinished after the rounds
    that the largest post could need) drop out.
    """
    ranked = stage(sibling_rank(comments.select("post_id", "comment_id", "parent_id", "score"), max_rows).drop("score"), "tour-siblings")
    first = ranked.filter("sibling_rank = 1").select("post_id", F.col("parent_id").alias("comment_id"), F.col("comment_id").alias("_first"))
    after = ranked.select("post_id", "parent_id", (F.col("sibling_rank") - 1).alias("sibling_rank"), F.col("comment_id").alias("_next"))
    present = ranked.select("post_id", F.col("comment_id").alias("parent_id"), F.lit(True).alias("_known"))
    nodes = ranked.join(first.hint("merge"), ["post_id", "comment_id"], "left")
    nodes = nodes.join(after.hint("merge"), ["post_id", "parent_id", "sibling_rank"], "left")
    nodes = nodes.join(present.hint("merge"), ["post_id", "parent_id"], "left")
    top = F.coalesce(F.col("parent_id") == F.col("post_id"), F.lit(False))
    climb = ~top & F.col("_known").isNotNull()
    down = nodes.select(
        "post_id", F.col("comment_id").alias("node"), F.lit(False).alias("up"),
        F.coalesce("_first", "comment_id").alias("nxt"), F.col("_first").isNull().alias("nxt_up"), F.lit(None).cast("boolean").alias("ok"),
    )
    up = nodes.select(
        "post_id", F.col("comment_id").alias("node"), F.lit(True).alias("up"),
        F.when(F.col("_next").isNotNull(), F.col("_next")).when(climb, F.col("parent_id")).alias("nxt"),
        F.col("_next").isNull().alias("nxt_up"),
        F.when(F.col("_next").isNull() & ~climb, top).alias("ok"),
    )
    elements = down.unionByName(up)
    has_next = F.col("nxt").isNotNull()
    elements = elements.select(
        "*",
        F.when(has_next & ~F.col("nxt_up"), 1).otherwise(0).cast("bigint").alias("s_pre"),
        F.when(has_next, F.when(F.col("nxt_up"), -1).otherwise(1)).otherwise(0).cast("bigint").alias("s_depth"),
    )
    elements = stage(elements, "tour")
    largest = ranked.groupBy("post_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(2 * largest, 2).bit_length() + 1):
        if elements.filter(has_next).isEmpty():
            break
        target = elements.select(
            "post_id", F.col("node").alias("nxt"), F.col("up").alias("nxt_up"),
            F.col("nxt").alias("_nxt"), F.col("nxt_up").alias("_nxt_up"), F.col("ok").alias("_ok"),
            F.col("s_pre").alias("_pre"), F.col("s_depth").alias("_depth"),
        )
        moving = elements.filter(has_next).join(target.hint("merge"), ["post_id", "nxt", "nxt_up"], "left")
        moving = moving.select(
            "post_id", "node", "up", F.col("_nxt").alias("nxt"), F.col("_nxt_up").alias("nxt_up"), F.col("_ok").alias("ok"),
            (F.col("s_pre") + F.col("_pre")).alias("s_pre"), (F.col("s_depth") + F.col("_depth")).alias("s_depth"),
        )
        elements = stage(elements.filter(~has_next).unionByName(moving), "tour")
    walked = elements.filter(~F.col("up") & ~has_next & F.coalesce("ok", F.lit(False)))
    walked = walked.select("post_id", F.col("node").alias("comment_id"), "s_pre", (-F.col("s_depth") - 1).alias("depth"))
    total = walked.groupBy("post_id").agg(F.max("s_pre").alias("_total"))
    walked = walked.join(total, "post_id").withColumn("preorder", F.col("_total") + 1 - F.col("s_pre"))
    along = Window.partitionBy("post_id").orderBy("preorder").rowsBetween(Window.unboundedPreceding, 0)
    thread = F.last(F.when(F.col("depth") == 0, F.col("comment_id")), ignorenulls=True).over(along)
    return walked.select("post_id", "comment_id", thread.alias("thread_id"), F.col("depth").cast("int"), "preorder")


def _roots(nodes: DataFrame) -> DataFrame:
    """`nodes` with `thread_id`, the top-level comment above each; comments that reach none drop out.

    Ancestor pointers double: depth d takes about log2(d) joins of fixed-width rows. A pointer that meets a missing
    parent drops out at once; a round that settles nobody leaves only cycles. Ids must be unique within a post.
    """
    top = F.col("parent_id") == F.col("post_id")
    state = nodes.filter(F.col("parent_id").isNotNull()).select(
        "*", F.when(top, F.col("comment_id")).otherwise(F.col("parent_id")).alias("anc"), top.alias("done")
    )
    state = stage(state, "roots")
    settled, pending = state.filter("done"), state.filter("not done")
    left = pending.count()
    while left:
        known = settled.unionByName(pending).select(
            "post_id", F.col("comment_id").alias("anc"), F.col("anc").alias("_anc"), F.col("done").alias("_done")
        )
        step = pending.drop("done").join(known.hint("merge"), ["post_id", "anc"])
        step = stage(step.select(*nodes.columns, F.col("_anc").alias("anc"), F.col("_done").alias("done")), "roots")
        settled, pending = settled.unionByName(step.filter("done")), step.filter("not done")
        rest = pending.count()
        if rest == left:
            break
        left = rest
    return settled.drop("done").withColumnRenamed("anc", "thread_id")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole threads of (post_id, thread_id, comment_id, parent_id, before), best comment first, in pre-order.

    `before`, on the top-level comment only, counts the post's comments in earlier threads.
    """
    names = ["post_id", "comment_id", "thread_id", "depth", "preorder", "position"]
    types: list[pa.DataType] = []
    out: list[tuple] = []
    thread: list[tuple] = []

    def finish() -> None:
        replies: dict = {}
        before = 0
        for _, root, comment, parent, number in thread:
            if comment == root:
                before = number
            else:
                replies.setdefault(parent, []).append(comment)
        post, root = thread[0][:2]
        waiting, position = [(root, 0)], 0
        while waiting:
            comment, depth = waiting.pop()
            position += 1
            out.append((post, comment, root, depth, before + position, position))
            waiting.extend((reply, depth + 1) for reply in reversed(replies.get(comment, ())))
        thread.clear()

    def emit() -> pa.RecordBatch:
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*out), types)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        kinds = dict(zip(batch.schema.names, batch.schema.types))
        types = [kinds["post_id"], kinds["comment_id"], kinds["thread_id"], pa.int32(), pa.int64(), pa.int64()]
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if thread and thread[0][:2] != row[:2]:
                finish()
            thread.append(row)
            if len(out) >= 10_000:
                yield emit()
    if thread:
        finish()
    if out:
        yield emit()


def euler_walk(comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """post_id, comment_id, thread_id, depth, preorder, position (in the thread) of comments reachable from their post.

    Each comment's thread is found by pointer doubling; a thread of ordinary size is walked inside one task, many to a
    task, and starts where the threads before it in its post end: a prefix sum over the thread sizes. No post and no
    path has to fit into a task. Threads above `max_rows` (by default `THREAD_ROWS`) are ranked as lists (`_tour`), and
    so are posts in which a comment id is missing, repeated or the post's own.
    """
    limit = THREAD_ROWS if max_rows is None else max_rows
    slim = stage(comments.select("post_id", "comment_id", "parent_id", "score").filter(F.col("post_id").isNotNull()), "walk")
    own = F.col("comment_id").isNull() | (F.col("comment_id") == F.col("post_id"))
    odd = slim.groupBy("post_id", "comment_id").agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | own)
    odd = stage(odd.select("post_id").distinct(), "walk-odd")
    parts = []
    if not odd.isEmpty():
        walked = _tour(slim.join(odd, "post_id", "left_semi"), max_rows)
        parts.append(rank_in_group(walked, ["post_id", "thread_id"], [F.col("preorder").asc()], "position", max_rows))
        slim = slim.join(odd, "post_id", "left_anti")
    rows = stage(_roots(slim), "walk-rows")
    is_top = F.col("comment_id") == F.col("thread_id")
    tops = rows.groupBy("post_id", "thread_id").agg(
        F.count(F.lit(1)).alias("size"), F.max(F.when(is_top, F.col("score"))).alias("score")
    )
    tops = stage(tops.withColumnRenamed("thread_id", "comment_id"), "walk-threads")
    tops = rank_in_group(tops, ["post_id"], by_score(), "at", max_rows)
    tops = running(tops, ["post_id"], "at", {"before": (F.sum, F.col("size"))}, inclusive=False, block=BLOCK_ROWS)
    tops = stage(tops.select("post_id", F.col("comment_id").alias("thread_id"), "size", F.col("before").cast("bigint")), "walk-threads")
    big = tops.filter(F.col("size") > limit)  # fewer than rows / limit
    if not big.isEmpty():
        keys = F.broadcast(big.select("post_id", "thread_id"))
        large = rows.join(keys, ["post_id", "thread_id"], "left_semi")
        walked = _tour(large.drop("thread_id"), max_rows).drop("thread_id")
        walked = stage(walked.join(large.select("post_id", "comment_id", "thread_id").hint("merge"), ["post_id", "comment_id"]), "walk-large")
        first = walked.filter(is_top).select("post_id", "thread_id", F.col("preorder").alias("_first"))
        starts = F.broadcast(first.join(big, ["post_id", "thread_id"]))
        walked = walked.join(starts, ["post_id", "thread_id"]).withColumn("position", F.col("preorder") - F.col("_first") + 1)
        walked = walked.withColumn("preorder", F.col("before") + F.col("position"))
        parts.append(walked.select("post_id", "comment_id", "thread_id", "depth", "preorder", "position"))
        rows = rows.join(keys, ["post_id", "thread_id"], "left_anti")
    # top-level comments get the start of their thread from the thread's own row, so no join of all rows is needed
    heads = tops.filter(F.col("size") <= limit).select(
        "post_id", "thread_id", F.col("thread_id").alias("comment_id"), F.col("post_id").alias("parent_id"),
        F.lit(None).cast("bigint").alias("score"), "before",
    )
    rest = rows.filter(~is_top).select("post_id", "thread_id", "comment_id", "parent_id", "score", F.lit(None).cast("bigint").alias("before"))
    dealt = heads.unionByName(rest).repartition("post_id", "thread_id").sortWithinPartitions("post_id", "thread_id", *by_score())
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"post_id {kind['post_id']}, comment_id {kind['comment_id']}, thread_id {kind['thread_id']}, depth int, preorder bigint, position bigint"
    parts.append(dealt.select("post_id", "thread_id", "comment_id", "parent_id", "before").mapInArrow(_walk, schema))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _walk_order(tree: DataFrame) -> list:
    return [F.col("preorder").asc()] if "preorder" in tree.columns else [F.col("path").asc()]


def flatten_tree(tree: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Adds `preorder`, from 1 within each post; a tree from `euler_walk` has it already."""
    if "preorder" in tree.columns:
        return tree
    return rank_in_group(tree, ["post_id"], [F.col("path").asc()], "preorder", max_rows)


def threads(tree: DataFrame, max_rows: int | None = None) -> DataFrame:
    """post_id, thread_id, position, comment_id, depth: the comments of each thread in order, from position 1."""
    if "position" in tree.columns:
        return tree.select("post_id", "thread_id", "position", "comment_id", "depth")
    ranked = rank_in_group(tree, ["post_id", "thread_id"], _walk_order(tree), "position", max_rows)
    return ranked.select("post_id", "thread_id", "position", "comment_id", "depth")


def root_counts(comments: DataFrame) -> DataFrame:
    """Top-level comments per post."""
    roots = comments.filter(F.col("parent_id") == F.col("post_id"))
    return roots.groupBy("post_id").agg(F.count(F.lit(1)).alias("top_level"))


def thread_documents(tree: DataFrame, comments: DataFrame, max_rows: int | None = None) -> DataFrame:
    """post_id, preorder, depth, fragment: each post's comments nested through `replies`, one fragment per comment.

    In pre-order a document is the concatenation of its fragments: a comment's opening, then the brackets that close
    before the next comment, which only depend on the next depth. That neighbour comes by a join on its number.
    """
    walk = stage(flatten_tree(tree, max_rows).select("post_id", "comment_id", "depth", "preorder"), "documents-walk")
    following = walk.select("post_id", (F.col("preorder") - 1).alias("preorder"), F.col("depth").alias("_next"))
    walk = walk.join(following.hint("merge"), ["post_id", "preorder"], "left")
    fields = [c for c in comments.columns if c != "depth"]
    rows = walk.join(comments.drop("post_id", "depth").hint("merge"), "comment_id")
    js = F.to_json(F.struct(*fields, "depth"), {"ignoreNullFields": "false"})
    nxt, depth = F.col("_next"), F.col("depth")
    closing = F.when(nxt.isNull(), F.concat(F.repeat(F.lit("]}"), depth + 1), F.lit("]"))).when(
        nxt <= depth, F.concat(F.repeat(F.lit("]}"), depth - nxt + 1), F.lit(","))
    )
    opening = F.concat(F.when(F.col("preorder") == 1, F.lit("[")).otherwise(F.lit("")), F.expr("left(_js, length(_js) - 1)"), F.lit(',"replies":['))
    rows = rows.withColumn("_js", js)
    return rows.select("post_id", "preorder", "depth", F.concat(opening, F.coalesce(closing, F.lit(""))).alias("fragment"))
