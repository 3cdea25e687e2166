"""Connected components by min-label hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadlens.llm.common import gathered
from threadlens.session import cut_lineage

ROWS = 100_000  # a task writes in a round


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b), bigint: the label is the smallest node of the component.

    Each round hooks a node, and the root it points to, below the smallest label next to it, then halves the paths. Labels
    only fall, so an unchanged sum means the end; rounds grow with the logarithm of the longest path. Aggregates combine
    before the shuffle, and joins on a label that many nodes share are split by adaptive execution. A small graph leaves
    few files in each round, whatever the number of shuffle partitions.
    """
    n = 2 * edges.count()

    def cut(rows: DataFrame) -> DataFrame:
        return cut_lineage(gathered(rows, n, ROWS))

    both = edges.select("a", "b").union(edges.select("b", "a"))
    both = cut(both.distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")))
    total = None
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("near")).agg(F.min("label").alias("low"))
        seen = labels.join(near, F.col("node") == F.col("near"))
        hooked = seen.select("node", F.least("label", "low").alias("label")).union(seen.select("label", "low"))
        hooked = cut(hooked.groupBy("node").agg(F.min("label").alias("label")))
        roots = hooked.select(F.col("node").alias("root"), F.col("label").alias("above"))
        labels = cut(hooked.join(roots, F.col("label") == F.col("root")).select("node", F.col("above").alias("label")))
        last, total = total, labels.agg(F.sum(F.col("label").cast("decimal(38,0)")).alias("s")).first()["s"]
        if total == last:
            return labels
