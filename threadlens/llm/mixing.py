"""Mixes sources to target weights by capped water-filling.

Every source gets the same level times its weight, but no more than `max_epochs` times its size; what a capped source
cannot take raises the level of the others. One pass over the documents sums sizes by source and seeded bucket; the level
and the targets come from that small table by one-row aggregates, one per round of clamping.

A source's target is taken as whole repetitions of all its documents and a fraction of one more: documents in the lower
seeded buckets give a whole extra copy, those in the bucket where the target falls give a seeded part of themselves. So
the words taken meet the target to within the rounding of that one bucket, no document exceeds its whole repetitions by
more than one, and the choice depends on nothing but the seed, the id and the sums: reruns agree. No row is ranked and no
document moves: the plan (one row per source) is joined where the rows lie.

Null text has no words; null is a source of its own and comes last. Rows without words take no part (taken 0). Rows equal
in id share a bucket. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from threadlens.llm.common import SPACE, count_words, staged, text_of
from threadlens.plans.skew import rank_in_group

BUCKETS = 4096
SEED = 17
BROADCAST_SOURCES = 50_000  # a plan of more sources is joined by a shuffle


def _seeded(id_col: str, seed: int, salt: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(salt), F.col(id_col))


def level(sources: DataFrame, total: float) -> float:
    """The water level: sum of least(cap, level * weight) over (cap, weight) rows equals `total`, or infinity."""
    low = 0.0
    while True:
        capped = F.col("cap") <= F.col("weight") * F.lit(low)
        row = sources.agg(
            F.sum(F.when(capped, F.col("cap"))).alias("cap"), F.sum(F.when(~capped, F.col("weight"))).alias("weight")
        ).first()
        if not row["weight"]:
            return math.inf
        high = (total - (row["cap"] or 0)) / row["weight"]
        if high <= low:
            return low
        low = high


def plan(sized: DataFrame, weights: Sequence[int], share: float, max_epochs: int, seed: int = SEED) -> tuple[DataFrame, int]:
    """(source, source_size, target, whole, cut, part) per source, and the number of sources.

    `sized` has `_m_source`, `_m_size`, `_m_bucket`. A document is repeated `whole` times, once more if its bucket is below
    `cut`, and by the share `part` of itself if its bucket is `cut`.
    """
    buckets = staged(sized.groupBy("_m_source", "_m_bucket").agg(F.sum("_m_size").alias("n")), "mix-buckets")
    sums = buckets.groupBy("_m_source").agg(F.sum("n").alias("source_size")).withColumn("_g", F.lit(0))
    ranked = rank_in_group(sums, ["_g"], [F.col("_m_source").asc_nulls_last()], "place")
    cycle = F.array(*map(F.lit, weights))
    sources = ranked.select(
        "_m_source", "source_size", F.get(cycle, ((F.col("place") - 1) % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"),
    )
    sources = staged(sources, "mix-sources")
    total = sources.agg(F.sum("source_size").alias("n"), F.count(F.lit(1)).alias("k")).first()
    height = level(sources, share * (total["n"] or 0))
    reach = F.col("cap").cast("double") if math.isinf(height) else F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(height))
    targets = sources.withColumn("target", reach)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    targets = targets.withColumn("whole", whole).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    # at most BUCKETS rows of a source
    upto = F.sum("n").over(W.partitionBy("_m_source").orderBy("_m_bucket").rowsBetween(W.unboundedPreceding, W.currentRow))
    sums_upto = buckets.withColumn("upto", upto).withColumnRenamed("_m_source", "_b_source")
    at = targets.join(sums_upto, F.col("_m_source").eqNullSafe(F.col("_b_source")))
    crossed = F.when(F.col("upto") > F.col("left"), F.struct("_m_bucket", ((F.col("left") - F.col("upto") + F.col("n")) / F.greatest("n", F.lit(1))).alias("part")))
    plans = at.groupBy("_m_source", "source_size", "target", "whole").agg(F.min(crossed).alias("at"))
    plans = plans.select(
        F.col("_m_source").alias("_p_source"), F.col("source_size").alias("_p_size"), F.col("target").alias("_p_target"),
        F.col("whole").alias("_p_whole"), F.col("at._m_bucket").alias("_p_cut"), F.col("at.part").alias("_p_part"),
    )
    return staged(plans, "mix-plan"), total["k"]


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """All columns of `docs` with `_m_size`, `_p_size` and `_p_target` of the source, and `_m_taken`, the words taken."""
    rows = docs.withColumns(
        {
            "_m_size": count_words(text_of(text_col)),
            "_m_bucket": F.pmod(_seeded(id_col, seed, 0), F.lit(BUCKETS)),
            "_m_source": F.col(source_col),
        }
    )
    plans, n = plan(rows, weights, share, max_epochs, seed)
    plans = F.broadcast(plans) if n <= BROADCAST_SOURCES else plans
    rows = rows.join(plans, F.col("_m_source").eqNullSafe(F.col("_p_source")), "left")
    toss = F.pmod(_seeded(id_col, seed, 1), F.lit(1 << 30)) / F.lit(float(1 << 30))
    part = F.least(F.col("_m_size"), F.floor(F.col("_m_size") * F.col("_p_part") + toss))
    extra = F.when(F.col("_m_bucket") < F.col("_p_cut"), F.col("_m_size")).when(F.col("_m_bucket") == F.col("_p_cut"), part)
    taken = F.col("_p_whole") * F.col("_m_size") + F.coalesce(extra, F.lit(0))
    return rows.withColumn("_m_taken", taken.cast("bigint"))


def repeat(mixed: DataFrame, columns: Sequence[str], text_col: str = "text") -> DataFrame:
    """The mixed corpus: each document as often as taken, the last copy cut after the words that are left over."""
    whole = F.expr("_m_taken div greatest(_m_size, 1)")
    over = F.col("_m_taken") - whole * F.col("_m_size")
    copies = F.array_repeat(F.lit(-1).cast("bigint"), whole.cast("int"))
    copies = F.when(over > 0, F.array_append(copies, over)).otherwise(copies)
    rows = mixed.withColumn("_m_copy", F.explode(copies))
    words = F.concat(F.lit(rf"^(?:[{SPACE}]*+[^{SPACE}]++){{"), F.greatest("_m_copy", F.lit(1)), F.lit("}+"))
    start = F.call_function("regexp_extract", F.col(text_col), words, F.lit(0))
    cut = F.when(F.col("_m_copy") > 0, start).otherwise(F.col(text_col))
    return rows.select(*[cut.alias(c) if c == text_col else F.col(c) for c in columns])
