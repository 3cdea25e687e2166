"""Ranking, prefix sums, joins and limits that hold when one key owns a large share of all rows.

A key is *hot* when it has more than `max_rows` rows. Cold groups take the ordinary one-shuffle window or join. Hot
groups are spread over many tasks: sorted by range and numbered per partition, cut into position blocks, or joined to a
broadcast of the few right-hand rows they need. N rows have fewer than N / max_rows hot keys, which bounds what is
broadcast: one row per million rows of input by default. No hot key is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from threadlens.session import cut_lineage

MAX_GROUP_ROWS = 1_000_000
MAX_LIMIT_ROWS = 10_000
BLOCK_ROWS = 500_000

_BEFORE = (W.unboundedPreceding, -1)
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> DataFrame | None:
    """The keys with more than `max_rows` rows as a frame, or None when there is none."""
    limit = MAX_GROUP_ROWS if max_rows is None else max_rows
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = cut_lineage(counts.filter(F.col("_n") > limit).select(*keys))
    return None if hot.isEmpty() else hot


def _same(keys: Sequence[str], left: DataFrame, right: DataFrame, prefix: str) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cold rows, hot rows); the broadcast holds hot keys only."""
    marks = F.broadcast(hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys]))
    on = _same(keys, df, marks, "_h_")
    return df.join(marks, on, "left_anti"), df.join(marks, on, "left_semi")


def _numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-sorted rows with partition `_pid` and row number `_idx`; the checkpoint pins the range bounds."""
    df = cut_lineage(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    return df.withColumns(
        {"_pid": F.shiftright("_mid", _ROW_BITS), "_idx": F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}
    ).drop("_mid")


def _rank_by_range(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    rows = _numbered(df, [*map(F.col, group), *order])
    runs = rows.groupBy("_pid", *group).agg(F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(W.partitionBy(*group).orderBy("_pid").rowsBetween(*_BEFORE))
    # one row per partition and hot key met there: at most partitions + hot keys rows
    shifts = F.broadcast(
        runs.select(
            F.col("_pid").alias("_r__pid"),
            *[F.col(g).alias(f"_r_{g}") for g in group],
            (F.coalesce(earlier, F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        )
    )
    out = rows.join(shifts, _same(["_pid", *group], rows, shifts, "_r_"))
    return out.select(*df.columns, (F.col("_idx") + F.col("_shift")).alias(name))


def rank_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rank", max_rows: int | None = None
) -> DataFrame:
    """Row number (bigint, from 1) within each group; `order` must be total within a group."""
    hot = hot_keys(df, group, max_rows)
    window = F.row_number().over(W.partitionBy(*group).orderBy(*order)).cast("bigint")
    if hot is None:
        return df.withColumn(name, window)
    cold, big = split_hot(df, group, hot)
    return cold.withColumn(name, window).unionByName(_rank_by_range(big, group, order, name))


def running(
    df: DataFrame,
    group: Sequence[str],
    pos: str,
    aggs: dict[str, tuple],
    ties: Sequence[str] = (),
    inclusive: bool = True,
    block: int | None = None,
) -> DataFrame:
    """Running aggregates `{name: (F.sum or F.max, column)}` per group along the whole-number position `pos`.

    With `block`, each group is cut into blocks of that many positions: block totals are carried forward, and the window
    only ever covers one block. Without it, one window per group does, which suits groups known to be cold.
    """
    frame = (W.unboundedPreceding, W.currentRow if inclusive else -1)
    if block is None:
        whole = W.partitionBy(*group).orderBy(pos, *ties).rowsBetween(*frame)
        out = {n: fn(col).over(whole) for n, (fn, col) in aggs.items()}
        return df.withColumns({n: F.coalesce(c, F.lit(0)) if aggs[n][0] is F.sum else c for n, c in out.items()})
    rows = df.withColumn("_b", F.floor(F.col(pos) / F.lit(block)))
    totals = rows.groupBy(*group, "_b").agg(*[fn(col).alias(f"_t_{n}") for n, (fn, col) in aggs.items()])
    earlier = W.partitionBy(*group).orderBy("_b").rowsBetween(*_BEFORE)
    carried = totals.select(
        *[F.col(k).alias(f"_c_{k}") for k in [*group, "_b"]],
        *[fn(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, (fn, _) in aggs.items()],
    )
    inner = W.partitionBy(*group, "_b").orderBy(pos, *ties).rowsBetween(*frame)
    rows = rows.withColumns({f"_i_{n}": fn(col).over(inner) for n, (fn, col) in aggs.items()})
    on = reduce(and_, [rows[k] == carried[f"_c_{k}"] for k in [*group, "_b"]])

    def both(name: str, fn) -> Column:
        parts = [F.col(f"_c_{name}"), F.col(f"_i_{name}")]
        return F.greatest(*parts) if fn is F.max else sum((F.coalesce(x, F.lit(0)) for x in parts), F.lit(0))

    return rows.join(carried.hint("merge"), on, "left").select(*df.columns, *[both(n, fn).alias(n) for n, (fn, _) in aggs.items()])


def join_hot(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hot: DataFrame | None) -> DataFrame:
    """Join to a right side that is unique on `keys`; `hot` holds the hot keys of the left side, if any.

    Right rows of hot keys, one per key, are broadcast; all others use the ordinary join.
    """
    keys = list(keys)
    if hot is None:
        return left.join(right, keys, how)
    cold, big = split_hot(left, keys, hot)
    few = F.broadcast(right.join(F.broadcast(hot), keys, "left_semi"))
    return cold.join(right, keys, how).unionByName(big.join(few, keys, how))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_rows: int | None = None,
    left_rows: int | None = None,
) -> DataFrame:
    """`join_hot` with the hot keys of `left` looked up first, unless its known row count rules them out."""
    limit = MAX_GROUP_ROWS if max_rows is None else max_rows
    none_hot = left_rows is not None and left_rows <= limit
    return join_hot(left, right, keys, how, None if none_hot else hot_keys(left, keys, limit))


def sorted_by(order: Sequence[tuple[str, str]]) -> list[Column]:
    """Sort columns of (name, "asc" or "desc") pairs."""
    return [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order]


def _nth(df: DataFrame, n: int, order: Sequence[tuple[str, str]]):
    """The n-th row of a slim frame by global position, or None when there are fewer."""
    rows = _numbered(df, sorted_by(order))
    sizes = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition
    starts = sizes.select(
        F.col("_pid").alias("_s_pid"),
        F.coalesce(F.sum("_n").over(W.orderBy("_pid").rowsBetween(*_BEFORE)), F.lit(0)).alias("_start"),
    )
    at = rows.join(F.broadcast(starts), F.col("_pid") == F.col("_s_pid"))
    return at.filter(F.col("_start") + F.col("_idx") == n - 1).select(*df.columns).first()


def top_n(df: DataFrame, n: int, order: Sequence[tuple[str, str]]) -> DataFrame:
    """First `n` rows by `order`, which must be total, in that order.

    A small `n` merges candidates. For a large one that merge would fill a single task, so only the sort columns are
    range-sorted to find the n-th row, the table is filtered against it where it lies, and what is left is range-sorted.
    """
    if n <= MAX_LIMIT_ROWS:
        return df.orderBy(*sorted_by(order)).limit(n)
    times = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    exact = {c: F.unix_micros(c) if c in times else F.col(c) for c, _ in order}
    last = _nth(df.select(*[e.alias(c) for c, e in exact.items()]), n, order)
    if last is None:
        return df.orderBy(*sorted_by(order))
    keep = F.lit(True)
    for name, way in reversed(order):
        col, value = exact[name], last[name]
        if way == "desc":  # NULL sorts last
            before = col.isNotNull() if value is None else F.coalesce(col > value, F.lit(False))
        else:  # NULL sorts first
            before = F.lit(False) if value is None else col.isNull() | F.coalesce(col < value, F.lit(False))
        keep = before | (col.eqNullSafe(F.lit(value)) & keep)
    return df.filter(keep).orderBy(*sorted_by(order))
