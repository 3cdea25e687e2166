"""Expressions and staging shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from threadlens.session import scratch_path

SPACE = r" \x09-\x0D"  # inside a character class
WORD = rf"[^{SPACE}]+"


def text_of(name: str = "text") -> Column:
    """The text column with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def hash_sample(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """About `rows` rows picked by a hash of `keys`, or all where there are fewer: for fits, whose input is bounded.

    Rows are thinned where they lie, so a limit that follows gathers little in one task, however large the table.
    """
    n = df.count()
    if n <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit(rows), *keys), F.lit(1 << 30)) < int((1 << 30) * rows / n))


def gathered(df: DataFrame, rows: int, each: int) -> DataFrame:
    """`df` in at most one partition for every `each` of `rows` rows, two a core at least: for a result that is written.

    Partitions are put together where they lie, without a shuffle. Every file of a local or mounted folder costs a process
    that sets its permissions, so a few rows should not leave one file for each shuffle partition.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def staged(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: lineage ends there and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition) if partition else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
