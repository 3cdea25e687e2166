"""Table maintenance: evolution, re-cleaning, run-once flags, keyed updates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from threadlens.functions import text as tx

CLEANED_FLAG = "html_cleaned_v1"

# Text columns re-cleaned per table; `True` also cuts the submission tagline.
TEXT_COLUMNS = {
    "posts": {"title": False, "body": True},
    "comments": {"body": False},
    "qa_pairs": {"question": False, "answer": False},
}


def ensure_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Adds each absent column with its default; present ones stay untouched."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def reclean(df: DataFrame, table: str) -> DataFrame:
    """Texts cleaned once more, plus `changed`. Each pass removes one layer of escaping, so it is not idempotent."""
    columns = TEXT_COLUMNS[table]
    clean = {c: tx.clean_post_text(F.col(c)) if cut else tx.clean_comment_text(F.col(c)) for c, cut in columns.items()}
    out = df.withColumns({f"_new_{c}": e for c, e in clean.items()})
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    out = out.withColumn("changed", changed)
    return out.withColumns({c: F.col(f"_new_{c}") for c in columns}).drop(*[f"_new_{c}" for c in columns])


def upsert(meta: DataFrame, rows: DataFrame, keys: Sequence[str] = ("key",)) -> DataFrame:
    """Insert or replace by key."""
    return meta.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows)


def flag_is_set(meta: DataFrame, key: str) -> bool:
    return not meta.filter((F.col("key") == key) & (F.col("value") == "true")).isEmpty()


def run_once(meta: DataFrame, key: str, fn: Callable[[], object], force: bool = False) -> DataFrame:
    """Calls `fn` unless the flag is set, and returns the metadata with the flag set."""
    if not force and flag_is_set(meta, key):
        return meta
    fn()
    return upsert(meta, meta.sparkSession.createDataFrame([(key, "true")], meta.schema))


def apply_enrichment(table: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Columns of `updates` (unique on `key`) overwrite those of `table` where the key matches."""
    cols = [c for c in updates.columns if c != key]
    marked = updates.select(key, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_hit"))
    joined = table.join(marked, key, "left")
    return joined.select(
        *[F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in table.columns]
    )
