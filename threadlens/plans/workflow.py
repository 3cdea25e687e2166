"""The jobs a user runs: load, pair, enrich, re-clean, view and export stored tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from threadlens.operators import enrich, ingest as ing, maintain, qa, report
from threadlens.schemas import KEYS
from threadlens.sources.tables import Tables

ARRIVAL = ["batch_id", "created_utc"]


def load_batch(tables: Tables, items: DataFrame, batch_id: int, ingest_ts: dt.datetime | None = None) -> DataFrame:
    """Adds the new posts and comments of one load; running the same load again changes nothing. Returns the counts.

    The raw items are parsed once, into a staging folder of this run alone. The rows are kept apart until the load
    wins a slot of the commit log; before each try, rows whose keys a load committed since then holds are dropped, so
    loads beside each other store each key once.
    """
    now = F.lit(ingest_ts or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    staging = f"{tables.root}/_staging/{uuid.uuid4().hex}"
    items.write.mode("overwrite").parquet(staging, compression="zstd")
    items = tables.spark.read.schema(items.schema).parquet(staging)
    raw_posts, raw_comments = ing.split_items(items)
    good = {
        "posts": ing.normalize_posts(raw_posts, now, batch_id),
        "comments": ing.normalize_comments(raw_comments, now, batch_id),
    }
    seen = max([slot for slot, _, _ in tables.commits()], default=0)
    staged = {}
    for name, rows in good.items():
        stored = tables.read(name).filter(F.col("batch_id") != batch_id)
        staged[name] = _stage(tables, name, ing.insert_ignore(stored, rows, KEYS[name], ARRIVAL))
    staged["rejects"] = _stage(tables, "rejects", ing.reject_items(items, batch_id))
    while True:
        newer = [c for c in tables.commits(seen) if c[1] != batch_id]
        for name in good:
            if newer:
                rows = tables.spark.read.schema(tables.read(name).schema).parquet(staged[name]).withColumn("batch_id", F.lit(batch_id))
                taken = None
                for entry in newer:
                    keys = tables.committed_rows(name, entry).select(*KEYS[name])
                    taken = keys if taken is None else taken.unionByName(keys)
                staged[name] = _stage(tables, name, rows.join(taken, KEYS[name], "left_anti"))
        seen = max([seen, *[slot for slot, _, _ in newer]])
        if tables.try_commit(seen + 1, batch_id, staged):  # all slots up to `seen` are checked against
            break
    for name, path in staged.items():
        tables.publish(name, path, batch_id)
    tables._remove(staging)
    return ing.ingest_summary(*[tables.read(n).filter(F.col("batch_id") == batch_id) for n in ("posts", "comments")])


def _stage(tables: Tables, name: str, rows: DataFrame) -> str:
    path = tables.pending(name)
    rows.drop("batch_id").write.parquet(path, compression="zstd")
    return path


def ingest(tables: Tables, items: DataFrame, mode: str = "update", ingest_ts: dt.datetime | None = None) -> DataFrame:
    """`fresh` clears all tables first, rejects included; `update` adds what is new."""
    if mode not in ("fresh", "update"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "fresh":
        tables.clear()
        tables.forget_loads()
    return load_batch(tables, items, tables.new_load(f"items:{uuid.uuid4()}"), ingest_ts)


def generate_qa(tables: Tables, post_ids: Sequence[str] | None = None) -> DataFrame:
    """Replaces all pairs, even when only some posts are listed. Returns the run totals."""
    posts, comments = tables.read("posts"), tables.read("comments")
    tables.overwrite("qa_pairs", qa.generate_qa(posts, comments, post_ids))
    chosen = qa.posts_by_ids(posts, post_ids) if post_ids else posts
    return qa.qa_summary(chosen, tables.read("qa_pairs"))


def run_enrichment(tables: Tables) -> DataFrame:
    tables.overwrite("posts", enrich.enrich_posts(tables.read("posts")))
    tables.overwrite("comments", enrich.enrich_comments(tables.read("comments")))
    return enrich.enrich_summary(tables.read("posts"), tables.read("comments"))


def clean_stored(tables: Tables, force: bool = False) -> None:
    """Re-cleans all stored texts once, or again with `force`."""

    def clean_all() -> None:
        for name in maintain.TEXT_COLUMNS:
            tables.overwrite(name, maintain.reclean(tables.read(name), name).drop("changed"))

    meta = tables.read("db_metadata")
    if force or not maintain.flag_is_set(meta, maintain.CLEANED_FLAG):
        tables.overwrite("db_metadata", maintain.run_once(meta, maintain.CLEANED_FLAG, clean_all, force))


def view(tables: Tables, n: int = 3) -> dict[str, DataFrame]:
    names = ("posts", "comments", "qa_pairs")
    stored = {t: tables.read(t) for t in names}
    return {"statistics": report.statistics(**stored), **{t: report.previews(stored[t], t, n) for t in names}}


def export(tables: Tables, path: str, fmt: str = "csv", limit: int | None = None) -> DataFrame:
    """Writes the three sheets below `path`; `limit` keeps the latest comments and pairs only. Returns rows per sheet."""
    sheets = {}
    for name in ("posts", "comments", "qa_pairs"):
        sheets[name] = report.export_frame(tables.read(name), name, None if name == "posts" else limit, titles=fmt == "csv")
        report.write_export(sheets[name], f"{path.rstrip('/')}/{name}", fmt)
    return report.export_summary(**sheets)
