"""Micro-batch loading of a dump folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from threadlens.plans.workflow import load_batch
from threadlens.sources.items import stream_items
from threadlens.sources.tables import Tables


def ingest_stream(
    tables: Tables,
    path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    ingest_ts: dt.datetime | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Loads files as they arrive.

    Each micro-batch claims a load number under its checkpoint and batch, and finds it again when it is replayed after a
    failure: the load then replaces itself, and no other load is touched.
    """

    def load(batch: DataFrame, number: int) -> None:
        load_batch(tables, batch, tables.new_load(f"stream:{checkpoint}#{number}"), ingest_ts)

    writer = stream_items(tables.spark, path, files_per_batch).writeStream.foreachBatch(load)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
