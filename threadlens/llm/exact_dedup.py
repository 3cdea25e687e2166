"""Exact deduplication by content sort.

Sampled splitters deal the rows by (start of the normalised text, its hash, id), so equal texts form one stretch of the
sorted order, which may run over several partitions: a text that a third of all rows share is spread over as many tasks
as its rows need. Spark's external sort brings equals together, and one pass over each partition compares neighbours on
their whole normalised bytes. Only the first and the last stretch of a partition can go on in another one; those few
(two per partition) are settled by a small join.

The splitters hold a prefix and a hash instead of whole texts because the driver keeps a sample of them; the comparison
itself reads every byte. Normalising lower-cases A-Z only. The sort key lower-cases all letters: texts equal under the
narrow rule are equal under the wide one, and the comparison tells the others apart.

Null text counts as empty. Among equal texts the largest id stays (null ids are smallest); rows equal in id and text
keep exactly one. An empty table gives an empty result. Columns whose names start with `_x_` are reserved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from threadlens.llm.common import staged, text_of

PREFIX_CHARS = 32
ROWS = "id bigint, sha string, keep bigint, n bigint, rank bigint, pid int, edge boolean"


def _sorted(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    low = F.lower(text_of(text_col))
    keyed = df.withColumns({"_x_start": F.left(low, F.lit(PREFIX_CHARS)), "_x_hash": F.xxhash64(low)})
    order = [F.col("_x_start"), F.col("_x_hash"), F.col(id_col).desc_nulls_last()]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order)


def _member_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with its place among the equals met in this partition.

    Ids of the stretch at hand are buffered until it ends; texts are not.
    """
    pid = TaskContext.get().partitionId()
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    names = ["id", "sha", "keep", "n", "rank", "pid", "edge"]
    first: int | None = None
    current: int | None = None
    groups: dict[bytes, list] = {}
    out: list[tuple] = []

    def flush(edge: bool) -> None:
        for norm, ids in groups.items():
            sha = hashlib.sha256(norm).hexdigest()
            out.extend((i, sha, ids[0], len(ids), r, pid, edge) for r, i in enumerate(ids))
        groups.clear()

    def table() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        out.clear()
        return made

    for batch in batches:
        for row_id, text, key in zip(*(c.to_pylist() for c in batch.columns)):
            if first is None:
                first = current = key
            if key != current:
                flush(current == first)
                current = key
            groups.setdefault(text.lower(), []).append(row_id)  # bytes.lower() touches A-Z only
        if len(out) >= 10_000:
            yield table()
    flush(True)
    if out:
        yield table()


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = _sorted(slim, "id", "text").select("id", text_of().cast("binary").alias("text"), "_x_hash")
    found = staged(rows.mapInArrow(_member_rows, ROWS), "exact-rows")
    # two stretches per partition (and more only where 64-bit hashes collide)
    ends = (
        found.filter(F.col("edge") & (F.col("rank") == 0))
        .groupBy(F.col("sha").alias("_sha"))
        .agg(F.max("keep").alias("_keep"), F.sum("n").alias("_n"), F.min("pid").alias("_pid"))
    )
    joined = found.join(F.broadcast(ends), F.col("edge") & (F.col("sha") == F.col("_sha")), "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("_keep", "keep").alias("keep_id"),
        F.coalesce("_n", "n").alias("group_size"),
        ((F.col("rank") == 0) & (F.col("pid") == F.coalesce("_pid", "pid"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _heads(schema: list[str]):
    """Whole rows that open a stretch of equals in their partition, with the digest and the partition."""
    text_at, key_at = len(schema), len(schema) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        first = current = None
        seen: set[bytes] = set()
        for batch in batches:
            picked, shas, firsts = [], [], []
            for at, (text, key) in enumerate(zip(batch.column(text_at).to_pylist(), batch.column(key_at).to_pylist())):
                if first is None:
                    first = key
                if key != current:
                    current = key
                    seen.clear()
                norm = text.lower()
                if norm not in seen:
                    seen.add(norm)
                    picked.append(at)
                    shas.append(hashlib.sha256(norm).hexdigest())
                    firsts.append(key == first)
            rows = batch.take(pa.array(picked, pa.int64()))
            columns = [rows.column(i) for i in range(text_at)]
            columns += [pa.array(shas, pa.string()), pa.array([pid] * len(picked), pa.int32()), pa.array(firsts, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    return run


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    extra = [T.StructField("sha", T.StringType()), T.StructField("pid", T.IntegerType()), T.StructField("first", T.BooleanType())]
    n = len(fields)
    plain = docs.toDF(*[f"c{i}" for i in range(n)])
    key, body = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    rows = _sorted(plain, key, body).select(*plain.columns, text_of(body).cast("binary").alias("_x_text"), "_x_hash")
    schema = T.StructType([*fields, *[T.StructField(f"c{n + i}", f.dataType) for i, f in enumerate(extra)]])
    heads = staged(rows.mapInArrow(_heads([f.name for f in fields]), schema), "exact-heads")
    sha, pid, first = (f"c{n + i}" for i in range(3))
    # a stretch that opens a partition may have begun in an earlier one: one such text per partition
    openers = heads.filter(first).select(F.col(sha).alias("_sha")).distinct()
    earliest = (
        heads.select(sha, pid).join(F.broadcast(openers), F.col(sha) == F.col("_sha")).groupBy("_sha").agg(F.min(pid).alias("_pid"))
    )
    kept = heads.join(F.broadcast(earliest), F.col(first) & (F.col(sha) == F.col("_sha")), "left")
    kept = kept.filter(F.col("_pid").isNull() | (F.col(pid) == F.col("_pid")))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
