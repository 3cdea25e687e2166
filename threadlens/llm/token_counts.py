"""Token counts per document with a two-tier look-up and no shuffle of pre-tokens.

`frequent_lengths` makes the first tier: every task counts the pre-tokens of its documents in a bounded table and hands
on its most frequent ones; their sums give the `TABLE_SIZE` most frequent of the corpus, whose token counts are broadcast
(a bounded table, whatever the corpus). The second tier is a cache in each Python worker, filled by the library for
pre-tokens the table lacks. Counts never depend on what the tiers hold: they equal the library's.

Null text counts as empty (no bytes, no tokens). Ids may repeat or be null: one row comes out per row that goes in.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadlens.llm.common import text_of
from threadlens.llm.pretokens import encoder, worker_state

TABLE_SIZE = 65_536
TASK_KEYS = 400_000  # pre-tokens a task counts before it forgets the rare ones
TASK_TOP = 16_384  # pre-tokens a task hands on
CACHE_SIZE = 400_000


def _task_top(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(path), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for segment in enc.segments(text)[::2]:
                    seen.update(enc.pretokens(segment) or ())
                if len(seen) > TASK_KEYS:
                    seen = Counter(dict(seen.most_common(TASK_KEYS // 4)))
        top = seen.most_common(TASK_TOP)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["pretoken", "n"])

    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", size: int = TABLE_SIZE) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens."""
    tops = docs.select(text_of(text_col)).mapInArrow(_task_top(path), "pretoken string, n bigint")
    rows = tops.groupBy("pretoken").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pretoken").limit(size).collect()
    words, enc = [r["pretoken"] for r in rows], encoder(path)
    return {w: len(x) // enc.width for w, x in zip(words, enc.fresh(words))} if words else {}


def _count(path: str, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, frequent = encoder(path), table.value
        cache: dict[str, int] = worker_state().setdefault(("lengths", path), {})

        def tokens(text: str) -> int:
            total = 0
            for i, segment in enumerate(enc.segments(text)):
                if i % 2:
                    total += 1
                    continue
                words = enc.pretokens(segment)
                if words is None:
                    total += len(enc.whole(segment)) // enc.width
                    continue
                known = list(map(frequent.get, words))
                if None in known:
                    rare = [w for w, n in zip(words, known) if n is None]
                    new = list({w for w in rare if w not in cache})
                    if len(cache) + len(new) > CACHE_SIZE:
                        cache.clear()
                        new = list(set(rare))
                    if new:
                        cache.update(zip(new, (len(x) // enc.width for x in enc.fresh(new))))
                    total += sum(map(cache.__getitem__, rare))
                    known = [n for n in known if n is not None]
                total += sum(known)
            return total

        for batch in batches:
            counts = pa.array([tokens(t) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], ["id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row by the tokenizer file at `path`."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text_col))
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("bigint"), F.octet_length(text).cast("bigint"), text)
    counted = rows.mapInArrow(_count(path, table), "id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumnRenamed("id", id_col)
