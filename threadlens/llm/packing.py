"""Packs token sequences with minimum bin slack.

A document longer than a window is cut at multiples of the window, so its full pieces fill sequences of their own. What
remains of each document is shorter than a window. The counts of those lengths, at most `window - 1` numbers however many
documents there are, go to the driver, where `plan` fills one window after another: the longest remaining piece goes in,
then a subset-sum dynamic program over a bit set (one bit per fill level) finds the multiset of remaining lengths that
comes closest to the window, and backtracking gives the count of each length. A multiset is used as often as the counts
allow, so the number of programs run depends on the lengths, not on the documents.

The plan says which ranks of a length go where. Ranks are dealt by `rank_in_group`, which spreads a length that many
documents share over many tasks; the plan is joined as a broadcast (at most a few rows per length and multiset).

Null text counts as empty: such a document is its end id alone. Ids may repeat or be null; each row is packed once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from threadlens.llm.common import staged, text_of
from threadlens.llm.pretokens import encoder
from threadlens.plans.skew import rank_in_group

WINDOW = 4096
PIECES = "id bigint, start bigint, length bigint, crc bigint, doc_tokens bigint, task bigint, k bigint"
PLAN = "p_length bigint, p_from bigint, p_to bigint, p_sequence bigint, p_copies bigint, p_offset bigint"


class Fill(NamedTuple):
    times: int
    copies: dict[int, int]  # length -> pieces of it in one sequence, longest first


def _closest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset of lengths whose sum comes closest to `room` without passing it.

    `lengths` are the available ones, longest first. Bit s of a level is set when the sum s can be reached.
    """
    full, mask = 1 << room, (1 << (room + 1)) - 1
    levels, steps, reach = [], [], 1
    for length in lengths:
        if length > room:
            continue
        left, chunk = min(counts[length], room // length), 1
        while left and not reach & full:
            take = min(chunk, left)
            levels.append(reach)
            steps.append((length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            chunk *= 2
        if reach & full:
            break
    at, chosen = reach.bit_length() - 1, {}
    for (length, take), before in zip(reversed(steps), reversed(levels)):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= length * take
    return chosen


def plan(counts: dict[int, int], window: int = WINDOW) -> list[Fill]:
    """Fills that use up all lengths (each from 1 to window - 1)."""
    counts = dict(counts)
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    fills = []
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        rest = [n for n in lengths if counts[n]] if not counts[longest] else lengths
        chosen = _closest(counts, rest, window - longest)
        counts[longest] += 1
        copies = {longest: 1}
        for length, n in chosen.items():
            copies[length] = copies.get(length, 0) + n
        times = min(counts[length] // n for length, n in copies.items())
        for length, n in copies.items():
            counts[length] -= n * times
        fills.append(Fill(times, dict(sorted(copies.items(), reverse=True))))
        lengths = [n for n in lengths if counts[n]]
    return fills


def _rows(fills: list[Fill]) -> tuple[list[tuple], int]:
    """Rows of PLAN, and the number of sequences."""
    rows, used, sequence = [], {}, 0
    for times, copies in fills:
        offset = 0
        for length, n in copies.items():
            start = used.get(length, 0)
            used[length] = start + n * times
            rows.append((length, start, used[length], sequence, n, offset))
            offset += length * n
        sequence += times
    return rows, sequence


def _cut(path: str, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, full = encoder(path, "<u4"), TaskContext.get().partitionId(), 0
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memoryview(enc.encode(text) + end)
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    full += length == window
                    row = (doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, task, full)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], [x.split()[0] for x in PIECES.split(", ")])

    return run


def pack(docs: DataFrame, path: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    rows = docs.select(F.col(id_col).cast("bigint"), text_of(text_col))
    pieces = staged(rows.mapInArrow(_cut(path, end_id, window), PIECES), "pack-pieces")
    short = pieces.filter(F.col("length") < window)
    counts = {r["length"]: r["n"] for r in short.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    fills, sequences = _rows(plan(counts, window))
    places = F.broadcast(docs.sparkSession.createDataFrame(fills, PLAN))

    ranked = rank_in_group(short, ["length"], [F.col(c) for c in ("id", "start", "crc", "doc_tokens", "task")], "rank")
    place = F.col("rank") - 1
    put = ranked.join(places, (F.col("length") == F.col("p_length")) & (place >= F.col("p_from")) & (place < F.col("p_to")))
    nth = place - F.col("p_from")
    put = put.withColumns(
        {
            "sequence_id": F.col("p_sequence") + F.expr("(rank - 1 - p_from) div p_copies"),
            "offset": F.col("p_offset") + F.pmod(nth, F.col("p_copies")) * F.col("length"),
        }
    )

    full = pieces.filter(F.col("length") == window)
    # one row per task that wrote pieces
    before = F.sum("n").over(W.orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    shifts = full.groupBy("task").agg(F.count(F.lit(1)).alias("n")).select(F.col("task").alias("s_task"), F.coalesce(before, F.lit(0)).alias("s"))
    whole = full.join(F.broadcast(shifts), F.col("task") == F.col("s_task"))
    whole = whole.withColumns({"sequence_id": F.lit(sequences) + F.col("s") + F.col("k") - 1, "offset": F.lit(0).cast("bigint")})

    columns = [F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    return put.select(*columns).unionByName(whole.select(*columns))
