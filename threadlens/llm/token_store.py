"""Token ids on disk: one binary file per range of documents, with Elias-Fano coded boundaries.

Rows are dealt by ranges of the id and sorted; each task encodes its range and emits records, which Spark's text writer
stores through its committer (a record is the only line of its kind, so the file is the record's bytes and a newline).
A record holds, little-endian and padded to 8 bytes each:

    magic, then int64: task, number within the task, documents n, ids u, bytes per id, low bits l, words of the low
    part, words of the high part
    document ids (int64), null marks (one bit each), low part, high part, select samples (uint32), token ids

The n rising boundaries (ends of the documents in the id array) take about n * (2 + log2(u / n)) bits: the low l bits of
each are packed, the high parts are marked in a bit vector in unary. `select` finds one boundary from a sampled position
without decoding the rest.

A record holds at most `RECORD_IDS` ids (or one document); a task holds one record at a time. Null text counts as empty.
Null ids come first; rows of one id are ordered by a hash of their text, and every row is stored once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from threadlens.llm.common import staged, text_of
from threadlens.llm.pretokens import encoder

MAGIC = b"IDSTORE1"
RECORD_IDS = 4_000_000
SAMPLE = 64  # every 64th set bit of the high part has its position stored
HEADER = 8


def _pad(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


class Boundaries:
    """Elias-Fano code of a rising sequence."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> Boundaries:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        values = values.astype(np.uint64)
        bits = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        marks = np.zeros(n + (top >> low_bits) + 1, np.uint8)
        marks[at] = 1
        return cls(n, low_bits, low, np.packbits(marks, bitorder="little"), at[::SAMPLE].astype("<u4"))

    def _low(self, i: int) -> int:
        bits = np.unpackbits(self.low[i * self.low_bits // 8 : ((i + 1) * self.low_bits + 7) // 8], bitorder="little")
        start = i * self.low_bits % 8
        return sum(int(b) << k for k, b in enumerate(bits[start : start + self.low_bits]))

    def select(self, i: int) -> int:
        """The i-th value."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        bits = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little")[at % 8 :]) + at
        while len(bits) <= left:
            left -= len(bits)
            byte += 1
            bits = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little")) + byte * 8
        return (int(bits[left]) - i) << self.low_bits | self._low(i)

    def decode(self) -> np.ndarray:
        """All values."""
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return (high.astype(np.int64) << self.low_bits) | low


def pack_record(task: int, number: int, doc_ids: list, ends: list[int], ids: bytes, width: int) -> bytes:
    code = Boundaries.encode(np.array(ends, np.int64))
    parts = [
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.packbits([d is None for d in doc_ids]).tobytes(),
        code.low.tobytes(),
        code.high.tobytes(),
        code.samples.tobytes(),
        ids,
    ]
    head = np.array([task, number, len(ends), len(ids) // width, width, code.low_bits, len(code.low), len(code.high)], "<i8")
    return MAGIC + head.tobytes() + b"".join(map(_pad, parts))


def unpack_records(content: bytes) -> Iterator[tuple[int, int, list, Boundaries, np.ndarray]]:
    """(task, number, document ids, boundaries, token ids) of each record of a file."""
    at = 0
    while at < len(content):
        if content[at : at + len(MAGIC)] != MAGIC:
            raise ValueError(f"no record at byte {at}")
        at += len(MAGIC)
        task, number, n, u, width, low_bits, low, high = np.frombuffer(content, "<i8", HEADER, at).tolist()
        at += 8 * HEADER

        def part(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, dtype, count, at)
            at += found.nbytes + -found.nbytes % 8
            return found

        doc_ids, nulls = part("<i8", n), part("u1", (n + 7) // 8)
        missing = np.unpackbits(nulls, count=n).tolist() if n else []
        code = Boundaries(n, low_bits, part("u1", low), part("u1", high), part("<u4", -(-n // SAMPLE)))
        ids = part(f"<u{width}", u)
        at += 1  # the writer's newline
        yield task, number, [None if m else d for d, m in zip(doc_ids.tolist(), missing)], code, ids


def _encode(path: str, end_id: int, record_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, "<u2")
        task, number, size = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], enc.dtype).tobytes()
        doc_ids: list = []
        ends: list[int] = []
        parts: list[bytes] = []

        def record() -> pa.RecordBatch:
            data = pack_record(task, number, doc_ids, ends, b"".join(parts), enc.width)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = enc.encode(text) + end
                n = len(data) // enc.width
                if ends and size + n > record_ids:
                    yield record()
                    number, size = number + 1, 0
                    for part in (doc_ids, ends, parts):
                        part.clear()
                size += n
                doc_ids.append(doc_id)
                ends.append(size)
                parts.append(data)
        if ends:
            yield record()

    return run


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", record_ids: int = RECORD_IDS) -> None:
    """Writes the ids of all rows, each document closed by `end_id`, in ascending order of the id. Ids must fit 16 bits."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    records = rows.mapInArrow(_encode(tokenizer, end_id, record_ids), "data binary")
    records.select(F.col("data").cast("string").alias("value")).write.text(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            for task, number, doc_ids, code, ids in unpack_records(memoryview(content.as_buffer()).tobytes()):
                ends = code.decode()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(ends)
                columns = [np.full(n, task), np.full(n, number), np.arange(n), starts, ends - starts, np.array(crcs, np.int64)]
                arrays = [pa.array(doc_ids, pa.int64()), *[pa.array(c.astype(np.int64)) for c in columns]]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "task", "number", "place", "start", "n_tokens", "crc"])


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, place) of every stored document; `start` counts all ids before it."""
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = "id bigint, task bigint, number bigint, place bigint, start bigint, n_tokens bigint, crc bigint"
    rows = staged(files.mapInArrow(_read, schema), "ids-read")
    # one row per record: far fewer than documents
    sizes = rows.groupBy("task", "number").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("task", "number").rowsBetween(W.unboundedPreceding, -1))
    shifts = sizes.select("task", "number", F.coalesce(before, F.lit(0)).alias("shift"))
    return rows.join(shifts, ["task", "number"]).select(
        "id", (F.col("start") + F.col("shift")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"), "place"
    )
