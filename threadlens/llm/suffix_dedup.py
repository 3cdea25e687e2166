"""Removes every byte covered by a 200-byte string that occurs elsewhere, by sparse suffix arrays in logarithmic levels.

*Anchors.* Of the 32-byte seeds inside a window of 200 bytes, the one with the smallest hash is the window's anchor.
Equal windows have equal anchors at equal places, so only suffixes that start at anchors need comparing: about one in 85.
An entry is an anchor with the stretch of windows that it serves: seed hash, hash of the whole stretch, document, place.

*Whole stretches.* Seeds that occur once cannot be part of a match; a count with map-side combining rules them out. Among
the rest, a stretch that occurs twice is a match as a whole. Copies meet only as one row per distinct stretch.

*Levels.* What remains are stretches that share a seed but differ: the ends of matches. Their bytes are dealt by seed.
In a task every arriving batch gets an array of its windows in sorted order, is scanned against the existing levels for
equal windows, and becomes a level; levels of like size merge, so an entry is merged a logarithmic number of times. The
order is that of two independent 64-bit hashes of the 200 bytes, which serves as well as the bytes' own order when only
equality over the full length counts. A seed with more than `MAX_STRETCHES` distinct stretches is not dealt to one task:
its windows are counted by hash instead, with map-side combining.

Matches never cross documents; strings are judged on the input. Rows are told apart by id and text hash, so rows equal in
both are copies of each other. Null text counts as empty; texts below 200 bytes lose nothing. Text travels compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadlens.llm.common import staged, text_of
from threadlens.llm.pretokens import worker_state

LENGTH = 200
SEED_BYTES = 32
SEEDS = LENGTH - SEED_BYTES + 1  # seeds in a window
PLACE_BITS = 20
CHUNK = (1 << PLACE_BITS) - 2 * LENGTH  # windows handled at once
MAX_STRETCHES = 50_000
FLUSH_WINDOWS = 2_000_000
U = np.uint64
MIX = (U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB))  # odd multipliers of a common mixer


class Rolling:
    """Hashes of any stretch of a byte array from running sums, modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, np.uint64) * U(2) + U(1)
        self.base = int(rng.integers(0, 1 << 62)) * 4 + 3
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(2 * len(self.powers), n + 1)
            both = []
            for base in (self.base, pow(self.base, -1, 1 << 64)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                both.append(np.multiply.accumulate(steps))
            self.powers, self.inverse = both

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverse[start])

    def each(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Of every stretch of that width."""
        n = len(sums) - width
        return mixed((sums[width:] - sums[:n]) * self.inverse[:n])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX[1]
    x = (x ^ (x >> U(27))) * MIX[2]
    return x ^ (x >> U(31))


def rolling(seed: int) -> Rolling:
    return worker_state().setdefault(("rolling", seed), Rolling(seed))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by running minima inside blocks from either side."""
    n = len(x)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def entries(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first window, last window, seed hash, stretch hash) of each anchor, in chunks."""
    roll = rolling(1)
    low = U((1 << PLACE_BITS) - 1)
    for start in range(0, len(data) - LENGTH + 1, CHUNK):
        part = data[start : start + CHUNK + LENGTH - 1]
        sums = roll.sums(part)
        seeds = roll.each(sums, SEED_BYTES)
        at = (sliding_min((seeds & ~low) | np.arange(len(seeds), dtype=np.uint64), SEEDS) & low).astype(np.int64)
        first = np.append(0, np.flatnonzero(at[1:] != at[:-1]) + 1)
        last = np.append(first[1:] - 1, len(at) - 1)
        place = at[first]
        shape = ((place - first).astype(np.uint64) << U(16)) | (last - first).astype(np.uint64)
        whole = mixed(roll.between(sums, first, last + LENGTH) + (shape + U(1)) * MIX[0])
        yield first + start, last + start, seeds[place], whole


def _bytes(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer() or b"", np.uint8)


def _as_signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _find_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "h", "at", "seed", "whole"]
    for batch in batches:
        rows: list[list[np.ndarray]] = [[], [], [], []]  # row of the batch, at, seed, whole
        size = 0
        for row in range(batch.num_rows):
            for first, last, seed, whole in entries(_bytes(batch.column(2)[row])):
                for column, values in zip(rows, (np.full(len(first), row), first << 8 | (last - first), seed, whole)):
                    column.append(values)
                size += len(first)
        if size:
            of, at, seed, whole = (np.concatenate(c) for c in rows)
            of = pa.array(of)
            columns = [batch.column(0).take(of), batch.column(1).take(of), _as_signed(at), _as_signed(seed), _as_signed(whole)]
            yield pa.RecordBatch.from_arrays(columns, names)


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(3).compress
    for batch in batches:
        packed = pa.array([press(t) for t in batch.column(2).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["id", "h", "packed"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked stretches of each document."""
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for row_id, h, packed, asked in zip(*(c.to_pylist() for c in batch.columns)):
            text = expand(packed)
            for x in asked:
                first, extra = x["at"] >> 8, x["at"] & 255
                for column, value in zip(out, (x["seed"], x["alone"], row_id, h, first, text[first : first + extra + LENGTH])):
                    column.append(value)
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["seed", "alone", "id", "h", "first", "data"])


class Stretches:
    """The windows of a batch of stretches: hashes, stretch number and place."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch
        values = batch.column(5).to_pylist()
        sizes = np.array([len(v) for v in values], np.int64)
        counts = sizes - LENGTH + 1
        data = np.frombuffer(b"".join(values), np.uint8)
        self.of = np.repeat(np.arange(len(values)), counts)
        self.place = np.arange(len(self.of)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = np.repeat(np.cumsum(sizes) - sizes, counts) + self.place
        self.keys = []
        for seed in (1, 2):
            roll = rolling(seed)
            self.keys.append(roll.between(roll.sums(data), start, start + LENGTH))

    def spans(self, match: np.ndarray) -> pa.RecordBatch:
        """Runs of matching windows of the stretches that occur once."""
        alone = np.array(self.batch.column(1).to_pylist(), bool)
        at = np.flatnonzero(match & alone[self.of])
        if len(at):
            new = np.append(True, (at[1:] != at[:-1] + 1) | (self.of[at[1:]] != self.of[at[:-1]]))
            begin = at[new]
            end = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
        else:
            begin = end = at
        first = np.array(self.batch.column(4).to_pylist(), np.int64)[self.of[begin]]
        of = pa.array(self.of[begin])
        columns = [self.batch.column(2).take(of), self.batch.column(3).take(of), pa.array(first + self.place[begin]), pa.array(first + self.place[end] + LENGTH)]
        return pa.RecordBatch.from_arrays(columns, ["id", "h", "start", "stop"])


class Levels:
    """Sorted arrays of windows whose sizes grow geometrically; a new one is scanned against all and merged with its like."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # key, second key, window number
        self.parts: list[tuple[Stretches, int]] = []
        self.match = np.zeros(0, bool)

    @property
    def size(self) -> int:
        return len(self.match)

    def add(self, batch: pa.RecordBatch) -> None:
        if not batch.num_rows:
            return
        part, base = Stretches(batch), self.size
        self.parts.append((part, base))
        self.match = np.append(self.match, np.zeros(len(part.of), bool))
        order = np.lexsort((part.keys[1], part.keys[0]))
        new = (part.keys[0][order], part.keys[1][order], order + base)
        equal = np.flatnonzero((new[0][1:] == new[0][:-1]) & (new[1][1:] == new[1][:-1]))
        self.match[new[2][equal]] = self.match[new[2][equal + 1]] = True
        for level in self.levels:
            self._scan(new, level)
        while self.levels and len(self.levels[-1][0]) <= 2 * len(new[0]):
            new = self._merge(self.levels.pop(), new)
        self.levels.append(new)

    def _scan(self, new: tuple, level: tuple) -> None:
        """Marks equal windows of both. A level's equals among themselves are marked already, so its first one will do."""
        at = np.searchsorted(level[0], new[0])
        at[at == len(level[0])] = 0
        same = np.flatnonzero((level[0][at] == new[0]) & (level[1][at] == new[1]))
        self.match[new[2][same]] = self.match[level[2][at[same]]] = True

    @staticmethod
    def _merge(a: tuple, b: tuple) -> tuple:
        order = np.argsort(np.concatenate([a[0], b[0]]), kind="stable")  # two sorted runs
        return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b))

    def finish(self) -> Iterator[pa.RecordBatch]:
        for part, base in self.parts:
            yield part.spans(self.match[base : base + len(part.of)])


def _level_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans found among the stretches of a partition, which come sorted by seed."""
    levels, last = Levels(), None
    for batch in batches:
        if not batch.num_rows:
            continue
        seeds = batch.column(0).to_numpy()
        if levels.size > FLUSH_WINDOWS:
            same = int(np.argmax(seeds != last)) if (seeds != last).any() else len(seeds)
            levels.add(batch.slice(0, same))
            batch, seeds = batch.slice(same), seeds[same:]
            if batch.num_rows:
                yield from levels.finish()
                levels = Levels()
        if batch.num_rows:
            levels.add(batch)
            last = seeds[-1]
    yield from levels.finish()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of each stretch by its hashes."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = Stretches(batch.slice(at, 1000))
            of = pa.array(part.of)
            first = np.array(part.batch.column(4).to_pylist(), np.int64)[part.of] + part.place
            columns = [*map(_as_signed, part.keys), *[part.batch.column(i).take(of) for i in (1, 2, 3)], pa.array(first)]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "alone", "id", "h", "start"])


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_stretches: int = MAX_STRETCHES) -> DataFrame:
    """(id, h, start, stop): stretches of bytes to remove, which may overlap; h is the hash of the text."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))
    found = staged(rows.mapInArrow(_find_entries, "id bigint, h bigint, at bigint, seed bigint, whole bigint"), "suffix-entries")
    often = found.groupBy("seed").count().filter(F.col("count") > 1).select("seed")
    shared = staged(found.join(often, "seed", "left_semi"), "suffix-shared")

    place = F.struct("id", "h", "at")
    kinds = shared.groupBy("seed", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one"))
    kinds = staged(kinds, "suffix-kinds")
    twice = kinds.filter("n > 1").select("seed", "whole")
    first = F.shiftright("at", 8)
    full = shared.join(twice, ["seed", "whole"], "left_semi").select(
        "id", "h", first.alias("start"), (first + F.col("at").bitwiseAND(F.lit(255)) + LENGTH).alias("stop")
    )

    mixed_seeds = kinds.groupBy("seed").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).filter("k > 1 and least = 1")
    asked = kinds.join(mixed_seeds.select("seed", "k"), "seed").select(
        "one.id", "one.h", F.struct("seed", (F.col("n") == 1).alias("alone"), "one.at").alias("x"), F.col("k") > max_stretches
    )
    asked = asked.toDF("a_id", "a_h", "x", "hot").groupBy("a_id", "a_h", "hot").agg(F.collect_set("x").alias("asked"))
    packed = rows.mapInArrow(_compress, "id bigint, h bigint, packed binary")
    joined = packed.join(asked, F.col("id").eqNullSafe(F.col("a_id")) & (F.col("h") == F.col("a_h")))
    schema = "seed bigint, alone boolean, id bigint, h bigint, first bigint, data binary"
    # a row with an equal in id and text repeats whole stretches only, and those are never alone
    any_hot = not mixed_seeds.filter(F.col("k") > max_stretches).isEmpty()
    cold = joined.filter(~F.col("hot")).select("id", "h", "packed", "asked").mapInArrow(_slices, schema)
    dealt = cold.repartition("seed").sortWithinPartitions("seed")
    parts = full.unionByName(dealt.mapInArrow(_level_scan, "id bigint, h bigint, start bigint, stop bigint"))
    if any_hot:
        hot = joined.filter("hot").select("id", "h", "packed", "asked").mapInArrow(_slices, schema)
        windows = staged(hot.mapInArrow(_windows, "k1 bigint, k2 bigint, alone boolean, id bigint, h bigint, start bigint"), "suffix-windows")
        equal = windows.groupBy("k1", "k2").count().filter(F.col("count") > 1).select("k1", "k2")
        hits = windows.filter("alone").join(equal, ["k1", "k2"], "left_semi")
        parts = parts.unionByName(hits.select("id", "h", "start", (F.col("start") + LENGTH).alias("stop")))
    return parts


def merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(found):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for row_id, packed, found in zip(*(c.to_pylist() for c in batch.columns)):
            text, at, kept = expand(packed), 0, []
            runs = merged([(s["start"], s["stop"]) for s in found or ()])
            for start, stop in runs:
                kept.append(text[at:start])
                at = stop
            kept.append(text[at:])
            for column, value in zip(out, (row_id, len(text), sum(b - a for a, b in runs), len(runs), b"".join(kept))):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_stretches: int = MAX_STRETCHES) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept: the remaining bytes) of every row."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))
    cuts = spans(docs, id_col, text_col, max_stretches)
    cuts = staged(cuts.groupBy("id", "h").agg(F.collect_set(F.struct("start", "stop")).alias("found")), "suffix-cuts").toDF("c_id", "c_h", "found")
    packed = rows.mapInArrow(_compress, "id bigint, h bigint, packed binary")
    joined = packed.join(cuts, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h")), "left")
    out = joined.select("id", "packed", "found").mapInArrow(_cut, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return out.withColumnRenamed("id", id_col)
