"""SimHash near-duplicates over a segment-popcount embedding.

A fingerprint is cut into 32 segments of two bits; the bit counts of the segments are its embedding. The Manhattan
distance of two embeddings never exceeds the Hamming distance of the fingerprints, so it rules pairs out. Written in
unary (00, 01, 11) the counts fit 64 bits again, and the Manhattan distance is the bit count of an exclusive or.

Grid join: the segments form `GROUPS` groups. A pair at Manhattan distance 3 or less differs in three groups at most, so
it shares a cell of the grid over the other three: twenty projections of the embedding with unit cells find all pairs.
Inside a cell, links are followed by a search that drops each fingerprint once it is reached, so copies of copies cost
one comparison each and no list of pairs is made; only the links of a spanning forest leave the task.

Cells above `MAX_CELL` fingerprints are taken apart by finer grids over the bits themselves (12 groups of which 9 agree,
then 24 of which 21 agree); the last leaves 8 bits free, so its cells hold at most 256 fingerprints. No pair is lost.

Documents that share a fingerprint meet only as one row per fingerprint. Null text counts as empty (fingerprint zero).
Null ids are grouped like any others and never name a group unless it has no other id. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from threadlens.llm.common import gathered, staged, text_of
from threadlens.llm.components import components
from threadlens.session import cut_lineage

SEED = 42
WORDS = 3
DISTANCE = 3
MAX_CELL = 20_000
ROWS = 2000  # fingerprints or texts a task looks at in steps that write little
GRIDS = (6, 12, 24)  # groups; all but DISTANCE of them agree
EVEN = 0x5555_5555_5555_5555
SHORT_RUN = 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Majority bits of the hashes of all word shingles, as a signed 64-bit number."""
    tokens = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if not tokens:
        return 0
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)))) if len(tokens) >= words else [b" ".join(tokens)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), batch.column(2)], ["id", "fp", "hash"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, fp, hash of the text) of every row."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("bigint"), text.cast("binary"), F.xxhash64(text))
    return rows.mapInArrow(_fingerprints(words), "id bigint, fp bigint, hash bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def embedding(fp: Column) -> Column:
    """Bit counts of the two-bit segments in unary."""
    low, high = fp.bitwiseAND(F.lit(EVEN)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(EVEN))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def masks(groups: int) -> list[int]:
    """Bits of each choice of all but DISTANCE groups; groups are made of whole segments."""
    edges = [round(i * 32 / groups) * 2 for i in range(groups + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, groups - DISTANCE)]


def _cells(fps: DataFrame, groups: int) -> DataFrame:
    point = embedding(F.col("fp")) if groups == GRIDS[0] else F.col("fp")
    cells = [F.struct(F.lit(i).alias("grid"), point.bitwiseAND(F.lit(_signed(m))).alias("cell")) for i, m in enumerate(masks(groups))]
    return fps.select("fp", F.explode(F.array(*cells)).alias("c")).select("c.grid", "c.cell", "fp")


def _unary(fps: np.ndarray) -> np.ndarray:
    even = np.uint64(EVEN)
    low, high = fps & even, (fps >> np.uint64(1)) & even
    return low | high | ((low & high) << np.uint64(1))


def _near(fps: np.ndarray, points: np.ndarray, fp: np.uint64, point: np.uint64) -> np.ndarray:
    """Marks of the fingerprints that link to `fp`: the lower bound first, then the exact distance."""
    near = np.bitwise_count(points ^ point) <= DISTANCE
    near[near] = np.bitwise_count(fps[near] ^ fp) <= DISTANCE
    return near


def _forest(fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect all fingerprints of a cell which links connect."""
    points = _unary(fps)
    while len(fps) > 1:
        queue, fps, points = [(fps[0], points[0])], fps[1:], points[1:]
        while queue and len(fps):
            fp, point = queue.pop()
            near = _near(fps, points, fp, point)
            if near.any():
                for other in fps[near]:
                    yield int(fp), int(other)
                queue.extend(zip(fps[near], points[near]))
                fps, points = fps[~near], points[~near]


class _Union:
    """Keeps only the links that join two parts."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        above = self.above
        while above.get(x, x) != x:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    def add(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.above[max(x, y)] = min(x, y)
            self.links.append((a, b))


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the cells of a partition; rows come sorted by cell, and the unfinished cell is carried on."""
    union = _Union()
    held: tuple[np.ndarray, ...] = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64))

    def work(grid: np.ndarray, cell: np.ndarray, fps: np.ndarray) -> None:
        new = np.concatenate([[True], (grid[1:] != grid[:-1]) | (cell[1:] != cell[:-1])])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(fps)))
        run = np.cumsum(new)
        points = _unary(fps)
        short = np.repeat(sizes <= SHORT_RUN, sizes)
        for step in range(1, min(SHORT_RUN, int(sizes.max()))):
            same = (run[step:] == run[:-step]) & short[step:]
            same[same] = np.bitwise_count(points[step:][same] ^ points[:-step][same]) <= DISTANCE
            same[same] = np.bitwise_count(fps[step:][same] ^ fps[:-step][same]) <= DISTANCE
            at = np.flatnonzero(same)
            for a, b in zip(fps[at].tolist(), fps[at + step].tolist()):
                union.add(a, b)
        for at in np.flatnonzero(sizes > SHORT_RUN):
            for a, b in _forest(fps[starts[at] : starts[at] + sizes[at]]):
                union.add(a, b)

    def emit() -> pa.RecordBatch:
        pairs = np.array(union.links, np.uint64).reshape(-1, 2).astype(np.int64)
        union.links.clear()
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    for batch in batches:
        grid, cell, fps = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        rows = tuple(np.concatenate(p) for p in zip(held, (grid, cell, fps.astype(np.uint64))))
        last = (rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1])
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if cut:
            work(*(c[:cut] for c in rows))
        held = tuple(c[cut:] for c in rows)
        if len(union.links) > 50_000:
            yield emit()
    if len(held[0]):
        work(*held)
    yield emit()


def links(fps: DataFrame, max_cell: int = MAX_CELL) -> DataFrame:
    """Links (a, b) between distinct fingerprints; they connect what all pairs within DISTANCE connect."""
    found, rest = None, fps
    for groups in GRIDS:
        cells, more = _cells(rest, groups), None
        if groups != GRIDS[-1]:
            big = cells.groupBy("grid", "cell").count().filter(F.col("count") > max_cell).select("grid", "cell")
            big = staged(gathered(big, rest.count(), ROWS), "simhash-big")
            if not big.isEmpty():
                more = cut_lineage(cells.join(big, ["grid", "cell"], "left_semi").select("fp").distinct())
                cells = cells.join(big, ["grid", "cell"], "left_anti")
        dealt = cells.repartition("grid", "cell").sortWithinPartitions("grid", "cell")
        part = dealt.mapInArrow(_links, "a bigint, b bigint")
        found = part if found is None else found.union(part)
        if more is None:
            break
        rest = more
    return found


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, max_cell: int = MAX_CELL) -> DataFrame:
    """(id, fp, hash, component, label): the component is the smallest id that links reach, the label its smallest print."""
    rows = staged(fingerprints(docs, id_col, text_col, words), "simhash-prints")
    first = staged(gathered(rows.groupBy("fp").agg(F.min("id").alias("first")), rows.count(), ROWS), "simhash-distinct")
    prints = first.count()
    labels = components(staged(gathered(links(first.select("fp"), max_cell), prints, ROWS), "simhash-links"))
    joined = first.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    names = joined.groupBy("label").agg(F.min("first").alias("component"))
    named = cut_lineage(gathered(joined.join(names, "label").select(F.col("fp").alias("_fp"), "component", "label"), prints, ROWS))
    return rows.join(named, F.col("fp") == F.col("_fp")).select(F.col("id").alias(id_col), "fp", "hash", "component", "label")


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col).cast("bigint"), text_of(text_col))


def row_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, max_cell: int = MAX_CELL) -> DataFrame:
    """The groups of `near_groups` by the keys of rows: (a, b), a < b, of the smallest key of a group with each other one."""
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    groups = near_groups(keyed, "key", "text", words, max_cell)
    return groups.select(F.col("component").alias("a"), F.col("key").alias("b")).filter("a < b").distinct()


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay: of each group the smallest id (null last), of equal ids the smallest text hash.

    Rows equal in id and text count as one document: they stay or go together.
    """
    return drop_later(docs, near_groups(docs, id_col, text_col), id_col, text_col)


def drop_later(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`docs` without the rows that are not the first of their group; `groups` names id, hash and label of rows in groups."""
    groups = staged(groups.select("label", F.col(id_col).isNull().alias("no"), F.col(id_col).alias("_n_id"), F.col("hash").alias("_n_hash")), "simhash-groups")
    order = F.struct("no", "_n_id", "_n_hash")
    best = groups.groupBy("label").agg(F.min(order).alias("best"))
    keep = best.select(F.col("best._n_id").alias("_n_id"), F.col("best._n_hash").alias("_n_hash")).distinct()
    out = groups.select("_n_id", "_n_hash").distinct().join(
        keep.toDF("_k_id", "_k_hash"), F.col("_n_id").eqNullSafe(F.col("_k_id")) & (F.col("_n_hash") == F.col("_k_hash")), "left_anti"
    )
    dropped = staged(gathered(out, groups.count(), ROWS), "simhash-dropped")
    on = F.col(id_col).eqNullSafe(F.col("_n_id")) & (F.xxhash64(text_of(text_col)) == F.col("_n_hash"))
    return docs.join(dropped, on, "left_anti")
