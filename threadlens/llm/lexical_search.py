"""Ranked lexical search over a length-stratified index.

Every document row is a document (repeated rows count twice). Its terms are the maximal runs of ASCII letters and
digits and of any non-ASCII character, with only A-Z lower-cased; a null text has none. With N the documents holding a
term, L all their terms and n one document's, the normaliser is m = 75 + (25 n N) div L, so documents of equal m form
one stratum. The index keeps, by stratum, one row per document with its postings (numbers and tf of the queried terms),
and for each term and stratum the df and the largest tf.

A query's score of a document sums w * impact over its terms, repeats included, with w = floor(1000 ln((2N+2)/(2df+1)))
and impact = (10^9 tf) div (1000 tf + 12 m). Since impact grows with tf, the largest tf of a term in a stratum bounds
every score there. Strata are visited in order of that bound until they are sure to hold `top` documents of positive
score; the `top`-th score among them is a floor, and only strata whose bound reaches it are scored. Inside a stratum,
terms whose summed bounds stay below the floor only add to documents found through the other terms. Nothing below the
floor can enter the result, so the ranking is the same as scoring every document.

A document's postings lie in one row, so scores are summed where the row lies and each task hands on `top` rows an item;
neither postings nor scores are shuffled. The query side goes to every task: items are dealt into blocks of about
`BROADCAST_ROWS` (item, term) rows, and each block has an index of its own.

Results: per item, its `top` highest positive scores, equal scores by ascending doc_id (rows of one doc_id in any
order). Items are grouped by item_id (null is one item; several rows of an id query with all their terms); an item
without terms, an empty table or a corpus without terms gives no rows. Other columns of either table are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from threadlens.llm.common import staged, text_of

# Fixed values of the scoring contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
TOP = 20

BROADCAST_ROWS = 200_000  # (item, term) rows of a block
CELLS = 1_000_000  # products and scores that a task holds at once, about
_TEXT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def _postings(vocabulary):
    """Terms of each text (UTF-8: all bytes of a non-ASCII character belong to a term) and the tf of the known ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            n, ends, ids, tfs = [], [0], [], []
            for text in batch.column(2).to_pylist():
                words = text.translate(_TEXT).split()
                n.append(len(words))
                for word, tf in Counter(words).items():
                    if (number := known.get(word)) is not None:
                        ids.append(number)
                        tfs.append(tf)
                ends.append(len(ids))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (ids, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), *lists], ["rid", "doc_id", "n", "ids", "tfs"])

    return run


def build_index(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(index, strata) for the terms of `vocabulary`, numbered in its order, staged in the shared folder.

    index: rid (row key), doc_id, m, ids and tfs (a document's postings), by m. strata: term (number), m, w, df of the
    term in the stratum, top_impact. N and L come from all terms of every text, df from all postings of a term.
    """
    known = docs.sparkSession.sparkContext.broadcast({t.encode(): i for i, t in enumerate(vocabulary)})
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("bigint"), text_of(text_col).cast("binary"))
    rows = staged(rows.mapInArrow(_postings(known), "rid bigint, doc_id bigint, n bigint, ids array<int>, tfs array<int>"), "search-postings")
    totals = rows.agg(F.count_if(F.col("n") > 0).alias("N"), F.sum("n").alias("L")).first()
    big_n, big_l = totals["N"], totals["L"] or 0
    rows = rows.withColumn("m", F.lit(75) + F.expr(f"(25 * n * {big_n}) div {max(big_l, 1)}"))
    index = rows.filter(F.size("ids") > 0).select("rid", "doc_id", "m", "ids", "tfs")
    index = staged(index.repartitionByRange("m", "rid").sortWithinPartitions("m"), "search-index")
    each = index.select("m", F.explode(F.arrays_zip("ids", "tfs")).alias("p")).select("m", F.col("p.ids").alias("term"), F.col("p.tfs").alias("tf"))
    strata = staged(each.groupBy("term", "m").agg(F.max("tf").cast("bigint").alias("tf"), F.count("*").alias("df")), "search-strata")
    weights = strata.groupBy("term").agg(F.sum("df").alias("df"))
    weights = weights.select("term", F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * big_n + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("bigint").alias("w"))
    strata = strata.join(weights, "term").withColumn("top_impact", F.expr("(1000000000 * tf) div (1000 * tf + 12 * m)"))
    return index, staged(strata.select("term", "m", "w", "df", "top_impact"), "search-terms")


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, term, qn (times the term occurs in the item).

    `item_id` here is a non-null key (null flag, value), so that joins keep the item of a null id.
    """
    key = F.named_struct(F.lit("none"), F.col(id_col).isNull(), F.lit("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)))
    words = items.select(key.alias("item_id"), F.explode(terms(F.col(text_col))).alias("term"))
    return words.groupBy("item_id", "term").agg(F.count("*").alias("qn"))


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _best_of(rows: list[np.ndarray], top: int) -> list[np.ndarray]:
    """rows: item, score, has id, doc_id, rid. Each item's best, in order."""
    order = np.lexsort((rows[4], rows[3], rows[2], -rows[1], rows[0]))
    item = rows[0][order]
    at = np.arange(len(item)) - np.searchsorted(item, item)
    return [c[order[at < top]] for c in rows]


def _products(owner, impact, used, first, counts, item, gain, n_items):
    """(cell, value) of every posting with every entry of its term; entries lie by `used` term."""
    times = counts[used]
    at = _spread(first[used], times)
    return np.repeat(owner, times) * n_items + item[at], gain[at] * np.repeat(impact, times)


def _slice_scores(owner, ids, impact, n_docs, query, floor, asked) -> np.ndarray:
    """Scores (document, item) of documents of one stratum that can reach the floor of the item; others may be less.

    Within the stratum, an item's terms of least bound whose sum stays below the floor are not essential: a document
    holding only those cannot reach it. Essential terms find the documents; the others count for those found only.
    """
    ptr, entry_item, entry_gain = query
    terms_here, used = np.unique(ids, return_inverse=True)
    largest = np.zeros(len(terms_here), np.int64)
    np.maximum.at(largest, used, impact)
    counts = ptr[terms_here + 1] - ptr[terms_here]
    at, of = _spread(ptr[terms_here], counts), np.repeat(np.arange(len(terms_here)), counts)
    at, of = (x[asked[entry_item[at]]] for x in (at, of))
    item, gain = entry_item[at], entry_gain[at]
    bound = gain * largest[of]
    order = np.lexsort((bound, item))
    total = np.cumsum(bound[order])
    start = np.searchsorted(item[order], item[order])
    essential = np.empty(len(at), bool)
    essential[order] = total - (total - bound[order])[start] >= floor[item[order]]
    scores = np.zeros(n_docs * len(floor), np.int64)
    for part in (essential, ~essential):
        own = np.bincount(of[part], minlength=len(terms_here))
        cell, value = _products(owner, impact, used, np.cumsum(own) - own, own, item[part], gain[part], len(floor))
        if part is not essential:
            found = scores[cell] > 0
            cell, value = cell[found], value[found]
        np.add.at(scores, cell, value)
    return scores.reshape(n_docs, len(floor))


def _visit(query, top: int):
    """Best documents of each item among the index rows of a task; the floors rise with what the task has found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (none, key), entries, floors, first = query.value
        ptr, floor, width = entries[0], floors.copy(), len(floors)
        best = [np.zeros(0, np.int64)] * 5
        for batch in batches:
            rid, doc, m, ids, tfs = batch.columns
            rid, m, has = rid.to_numpy(), m.to_numpy(), doc.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = pc.fill_null(doc, 0).to_numpy()
            ends = np.cumsum(np.concatenate([[0], pc.list_value_length(ids).to_numpy()]))
            ids, tf = ids.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
            work = np.concatenate([[0], np.cumsum(ptr[ids + 1] - ptr[ids])])[ends] + np.arange(len(ends)) * width
            cuts = np.flatnonzero((m[1:] != m[:-1]) | np.diff(work[1:] // CELLS).astype(bool)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(m)]):
                asked = np.ones(width, bool)
                if first is not None:
                    asked[:] = False
                    asked[first.get(int(m[a]), [])] = True
                if a == b or not asked.any():
                    continue
                part = slice(ends[a], ends[b])
                impact = 1_000_000_000 * tf[part] // (1000 * tf[part] + 12 * m[a])
                owner = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
                scores = _slice_scores(owner, ids[part], impact, b - a, entries, floor, asked)
                good = scores >= floor
                if b - a > top:
                    good &= scores >= np.partition(scores, b - a - top, axis=0)[b - a - top]
                d, i = np.nonzero(good)
                if len(d):
                    best = _best_of([np.concatenate(x) for x in zip(best, (i, scores[d, i], has[a + d], doc[a + d], rid[a + d]))], top)
                    full = np.flatnonzero(np.bincount(best[0], minlength=width) >= top)
                    last = np.searchsorted(best[0], full, "right") - 1
                    floor[full] = np.maximum(floor[full], best[1][last])
        item, score, has, doc, rid = best
        columns = [pa.array(none[item]), pa.array(key[item]), pa.array(rid), pa.array(doc, mask=has == 0), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, ["none", "id", "rid", "doc_id", "score"])

    return run


def _best(scores: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("none", "id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "rid")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search(docs: DataFrame, wanted: DataFrame, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    rows = wanted.select("item_id.none", "item_id.id", "term", "qn").toArrow().to_pylist()
    if not rows:
        return None
    vocabulary = sorted({r["term"] for r in rows})
    numbers = {t: i for i, t in enumerate(vocabulary)}
    items = {k: i for i, k in enumerate(sorted({(r["none"], r["id"]) for r in rows}))}
    entries = np.array(sorted((numbers[r["term"]], items[r["none"], r["id"]], r["qn"]) for r in rows), np.int64)
    index, strata = build_index(docs, vocabulary)
    found = strata.groupBy("term").agg(F.first("w").alias("w")).toArrow()
    weights = np.zeros(len(vocabulary), np.int64)
    weights[found.column(0).to_numpy()] = found.column(1).to_numpy()
    ptr = np.searchsorted(entries[:, 0], np.arange(len(vocabulary) + 1))
    names = np.array([k[0] for k in items], bool), np.array([k[1] for k in items], np.int64)
    query = ptr, entries[:, 1].copy(), entries[:, 2] * weights[entries[:, 0]]
    schema = "none boolean, id bigint, rid bigint, doc_id bigint, score bigint"

    def visit(index: DataFrame, floors: np.ndarray, first: dict[int, list[int]] | None) -> DataFrame:
        sent = spark.sparkContext.broadcast((names, query, floors, first))
        return _best(index.mapInArrow(_visit(sent, top), schema), top)

    asked = spark.createDataFrame(pa.table({"term": pa.array(entries[:, 0], pa.int32()), "item": entries[:, 1], "qn": entries[:, 2]}))
    asked = strata.join(F.broadcast(asked), "term")  # (item, term, stratum) only where the stratum holds the term
    sure = F.when((F.col("w") > 0) & (F.col("top_impact") > 0), F.col("df")).otherwise(0)
    bounds = asked.groupBy("item", "m").agg(F.sum(F.col("qn") * F.col("w") * F.col("top_impact")).alias("bound"), F.max(sure).alias("sure"))
    by_bound = Window.partitionBy("item").orderBy(F.col("bound").desc(), "m").rowsBetween(Window.unboundedPreceding, -1)
    bounds = staged(bounds.filter("bound > 0").withColumn("before", F.coalesce(F.sum("sure").over(by_bound), F.lit(0))), "search-bounds")
    # First visit: strata of the highest bounds until `top` positive scores are certain; their `top`-th score is a floor.
    first: dict[int, list[int]] = {}
    for row in bounds.filter(F.col("before") < top).select("m", "item").toArrow().to_pylist():
        first.setdefault(row["m"], []).append(row["item"])
    ones = np.ones(len(items), np.int64)
    some = index.join(F.broadcast(bounds.filter(F.col("before") < top).select("m").distinct()), "m", "left_semi").select(*index.columns)
    scores = visit(some, ones, first).groupBy("none", "id").agg(F.min("score").alias("floor"), F.count("*").alias("found"))
    floors = ones.copy()
    for row in scores.filter(F.col("found") >= top).toArrow().to_pylist():
        floors[items[row["none"], row["id"]]] = row["floor"]
    reach = spark.createDataFrame(pa.table({"item": np.arange(len(items)), "floor": floors}))
    kept = bounds.join(F.broadcast(reach), "item").filter(F.col("bound") >= F.col("floor")).select("m").distinct()
    return visit(index.join(F.broadcast(kept), "m", "left_semi").select(*index.columns), floors, None)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score (long): each item's `top` best documents."""
    wanted = staged(query_terms(items), "search-query")
    blocks = max(1, -(-wanted.count() // max(BROADCAST_ROWS, 1)))
    block = F.pmod(F.xxhash64("item_id.none", "item_id.id"), F.lit(blocks))
    found = [x for b in range(blocks) if (x := _search(docs, wanted.filter(block == b), top)) is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    item = F.when(~F.col("none"), F.col("id")).alias("item_id")
    return reduce(DataFrame.unionByName, found).select(item, F.col("rank").cast("int"), "doc_id", "score")
