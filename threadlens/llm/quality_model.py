"""Document quality by histogram gradient-boosted trees over document statistics.

Statistics are Spark expressions over every whole text (null as empty): sizes, word and line shapes, character
classes, repetition. Labelled rows outside the held-out fold (crc32 of the id as text, mod 4, is not 2) are thinned by
hash to at most `fit_rows` (a documented bound) and fitted on the driver: every feature is cut into at most `BINS`
quantile bins, each tree level is grown from per-bin sums of gradients and hessians of the logistic loss (one
`bincount` per feature and node), and leaves take Newton steps. The trees are complete, so they flatten into arrays
(feature and cut per inner node, value per leaf, heap order) and a batch of documents walks all trees at once in numpy,
inside an Arrow-batched UDF over all rows. A node without a useful split sends every row left (its cut is infinite), so
its right side is never reached.

Results: one row per document row; score in [0, 1], higher where label 1 is likelier, empty and null texts included.
Labels, language, source and id are never features. Repeated label rows of an id average their labels; labels without a
document, with a null id or null quality are left out. Null doc_id counts as the empty text in the fold hash (not held
out). Too few labelled rows (or one class only) give a constant score: the mean label, else 0.5. Columns of `docs`
besides id and text are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from threadlens.llm.common import SPACE, WORD, hash_sample, text_of

FIT_ROWS = 20_000  # labelled rows a fit sees at most, picked by hash
TREES = 80
DEPTH = 3
RATE = 0.1
BINS = 32
L2 = 1.0
MIN_LEAF = 8
CUT = 0.7  # predicted label 1 from this score on


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(4)) == 2


def _ratio(a: Column, b: Column) -> Column:
    return (a.cast("double") / F.greatest(b, F.lit(1)).cast("double"))


def statistics(text: Column) -> dict[str, Column]:
    """Feature name -> expression over the text column (already null-safe)."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    n_words, n_lines, n_chars = F.size(words), F.size(lines), F.length(text)
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return {
        "chars": F.log1p(n_chars.cast("double")),
        "words": F.log1p(n_words.cast("double")),
        "word_length": _ratio(n_chars - F.regexp_count(text, F.lit(f"[{SPACE}]")), n_words),
        "longest_word": F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)).cast("double"),
        "lines": F.log1p(n_lines.cast("double")),
        "words_per_line": _ratio(n_words, n_lines),
        "distinct_words": _ratio(F.size(F.array_distinct(F.transform(words, F.lower))), n_words),
        "dup_lines": _ratio(n_lines - F.size(F.array_distinct(lines)), n_lines),
        "line_ends": _ratio(F.size(F.filter(lines, lambda line: F.rtrim(line).rlike(r"[.!?\"')]$"))), n_lines),
        "digits": _ratio(F.regexp_count(text, F.lit("[0-9]")), n_chars),
        "capitals": _ratio(F.regexp_count(text, F.lit(r"\p{Lu}")), letters),
        "letters": _ratio(letters, n_chars),
        "non_ascii": _ratio(F.regexp_count(text, F.lit(r"[^\x00-\x7F]")), n_chars),
        "punctuation": _ratio(F.regexp_count(text, F.lit(r"[.,;:!?]")), n_words),
        "symbols": _ratio(F.regexp_count(text, F.lit(r"[#*$%&|<>@~^=_\\/{}\[\]]")), n_words),
        "links": _ratio(F.regexp_count(text, F.lit(r"https?://|www\.")), n_words),
        "bullets": _ratio(F.size(F.filter(lines, lambda line: line.rlike(r"^\s*([-*•·]|[0-9]+[.)])\s"))), n_lines),
        "shouting": _ratio(F.size(F.filter(words, lambda w: w.rlike(r"^\p{Lu}{2,}$"))), n_words),
    }


FEATURES = [
    "chars", "words", "word_length", "longest_word", "lines", "words_per_line", "distinct_words", "dup_lines",
    "line_ends", "digits", "capitals", "letters", "non_ascii", "punctuation", "symbols", "links", "bullets", "shouting",
]


def featurised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one double column per feature, `f_<name>`."""
    stats = statistics(text_of(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), *[stats[n].alias(f"f_{n}") for n in FEATURES])


class Model(NamedTuple):
    """Complete trees in heap order: `feature`, `cut` (T, 2^D - 1); `leaf` (T, 2^D); margin = base + sum of leaves."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.zeros(0)


def fit_arrays(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Model:
    """Histogram boosting of the logistic loss on rows `x` (n, f) with targets `y` in [0, 1]."""
    n, f = x.shape
    inner, leaves = (1 << depth) - 1, 1 << depth
    mean = float(np.clip(y.mean() if n else 0.5, 1e-6, 1 - 1e-6))
    base = float(np.log(mean / (1 - mean)))
    feature = np.zeros((trees, inner), np.int32)
    cut = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    if n < 2 * MIN_LEAF or y.min() == y.max():
        return Model(base, feature[:0], cut[:0], leaf[:0])
    edges = [_cuts(x[:, j], bins) for j in range(f)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(f)], axis=1)
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for d in range(depth):
            for k in range((1 << d) - 1, (1 << (d + 1)) - 1):
                rows = node == k
                best = (0.0, -1, 0)
                gs, hs, cs = g[rows].sum(), h[rows].sum(), rows.sum()
                for j in range(f):
                    width = len(edges[j]) + 1
                    gl = np.cumsum(np.bincount(binned[rows, j], g[rows], width))[:-1]
                    hl = np.cumsum(np.bincount(binned[rows, j], h[rows], width))[:-1]
                    cl = np.cumsum(np.bincount(binned[rows, j], minlength=width))[:-1]
                    ok = (cl >= MIN_LEAF) & (cs - cl >= MIN_LEAF)
                    gain = gl**2 / (hl + L2) + (gs - gl) ** 2 / (hs - hl + L2) - gs**2 / (hs + L2)
                    gain = np.where(ok, gain, 0.0)
                    if len(gain) and gain.max() > best[0]:
                        best = (float(gain.max()), j, int(gain.argmax()))
                if best[1] >= 0:
                    feature[t, k], cut[t, k] = best[1], edges[best[1]][best[2]]
            right = x[np.arange(n), feature[t, node]] > cut[t, node]
            node = 2 * node + 1 + right
        slot = node - inner
        gl = np.bincount(slot, g, leaves)
        hl = np.bincount(slot, h, leaves)
        leaf[t] = -rate * gl / (hl + L2)
        margin += leaf[t, slot]
    return Model(base, feature, cut, leaf)


def margins(model: Model, x: np.ndarray) -> np.ndarray:
    """All trees at once: one step down per level for every (row, tree)."""
    n, trees = len(x), len(model.leaf)
    if not trees:
        return np.full(n, model.base)
    node = np.zeros((n, trees), np.int64)
    cols = np.arange(trees)[None, :]
    for _ in range(model.feature.shape[1].bit_length()):
        f = model.feature[cols, node]
        value = np.take_along_axis(x, f, axis=1)
        node = 2 * node + 1 + (value > model.cut[cols, node])
    return model.base + model.leaf[cols, node - model.feature.shape[1]].sum(axis=1)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on labelled rows outside the held-out fold, at most `fit_rows` of them."""
    target = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    target = target.groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("_y"))
    target = target.filter(~held_out())
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(target, "doc_id")
    stats = statistics(text_of("text"))  # of the picked labelled rows only
    chosen = hash_sample(labelled, ["doc_id"], fit_rows)
    picked = chosen.select("_y", *[stats[n].alias(f"f_{n}") for n in FEATURES]).toPandas()
    x = picked[[f"f_{n}" for n in FEATURES]].to_numpy(np.float64)
    return fit_arrays(x, picked["_y"].to_numpy(np.float64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    names = [f"f_{n}" for n in FEATURES]

    @F.pandas_udf("double")
    def walk(features: pd.DataFrame) -> pd.Series:
        m = margins(model, features[names].to_numpy(np.float64))
        return pd.Series(1 / (1 + np.exp(-m)))

    rows = featurised(docs, id_col, text_col)
    scored = rows.select("doc_id", held_out().alias("held_out"), walk(F.struct(*names)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
