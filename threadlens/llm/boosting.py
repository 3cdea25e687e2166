"""Gradient-boosted trees on a table of numbers, applied as a Spark expression.

Trees split at quantiles and take second-order leaf values of the logistic loss. `fit` takes a bounded table to the
driver; `fit_frame` fits a frame of any size where it lies: rows are binned once, each level of a tree is one combining
aggregate of gradients by (node, feature, bin), and only these sums reach the driver. Scoring is one expression.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from threadlens.llm.common import staged

TREES = 20
DEPTH = 3
RATE = 0.3
CUTS = 32
SMOOTH = 1.0
MIN_ROWS = 5
SCORE_STEP = 0.001  # width of the score bins that `calibrate_frame` counts


class Node(NamedTuple):
    """A leaf if `feature` is negative; else rows with a value up to `cut` go left."""

    feature: int
    cut: float
    value: float
    left: Node | None = None
    right: Node | None = None


class Model(NamedTuple):
    start: float
    trees: list[Node]


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTH)


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> Node:
    value = -RATE * g.sum() / (h.sum() + SMOOTH)
    best: tuple[float, int, float] | None = None
    if depth and len(g) >= 2 * MIN_ROWS:
        for feature in range(x.shape[1]):
            column = x[:, feature]
            order = np.argsort(column, kind="stable")
            ranked = column[order]
            ends = np.flatnonzero(ranked[1:] != ranked[:-1])  # the last row of each value
            ends = ends[(ends + 1 >= MIN_ROWS) & (len(g) - ends - 1 >= MIN_ROWS)]
            if not len(ends):
                continue
            ends = ends[np.unique(np.linspace(0, len(ends) - 1, CUTS).astype(int))]
            left_g, left_h = np.cumsum(g[order])[ends], np.cumsum(h[order])[ends]
            gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
            at = int(np.argmax(gains))
            if gains[at] > 1e-9 and (best is None or gains[at] > best[0]):
                best = (float(gains[at]), feature, float((ranked[ends[at]] + ranked[ends[at] + 1]) / 2))
    if best is None:
        return Node(-1, 0.0, float(value))
    _, feature, cut = best
    left = x[:, feature] <= cut
    return Node(feature, cut, 0.0, _tree(x[left], g[left], h[left], depth - 1), _tree(x[~left], g[~left], h[~left], depth - 1))


def _apply(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    return np.where(x[:, node.feature] <= node.cut, _apply(node.left, x), _apply(node.right, x))


def scores(model: Model, x: np.ndarray) -> np.ndarray:
    """Log-odds."""
    return model.start + sum((_apply(t, x) for t in model.trees), np.zeros(len(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Model | None:
    """A model of y (0 or 1), or None when only one class is there."""
    if not len(y) or y.min() == y.max():
        return None
    start = float(np.log(y.mean() / (1 - y.mean())))
    model = Model(start, [])
    z = np.full(len(y), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        tree = _tree(x, p - y, p * (1 - p), depth)
        model.trees.append(tree)
        z = z + _apply(tree, x)
    return model


def calibrate(score: np.ndarray, y: np.ndarray, precision: float) -> float | None:
    """The lowest score above which at least `precision` of the rows are positive, or None."""
    order = np.argsort(-score, kind="stable")
    ranked, right = score[order], np.cumsum(y[order])
    last = np.append(ranked[1:] != ranked[:-1], True)
    good = np.flatnonzero(last & (right >= precision * np.arange(1, len(y) + 1)) & (right > 0))
    if not len(good):
        return None
    at = int(good[-1])
    below = ranked[at + 1] if at + 1 < len(ranked) else ranked[at] - 1.0
    return float((ranked[at] + below) / 2)


def fit_calibrated(rows: Sequence[Sequence[float]], labels: Sequence[int], precision: float) -> tuple[Model, float] | None:
    """A model and the threshold that keeps `precision` on every third row, which the model does not see."""
    if not len(labels):
        return None
    x, y = np.array(rows, float), np.array(labels, float)
    held = np.arange(len(y)) % 3 == 0
    model = fit(x[~held], y[~held])
    if model is None:
        return None
    cut = calibrate(scores(model, x[held]), y[held], precision)
    return None if cut is None else (model, cut)


def expression(model: Model, feature: Callable[[int], Column]) -> Column:
    """The log-odds as a column; `feature(i)` gives the i-th feature."""

    def branch(node: Node) -> Column:
        if node.feature < 0:
            return F.lit(node.value)
        return F.when(feature(node.feature) <= node.cut, branch(node.left)).otherwise(branch(node.right))

    total = F.lit(model.start)
    for tree in model.trees:
        total = total + branch(tree)
    return total


def _split(sums: np.ndarray, cuts: int) -> tuple[float, int, np.ndarray, np.ndarray] | None:
    """(gain, bin, left sums, right sums) of the best split of one feature; `sums` holds (g, h, rows) by bin."""
    left = np.cumsum(sums, axis=0)[:cuts]
    right = sums.sum(axis=0) - left
    ok = (left[:, 2] >= MIN_ROWS) & (right[:, 2] >= MIN_ROWS)
    if not ok.any():
        return None
    gains = _gain(left[:, 0], left[:, 1]) + _gain(right[:, 0], right[:, 1]) - _gain(*sums.sum(axis=0)[:2])
    at = int(np.argmax(np.where(ok, gains, -np.inf)))
    return (float(gains[at]), at, left[at], right[at]) if gains[at] > 1e-9 else None


def _grow(rows: DataFrame, cuts: list[list[float]], total: np.ndarray, depth: int) -> Node:
    """One tree for rows (bins, g, h): a level of it is one aggregate over all rows."""
    splits: dict[int, tuple[int, int]] = {}  # node -> feature, bin; the children of node i are 2i and 2i + 1
    sums = {1: total}
    for level in range(depth):
        open_nodes = [i for i in sums if i >> level == 1]
        if not open_nodes:
            break
        node = _node(splits)
        found = rows.select(node.alias("node"), "g", "h", F.posexplode("bins").alias("f", "b")).filter(F.col("node").isin(open_nodes))
        counted = found.groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")).collect()
        tables = {(i, f): np.zeros((len(c) + 1, 3)) for i in open_nodes for f, c in enumerate(cuts)}
        for r in counted:
            tables[r["node"], r["f"]][r["b"]] = (r["g"], r["h"], r["n"])
        for i in open_nodes:
            best = None
            for f, c in enumerate(cuts):
                split = _split(tables[i, f], len(c))
                if split and (best is None or split[0] > best[1][0]):
                    best = (f, split)
            if best:
                f, (_, at, left, right) = best
                splits[i] = (f, at)
                sums[2 * i], sums[2 * i + 1] = left, right

    def build(i: int) -> Node:
        if i not in splits:
            return Node(-1, 0.0, float(-RATE * sums[i][0] / (sums[i][1] + SMOOTH)))
        f, at = splits[i]
        return Node(f, cuts[f][at], 0.0, build(2 * i), build(2 * i + 1))

    return build(1)


def _node(splits: dict[int, tuple[int, int]], at: int = 1) -> Column:
    """The node that a row has reached by its bins."""
    if at not in splits:
        return F.lit(at)
    feature, cut = splits[at]
    return F.when(F.get("bins", F.lit(feature)) <= cut, _node(splits, 2 * at)).otherwise(_node(splits, 2 * at + 1))


def fit_frame(rows: DataFrame, names: Sequence[str], label: str = "y", trees: int = TREES, depth: int = DEPTH) -> Model | None:
    """A model of `label` (0 or 1) from the columns `names` of all rows, or None when only one class is there."""
    at = [(i + 1) / CUTS for i in range(CUTS - 1)]
    quantiles = [F.percentile_approx(n, at, 10_000).alias(f"q{i}") for i, n in enumerate(names)]
    first = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"), *quantiles).first()
    if not first["n"] or first["bad"] in (0, first["n"]):
        return None
    cuts = [sorted(set(first[f"q{i}"])) for i in range(len(names))]
    bins = [sum(((F.col(n) > c).cast("int") for c in cs), F.lit(0)) for n, cs in zip(names, cuts)]
    mean = first["bad"] / first["n"]
    model = Model(float(np.log(mean / (1 - mean))), [])
    rows = staged(rows.select(F.col(label).cast("double").alias("y"), F.array(*bins).alias("bins"), F.lit(model.start).alias("z")), "boosting-rows")
    p = 1 / (1 + F.exp(-F.col("z")))
    in_bins = [{c: b for b, c in enumerate(cs)} for cs in cuts]

    def value(node: Node) -> Column:
        if node.feature < 0:
            return F.lit(node.value)
        left = F.get("bins", F.lit(node.feature)) <= in_bins[node.feature][node.cut]
        return F.when(left, value(node.left)).otherwise(value(node.right))

    for _ in range(trees):
        steep = rows.select("bins", (p - F.col("y")).alias("g"), (p * (1 - p)).alias("h"))
        whole = steep.agg(F.sum("g").alias("g"), F.sum("h").alias("h")).first()
        tree = _grow(steep, cuts, np.array([whole["g"], whole["h"], first["n"]]), depth)
        model.trees.append(tree)
        rows = staged(rows.select("y", "bins", (F.col("z") + value(tree)).alias("z")), "boosting-rows")
    return model


def calibrate_frame(scored: DataFrame, precision: float) -> float | None:
    """As `calibrate`, over all rows (score, y): they are counted in bins of `SCORE_STEP`, a cut lies between two bins."""
    binned = scored.groupBy(F.floor(F.col("score") / SCORE_STEP).alias("b")).agg(F.sum("y").alias("bad"), F.count(F.lit(1)).alias("n"))
    ranked = sorted(((r["b"], r["bad"], r["n"]) for r in binned.collect()), reverse=True)
    cut, bad, n = None, 0, 0
    for b, more, count in ranked:
        bad, n = bad + more, n + count
        if bad > 0 and bad >= precision * n:
            cut = (b - 0.5) * SCORE_STEP if (b - 1) not in {x[0] for x in ranked} else b * SCORE_STEP - 1e-9
    return cut
