"""URL filter: longest-match host and path rules, else boosted trees over lexical features.

Features are built-in expressions of host, path and query: lengths, depth, digit share, entropy of the host, parameters,
hyphens, and how often URLs under the same registered suffix were unwanted among the labelled ones. The trees are fitted
on all labelled URLs where they lie (`boosting.fit_frame`); a threshold calibrated on rows the trees did not see keeps
`PRECISION`. Every suffix met has a figure of its own, in a table that URLs are joined with: up to `BROADCAST_SUFFIXES` of
them it is broadcast and judging is a projection; beyond, URLs are shuffled by suffix. No Python.

A null URL, or one without `://`, has an empty host and path; the method allows it. Without labels of both classes the
method allows everything. Repeated rows are judged alike; the frame may hold any other columns.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from threadlens.llm import boosting
from threadlens.llm.common import staged

PARTS = 6  # of the URLs by hash: 3 for the suffix figures, 2 for the trees, 1 for the threshold
PRECISION = 0.95
PRIOR = 10  # rows at the mean that each suffix is taken to have besides its own
BROADCAST_SUFFIXES = 100_000  # a table of more suffixes is joined by a shuffle
#: Words in a host that mark a URL as unwanted where no better labels are given.
UNWANTED = ("adult", "ads", "bets", "casino", "pills", "porn", "spam")


class Rule(NamedTuple):
    action: str  # allow or block
    place: str  # host and path, like "example.org/es/"

    @property
    def host(self) -> str:
        return self.place.partition("/")[0]

    @property
    def path(self) -> str:
        return self.place[len(self.host) :]


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The number of the longest rule that fits, or null."""
    found = F.lit(None).cast("int")
    for number, rule in sorted(enumerate(rules), key=lambda r: (len(r[1].place), r[1].place)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(number)).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    seen = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("double"),
    )
    spread = F.aggregate(seen, F.lit(0.0), lambda total, k: total + F.when(k > 0, k * F.log2(k)).otherwise(F.lit(0.0)))
    return F.log2(n) - spread / n


def suffix(host: Column) -> Column:
    """The last two labels."""
    return F.substring_index(host, ".", -2)


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    whole = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(whole, r"\?([^#]*)", 1)
    return {
        "length": F.length(whole),
        "host_length": F.length(host),
        "labels": F.regexp_count(host, F.lit(r"\.")),
        "label_length": F.length(F.substring_index(host, ".", 1)),
        "hyphens": F.regexp_count(host, F.lit("-")),
        "host_digits": F.regexp_count(host, F.lit("[0-9]")),
        "host_entropy": _entropy(host),
        "depth": F.regexp_count(path, F.lit("/[^/]")),
        "digit_share": F.regexp_count(whole, F.lit("[0-9]")) / F.greatest(F.length(whole), F.lit(1)),
        "parameters": F.when(query != "", F.regexp_count(query, F.lit("&")) + 1).otherwise(F.lit(0)),
        "fragment": F.contains(whole, F.lit("#")).cast("int"),
        "secure": F.startswith(whole, F.lit("https")).cast("int"),
    }


class Suffixes:
    """Log-odds of being unwanted by suffix: a table (suffix, odds) of all suffixes met, `other` for any that was not."""

    def __init__(self, table: DataFrame, other: float) -> None:
        self.table, self.other, self.count = table, other, table.count()

    def __getitem__(self, name: str) -> float:
        row = self.table.filter(F.col("suffix") == name).first()
        if row is None:
            raise KeyError(name)
        return row["odds"]

    def joined(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """`rows` with the log-odds of the suffix in column `key` as column `name`."""
        few = self.count <= BROADCAST_SUFFIXES
        table = self.table.select(F.col("suffix").alias(key), F.col("odds").alias(name)).hint("broadcast" if few else "merge")
        return rows.join(table, key, "left").select(*rows.columns, F.coalesce(name, F.lit(self.other)).alias(name))


class UrlModel(NamedTuple):
    trees: boosting.Model
    cut: float
    suffixes: Suffixes


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "unwanted", precision: float = PRECISION) -> UrlModel | None:
    """Trees for all labelled URLs (label 1 or true: unwanted), or None where nothing can be told."""
    rows = labelled.filter(F.col(url_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.select(F.col(url_col).alias("url"), F.col(label_col).cast("int").alias("y"))
    rows = rows.withColumns(dict(zip(("host", "path"), host_and_path(F.col("url")))))
    named = features(F.col("url"), F.col("host"), F.col("path"))
    # half of the URLs give the suffix figures, a third the trees, the rest the threshold: no row tells its own label
    part = F.pmod(F.xxhash64("url", F.lit(PARTS)), F.lit(PARTS)).alias("part")
    rows = staged(rows.select("y", part, suffix(F.col("host")).alias("suffix"), *[c.cast("double").alias(n) for n, c in named.items()]), "url-rows")
    mean = rows.agg(F.avg("y").alias("mean")).first()["mean"]
    if mean is None:
        return None

    def odds(bad: Column, n: Column) -> Column:
        p = F.greatest(F.least((bad + PRIOR * mean) / (n + PRIOR), F.lit(1 - 1e-6)), F.lit(1e-6))
        return F.log(p / (1 - p))

    counts = rows.filter(F.col("part") < PARTS // 2).groupBy("suffix").agg(F.sum("y").alias("bad"), F.count(F.lit(1)).alias("n"))
    figures = staged(counts.select("suffix", odds(F.col("bad"), F.col("n")).alias("odds")), "url-suffixes")
    p = min(max(mean, 1e-6), 1 - 1e-6)
    suffixes = Suffixes(figures, math.log(p / (1 - p)))
    rows = staged(suffixes.joined(rows, "suffix", "suffix_odds"), "url-rows")
    names = [*named, "suffix_odds"]
    trees = boosting.fit_frame(rows.filter(F.col("part").between(PARTS // 2, PARTS - 2)), names)
    if trees is None:
        return None
    held = rows.filter(F.col("part") == PARTS - 1)
    cut = boosting.calibrate_frame(held.select(boosting.expression(trees, lambda i: F.col(names[i])).alias("score"), "y"), precision)
    return None if cut is None else UrlModel(trees, cut, suffixes)


def judge(pages: DataFrame, rules: Sequence[Rule], model: UrlModel | None, url_col: str = "url") -> DataFrame:
    """All columns of `pages` with `_u_host`, `_u_path`, `_u_rule` (null if none fits) and `_u_verdict`."""
    rows = pages.withColumns(dict(zip(("_u_host", "_u_path"), host_and_path(F.col(url_col)))))
    host, path = F.col("_u_host"), F.col("_u_path")
    rows = rows.withColumn("_u_number", matching_rule(rules, host, path))
    blocked = F.lit(False)
    if model is not None:
        rows = model.suffixes.joined(rows.withColumn("_u_suffix", suffix(host)), "_u_suffix", "_u_odds")
        columns = [*features(F.col(url_col), host, path).values(), F.col("_u_odds")]  # in the order that the trees know
        rows = rows.withColumns({f"_u_{i}": c.cast("double") for i, c in enumerate(columns)})
        blocked = (host != "") & (boosting.expression(model.trees, lambda i: F.col(f"_u_{i}")) > model.cut)
    own = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    places, actions = F.array(*[F.lit(r.place) for r in rules]), F.array(*[F.lit(r.action) for r in rules])
    number = F.col("_u_number")
    if rules:
        rows = rows.withColumns({"_u_rule": F.get(places, number), "_u_verdict": F.coalesce(F.get(actions, number), own)})
    else:
        rows = rows.withColumns({"_u_rule": F.lit(None).cast("string"), "_u_verdict": own})
    return rows.select(*pages.columns, "_u_host", "_u_path", "_u_rule", "_u_verdict")


def labelled_by_words(pages: DataFrame, words: Sequence[str] = UNWANTED, url_col: str = "url") -> DataFrame:
    """(url, unwanted): the host holds one of the words between its dots and hyphens."""
    host, _ = host_and_path(F.col(url_col))
    pattern = rf"(^|[.-])({'|'.join(words)})($|[.-])"
    return pages.select(F.col(url_col).alias("url"), host.rlike(pattern).cast("int").alias("unwanted"))
