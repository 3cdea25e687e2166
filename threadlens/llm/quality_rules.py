"""Quality rules as a learned decision list.

`text_statistics` computes per-document figures with built-in functions only. `learn_rules` fits an ordered list of
threshold conjunctions by sequential covering: a rule grows one condition at a time by information gain on two thirds of
the labelled rows, is pruned on the remaining third, and is kept only when it stays precise there; rows that it covers
leave, and the next rule starts. `verdict` turns the list into one conditional expression, so that applying it is a
projection without any shuffle.

The fit sees at most `FIT_ROWS` labelled documents, picked by a hash of the id, as rows of numbers; applying the list covers
all rows and is map-only.

Null text counts as empty; a document without words fails the base rules. Without labels the list is empty and only the
base rules decide. A label row with null id or null quality is ignored; of several labels of one id the lowest counts.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from threadlens.llm.common import SPACE, WORD, hash_sample, text_of

FIT_ROWS = 20_000
MAX_RULES = 8
MAX_CONDITIONS = 3
THRESHOLDS = 200  # tried per feature and step
MIN_PRECISION = 0.97  # on rows the rule was not grown on
MIN_COVER = 5
#: Per-word and per-character ratios, so that a rule means the same for short and long texts.
FEATURES = {
    "symbols": "n_symbols / greatest(n_words, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "shouts": "n_shouts / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "words": "cast(n_words as double)",
}


class Condition(NamedTuple):
    feature: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float


def _covered(at: Column) -> Column:
    """Words covered by three-word windows at the given rising positions: each counts up to the next one's start."""
    steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1), p + 3) - p).cast("bigint"))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of `docs` and the statistics; the frame may hold any other columns but these."""
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(rf"[^{SPACE}]"))
    rows = docs.withColumns({"_q_words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), "_q_lines": lines})
    # most texts repeat no window: a set of hashes tells, and only the others sort
    hashes = F.when(
        F.size("_q_words") >= 4,
        F.transform(
            F.sequence(F.lit(0), F.size("_q_words") - 3),
            lambda i: F.xxhash64(F.col("_q_words")[i], F.col("_q_words")[i + 1], F.col("_q_words")[i + 2]),
        ),
    )
    rows = rows.withColumn("_q_hashes", hashes)
    repeats = F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes")
    pairs = F.transform("_q_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    rows = rows.withColumn("_q_sorted", F.when(repeats, F.sort_array(pairs)))
    ordered = F.col("_q_sorted")

    def repeated(pair: Column, i: Column) -> Column:
        after, before = F.get(ordered, i + 1)["h"], F.get(ordered, i - 1)["h"]
        return F.coalesce(pair["h"] == after, F.lit(False)) | F.coalesce(pair["h"] == before, F.lit(False))

    at = F.sort_array(F.transform(F.filter(ordered, repeated), lambda pair: pair["at"]))
    rows = rows.withColumn("_q_at", at)
    figures = {
        "n_words": F.size("_q_words"),
        "word_chars": F.length(text) - F.regexp_count(text, F.lit(f"[{SPACE}]")),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
        "n_lines": F.size("_q_lines"),
        "n_dup_lines": F.size("_q_lines") - F.size(F.array_distinct("_q_lines")),
        "n_repeat_words": F.coalesce(_covered(F.col("_q_at")), F.lit(0)),
        "n_capitals": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "n_shouts": F.regexp_count(text, F.lit("!")),
    }
    # a generator, so that a filter on the figures is not rewritten into the array expressions below it
    row = F.struct(*[f.cast("bigint").alias(name) for name, f in figures.items()])
    return rows.select(*[F.col(c) for c in docs.columns], F.inline(F.array(row)))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _matches(rule: list[Condition], row: dict) -> bool:
    return all((row[c.feature] > c.threshold) == c.above for c in rule)


def _tally(rule: list[Condition], rows: list[tuple[dict, bool]]) -> tuple[int, int]:
    """(bad, good) rows that the rule covers."""
    bad = good = 0
    for row, is_bad in rows:
        if _matches(rule, row):
            bad, good = bad + is_bad, good + (not is_bad)
    return bad, good


def _grow(rows: list[tuple[dict, bool]]) -> list[Condition]:
    """Adds the condition with the most information gained on bad rows until no good row is covered."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS and any(not bad for _, bad in rows):
        total_bad = sum(bad for _, bad in rows)
        before = math.log2(total_bad / len(rows))
        best: tuple[float, Condition] | None = None
        for feature in FEATURES:
            ordered = sorted((row[feature], bad) for row, bad in rows)
            at_most, seen_bad = {}, 0  # threshold -> (rows, bad rows) with a value not above it
            for i, (value, bad) in enumerate(ordered):
                seen_bad += bad
                at_most[value] = (i + 1, seen_bad)
            values = list(at_most)
            step = max(1, len(values) // THRESHOLDS)
            for value, following in list(zip(values, values[1:]))[::step]:
                n, bad = at_most[value]
                cut = (value + following) / 2  # half way, to leave rows just past the seen ones alone
                for above, b, m in ((False, bad, n), (True, total_bad - bad, len(rows) - n)):
                    if b:
                        gain = b * (math.log2(b / m) - before)
                        if best is None or gain > best[0]:
                            best = (gain, Condition(feature, above, cut))
        if best is None or best[0] <= 0:
            break
        rule.append(best[1])
        rows = [(row, bad) for row, bad in rows if _matches([best[1]], row)]
    return rule


def cover(rows: list[tuple[dict, bool]]) -> list[list[Condition]]:
    """Rejecting rules in order, from (features, is bad) rows whose every third is held back for pruning."""
    grow = [r for i, r in enumerate(rows) if i % 3]
    prune = [r for i, r in enumerate(rows) if i % 3 == 0]
    rules: list[list[Condition]] = []
    while len(rules) < MAX_RULES and sum(bad for _, bad in grow) >= MIN_COVER:
        rule = _grow(grow)

        def worth(k: int) -> float:
            bad, good = _tally(rule[:k], prune)
            return (bad - good) / (bad + good) if bad + good else -1.0

        if not rule:
            break
        rule = rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))]
        bad, good = _tally(rule, prune)
        if bad < MIN_COVER or bad < MIN_PRECISION * (bad + good):
            break
        rules.append(rule)
        grow = [r for r in grow if not _matches(rule, r[0])]
        prune = [r for r in prune if not _matches(rule, r[0])]
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> list[list[Condition]]:
    """The decision list for `labels` (id, quality 0 or 1), fitted on at most `fit_rows` labelled documents."""
    known = hash_sample(labels.filter(F.col("quality").isNotNull()), [id_col], fit_rows)
    marks = known.groupBy(F.col(id_col).alias("_l_id")).agg(F.min("quality").alias("_quality"))
    marks = F.broadcast(marks.orderBy(F.xxhash64("_l_id"), "_l_id").limit(fit_rows))
    seen = docs.select(id_col, text_col).join(marks, F.col(id_col) == F.col("_l_id"))
    seen = text_statistics(seen, text_col).filter(~base_failed())
    columns = [F.expr(e).alias(f) for f, e in FEATURES.items()]
    # ids that repeat add rows, so the number is bounded once more
    rows = seen.select(F.xxhash64(id_col).alias("_h"), "_quality", *columns).orderBy("_h", *FEATURES).limit(fit_rows).collect()
    return cover([({f: float(r[f]) for f in FEATURES}, r["_quality"] == 0) for r in rows])


def rejected_by(rules: list[list[Condition]]) -> Column:
    """Number of the first rule that fires, from 1, or null."""
    found = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        fires = F.lit(True)
        for c in rule:
            value = F.expr(FEATURES[c.feature])
            fires = fires & ((value > c.threshold) if c.above else (value <= c.threshold))
        found = F.when(fires, F.lit(number)).otherwise(found)
    return found


def judge(stats: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """Adds `base_failed`, `rule` (of the list, null if none fires) and `kept`."""
    judged = stats.withColumns({"base_failed": base_failed(), "rule": rejected_by(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
