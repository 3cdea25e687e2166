"""Personal data by candidate gradient boosting, in built-in functions only.

Base spans follow fixed patterns and checks (`KINDS`) and always stay. High-recall generators then propose further,
overlapping spans of each kind; boosted trees score them by their format and by the text around them, and those above a
threshold calibrated on held-out candidates are added where they touch no base span and no better candidate.

The trees learn from the text itself: a candidate is a positive where it overlaps a base span of its kind, the other
candidates are negatives. The fit sees at most `FIT_ROWS` candidates of about `FIT_DOCS` texts, picked by a hash, as rows of numbers; detection
itself reads every text. Everything runs inside the row: matches are cut out by the pattern once more to get
their offsets, so no text is exploded or shuffled. Texts without a digit or an at sign are done after one look.

The patterns are written so that they scan in linear time: a run is entered only at its start and given up as a whole.
Null text counts as empty and has no spans. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from threadlens.llm import boosting
from threadlens.llm.common import hash_sample, text_of

FIT_DOCS = 50_000  # texts whose candidates are looked at for the fit
FIT_ROWS = 20_000
PRECISION = 0.99
CONTEXT = 24  # characters looked at on either side

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, leftmost and non-overlapping; possessive runs and look-behinds change their cost, not their matches.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Wider patterns; a span is proposed where it stands free of letters and digits.
GENERATORS = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64}+\s?(?:@|\(at\)|\[at\])\s?[A-Za-z0-9-]{1,63}+(?:\s?(?:\.|\(dot\)|\[dot\])\s?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![A-Za-z0-9.])[0-9]{1,3}+(?:[.,:][0-9]{1,3}+){3}+(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])[0-9]{4}+(?:[\x20./-]?[0-9]){8,15}+(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9])[+(]{0,2}+[0-9](?:[\x20()./-]{0,2}+[0-9]){6,15}+(?![A-Za-z0-9])",
}
#: Words near a span that speak for a kind, in the languages of the corpus.
CUES = {
    "email": r"mail|contact|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|address|adresse",
    "card": r"card|visa|master|credit|karte|carte|tarjeta",
    "phone": r"call|phone|tel|fax|mobile|anruf|llam",
}
NAMES = [
    "kind", "length", "digits", "digit_share", "separators", "dots", "hyphens", "spaces", "plus", "brackets", "at", "capitals",
    "checksum", "groups", "longest_group", "cue", "before_space", "after_space",
]


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start,value>> of the matches: the pieces between them give the offsets."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern)
    steps = F.zip_with(values, gaps, lambda v, g: F.struct(F.length(g).alias("gap"), F.length(v).alias("size"), v.alias("value")))
    steps = F.filter(steps, lambda s: s["value"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,value:string>>)").alias("found"))

    def put(done: Column, s: Column) -> Column:
        at = done["at"] + s["gap"]
        found = F.array_append(done["found"], F.struct(at.alias("start"), s["value"].alias("value")))
        return F.struct((at + s["size"]).alias("at"), found.alias("found"))

    return F.aggregate(steps, start, put, lambda done: done["found"])


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    worth = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(worth, F.lit(0), lambda total, d: total + d) % 10 == 0


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    n = F.length(only_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return n.between(13, 19) & F.when(n.between(13, 19), luhn(only_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _passes(kind: str):
    return lambda s: valid(kind, s["value"])


def _none() -> Column:
    return F.expr("cast(array() as array<struct<start:int,value:string>>)")


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of `docs` with `_b_<kind>` arrays of the base spans."""
    text = text_of(text_col)
    found = {}
    for kind in KINDS:
        worth = F.contains(text, F.lit("@")) if kind == "email" else text.rlike("[0-9]")
        matches = F.filter(spans(text, PATTERNS[kind]), _passes(kind))
        found[f"_b_{kind}"] = F.when(worth, matches).otherwise(_none())
    return docs.withColumns(found)


def _features(kind: str, text: Column, start: Column, value: Column) -> list[Column]:
    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern))

    n = F.length(value)
    before = F.substr(text, F.greatest(start + 1 - CONTEXT, F.lit(1)), F.least(start, F.lit(CONTEXT)))
    after = F.substr(text, start + 1 + n, F.lit(1))
    groups = F.split(value, "[^0-9]++")
    digits = only_digits(value)
    return [
        F.lit(KINDS.index(kind)), n, count("[0-9]"), count("[0-9]") / n, count("[^A-Za-z0-9]"), count(r"\."), count("-"), count(r"\s"),
        F.startswith(value, F.lit("+")).cast("int"), count(r"[()\[\]]"), count("@"), count("[A-Z]"),
        F.when(F.length(digits).between(12, 19), luhn(digits).cast("int")).otherwise(F.lit(-1)), F.size(groups),
        F.array_max(F.transform(groups, F.length)), F.lower(before).rlike(CUES[kind]).cast("int"),
        F.endswith(before, F.lit(" ")).cast("int"), (after == " ").cast("int"),
    ]


def candidates(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds `_c`, an array of proposed spans (kind, start, end, x: features), to a frame with base spans.

    `touch` tells whether a proposal overlaps a base span of any kind, `same` one of its own kind.
    """
    text, parts = text_of(text_col), []

    def proposals(number: int, kind: str):
        def proposal(s: Column) -> Column:
            start, end = s["start"], s["start"] + F.length(s["value"])

            def overlaps(name: str) -> Column:
                return F.exists(f"_b_{name}", lambda b: (b["start"] < end) & (start < b["start"] + F.length(b["value"])))

            touch = overlaps(KINDS[0])
            for other in KINDS[1:]:
                touch = touch | overlaps(other)
            x = F.array(*[f.cast("double") for f in _features(kind, text, start, s["value"])])
            fields = {"kind": F.lit(number), "start": start, "end": end, "touch": touch, "same": overlaps(kind), "x": x}
            return F.struct(*[c.alias(n) for n, c in fields.items()])

        return proposal

    for number, kind in enumerate(KINDS):
        worth = text.rlike(r"@|\(at\)|\[at\]") if kind == "email" else text.rlike("[0-9]")
        parts.append(F.when(worth, F.transform(spans(text, GENERATORS[kind]), proposals(number, kind))))
    empty = F.expr("cast(array() as array<struct<kind:int,start:int,end:int,touch:boolean,same:boolean,x:array<double>>>)")
    return rows.withColumn("_c", F.concat(*[F.coalesce(p, empty) for p in parts]))


class Detector(NamedTuple):
    model: boosting.Model
    cut: float


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS, precision: float = PRECISION) -> Detector | None:
    """Trees that tell candidates like the base spans from the others, or None where the texts hold only one sort."""
    some = hash_sample(docs.select(id_col, text_col), [id_col], FIT_DOCS)
    rows = candidates(base_spans(some, text_col), text_col).select(id_col, F.explode("_c").alias("c"))
    order = [F.xxhash64(id_col, "c.start", "c.kind"), F.col("c.x")]
    found = rows.select(id_col, "c").orderBy(*order).limit(fit_rows).select("c.x", "c.same").collect()
    fitted = boosting.fit_calibrated([r["x"] for r in found], [int(r["same"]) for r in found], precision)
    return None if fitted is None else Detector(*fitted)


SPAN = "array<struct<kind:int,start:int,end:int>>"


def detect(docs: DataFrame, detector: Detector | None, text_col: str = "text") -> DataFrame:
    """All columns of `docs` with `_base` and `_all`: sorted arrays of (kind number, start, end)."""
    rows = base_spans(docs, text_col)

    def as_span(number: int):
        return lambda s: F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), (s["start"] + F.length(s["value"])).alias("end"))

    own = [F.transform(f"_b_{kind}", as_span(number)) for number, kind in enumerate(KINDS)]
    if detector is None:
        more = F.expr(f"cast(array() as {SPAN})")
        rows = rows.withColumn("_free", more)
    else:
        rows = candidates(rows, text_col)
        free = F.filter("_c", lambda c: ~c["touch"])
        scored = F.transform(
            free,
            lambda c: F.struct(
                boosting.expression(detector.model, lambda i: c["x"][i]).alias("score"), c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")
            ),
        )
        rows = rows.withColumn("_scored", F.filter(scored, lambda c: c["score"] > detector.cut))

        def best(c: Column) -> Column:
            """No candidate that overlaps this one is better; the earlier kind and start wins a tie."""

            def better(o: Column) -> Column:
                first = (o["kind"] < c["kind"]) | ((o["kind"] == c["kind"]) & (o["start"] < c["start"]))
                return (o["start"] < c["end"]) & (c["start"] < o["end"]) & ((o["score"] > c["score"]) | ((o["score"] == c["score"]) & first))

            return ~F.exists("_scored", better)

        rows = rows.withColumn(
            "_free", F.transform(F.filter("_scored", best), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
        )
    rows = rows.withColumn("_base", F.concat(*own))
    return rows.select(*docs.columns, "_base", F.sort_array(F.concat("_base", "_free")).alias("_all"))


def is_kind(number: int):
    return lambda s: s["kind"] == number


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, detector: Detector | None, text_col: str = "text") -> DataFrame:
    """`docs` with every span replaced by its kind in angle brackets; spans that overlap are merged under the first kind."""
    rows = detect(docs, detector, text_col).withColumn("_t", text_of(text_col))
    marked = F.sort_array(F.transform("_all", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names = F.array(*map(F.lit, KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        piece = F.concat(F.substr("_t", done["at"] + 1, s["start"] - done["at"]), F.lit("<"), F.get(names, s["kind"]), F.lit(">"))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(fresh, F.concat(done["out"], piece)).otherwise(done["out"]).alias("out"))

    whole = F.aggregate(marked, start, put)
    rows = rows.withColumn("_r", whole)
    text = F.concat(F.col("_r.out"), F.substr("_t", F.col("_r.at") + 1, F.greatest(F.length("_t") - F.col("_r.at"), F.lit(0))))
    return rows.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
