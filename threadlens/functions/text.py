"""Text expressions. All stay in the JVM except HTML unescaping of texts that hold an ampersand."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from threadlens.functions.vocab import (
    CLOSERS, LABEL_THRESHOLD, MAX_CHARS, MAX_TRAILING, MAX_WORDS, NEGATIVE, PLACEHOLDER, POSITIVE, STOPWORDS, TAGLINE,
    TAGLINE_LINK, WHITESPACE, WORD_CLASS,
)


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape(col: Column) -> Column:
    """One pass of HTML5 unescaping; only texts with an ampersand travel to Python."""
    return F.coalesce(_unescape(F.when(F.contains(col, F.lit("&")), col)), col)


def strip(col: Column) -> Column:
    """Unicode-aware trim of both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def clean_comment_text(col: Column) -> Column:
    return F.coalesce(strip(unescape(col)), F.lit(""))


def cut_tagline(cleaned: Column) -> Column:
    """Text before the first tagline, for cleaned texts that hold tagline and link marker."""
    tagged = cleaned.contains(TAGLINE) & cleaned.contains(TAGLINE_LINK)
    return F.when(tagged, strip(F.substring_index(cleaned, TAGLINE, 1))).otherwise(cleaned)


def clean_post_text(col: Column) -> Column:
    return cut_tagline(clean_comment_text(col))


def is_valid_text(cleaned: Column) -> Column:
    """Not empty and not a placeholder; takes cleaned text."""
    return F.coalesce((cleaned != "") & ~cleaned.rlike(PLACEHOLDER), F.lit(False))


def word_count(col: Column) -> Column:
    return F.size(F.regexp_extract_all(col, F.lit(f"[^{WHITESPACE}]+"), F.lit(0)))


def is_question(cleaned: Column) -> Column:
    """Short valid text whose last question mark is at or near the end; takes cleaned text."""
    mark = F.lit("?")
    near_end = F.endswith(F.rtrim(cleaned, F.lit(CLOSERS)), mark) | (
        F.length(F.substring_index(cleaned, "?", -1)) <= MAX_TRAILING
    )
    # the word count builds an array, so it comes after the cheap length test
    return F.coalesce(
        F.contains(cleaned, mark)
        & (F.length(cleaned) <= MAX_CHARS)
        & is_valid_text(cleaned)
        & near_end
        & (word_count(cleaned) <= MAX_WORDS),
        F.lit(False),
    )


def round4(x: Column) -> Column:
    """Round |x| <= 1 to 4 decimals, half-even on the exact binary value.

    Near a halfway point the double is scaled by a power of two to an exact integer and compared exactly; Spark's own
    rounding works on the shortest decimal form and differs on values such as 1/160.
    """
    y = F.abs(x)
    floor = F.floor(y * 10000)
    near_tie = F.abs(y * 10000 - floor - 0.5) < 1e-6

    def settle(bits: int) -> Column:
        exact = (y * float(2**bits)).cast("bigint").cast("decimal(19,0)") * F.lit(20000).cast("decimal(5,0)")
        tie = (2 * floor + 1).cast("decimal(6,0)") * F.lit(str(2**bits)).cast("decimal(22,0)")
        return F.when(exact < tie, floor).when(exact > tie, floor + 1).otherwise(floor + floor % 2)

    steps = F.when(near_tie & (y >= 2.0**-8), settle(61)).when(near_tie, settle(69)).otherwise(F.floor(y * 10000 + 0.5))
    return F.signum(x) * steps / 10000.0


def word_tokens(col: Column) -> Column:
    """Lower-cased runs of letters, numbers and underscores."""
    return F.regexp_extract_all(F.lower(col), F.lit(f"{WORD_CLASS}+"), F.lit(0))


def lexicon_hits(cleaned: Column) -> Column:
    """Word tokens found in either word list."""
    return F.filter(word_tokens(cleaned), lambda t: t.isin(POSITIVE + NEGATIVE))


def positive_count(hits: Column) -> Column:
    return F.size(F.filter(hits, lambda t: t.isin(POSITIVE)))


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score >= LABEL_THRESHOLD, "positive").when(score <= -LABEL_THRESHOLD, "negative").otherwise("neutral")
    )


def entities(cleaned: Column) -> Column:
    """Distinct capitalised phrases in order of first appearance, without stopwords."""
    word = "[A-Z][a-z]{2,}"
    phrase = f"(?<!{WORD_CLASS}){word}(?:[{WHITESPACE}]+{word})*(?!{WORD_CLASS})"
    found = F.array_distinct(F.regexp_extract_all(cleaned, F.lit(phrase), F.lit(0)))
    return F.filter(found, lambda e: ~F.lower(e).isin(STOPWORDS))


def keyword_tokens(cleaned: Column) -> Column:
    """Lower-cased ASCII words of three letters or more, without stopwords."""
    pattern = f"(?<!{WORD_CLASS})[a-z]{{3,}}(?!{WORD_CLASS})"
    words = F.regexp_extract_all(F.lower(cleaned), F.lit(pattern), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(STOPWORDS))


def iso(col: Column) -> Column:
    """ISO-8601 text of a timestamp, empty for NULL; fractions only when present."""
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(col, "SSSSSS")
    return F.coalesce(F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros)), F.lit(""))


def title_case(name: str) -> str:
    """Header title of a column name."""
    return name.replace("_", " ").title()
