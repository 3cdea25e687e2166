"""Rule tables of the text primitives against plain Python."""

import html
import random

import pytest
from pyspark.sql import functions as F

from threadlens.functions import text as tx
from threadlens.functions.vocab import STOPWORDS
from threadlens.operators import enrich, report


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in sorted(df.select("i", expr(F.col("x"))).collect())]


def question(col):
    return tx.is_question(tx.clean_comment_text(col))


QUESTIONS = [
    ("How?", True),
    ('Really?")', True),
    ("x?" + ")" * 30, True),
    ("Why?" + "a" * 25, True),
    ("Why?" + "a" * 26, False),
    (" ".join(["a"] * 59 + ["a?"]), True),
    (" ".join(["a"] * 60 + ["a?"]), False),
    ("a" * 349 + "?", True),
    ("a" * 350 + "?", False),
    ("Is this so&#63;", True),
    ("[deleted] really?", False),
    ("[removed by mods]?", False),
    ("[ Removed by Reddit ]", False),
    ("No mark", False),
    ("", False),
    (None, False),
    ("　\x1cHow?\x1f ", True),
]


def test_question_rules(spark):
    assert column(spark, [q for q, _ in QUESTIONS], question) == [e for _, e in QUESTIONS]


def test_valid_text(spark):
    values = ["ok", "[Deleted by user]", "[REMOVED]", "[ removed by reddit ]", "[ removed by reddit ] no", " ", None, "&nbsp;"]
    got = column(spark, values, lambda c: tx.is_valid_text(tx.clean_comment_text(c)))
    assert got == [True, False, False, False, True, False, False, False]


def test_clean_post_text(spark):
    cases = [
        ("Hi &amp; bye", "Hi & bye"),
        ("Text submitted by /u/x [link] [comments]", "Text"),
        ("a submitted by b submitted by c [link]", "a"),
        ("submitted by me", "submitted by me"),
        ("&amp;amp;", "&amp;"),
        (None, ""),
        ("", ""),
        ("&notit; &#x80; &#0; &lt &Aacute;", html.unescape("&notit; &#x80; &#0; &lt &Aacute;")),
    ]
    assert column(spark, [c for c, _ in cases], tx.clean_post_text) == [e for _, e in cases]


def test_strip_and_words_match_python(spark):
    rng = random.Random(1)
    alphabet = " \t\n\x0b\x1c\x1f\x85\xa0 　ab​?"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    assert column(spark, values, tx.strip) == [v.strip() for v in values]
    assert column(spark, values, tx.word_count) == [len(v.split()) for v in values]


def test_round4_matches_python(spark):
    pairs = [(d, t) for t in (1, 3, 7, 32, 64, 96, 160, 320, 800, 1600, 20000) for d in range(0, t + 1, max(1, t // 160))]
    pairs += [(-d, t) for d, t in pairs]
    df = spark.createDataFrame(pairs, "d int, t int")
    rows = df.select("d", "t", tx.round4(F.col("d") / F.col("t")).alias("r")).collect()
    assert [(r.d, r.t, r.r) for r in rows if r.r != round(r.d / r.t, 4)] == []


@pytest.mark.parametrize(
    "text, score, label",
    [
        ("good bad", 0.0, "neutral"),
        ("good good bad", 0.3333, "positive"),
        ("Fraud!", -1.0, "negative"),
        ("good " * 33 + "bad " * 31, 0.0312, "neutral"),
        ("", 0.0, "neutral"),
        ("goodness goód best_ GOOD́", 1.0, "positive"),
    ],
)
def test_sentiment(spark, text, score, label):
    df = spark.createDataFrame([(1, text)], "id int, body string")
    row = enrich.analyze(df, "id", "body").first()
    assert (row.sentiment_score, row.sentiment_label) == (score, label)


def test_keyword_examples(spark):
    values = ["don't panic", "The Guardian reports. Guardian wins", None]
    df = spark.createDataFrame(list(enumerate(values)), "id int, body string")
    got = {r.id: r.keywords for r in enrich.analyze(df, "id", "body").collect()}
    assert got == {0: "don, panic", 1: "The Guardian, Guardian, reports, wins", 2: ""}


@pytest.mark.parametrize(
    "text, keywords",
    [
        ("New York New York", "New York New York, new, york"),
        ("New York. Bee bee cat cat cat", "New York, Bee, cat, new, york"),
        ("the fish and the Fish and the dog", "Fish, dog"),
        ("Al Bo Cat", "Cat"),  # capitalised words of two letters are no entities
        ("one two three four five six seven eight", "one, two, three, four, five, six, seven"),
        ("Ann. Bob. Cyd. Dot. Eve. Fay.", "Ann, Bob, Cyd, Dot"),  # top words that are entities are left out
        ("b b b aaa aaa zzz zzz ccc", "aaa, zzz, ccc"),  # ties keep the order of first appearance
        ("dog_x état &amp;amp; Café", "amp"),  # a letter of any script holds a word together
    ],
)
def test_keyword_rules(spark, text, keywords):
    df = spark.createDataFrame([(1, text)], "id int, body string")
    assert enrich.analyze(df, "id", "body").first().keywords == keywords


def test_keyword_properties(spark):
    rng = random.Random(2)
    words = ["New", "York", "The", "cat", "Café", "dog_x", "isn't", "İstanbul", "fish", "état", "Bee", "bee", "1st", "&amp;", "Mc"]
    gaps = [" ", " ", " ", "\n", ". ", "\u3000", "-", "  "]
    values = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, body string")
    for r in enrich.analyze(df, "id", "body").collect():
        found = r.keywords.split(", ") if r.keywords else []
        lower = [k.lower() for k in found]
        assert len(found) <= 7 and not set(lower) & set(STOPWORDS)
        plain = [k for k in found if k == k.lower()]
        assert len(set(plain)) == len(plain) and all(len(k) >= 3 for k in plain)


def test_valence_lexicon_sizes_agree(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "good good bad"), (2, "nothing"), (3, None)], "id int, body string")
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "word string, valence double")
    small = sorted(enrich.valence_sentiment(docs, "id", "body", lexicon).collect())
    monkeypatch.setattr(enrich, "MAX_BROADCAST_WORDS", 1)
    assert sorted(enrich.valence_sentiment(docs, "id", "body", lexicon).collect()) == small
    x = 1.9 * 2 - 2.5
    assert [r[1] for r in small] == [round(x / (x * x + 15) ** 0.5, 4), 0.0, 0.0]


def test_cells(spark):
    df = spark.createDataFrame(
        [(0.0002, True, 1.5), (12345678.9, False, 100.0), (1e7, None, None), (-2.5e-10, True, 0.1)], "a double, b boolean, c double"
    )
    got = [tuple(r) for r in report.format_cells(df).collect()]
    assert got == [("0.0002", "True", "1.5"), ("12345678.9", "False", "100.0"), ("10000000.0", "", ""), ("-0.00000000025", "True", "0.1")]
