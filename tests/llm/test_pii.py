"""Base spans against the plain patterns, added spans and redaction on small texts."""

import hashlib
import re

from hypothesis import given, settings, strategies as st

from tests.conftest import SF_SMALL
from threadlens.llm import pii as P

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def slow(text):
    return [(k, m.start(), m.end()) for k, name in enumerate(P.KINDS) for m in re.finditer(BASE[name], text or "") if good(name, m[0])]


CASES = [
    None, "", "@", "a@b", "a@b.c", "x a.b%c@d-e.f.g, z", "a@b.com%x@c.org", "a@b.c@d.e.f", "é@b.co 𝄞 q@r.st", "..@-.-", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 255.0255.0.00001",
    "999999999999999999999.1.1.1", "4111 1111-1111 1111", "4111  111111111111", "0000000000000", "+1 (988) 555-2485", "+1 12345678 ", "+1-------9", "++12345678901", "+123456789012345 6", "+1.2.3.4.5.6.7.8.9",
    "a" * 50_000 + "@", "1" * 50_000, "+1" + " " * 20_000, "1-" * 20_000 + "1", "1.1.1.1 " * 300, "mail me: joe [at] example [dot] com or call 555 123-4567 now",
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, kind int")


def test_base_spans(spark):
    docs = frame(spark, CASES).union(spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id + 1000", "text", "1"))
    detector = P.fit(docs)
    rows = P.detect(docs, detector).selectExpr("*").select("doc_id", "text", "_base", "_all", P.listed(P.F.col("_base")).alias("s")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = slow(r.text)
        assert [tuple(s) for s in r._base] == want, r.text
        assert set(want) <= {tuple(s) for s in r._all}
        added = [s for s in r._all if tuple(s) not in want]
        assert not any(a.start < e and s < a.end for a in added for _, s, e in want)
        assert hashlib.sha256(r.s.encode()).hexdigest() == hashlib.sha256(",".join(f"{P.KINDS[k]}:{s}:{e}" for k, s, e in want).encode()).hexdigest()


def test_random_text(spark):
    texts = []
    piece = st.sampled_from(["1", "23", "4", "255", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "%", "é", "\n", "4111111111111111", "1.2.3.4", "+1 555 123 4567"])

    @settings(max_examples=600, deadline=None, database=None)
    @given(st.lists(piece, max_size=25))
    def gather(parts):
        texts.append("".join(parts))

    gather()
    for r in P.base_spans(frame(spark, texts)).collect():
        got = [(k, s.start, s.start + len(s.value)) for k, name in enumerate(P.KINDS) for s in r[f"_b_{name}"]]
        assert got == slow(r.text), r.text


def test_added_spans_and_redaction(spark):
    hit = [f"call me at +1 (555) 010-{1000 + i} or write to u{i}@mail{i}.example.com from 10.0.{i % 250}.7" for i in range(150)]
    miss = [f"in version 1.{i} we sold 12 345 678 of {i} on 2021-0{i % 9 + 1}-11 10:15:{10 + i % 50}" for i in range(150)]
    train = frame(spark, hit + miss)
    detector = P.fit(train)
    assert detector is not None
    rows = {r.doc_id: r for r in P.detect(train, detector).collect()}
    assert all(rows[i]._all == rows[i]._base for i in range(150, 300))
    texts = P.redact(train, detector).collect()
    assert "call me at <phone> or write to <email> from <ip>" in {r.text for r in texts}
    assert {r.text for r in texts if r.doc_id >= 150} == set(miss)


def test_empty_and_none(spark):
    docs = frame(spark, ["plain"])
    assert P.fit(docs) is None and P.fit(docs.limit(0)) is None
    assert P.detect(docs, None).first()._all == [] and P.detect(docs.limit(0), None).count() == 0
