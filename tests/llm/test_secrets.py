"""Secret scans against Python's matcher and hand-made credentials."""

import random
import re

import pytest

from strata.llm import secrets
from strata.llm.secrets import STRONG, WEAK, scan

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = [*STRONG, *WEAK]


def base_by_hand(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def found(spark, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = sorted(scan(docs, **more).collect())
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    return rows


def weak(row, text):
    return [(KINDS[s.kind], text[s.start : s.end]) for s in row.spans if s.kind >= len(STRONG)]


ID = "user = jane_doe"
SHORT = "password: abc"
KEY = "Zx9Qw8Er7Ty6Ui5Op4As3"
URL = "https://db.example.org:5432/x"


def test_base_like_pythons_matcher(spark):
    rng = random.Random(2)
    parts = ["secret", "TOKEN=", "api_key", "ApiKey: '", "passwd", '"', "'", " ", ":", "=", "abcdefgh", "AKIA", "AKIAABCDEFGH1234", "é𝒳", "0123456789abcdef" * 2, "\n", "\n\n", "x", "ſecret=12345678", "toKen=12345678"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [None, "", "secret: token: abcdefgh", "secret" + " " * 3000 + "=" + " " * 3000 + "abcdefgh", "token=" * 5000, "é" * 100 + "token=abcdefgh"]
    rows = found(spark, texts)
    for row, text in zip(rows, texts, strict=True):
        assert [(s.start, s.kind, s.end) for s in row.base] == base_by_hand(text)
        assert set(row.base) <= set(row.spans) and row.spans == sorted(row.spans)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (ID, []),
        (SHORT, []),
        (KEY, []),
        (URL, []),
        (f"{ID}\n{SHORT}", [("identifier", ID), ("short", SHORT)]),
        (f"{ID}\n\n{SHORT}", []),
        (f"{ID}\n \t\r\n{SHORT}", []),
        (ID + "!" * 200 + SHORT, [("identifier", ID), ("short", SHORT)]),
        (ID + "!" * 201 + SHORT, []),
        (f"{URL} {KEY}", [("key", KEY)]),
        (f"{URL} {ID}", []),
        (f"{URL} {ID} {KEY}", [("endpoint", URL), ("identifier", ID), ("key", KEY)]),
        (f"host: db1 {SHORT}", [("short", SHORT)]),
        ("AKIAABCDEFGH1234 password=abc", [("short", "password=abc")]),
        (f"{ID} token = abcdefghij", [("identifier", ID)]),
        (f"{ID} token = {KEY}", [("identifier", ID)]),
        ("user=ab " + SHORT, []),
    ],
)
def test_weak_parts_need_their_complements(spark, text, expected):
    row, after = found(spark, [text, "é" * 7 + " " + text])
    assert weak(row, text) == expected
    assert [(s.kind, s.start, s.end) for s in after.spans] == [(s.kind, s.start + 8, s.end + 8) for s in row.spans]


def test_many_spans_in_one_text(spark, monkeypatch):
    monkeypatch.setattr(secrets, "STEPS", 7)
    text = "".join(f"é user=u{k:05} token=abc{k:09} x\n" for k in range(2000))
    (row,) = found(spark, [text])
    assert [(s.start, s.kind, s.end) for s in row.base] == base_by_hand(text)
    assert weak(row, text) == [("identifier", f"user=u{k:05}") for k in range(2000)]


def test_long_text_is_quick(spark):
    text = "lorem ipsum " * 100_000 + ID + " " + SHORT + "\n" + "A" * 200_000 + " " + "token=abcdefgh " * 40_000
    (row,) = found(spark, [text])
    assert [(s.start, s.kind, s.end) for s in row.base] == base_by_hand(text)
    assert weak(row, text)[:2] == [("identifier", ID), ("short", SHORT)]


def test_copies_null_keys_clashing_columns_and_empty(spark):
    text = f"{ID} {SHORT}"
    docs = spark.createDataFrame(
        [(None, text, "x", 1)] * 3 + [(5, text, "y", 2)] * 2 + [(5, None, None, None)], "doc_id long, text string, digest string, base int"
    )
    rows = scan(docs).collect()
    assert sorted((r.doc_id is None, len(r.spans)) for r in rows) == [(False, 0), (False, 2), (False, 2)] + [(True, 2)] * 3
    assert scan(docs.limit(0)).collect() == []


def test_no_python_on_the_path(spark):
    docs = spark.createDataFrame([(1, f"{ID} {SHORT}")], "doc_id long, text string")
    plan = scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "RDD" not in plan.replace("Scan ExistingRDD", "")
