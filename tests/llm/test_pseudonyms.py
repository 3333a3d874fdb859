import datetime as dt
import re

import pytest

from gridsight.llm import pseudonyms as p

KEY = b"test key"


@pytest.mark.parametrize("size", [1, 2, 3, 26, 97, 100, 1000])
def test_permutation(size):
    one = p.Permutation(KEY, "x", size)
    values = [one.of(i) for i in range(size)]
    assert sorted(values) == list(range(size))
    assert size == 1 or all(i != v for i, v in enumerate(values))
    assert [one.of(v, -1) for v in values] == list(range(size))
    assert size < 26 or values != [p.Permutation(b"other", "x", size).of(i) for i in range(size)]


VALUES = {
    "card": ["4111 1111 1111 1111", "4952935900253052", "3782-822463-10005"], "ip": ["169.122.221.182", "0.0.0.0"],
    "ssn": ["078-05-1120"], "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
    "phone": ["+1 (017) 555-7713", "(555) 123-4567", "+49 30 1234567", "+442071234567", "555-123-4567"],
    "date": ["2024-02-29", "3/4/1999", "31.12.2001", "1999/01/02", "12-31-1999"],
    "email": ["the.72@mail3.example.com", "Jo_Doe+x@a-b.example.org"],
}
CHECKS = {
    "card": lambda v: p.luhn(re.sub(rb"\D", b"", v)) == 0, "iban": lambda v: p.mod97(v.replace(b" ", b"")[4:] + v[:4]) == 1,
    "ip": lambda v: all(int(x) < 256 for x in v.split(b".")), "email": lambda v: b"@" in v,
    "ssn": lambda v: 0 < int(v[:3]) < 900 and v[:3] != b"666", "phone": lambda v: True,
    "date": lambda v: all(1 <= int(x) <= 31 or 1900 <= int(x) <= 2099 for x in re.split(rb"\D", v)),
}


@pytest.mark.parametrize("kind, value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_format_and_way_back(kind, value):
    text = f"é {value}, and".encode()
    there, back = p.Pseudonyms(KEY), p.Pseudonyms(KEY, -1)
    new, spans = there.replaced(text)
    assert spans == [(kind, 2, 2 + len(value))]
    other = new[3:-5]
    assert other != value.encode() and CHECKS[kind](other) and back.replaced(new)[0] == text
    if kind not in ("iban", "date"):
        shape = lambda v: re.sub(rb"[a-z]", b"a", re.sub(rb"[A-Z]", b"A", re.sub(rb"\d", b"0", v)))
        assert kind == "ip" or shape(other.split(b"@")[0]) == shape(value.encode().split(b"@")[0])
    assert there.replaced(b"again " + value.encode())[0] == b"again " + other, "equal values stay linked"


@pytest.mark.parametrize("text", [
    "", "no numbers", "4111 1111 1111 1112", "10.1.1.300", "1.2.3.4.5", "v1.02.3.4", "2023-02-29", "45/45/2000", "000-12-3456",
    "DE00 3704 0044 0532 0130 00", "a4111111111111111", "4111111111111111é", "1234-5678", "room 555", "user@host", "1899-01-01",
])
def test_invalid_values_stay(text):
    assert p.Pseudonyms(KEY).replaced(text.encode()) == (text.encode(), [])


@pytest.mark.parametrize("text, kinds", [
    ("4451718024887799 27.65.93.188 A", ["card", "ip"]), ("+1 (017) 555-7713 4111 1111 1111 1111", ["phone", "card"]),
    ("DE89 3704 0044 0532 0130 00 THE 2024 END 10.0.0.1", ["iban", "ip"]), ("4111 1111 1111 1112 4111-1111-1111-1111", ["card"]),
    ("+49 30 1234567 1.2.3.4 a@b.org 078-05-1120", ["phone", "ip", "email", "ssn"]),
])
def test_values_side_by_side(text, kinds):
    new, spans = p.Pseudonyms(KEY).replaced(text.encode())
    assert [s[0] for s in spans] == kinds and p.Pseudonyms(KEY, -1).replaced(new)[0] == text.encode()


@pytest.mark.parametrize("before, after", [
    ("“", "”"), ("«", "»"), ("\u00a0", "\u00a0"), ("\u202f", "\u202f"), ("—", "—"), ("–", "…"), ("…", "°"), ("：", "。"), ("（", "）"),
    ("地址", "的"), ("は", "です"), ("주소", "에서"), ("ที่อยู่", "ครับ"), ("nº", "²"), ("•", "™"), ("\U0001f4de", "\ufe0f"), ("...", "…"), ("--", ""),
])
@pytest.mark.parametrize("kind, value", [(k, v) for k, vs in VALUES.items() if k != "email" for v in vs])
def test_neighbours_beyond_ascii(kind, value, before, after):
    text = f"at {before}{value}{after} x"
    new, spans = p.Pseudonyms(KEY).replaced(text.encode())
    assert spans == [(kind, 3 + len(before), 3 + len(before) + len(value))]
    assert p.Pseudonyms(KEY, -1).replaced(new)[0] == text.encode()


@pytest.mark.parametrize("text", [
    "é10.1.2.3", "10.1.2.3é", "ж10.1.2.3", "10.1.2.3α", "e\u030110.1.2.3", "４10.1.2.3", "10.1.2.3４", "ש10.1.2.3", "é.10.1.2.3", "é-10.1.2.3",
    "v.10.1.2.3", "4111 1111 1111 1111é", "é+49 30 1234567", "ß2024-02-29",
])
def test_parts_of_words_stay(text):
    assert p.Pseudonyms(KEY).replaced(text.encode()) == (text.encode(), [])


def test_dates_cover_the_calendar():
    names = p.Pseudonyms(KEY)
    days = [dt.date(1900, 1, 1) + dt.timedelta(i) for i in range(0, 73_049, 37)]
    out = {names.of("date", d.isoformat().encode()) for d in days}
    assert len(out) == len(days) and all(dt.date.fromisoformat(o.decode()) for o in out)


def test_table(spark):
    rows = [(1, "card 4111 1111 1111 1111", "a", 0), (1, "4111111111111111 x", "b", 0), (2, None, "c", 0), (3, "", "d", 0), (4, "clean é", "e", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, kind int")
    got = {r.spans: r for r in p.pseudonymised(docs, KEY).collect()}
    digits = lambda t: re.sub(r"\D", "", t)
    assert digits(got["a"].text) == digits(got["b"].text) != "4111111111111111"
    assert got["c"].text is None and got["d"].text == "" and got["e"].text == "clean é" and got["e"]["values"] == []
    back = p.pseudonymised(p.pseudonymised(docs, KEY).drop("values"), KEY, step=-1)
    assert sorted((r.spans, r.text) for r in back.collect()) == sorted((s, t) for _, t, s, _ in rows)
    assert p.pseudonymised(docs.limit(0), KEY).count() == 0


def test_long_text():
    text = ("word " * 200_000 + "169.122.221.182 " + "word " * 200_000).encode()
    new, spans = p.Pseudonyms(KEY).replaced(text)
    assert [s[:2] for s in spans] == [("ip", 1_000_000)] and len(spans) == 1 and new != text
