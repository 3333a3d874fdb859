"""Format-preserving pseudonyms of personal numbers and dates.

Validated values are replaced by others of the same format under a keyed permutation of that format's
values: equal values get equal pseudonyms in every document, different ones different, none its own, and
who has the key can turn them back. The permutation is a Feistel network over the format's value count.

Kinds: ``card`` (13-19 digits, Luhn), ``iban`` (mod 97), ``ssn`` (issued ranges), ``ip`` (four octets),
``phone`` (8-15 digits in a written form), ``date`` (calendar days of 1900-2099, year first or last) and
``email`` (the part before the @ is permuted letter for letter and digit for digit; the domain stays).
Separators, letter case and check digits keep their form. Anything that fails its check stays, and so does
a number that is part of a longer word: one beside a letter or digit, or after a letter or digit and one of
``.``, ``-`` and ``+``. Punctuation, spaces and signs of any kind and letters of scripts without spaces end
a word.

Cases: a NULL text stays NULL, an empty one empty, both without values; repeated documents are treated
alike; an empty table gives no rows. A document's other columns are kept and never used; one named like
the result is replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsight.llm.common import unused, utf8

ROUNDS = 10
#: Values beyond which a permutation is not remembered.
REMEMBERED = 1 << 16

_EDGE = rb"0-9A-Za-z_"
#: What is beyond ASCII on either side is judged by ``_joined``.
_PATTERN = re.compile(
    rb"(?<![" + _EDGE + rb"])(?<![" + _EDGE + rb"][.+-])(?:"
    rb"(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?!\.?\d)"
    rb"|(?P<date>\d{4}(?P<d1>[-/.])\d{1,2}(?P=d1)\d{1,2}|\d{1,2}(?P<d2>[-/.])\d{1,2}(?P=d2)\d{4})(?![-/]?\d)"
    rb"|(?P<ssn>\d{3}-\d{2}-\d{4})(?!-?\d)"
    rb"|(?P<phone>\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    rb"|\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]\d{1,4}|\d{2,4})(?:[ .-]?\d{2,4}){1,4}"
    rb"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}(?P<d3>[ .-])\d{3}(?P=d3)\d{4})(?![-.]?\d)"
    rb"|(?P<card>\d{13,19}|\d{4}(?P<d4>[ -])\d{4}(?P=d4)\d{4}(?P=d4)\d{1,4}(?:(?P=d4)\d{1,3})?|\d{4}(?P<d5>[ -])\d{6}(?P=d5)\d{5})"
    rb"|(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30})"
    rb")(?![" + _EDGE + rb"])")
_EMAIL = re.compile(
    rb"(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?"
    rb"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])")
_DIGIT = re.compile(rb"[0-9]")
_FIRST = re.compile(rb"[+(]*[0-9A-Z]+")
_LETTERS, _DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"0123456789"

_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
_SSN_AREAS = [a for a in range(1, 900) if a != 666]


def _shorter(kind: str, value: bytes) -> Iterator[bytes]:
    """The value, and what is left of it as words at its end, which may be others', are taken off."""
    yield value
    if kind in ("phone", "iban", "card"):
        while (cut := max(value.rfind(b" "), value.rfind(b"-"), value.rfind(b"."))) > 0:
            value = value[:cut]
            yield value


#: Letters of scripts that put no spaces between words, or add endings to a number: Thai to Tibetan, Burmese,
#: Hangul, Khmer, Chinese and Japanese, Yi, their compatibility forms; and the ordinal marks.
_UNSPACED = (
    (0xAA, 0xAA), (0xBA, 0xBA), (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1100, 0x11FF), (0x1780, 0x17FF), (0x2E80, 0xA4CF),
    (0xA960, 0xA97F), (0xAC00, 0xD7FF), (0xF900, 0xFAFF), (0xFE30, 0xFE4F), (0xFF65, 0xFFDC), (0x20000, 0x3FFFF))


def _joined(char: str) -> bool:
    """Whether a character beyond ASCII makes a number beside it part of a word: digits do, and letters of
    scripts that part words by spaces."""
    kind = unicodedata.category(char)
    if kind == "Nd":
        return True
    return kind in ("Lu", "Ll", "Lt", "Lo") and not any(low <= ord(char) <= high for low, high in _UNSPACED)


def _joined_before(text: bytes, at: int) -> bool:
    if at and text[at - 1] in b".+-":
        at -= 1
    while at and text[at - 1] >= 0x80:
        start = at - 1
        while start and text[start] & 0xC0 == 0x80 and at - start < 4:
            start -= 1
        char = text[start:at].decode("utf-8", "replace")[-1]
        if unicodedata.category(char) not in ("Mn", "Mc"):
            return _joined(char)
        at = start  # marks belong to the letter before them
        if at and text[at - 1:at].isalnum():
            return True
    return False


def _joined_after(text: bytes, at: int) -> bool:
    return text[at:at + 1] >= b"\x80" and _joined(text[at:at + 4].decode("utf-8", "replace")[0])


class Permutation:
    """A keyed permutation of 0..size-1 without fixed points (for two values or more): a Feistel
    network, one step on, and the network back."""

    def __init__(self, key: bytes, label: str, size: int) -> None:
        self.size = size
        self._left = isqrt(size - 1) + 1 if size > 1 else 1
        self._right = -(-size // self._left)
        self._base = hashlib.blake2b(f"{label}|{size}".encode(), key=key, digest_size=32).digest()

    def _round(self, number: int, half: int) -> int:
        data = number.to_bytes(1, "big") + half.to_bytes(32, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self._base, digest_size=32).digest(), "big")

    def _through(self, value: int, back: bool) -> int:
        while True:
            left, right = divmod(value, self._right)
            for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if number % 2:
                    right = (right + sign * self._round(number, left)) % self._right
                else:
                    left = (left + sign * self._round(number, right)) % self._left
            value = left * self._right + right
            if value < self.size:
                return value

    def of(self, value: int, step: int = 1) -> int:
        return self._through((self._through(value, False) + step) % self.size, True)


class Pseudonyms:
    """The pseudonym of a written value, or None where it is not valid; ``step`` -1 turns back."""

    def __init__(self, key: bytes, step: int = 1) -> None:
        self._key, self._step = key, step
        self._permutation: Callable = lru_cache(1024)(lambda label, size: Permutation(key, label, size))
        self.of: Callable[[str, bytes], bytes | None] = lru_cache(REMEMBERED)(self._of)

    def _of(self, kind: str, value: bytes) -> bytes | None:
        return getattr(self, "_" + kind)(value)

    def _moved(self, label: str, size: int, value: int) -> int:
        return self._permutation(label, size).of(value, self._step) if size > 1 else value

    def _text(self, label: str, text: bytes) -> bytes:
        """Letters to letters of their case and digits to digits, the rest as it is."""
        radix = [26 if c in _LETTERS or c + 32 in _LETTERS else 10 if c in _DIGITS else 1 for c in text]
        size = value = 0
        total = 1
        for r in radix:
            total *= r
        for c, r in zip(text, radix):
            value = value * r + (_LETTERS.index(c | 32) if r == 26 else c - 48 if r == 10 else 0)
        size = total
        value = self._moved(f"{label}|{bytes(radix).hex()}", size, value)
        out = bytearray(text)
        for i in range(len(text) - 1, -1, -1):
            value, digit = divmod(value, radix[i])
            if radix[i] == 26:
                out[i] = _LETTERS[digit] - (32 if text[i] < 97 else 0)
            elif radix[i] == 10:
                out[i] = 48 + digit
        return bytes(out)

    @staticmethod
    def _filled(form: bytes, digits: bytes) -> bytes:
        source = iter(digits)
        return bytes(next(source) if 48 <= c <= 57 else c for c in form)

    def _card(self, value: bytes) -> bytes | None:
        digits = b"".join(_DIGIT.findall(value))
        if not 13 <= len(digits) <= 19 or len(set(re.sub(rb"\d", b"", value))) > 1 or luhn(digits):
            return None
        body = self._text("card", digits[:-1])
        return self._filled(value, body + b"%d" % (-luhn(body + b"0") % 10))

    def _iban(self, value: bytes) -> bytes | None:
        plain = value.replace(b" ", b"")
        if not 15 <= len(plain) <= 34 or mod97(plain[4:] + plain[:4]) != 1:
            return None
        body = self._text("iban" + plain[:2].decode(), plain[4:])
        check = b"%02d" % (98 - mod97(body + plain[:2] + b"00"))
        source = iter(plain[:2] + check + body)
        return bytes(32 if c == 32 else next(source) for c in value)

    def _ssn(self, value: bytes) -> bytes | None:
        area, group, serial = (int(x) for x in value.split(b"-"))
        if area == 0 or area == 666 or area > 899 or not group or not serial:
            return None
        at = (_SSN_AREAS.index(area) * 99 + group - 1) * 9999 + serial - 1
        at, serial = divmod(self._moved("ssn", len(_SSN_AREAS) * 99 * 9999, at), 9999)
        area, group = divmod(at, 99)
        return b"%03d-%02d-%04d" % (_SSN_AREAS[area], group + 1, serial + 1)

    def _ip(self, value: bytes) -> bytes | None:
        octets = [int(x) for x in value.split(b".")]
        if max(octets) > 255 or b".".join(b"%d" % o for o in octets) != value:
            return None
        return b".".join(b"%d" % o for o in self._moved("ip", 1 << 32, int.from_bytes(bytes(octets), "big")).to_bytes(4, "big"))

    def _phone(self, value: bytes) -> bytes | None:
        code = re.match(rb"\+(?:1(?=\D|\d{10})|\d{1,3}(?=\D)|\d\d)|", value)[0]
        digits = b"".join(_DIGIT.findall(value[len(code):]))
        if not 8 <= len(digits) + len(code) - code.count(b"+") <= 15 or len(digits) < 6:
            return None
        return code + self._filled(value[len(code):], self._text("phone" + code.decode(), digits))

    def _date(self, value: bytes) -> bytes | None:
        mark = re.search(rb"\D", value)[0]
        parts = value.split(mark)
        for order in ("ymd",) if len(parts[0]) == 4 else ("mdy", "dmy"):
            year, month, day = (int(parts[order.index(c)]) for c in "ymd")
            if not 1900 <= year <= 2099:
                return None
            try:
                at = dt.date(year, month, day).toordinal()
            except ValueError:
                continue
            while True:  # a day that would read as month first is no pseudonym of one that does not
                at = _FIRST_DAY + self._moved("date", _LAST_DAY - _FIRST_DAY + 1, at - _FIRST_DAY)
                found = dt.date.fromordinal(at)
                if order != "dmy" or found.day > 12:
                    break
            fields = {"y": b"%04d" % found.year, "m": b"%d" % found.month, "d": b"%d" % found.day}
            padded = any(len(p) == 2 and p[:1] == b"0" for p in parts) or all(len(p) >= 2 for p in parts)
            return mark.join(fields[c].rjust(2, b"0") if padded else fields[c] for c in order)
        return None

    def _email(self, value: bytes) -> bytes | None:
        local, _, domain = value.partition(b"@")
        return self._text("email" + domain.decode().lower(), local) + b"@" + domain

    def found(self, text: bytes) -> Iterator[tuple[int, int, str, bytes]]:
        """(start, end, kind, pseudonym) of every valid value, in bytes and in order; where two overlap,
        the one that begins first."""
        hits = []
        if b"@" in text:
            hits += [(m.start(), m.end(), "email", m[0]) for m in _EMAIL.finditer(text)]
        at = 0
        while _DIGIT.search(text, at) and (m := _PATTERN.search(text, at)):
            value = None
            if not _joined_before(text, m.start()):
                whole = not _joined_after(text, m.end())
                value = next((
                    v for v in _shorter(m.lastgroup, m[0])
                    if (whole or len(v) < len(m[0])) and self.of(m.lastgroup, v) is not None), None)
            if value is None:
                at = m.start() + len(_FIRST.match(m[0])[0])
            else:
                at = m.start() + len(value)
                hits.append((m.start(), at, m.lastgroup, value))
        end = 0
        for start, stop, kind, value in sorted(hits):
            if start >= end and (new := self.of(kind, value)) is not None:
                yield start, stop, kind, new
                end = stop

    def replaced(self, text: bytes) -> tuple[bytes, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and kind, start and end of each value in it in code points."""
        out, spans, at, points = [], [], 0, 0
        for start, end, kind, new in self.found(text):
            points += code_points(text[at:start])
            spans.append((kind, points, points + end - start))
            points += end - start
            out += [text[at:start], new]
            at = end
        return b"".join([*out, text[at:]]), spans


def code_points(text: bytes) -> int:
    return len(text.translate(None, bytes(range(0x80, 0xC0))))


def luhn(digits: bytes) -> int:
    """The check sum of a card number mod 10; 0 for a valid one."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = (c - 48) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def mod97(text: bytes) -> int:
    return int("".join(str(int(chr(c), 36)) for c in text)) % 97


_RESULT = pa.struct([
    ("text", pa.binary()),
    ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
])


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text", into: str = "values", step: int = 1) -> DataFrame:
    """The documents with pseudonyms in their text and an array ``into`` of the values' kinds and
    places in the original text. ``step=-1`` with the same key turns pseudonyms back."""

    @F.arrow_udf("struct<text:binary,spans:array<struct<kind:string,start:bigint,end:bigint>>>")
    def replace(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = Pseudonyms(key, step)
        for texts in batches:
            out = []
            for content in texts.to_pylist():
                new, spans = names.replaced(content)
                out.append({"text": new if spans else None,
                            "spans": [{"kind": k, "start": s, "end": e} for k, s, e in spans]})
            yield pa.array(out, _RESULT)

    changed = unused(docs, "_changed")
    return docs.withColumn(changed, replace(utf8(text))).withColumn(
        text, F.coalesce(F.col(f"{changed}.text").cast("string"), F.col(text))
    ).withColumn(into, F.col(f"{changed}.spans")).drop(changed)
