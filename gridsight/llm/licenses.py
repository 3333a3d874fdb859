"""License scans by conditional compression.

A stretch of a text around a stem of licence wording is a candidate block for every template that has the
stem: as long as the template, laid so that the stems meet. The block is compressed alone and with the
template as zstandard raw dictionary; templates are ranked by the size that the dictionary saves. Ranked
winners are confirmed by the exact differences in wording between block and template: words added, left
out or changed, and no change of a number or of what is forbidden or allowed.

Cases: a NULL, empty or wordless text has no licences; texts are scanned whole; repeated documents are
scanned one by one; an empty table gives no rows. A document's other columns are kept and never used; one
named like the result is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsight.llm.common import utf8

def _free_notice(what: str, terms: str, version: str) -> str:
    """The notice that the GNU licences ask for in a source file."""
    mark = ":" if version == "3" else ";"
    stop = "," if version == "3" else ";"
    return (
        f"This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {terms} as "
        f"published by the Free Software Foundation{stop} either version {version} of the License, or (at your option) any "
        f"later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        f"{terms} for more details.")


def _gnu_opening(title: str, date: str, first: str) -> str:
    return (
        f"GNU {title} PUBLIC LICENSE Version 3, {date} Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> "
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not "
        f"allowed. {first}")


def _bsd(marks: tuple[str, str, str], endorse: bool) -> str:
    """The BSD text under the marks of its list; three clauses or two."""
    one, two, three = (f"{m} " if m else "" for m in marks)
    clause = (
        f"{three}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. ") if endorse else ""
    return (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        f"following conditions are met: {one}Redistributions of source code must retain the above copyright notice, this "
        f"list of conditions and the following disclaimer. {two}Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        f"provided with the distribution. {clause}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE.")


_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_NUMBERED, _MARKED = ("1.", "2.", "3."), ("*", "*", "*")

#: Wording of common notices and licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "all-rights-reserved": "All rights reserved.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
        "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "GPL-2.0-notice": _free_notice("program", _GPL, "2"),
    "LGPL-2.0-notice": _free_notice("library", "Library " + _GPL, "2"),
    "LGPL-2.1-notice": _free_notice("library", _LGPL, "2.1"),
    "LGPL-3.0-notice": _free_notice("program", _LGPL, "3"),
    "AGPL-3.0-notice": _free_notice("program", _AGPL, "3"),
    "GPL-2.0-only-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License version 2 as published by the Free Software Foundation."),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0."),
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-NC-ND-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "BSD-2-Clause-text": _bsd(_NUMBERED, False),
    "BSD-2-Clause-text-marked": _bsd(_MARKED, False),
    "BSD-3-Clause-text": _bsd(_NUMBERED, True),
    "BSD-3-Clause-text-marked": _bsd(_MARKED, True),
    "Apache-2.0-text": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, "
        "reproduction, and distribution as defined by Sections 1 through 9 of this document. \"Licensor\" shall mean the "
        "copyright owner or entity authorized by the copyright owner that is granting the License."),
    "MPL-2.0-text": (
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that "
        "creates, contributes to the creation of, or owns Covered Software. 1.2. \"Contributor Version\" means the "
        "combination of the Contributions of others (if any) used by a Contributor and that particular Contributor's "
        "Contribution."),
    "GPL-2.0-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-2.0-preamble": (
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU "
        "General Public License is intended to guarantee your freedom to share and change free software--to make sure the "
        "software is free for all its users. This General Public License applies to most of the Free Software Foundation's "
        "software and to any other program whose authors commit to using it."),
    "LGPL-2.1-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-2.1-preamble": (
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU "
        "General Public Licenses are intended to guarantee your freedom to share and change free software--to make sure the "
        "software is free for all its users. This license, the Lesser General Public License, applies to some specially "
        "designated software packages--typically libraries--of the Free Software Foundation and other authors who decide "
        "to use it."),
    "GPL-3.0-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-3.0-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "AGPL-3.0-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "GPL-3.0-text": _gnu_opening(
        "GENERAL", "29 June 2007",
        "Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    "LGPL-3.0-text": _gnu_opening(
        "LESSER GENERAL", "29 June 2007",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the "
        "GNU General Public License, supplemented by the additional permissions listed below."),
    "AGPL-3.0-text": _gnu_opening(
        "AFFERO GENERAL", "19 November 2007",
        "Preamble The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software."),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions"),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author "
        "or authors of this software dedicate any and all copyright interest in the software to the public domain."),
}
#: Stems that mark candidate blocks; every template has one at least.
STEMS = (b"licen", b"copyright", b"permission", b"warrant", b"redistribut", b"all rights")
#: Least share of a block's compressed size that the template must save; most words that may differ for
#: each of the template's, and the number that may whatever the template's length.
MIN_REDUCTION, MAX_DIFFERENT, LEAST_DIFFERENT = 0.35, 0.1, 1
#: Templates of so few words may have words between theirs but none of theirs changed.
FIXED_WORDS = 3
#: Words whose change makes another licence of it.
_DECISIVE = re.compile(r"\d|^(not|no|never|without|with|may|must|shall|except|only|nc|nd|sa|by|non|noncommercial|sharealike|noderivatives|mit|bsd|apache|gnu|lesser|affero|mozilla|cc)$")

#: Templates whose place takes in the copyright statement beside them, and the forms of that statement
#: before and after: marks, years, holder. Its words are no differences.
STATED = frozenset(("all-rights-reserved",))
_MARK = rb"(?:(?i:\bcopyright\b)|\xc2\xa9|\([cC]\)|&copy;)"
_MARKS = _MARK + rb"(?:[ \t]*" + _MARK + rb")*[ \t,:.]*"
_STATED_BEFORE = re.compile(
    _MARKS + rb"(?:(?:[0-9]{4}|(?i:by)\b|[A-Z\xc3-\xf4\"'<\[{])[^\n]*)?(?:\r?\n[ \t#*/;-]*)?\Z")
_STATED_AFTER = re.compile(
    rb"[ \t.,;|]*" + _MARKS + rb"[0-9]{4}(?:[ \t]*[-,][ \t]*[0-9]{4})*"
    rb"(?:[ \t,]+(?:(?i:by)[ \t]+)?[A-Z\xc3-\xf4][^\s.,;]*(?:[ \t]+[A-Z&\xc3-\xf4][^\s.,;]*)*)?")
#: Most words and bytes of a statement before.
_STATED_WORDS, _STATED_BYTES = 16, 200

_STEM = re.compile(b"|".join(STEMS))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Match(NamedTuple):
    name: str
    start: int
    end: int
    reduction: float
    differences: int
    changes: list[str]


class _Template:
    def __init__(self, name: str, text: str) -> None:
        plain = text.encode().translate(_LOWER)
        self.name = name
        self.words = [w.decode() for w in _WORD.findall(plain)]
        self.may_differ = max(int(MAX_DIFFERENT * len(self.words)), LEAST_DIFFERENT)
        self.fixed = frozenset(self.words) if len(self.words) <= FIXED_WORDS else frozenset()
        self.counts = Counter(self.words)
        self.stems: dict[bytes, list[int]] = {}
        starts = [m.start() for m in _WORD.finditer(plain)]
        for found in _STEM.finditer(plain):
            at = max(i for i, s in enumerate(starts) if s <= found.start())
            self.stems.setdefault(found[0], []).append(at)
        if not self.stems:
            raise ValueError(f"template {name} has none of the stems that mark candidate blocks")
        body = " ".join(self.words).encode()
        self._alone = zstandard.ZstdCompressor(level=19, write_content_size=False)
        self._given = zstandard.ZstdCompressor(
            level=19, write_content_size=False,
            dict_data=zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    def reduction(self, block: bytes) -> float:
        """The share of the block's compressed size that the template saves."""
        alone = len(self._alone.compress(block))
        return 1 - len(self._given.compress(block)) / alone


class Scanner:
    def __init__(self, templates: dict[str, str]) -> None:
        self.templates = [_Template(n, t) for n, t in templates.items()]

    def scan(self, text: bytes) -> list[Match]:
        """Confirmed licences in page order, places in code points; of overlapping ones the best."""
        plain = text.translate(_LOWER)
        if not any(stem in plain for stem in STEMS):
            return []
        places = [m.span() for m in _WORD.finditer(plain)]
        words = [plain[s:e].decode("utf-8", "replace") for s, e in places]
        starts = [s for s, _ in places]
        found: dict[tuple[str, int], Match] = {}
        tried = set()
        for stem in _STEM.finditer(plain):
            at = _last_at_most(starts, stem.start())
            for template in self.templates:
                for inside in template.stems.get(stem[0], ()):
                    first, size = at - inside, len(template.words)
                    if (template.name, first) in tried:
                        continue
                    tried.add((template.name, first))
                    if (match := self._judge(template, words, first, size)) is not None:
                        found.setdefault((template.name, match.start), match)
        ranked = sorted(found.values(), key=lambda m: (5 * m.differences - m.reduction * (m.end - m.start), m.start, m.name))
        chosen: list[Match] = []
        for match in ranked:
            if all(match.end <= c.start or c.end <= match.start for c in chosen):
                chosen.append(match)
        out: list[Match] = []
        chosen.sort(key=lambda m: m.start)
        edges = [(places[m.start][0], places[m.end - 1][1]) for m in chosen]
        done = 0
        for nth, (match, (start, end)) in enumerate(zip(chosen, edges)):
            if match.name in STATED:
                start, end = _with_statement(text, start, end, done, edges[nth + 1][0] if nth + 1 < len(edges) else len(text))
            out.append(match._replace(start=_points(text[:start]), end=_points(text[:end])))
            done = end
        return out

    def _judge(self, template: _Template, words: list[str], first: int, size: int) -> Match | None:
        """The match, if its wording differs little enough and the template saves enough of it. Its edges
        are the first and last words that agree with the template's, widened by what the template has
        before and after them."""
        slack = max(size // 10, LEAST_DIFFERENT)
        begin, end = max(first - slack, 0), min(first + size + slack, len(words))
        block, mine = words[begin:end], template.words
        if len(block) < size - template.may_differ or (template.counts - Counter(block)).total() > template.may_differ:
            return None  # more of the template's words are missing than may differ
        steps = SequenceMatcher(None, mine, block, autojunk=False).get_opcodes()
        equal = [s for s in steps if s[0] == "equal"]
        if not equal:
            return None
        low = max(equal[0][3] - equal[0][1], 0)
        high = min(equal[-1][4] + len(mine) - equal[-1][2], len(block))
        reduction = template.reduction(" ".join(block[low:high]).encode())
        if reduction < MIN_REDUCTION:
            return None
        return self._confirm(template, block[low:high], begin + low, reduction)

    def _confirm(self, template: _Template, block: list[str], begin: int, reduction: float) -> Match | None:
        mine = template.words
        changes, count = [], 0
        for kind, a, b, c, d in SequenceMatcher(None, mine, block, autojunk=False).get_opcodes():
            if kind != "equal":
                old, new = mine[a:b], block[c:d]
                around = mine[a - 1:a + 1] if a == b and 0 < a < len(mine) else []
                if any(_DECISIVE.search(w) for w in old + new) or not template.fixed.isdisjoint(old):
                    return None
                if around and all(_DECISIVE.search(w) for w in around):
                    return None  # a word inside a name: CC BY-XX 4.0
                count += max(len(old), len(new))
                changes.append(f"{' '.join(old)}>{' '.join(new)}")
        if count > template.may_differ:
            return None
        return Match(template.name, begin, begin + len(block), round(reduction, 6), count, changes)


def _with_statement(text: bytes, start: int, end: int, least: int, most: int) -> tuple[int, int]:
    """The place widened by the copyright statement that stands beside it, between two bounds."""
    least = max(least, start - _STATED_BYTES)
    at = least
    while found := _STATED_BEFORE.search(text[:start], at):
        if len(_WORD.findall(found[0].translate(_LOWER))) <= _STATED_WORDS:
            start = found.start()
            break
        at = found.start() + 1
    if (found := _STATED_AFTER.match(text, end, most)) is not None:
        end = found.end()
    return start, end


def _last_at_most(starts: list[int], value: int) -> int:
    return max(bisect_right(starts, value) - 1, 0)


def _points(text: bytes) -> int:
    return len(text.translate(None, bytes(range(0x80, 0xC0))))


_RESULT = pa.list_(pa.struct([
    ("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reduction", pa.float64()),
    ("differences", pa.int64()), ("changes", pa.list_(pa.string()))]))


def scanned(docs: DataFrame, templates: dict[str, str] | None = None, text: str = "text", into: str = "licenses") -> DataFrame:
    """The documents with an array ``into`` of confirmed licences: name, place, size saved, number of
    differing words and the differences (template's words > text's)."""
    wanted = TEMPLATES if templates is None else templates

    @F.arrow_udf(
        "array<struct<name:string,start:bigint,end:bigint,reduction:double,differences:bigint,changes:array<string>>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(wanted)
        for texts in batches:
            yield pa.array([[m._asdict() for m in scanner.scan(t)] for t in texts.to_pylist()], _RESULT)

    return docs.withColumn(into, scan(utf8(text)))
