import pytest

from gridsight.llm import licenses as l


@pytest.fixture(scope="module")
def scanner():
    return l.Scanner(l.TEMPLATES)


@pytest.mark.parametrize("name", l.TEMPLATES)
def test_every_template_is_found_exactly(scanner, name):
    text = f"Some prose stands before, é. {l.TEMPLATES[name]} And after it more words come."
    found = scanner.scan(text.encode())
    assert [(m.name, m.differences) for m in found] == [(name, 0)]
    assert text[found[0].start:found[0].end] == l.TEMPLATES[name].rstrip(".")


@pytest.mark.parametrize("text", [
    "", "no such words", "my driving license was revoked", "licensed under the GNU General Public License, version 4",
    "Licensed under CC BY-XX 4.0.", "without warranty of any sort", "Released under the Foo License.",
])
def test_other_wording_is_none(scanner, text):
    assert scanner.scan(text.encode()) == []


def test_small_differences_are_listed(scanner):
    text = l.TEMPLATES["MIT-text"].replace("free of charge", "gratis").replace("Software without", "Program without")
    found = scanner.scan(text.encode())
    assert [m.name for m in found] == ["MIT-text"] and found[0].differences == 4
    assert found[0].changes == ["free of charge>gratis", "software>program"]


@pytest.mark.parametrize("before, notice, after", [
    ("prose. ", "All rights reserved", "."), ("a word ", "all rights reserved", " follows"),
    ("", "Copyright 2021 Acme. All rights reserved", "."), ("x\n", "Copyright (c) 2019-2021 Acme Inc.\n * All rights reserved", ".\ny"),
    ("é ", "© 2020 Ácme, Ltd. All Rights Reserved", ""), ("", "All rights reserved © 2021 Acme Corp", " and so on"),
    ("the copyright of it was sold. ", "All rights reserved", ""),
])
def test_rights_notice_with_its_copyright_statement(scanner, before, notice, after):
    found = scanner.scan((before + notice + after).encode())
    assert [(m.name, m.start, m.end, m.differences) for m in found] == [("all-rights-reserved", len(before), len(before) + len(notice), 0)]


@pytest.mark.parametrize("text", ["all rights and obligations", "all rights not reserved", "all rights were sold", "All rights"])
def test_other_rights_are_none(scanner, text):
    assert scanner.scan(text.encode()) == []


@pytest.mark.parametrize("text, name", [
    ("Licensed under the MIT License", "MIT"), ("Distributed under the Apache License, Version 2.0", "Apache-2.0"),
    ("Released under BSD 3-Clause License", "BSD-3-Clause"), ("Licensed under the CC BY 4.0 licence", "CC-BY-4.0"),
])
def test_short_templates_bear_a_difference(scanner, text, name):
    assert [(m.name, m.differences) for m in scanner.scan(f"It is: {text}.".encode())] == [(name, 1)]


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
{0} Redistributions of source code must retain the above copyright notice, this list of conditions and the following
   disclaimer.
{1} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
   disclaimer in the documentation and/or other materials provided with the distribution.
{2}THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.  IN NO
EVENT SHALL THE REGENTS OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.
"""
ENDORSE = """{} Neither the name of the University nor the names of its contributors may be used to endorse or promote products
   derived from this software without specific prior written permission.
"""


@pytest.mark.parametrize("text, name", [
    (BSD.format("1.", "2.", ""), "BSD-2-Clause-text"), (BSD.format("*", "*", ""), "BSD-2-Clause-text-marked"),
    (BSD.format("1.", "2.", ENDORSE.format("3.")), "BSD-3-Clause-text"),
    (BSD.format("*", "*", ENDORSE.format("*")), "BSD-3-Clause-text-marked"),
    ("# " + l.TEMPLATES["LGPL-2.1-notice"].replace("library", "program").replace(". ", ".\n# "), "LGPL-2.1-notice"),
    (l.TEMPLATES["GPL-2.0-notice"].replace("This program", "Foo"), "GPL-2.0-notice"),
    (l.TEMPLATES["AGPL-3.0-notice"].replace("This program", "This module"), "AGPL-3.0-notice"),
    (l.TEMPLATES["MPL-2.0-notice"].replace("http:", "https:"), "MPL-2.0-notice"),
    (l.TEMPLATES["GPL-3.0-text"].replace("https:", "http:"), "GPL-3.0-text"),
    (l.TEMPLATES["Apache-2.0-text"].replace("http:", "https:"), "Apache-2.0-text"),
    ("This book is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0-notice"),
])
def test_standard_texts_with_usual_variations(scanner, text, name):
    assert [m.name for m in scanner.scan(f"before it.\n{text}\nand after".encode())] == [name]


def test_several_licences_and_line_breaks(scanner):
    text = "Released under\nthe   MIT License.\n\nprose " * 2 + "Licensed under the Apache License,\nVersion 2.0."
    assert [m.name for m in scanner.scan(text.encode())] == ["MIT", "MIT", "Apache-2.0"]


def test_dictionary_ranks_its_own_text_first(scanner):
    block = " ".join(scanner.templates[2].words).encode()
    best = max(scanner.templates, key=lambda t: t.reduction(block))
    assert best.name == "GPL-3.0"


def test_template_without_a_stem():
    with pytest.raises(ValueError, match="none of the stems"):
        l.Scanner({"x": "do what you want"})


def test_table(spark):
    rows = [(1, "Released under the MIT License.", "a"), (1, None, "b"), (None, "", "c"), (2, "x " * 300_000 + "Released under the MIT License.", "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, name string")
    got = {r.name: [(m.name, m.start, m.end) for m in r.licenses] for r in l.scanned(docs).collect()}
    assert got == {"a": [("MIT", 0, 30)], "b": [], "c": [], "d": [("MIT", 600_000, 600_030)]}
    assert l.scanned(docs.limit(0)).count() == 0
