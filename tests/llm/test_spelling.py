import random
import re
import zlib
from collections import Counter

import pytest

from gridsight.llm import queries, spelling

LOW = str.maketrans(spelling.UPPER, spelling.LOWER)


def plain_near(words):
    """Near words by trying every deletion of every word."""
    words, keys = sorted(words), {}
    for w in words:
        for key in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            keys.setdefault(key, set()).add(w)

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return len(b) - len(a) < 2 and a != b and a[i + (len(a) == len(b)):] == b[i + 1:]

    out = {w: set() for w in words}
    for w in words:
        for key in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            out[w] |= {v for v in keys[key] if one_edit(w, v)}
    return out


def plain_variants(counts):
    near, out, form = plain_near(counts), {}, {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], counts.get(form[w]), root)
    return out


def got(df):
    rows = [(r.word, (r.n, r.n_near, r.form, r.form_n, r.root)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def plain_words(rows, shorten=False):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            check = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if shorten and check % 31 == 0:
                run = run[:check % len(run)] + run[check % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


@pytest.mark.parametrize("letters, sizes", [("ab", (7, 9)), ("abcÀÿ", (7, 8)), ("aé", (7, 14))])
def test_near_words_of_a_dense_vocabulary(spark, letters, sizes):
    pick = random.Random(len(letters) + sizes[1])
    words = {"".join(pick.choice(letters) for _ in range(pick.randint(*sizes))) for _ in range(400)}
    found = [tuple(r) for r in spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(w, v) for w, vs in plain_near(words).items() for v in vs}


@pytest.mark.parametrize("long", [9, 12])
def test_long_words_beside_short_ones(spark, long):
    pick, words = random.Random(long), set()
    for _ in range(40):
        word = "".join(pick.choice("abc") for _ in range(pick.randint(7, 16)))
        words.add(word)
        for _ in range(3):
            i = pick.randint(0, len(word))
            words.add(pick.choice([word[:i] + "c" + word[i:], word[:i] + word[i + 1:], word[:i] + "b" + word[i + 1:]]))
    found = {tuple(r) for r in spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string"), long).collect()}
    assert found == {(w, v) for w, vs in plain_near(words).items() for v in vs}


def test_chains_ties_and_thresholds(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "bbcdefgh": 20, "zzzzzzzz": 9, "zzzzzzzzz": 89,
              "aaaaaaaa": 1, "aaaaaaab": 10, "aaaaaaac": 10, "lonelyword": 5}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = got(spelling.variants(df))
    assert found == plain_variants(counts)
    assert found["abcdefg"][2:] == ("abcdefgh", 20, "abcdefghi")
    assert found["aaaaaaaa"][2] == "aaaaaaab" and found["zzzzzzzz"][2] is None


def test_vocabulary_of_odd_texts(spark):
    long = "x" * 50_000
    rows = [(1, None), (None, "Strange strange 1strange2 ÄRGERLICH Ärgerlich shorty"), (3, ""), (3, "straße" * 2 + " straßestraße"),
            (4, f"{long} {long}y {long} {long}y"), (4, "strange strange-strange_strange"), (5, "w" * 100 + " " + "longer " * 30_000)]
    docs = spark.createDataFrame([(d, t, "w", "r") for d, t in rows], "doc_id bigint, text string, word string, run string")
    words = spelling.vocabulary(docs)
    assert {r.word: r.n for r in words.collect()} == plain_words(rows)
    assert got(spelling.variants(words))[long][1] == 1


def test_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert spelling.variants(spelling.vocabulary(docs)).count() == 0
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op13_spelling(spark, folder)) == plain_variants(plain_words(rows, shorten=True))
