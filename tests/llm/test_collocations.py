import random
import re
from collections import Counter

import numpy as np
import pytest

from gridsight.llm import collocations, common

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    """Every phrase of every language counted in one dictionary."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    key = lang, tuple(words[i:i + size])
                    f[key] = f.get(key, 0) + 1
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in often.items():
        if any(g == lang and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (g, q), b in often.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    ranked = []
    for lang in sorted(n):
        for rank, (_, s, a, p, left, right, words) in enumerate(sorted(r for r in out if r[0] == lang)[:top], 1):
            ranked.append((lang, rank, p.decode(), -a, left, right, words, -s))
    return ranked


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def texts(seed, many=60):
    pick = random.Random(seed)
    words = ["the", "The", "of", "a", "a", "straße", "日本", "x#y", "end.", "stop,", "new\tyork", "  gap  ", "\n", "Ä", " ", "to\x0bbe"]
    fixed = ["as far as i know", "new york city council", "a a a a a", "ä the of"]
    rows = []
    for i in range(many):
        parts = [pick.choice(fixed) if pick.random() < 0.3 else pick.choice(words) for _ in range(pick.randint(0, 60))]
        rows.append((pick.choice(["en", "de", None, "und"]), " ".join(parts)))
    return [*rows, ("en", None), (None, ""), ("fr", "lonely"), ("en", rows[0][1]), ("en", rows[0][1])]


@pytest.mark.parametrize("least, top", [(2, 1000), (5, 7), (1, 50)])
def test_against_brute_force(spark, least, top):
    rows = texts(least)
    docs = spark.createDataFrame([(t, g, "p", 1) for g, t in rows], "text string, lang string, prefix string, f int")
    assert got(collocations.collocations(docs.repartition(3), least=least, top=top)) == plain(rows, least, top)


def test_split_stripes_small_blocks_and_full_bitmaps(spark, monkeypatch):
    """Hot prefixes in segments, blocks of a few words, and a bitmap so small that it lets everything through."""
    rows = texts(9)
    docs = spark.createDataFrame([(t, g) for g, t in rows], "text string, lang string")
    monkeypatch.setattr(collocations, "HOT", 3)
    monkeypatch.setattr(collocations, "SLOTS", 64)
    monkeypatch.setattr(collocations, "HELD", 20)
    monkeypatch.setattr(collocations._blocks, "__defaults__", (50, 6))
    assert got(collocations.collocations(docs, least=3)) == plain(rows, 3, 2000)


@pytest.mark.parametrize("block, most", [(1, 100), (7, 3), (40, 100)])
def test_blocks_lose_no_phrase(block, most, monkeypatch):
    import pyarrow as pa

    rows = [("en", "a b c d e f g"), ("de", "a b c. d e f"), ("en", "a b c d e f g " * 30), ("en", "x"), ("de", " . ,, ")]
    batch = pa.RecordBatch.from_arrays([pa.array([g for g, _ in rows]), pa.array([t.encode() for _, t in rows])], names=["lang", "text"])
    found = Counter()
    monkeypatch.setattr(collocations, "pieces", lambda text: common.pieces(text, 9))
    for lang, words, places, stop, _ in collocations._blocks(iter([batch]), block, most):
        for i, p in enumerate(places[:stop].tolist()):
            for size in range(1, 6):
                phrase = places[i:i + size].tolist()
                if len(phrase) == size and all(phrase):
                    found[lang, b" ".join(words[p] for p in phrase)] += 1
    want = Counter()
    for lang, text in rows:
        for piece in re.split("[.,]", text):
            words = piece.split()
            for i in range(len(words)):
                for size in range(1, min(5, len(words) - i) + 1):
                    want[lang, " ".join(words[i:i + size]).encode()] += 1
    assert found == want


@pytest.mark.parametrize("block, runs", [(1 << 18, 1 << 20), (9, 5), (40, 1)])
def test_longer_phrases_only_from_frequent_parts(block, runs, monkeypatch):
    """Words whose pairs are all frequent and whose triples mostly are not: phrases of four words and more are
    formed of frequent triples alone, and of those whatever the blocks."""
    import pyarrow as pa
    import xxhash

    pick = random.Random(4)
    text = " ".join(pick.choice("abcdefgh") if pick.random() < 0.9 else "a b c d e ." for _ in range(4000))
    words, size = text.split(), 3
    often = {tuple("abc"), tuple("bcd"), tuple("cde")}
    marks, none = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)
    for phrase in often:
        folded = 0
        for w in phrase:
            folded = (folded * int(collocations._STEP) + xxhash.xxh64_intdigest(f"en\n{w}".encode())) % (1 << 64)
        marks[folded % (1 << 19) >> 3] |= np.uint8(1 << (folded & 7))
    monkeypatch.setattr(collocations, "RUNS", runs)
    monkeypatch.setattr(collocations._blocks, "__defaults__", (block, 100))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text.encode()])], names=["lang", "text"])
    found = Counter()
    for stripes in collocations._longer(iter([batch]), marks, none, known=size, longest=5):
        for row in stripes.to_pylist():
            for word, count in zip(row["next"], row["counts"]):
                found[row["prefix"], word] += count
    want = Counter()
    for n in (4, 5):
        for i in range(len(words) - n + 1):
            if all(tuple(words[j:j + 3]) in often for j in range(i, i + n - 2)):
                want[" ".join(words[i:i + n - 1]), words[i + n - 1]] += 1
    assert found == want and set(want) == {("a b c", "d"), ("b c d", "e"), ("a b c d", "e")}


def test_products_beyond_64_bits(spark):
    big = spark.sql("SELECT 9000000000000L AS a, 900000000000000L AS n, 9000000000001L AS l, 9000000000007L AS r")
    score = big.select(collocations._score("a", "n", "l", "r")).first()[0]
    assert score == 1000 * 9000000000000 * 900000000000000 // (9000000000001 * 9000000000007)


def test_bitmap_bits(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLOTS", 1 << 12)
    df = spark.createDataFrame([("en", f"w{i} x") for i in range(500)], "lang string, phrase string")
    marks = collocations._bitmap(df)
    assert collocations._marked(marks, collocations._hashes("en", [b"w%d" % i for i in range(500)])
                                * collocations._STEP + collocations._hashes("en", [b"x"])).all()
    assert 0 < np.unpackbits(marks).sum() <= 500


def test_very_long_text_and_empty(spark):
    rows = [("en", "tick tock " * 200_000), ("en", "one two " * 3)]
    docs = spark.createDataFrame([(t, g) for g, t in rows], "text string, lang string")
    assert [r.phrase for r in collocations.collocations(docs).collect()] == [r[2] for r in plain(rows, 100, 2000)]
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.where("text LIKE 'one%'")).count() == 0


def test_rare_words_are_not_stored(spark, monkeypatch):
    """Only frequent words and the number of all, which is exact for a language without any frequent word too."""
    rows, plain = [], collocations.kept
    monkeypatch.setattr(collocations, "kept", lambda df, purpose: rows.append((purpose, plain(df, purpose))) or rows[-1][1])
    docs = spark.createDataFrame([("en", " ".join(["often"] * 5 + [f"rare{i}" for i in range(50)])), ("fr", "seul . mot")], "lang string, text string")
    found, totals = collocations.frequent_phrases(docs, least=5)
    assert sorted(tuple(r) for r in totals.collect()) == [("en", 55), ("fr", 2)]
    assert sorted(r.following for p, df in rows if p == "words" for r in df.collect()) == [".", ".", "often"]
    assert all(len(df.inputFiles()) <= 1 for _, df in rows)
    assert [r.phrase for r in found.where("prefix = ''").collect()] == ["often"]


def test_splits_share_a_stripe(spark, monkeypatch):
    """A task counts several splits and makes each of its prefixes' stripes once."""
    words = [f"w{i}" for i in range(20)]
    texts = [("en", " ".join(random.Random(i).choices(words, k=200))) for i in range(160)]
    made, merged = [], collocations._merged
    monkeypatch.setattr(collocations, "_merged", lambda stripes, least: made.append(stripes.count()) or merged(stripes, least))
    docs = spark.createDataFrame(texts, "lang string, text string").repartition(64).localCheckpoint()
    found, _ = collocations.frequent_phrases(docs, least=5)
    tasks = 64 // collocations.SPLITS
    assert made[1] == tasks * 20 and docs.rdd.getNumPartitions() == 64
    assert found.where("prefix = ''").count() == 20
    few = spark.createDataFrame(texts[:8], "lang string, text string").repartition(5).localCheckpoint()
    assert collocations._gathered(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_later_passes_hold_frequent_words_only(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(collocations, "RARE", 3)
    marks = np.zeros(1 << 13, np.uint8)
    for one in collocations._hashes("en", [b"a", b"b"]):
        slot = int(one) % (1 << 16)
        marks[slot >> 3] |= 1 << (slot & 7)
    text = " ".join(["a"] + [f"rare{i}" for i in range(50)] + ["b a rare0 b"]).encode()
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], names=["lang", "text"])
    (_, words, places, _, _), = collocations._blocks(iter([batch]), frequent=marks)
    assert words == [b".", b"a", b"b"]
    assert places.tolist() == [1] + [0] * 50 + [2, 1, 0, 2, 0]
    numbers = collocations._Numbers("en", marks)
    assert [numbers[b"rare%d" % i] for i in range(50)] == [0] * 50 and len(numbers) <= 4
