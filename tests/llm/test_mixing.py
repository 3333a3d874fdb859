import hashlib
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gridsight.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string, start int"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, goal = set(), {}
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        goal = {s: Fraction(most * sizes[s]) for s in full}
        goal |= {s: Fraction(left * weight[s], sum(weight[x] for x in open_)) for s in open_}
        above = {s for s in open_ if goal[s] > most * sizes[s]}
        if not above:
            return goal
        full |= above


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows):
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    goal, out = plain_targets(sizes), []
    for source in sizes:
        mine = [r for r in rows if r[2] == source]
        key = lambda r: hashlib.md5("|".join(["0", "" if r[0] is None else str(r[0]), r[1] or ""]).encode()).digest()
        left = int(goal[source])
        epochs = left // sizes[source] if sizes[source] else 0
        left -= epochs * sizes[source]
        for r in sorted(mine, key=key):
            n = len(words(r[1]))
            part = min(n, left)
            left -= part
            out.append((r[0], n, sizes[source], round(float(goal[source]), 6), epochs * n + part, epochs, part, r))
    return out


def rows():
    out = []
    for s, (source, count) in enumerate([("a", 3), ("b", 300), ("Z", 40), (None, 5), ("ä", 20), ("empty", 2), ("hot", 400)]):
        for i in range(count):
            text = None if source == "empty" else " ".join(f"w{j}" for j in range((i * 7 + s) % 23)) + ("\n" if i % 3 else " x ")
            out.append((None if i % 11 == 5 else i % 50, text, source, "clash", i))
    return out + [(7, "same words here", "hot", "clash", 1)] * 60


def test_same_as_plain_version(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = mixing.mix(df).select("doc_id", "size", "source_size", F.round("target", 6), F.col("epochs") * F.col("size") + F.col("part")).collect()
    key = lambda r: str(tuple(r))
    want = plain(data)
    assert sorted(map(key, got)) == sorted(key(w[:5]) for w in want)
    assert all(w[4] <= 3 * w[1] for w in want)


def test_mixed_documents(spark):
    data = rows()
    got = mixing.mixed_documents(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "text", "source", "size", "start", "epoch"]
    taken = {}
    for r in got.collect():
        taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
        assert r.epoch in (1, 2, 3) and r.size == "clash"
    want = {}
    for w in plain(data):
        want[w[7][2]] = want.get(w[7][2], 0) + w[4]
    assert taken == {s: n for s, n in want.items() if n}


def test_partial_text_is_a_prefix(spark):
    df = spark.createDataFrame([(1, "  one\ttwo\n three é  four ", 3), (2, "x", 0)], "doc_id int, text string, n bigint")
    got = [r[0] for r in df.select(mixing._first_words(F.col("text"), F.col("n"))).collect()]
    assert got == ["  one\ttwo\n three", ""]


@pytest.mark.parametrize("data", [[], [(1, None, "a", "", 0)], [(1, "x y", None, "", 0)]])
def test_small_tables(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert mixing.mix(df).count() == len(data)
    assert mixing.mixed_documents(df).count() == len([d for d in data if d[1]])


def test_documents_with_an_epoch_of_their_own(spark, folder):
    df = spark.createDataFrame([(1, "x y", "a", "old"), (2, "z " * 500_000, "b", "old")], "doc_id int, text string, source string, Epoch string")
    mixed = mixing.mixed_documents(df)
    mixed.write.parquet(f"{folder}/mix")
    assert mixed.columns == ["doc_id", "text", "source", "Epoch", "epoch_"]
    assert {(r.Epoch, r.epoch_ > 0) for r in spark.read.parquet(f"{folder}/mix").collect()} == {("old", True)}
