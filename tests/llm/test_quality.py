import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsight.llm import quality as q

DOCS = "doc_id bigint, text string, quality int, kept string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    text, w = text or "", words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + j for i, g in enumerate(windows) if windows.count(g) > 1 for j in range(3)}
    seen, duplicate = set(), 0
    for line in text.split("\n"):
        if words(line):
            duplicate += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), duplicate, len(hit)


def texts():
    pick = random.Random(4)
    bits = ["a", "b", "é", "𝒳", "#x", "|", " ", "\n", "\n\n", "\t", "a b c", "<>&", " ", "x\x0by", "\n \n"]
    out = [None, "", " \n ", "a", "a b c a b c", "a a a a a", "x\nx\nx", "a b c d e f a b c"]
    return out + [pick.choice(["", " "]).join(pick.choice(bits) for _ in range(pick.randint(1, 120))) for _ in range(300)]


def test_counts(spark):
    rows = [(i % 40, t, 3, "x") for i, t in enumerate(texts())]
    got = q.counted(spark.createDataFrame(rows, DOCS)).select("doc_id", "counts.*").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((i, *plain(t))) for i, t, *_ in rows)


def test_windows_of_many_words():
    ids = np.array([5, 6, 7, 8, 5, 6, 7, 9, 1, 1, 1, 1])
    assert q.repeated_words(ids, 10) == q.repeated_words(ids, 1 << 40) == 6 + 4


def labelled(count=900):
    pick = random.Random(1)
    good = [f"{a}{b}" for a in ("the", "an", "or", "re") for b in ("tion", "ing", "ed", "ly", "er")]
    rows, labels = [], []
    for i in range(count):
        ok = i % 3 > 0
        w = [pick.choice(good) + ("" if ok or pick.random() < 0.4 else pick.choice(["$$$", "%%%"])) for _ in range(80)]
        rows.append((i, " ".join(w), 0, "x"))
        labels.append((i, int(ok), 0))
    return rows, labels


def test_held_out_rows_and_calibration(spark):
    rows, labels = labelled()
    seen = spark.createDataFrame(labels[:600], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame(rows, DOCS)
    model = q.fit(docs, seen)
    got = q.judged(docs, model).where("doc_id >= 600").select("doc_id", "judged.quality", "judged.kept", "judged.base_failed").collect()
    right = [r.kept == bool(labels[r.doc_id][1]) for r in got if not r.base_failed]
    assert len(right) > 150 and np.mean(right) > 0.97
    sure = [r.quality for r in got if r.quality > 0.5]
    assert abs(np.mean(sure) - np.mean([labels[r.doc_id][1] for r in got if r.quality > 0.5])) < 0.1
    again = q.fit(docs.repartition(5), seen.repartition(3))
    assert again.intercept == pytest.approx(model.intercept) and np.allclose(again.grams, model.grams)


def test_block_features_are_those_of_single_texts():
    data = [t.encode() for t in texts() if t is not None]
    model = q.Model(np.random.default_rng(0).random(q.BUCKETS), np.random.default_rng(1).random(q.BUCKETS), 0.5, 1.0, 0.0)
    together = q.raw_scores(q.Block(data), model)
    assert np.allclose(together, [q.raw_scores(q.Block([t]), model)[0] for t in data])


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, None, 1, "x"), (1, "word " * 60, 1, "y"), (2, " ".join(map(str, range(60))), 1, "y")], DOCS)
    for rows in ([], [(None, 1), (1, None), (1, 7)], [(1, 1), (2, 1)]):
        labels = spark.createDataFrame(rows, "doc_id bigint, quality int")
        got = q.judged(docs, q.fit(docs, labels)).select("doc_id", "judged.base_failed", "judged.kept").collect()
        assert {(r.doc_id, r.base_failed) for r in got} == {(None, True), (1, True), (2, False)}
        assert not any(r.kept for r in got if r.base_failed)
    assert q.judged(docs.limit(0), q.fit(docs, labels)).select(F.col("judged.kept")).count() == 0
