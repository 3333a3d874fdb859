import random
import zlib

import pytest
from pyspark.sql import functions as F

from gridsight.llm import toxicity as t

DOCS = "doc_id bigint, text string, score double, y int"


def corpus(count=600):
    """Texts of filler words; those of label 1 hold an insult, and most of them also name a group, as
    few others do."""
    pick = random.Random(2)
    filler = [f"word{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(count):
        toxic = i % 4 == 0
        words = [pick.choice(filler) for _ in range(30)]
        if toxic:
            words.insert(pick.randrange(30), pick.choice(["nitwit", "DIMBULB!", "blockhead,"]))
        if pick.random() < (0.8 if toxic else 0.05):
            words.insert(0, "Muslim")
        elif pick.random() < 0.2:
            words.insert(0, "christian")
        docs.append((i, " ".join(words), 0.5, 7))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def plain_fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    got = t.scored(docs, t.fit(docs, labels)).join(labels, "doc_id").select(
        "doc_id", t.held_out().alias("out"), ((F.col("score") >= 0.5).cast("int") == F.col("toxic")).alias("right")).collect()
    assert all(r.out == plain_fold(r.doc_id) for r in got)
    out = [r.right for r in got if r.out]
    assert len(out) > 80 and sum(out) / len(out) > 0.98


def test_group_names_do_not_matter(tables):
    docs, labels = tables
    loose, bound = (t.fit(docs, labels, penalty=p) for p in (0.0, t.SWAP_PENALTY))
    gap = lambda m: abs(m.weights.get(b"muslim", 0) - m.weights.get(b"christian", 0))
    assert gap(bound) < 0.2 * gap(loose) and gap(bound) < 0.5
    neutral = ["a muslim word1 word2", "a christian word1 word2", "word1 word2", "", None]
    rows = docs.sparkSession.createDataFrame([(i, x, 0.0, 1) for i, x in enumerate(neutral)], DOCS)
    scores = [r.score for r in t.scored(rows, bound).orderBy("doc_id").collect()]
    assert max(scores) < 0.5 and scores[3] == scores[4]


def test_counterfactuals_swap_within_a_kind():
    swaps = t._swaps((("a", "b", "c"), ("x", "y")))
    got = t.counterfactuals({b"a", b"x", b"other"}, swaps)
    assert sorted(map(sorted, got)) == sorted(map(sorted, [
        {b"b", b"x", b"other"}, {b"c", b"x", b"other"}, {b"a", b"y", b"other"}]))


def test_reruns_agree_and_held_out_labels_are_unused(spark, tables):
    docs, labels = tables
    model = t.fit(docs, labels)
    turned = labels.withColumn("toxic", F.when(t.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert t.fit(docs.repartition(7), turned.repartition(3)) == model


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "x", 0.1, 1), (1, None, 0.1, 1), (1, "again", 0.1, 1)], DOCS)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 5), (3, 1)], "doc_id bigint, toxic int")
    for labels in (none, odd):
        rows = t.scored(docs, t.fit(docs, labels)).collect()
        assert len(rows) == 3 and len({r.score for r in rows}) == 1 and 0 <= rows[0].score <= 1
    assert t.drop_toxic(docs.limit(0), none).count() == 0
    assert t.drop_toxic(docs, none).columns == docs.columns
