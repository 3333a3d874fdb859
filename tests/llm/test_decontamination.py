import random
import re

import pytest

from gridsight.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, n=10):
    doc, hit, found = words(text), set(), set()
    for item, content in items:
        w = words(content)
        for p in range(max(len(w) - n, 0) + 1 if w else 0):
            g = w[p:p + n]
            for q in range(len(doc) - len(g) + 1):
                if doc[q:q + len(g)] == g:
                    hit.update(range(q, q + len(g)))
                    found.add("" if item is None else str(item))
    return len(doc), len(hit), sorted(found)


def cases():
    pick = random.Random(5)
    vocabulary = ["the", "Of", "é", "ß", "x1", "日本", "and", "|", "q-r", "İ"]
    items = [(i, " ".join(pick.choice(vocabulary) for _ in range(pick.randint(1, 25)))) for i in range(12)]
    items += [(3, "alone word"), (None, "no id here"), (20, None), (21, ""), (22, "!!"), (3, "alone word"), (10, "alone word")]
    docs = [None, "", "...", "alone WORD", "x alone\nword. alone", "no id here"]
    for _ in range(60):
        parts = [" ".join(pick.choice(vocabulary) for _ in range(pick.randint(0, 30))), pick.choice(items)[1] or ""]
        docs.append(pick.choice([" ", "\n", "; "]).join(parts))
    return [(i % 50 if i else None, t, "kept") for i, t in enumerate(docs)], items


@pytest.mark.parametrize("most", [1_000_000, 40])
def test_same_as_brute_force(spark, most):
    docs, items = cases()
    got = d.mark_leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string, items string"),
        spark.createDataFrame(items, "item_id bigint, text string"), max_windows=most)
    rows = got.select("doc_id", "leaks.n_words", d.n_hit(), "leaks.items").collect()
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in rows), key=key) == sorted(((i, *plain(t, items)) for i, t, _ in docs), key=key)


def test_drop_and_cut(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id bigint, text string")
    text = "Start, A b-c d e f g h i j K; end"
    docs = spark.createDataFrame([(1, text), (2, "clean a b"), (None, None)], "doc_id bigint, text string")
    assert sorted(r.doc_id or 0 for r in d.drop_contaminated(docs, items).collect()) == [0, 2]
    cut = {r.doc_id: r.text for r in d.cut_contaminated(docs, items).collect()}
    assert cut == {1: "Start, ; end", 2: "clean a b", None: None}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert [tuple(r) for r in d.mark_leaks(docs, none).select("leaks.n_words", d.n_hit()).collect()] == [(2, 0)]
    assert d.drop_contaminated(docs.limit(0), none).count() == 0


def test_long_text_in_parts():
    windows = d.WindowSet([b"t1 t2 t3"], ["7"])
    text = b" ".join([b"filler"] * 400_000 + [b"t1", b"t2", b"t3"] + [b"filler"] * 10)
    assert windows.scan([text, b"", b"t1 t2 t3"]) == [(400_013, [(400_000, 400_003)], ["7"]), (0, [], []), (3, [(0, 3)], ["7"])]


def test_columns_of_like_names_stay(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "x a b c y", "p", "q"), (2, "z", "r", "s")], "doc_id bigint, text string, _leaks string, LEAKS string")
    assert d.drop_contaminated(docs, items).collect() == docs.where("doc_id = 2").collect()
    assert d.cut_contaminated(docs, items).columns == docs.columns
