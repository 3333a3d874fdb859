import random

import pytest
import xxhash
from pyspark.sql import functions as F

from gridsight.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(rows, distance=2):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if bin(a ^ b).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, fp, least.get(find(i))) for i, (d, fp) in enumerate(rows)), key=str)


def texts():
    words = [f"w{i}" for i in range(40)] + ["Ärger", "É", "x y", "𝒳"]
    pick = random.Random(1)
    out = [None, "", " \n\t", "one", "ONE", "two words", "a b c", "A  b\nc", "a b c a b c"]
    for _ in range(40):
        base = [pick.choice(words) for _ in range(pick.randint(1, 300))]
        out += [" ".join(base), " ".join(base[:-1]), "\n".join([*base, "more"])]
    return out


def test_fingerprints_and_components(spark):
    rows = [(None if i % 17 == 3 else i % 90, t, "x", i) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, component int")
    got = simhash.near_duplicates(docs.drop("fp", "component")).select("doc_id", "fp", "component_id").collect()
    mine = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=str)
    assert mine == plain_components([(d, plain_fingerprint(t)) for d, t, _, _ in rows])
    assert simhash.near_duplicates(docs).count() == len(rows)


def test_hash_is_sparks(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert row.h & (1 << 64) - 1 == next(simhash.shingle_hashes(b"a b c")).tolist()[0]


def test_long_text_in_parts():
    text = b"word%d " * 3
    long = b" ".join(b"w%d" % (i % 5000) for i in range(400_000))
    words = long.split()
    ones = [0] * 64
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(len(words) - 2)]
    for b in range(64):
        ones[b] = sum(h >> b & 1 for h in hashes)
    assert int(simhash.fingerprints([text, long, b""])[1]) == sum((2 * o > len(hashes)) << b for b, o in enumerate(ones))


@pytest.mark.parametrize("distance, bucket", [(2, 512), (2, 3), (3, 4), (1, 2), (0, 2)])
def test_links_are_all_links(spark, distance, bucket):
    """Crowded neighbourhoods: buckets are dealt again, and no pair is lost."""
    pick = random.Random(distance)
    prints = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = pick.getrandbits(64)
        for _ in range(40):
            near = centre
            for bit in pick.sample(range(12), pick.randint(0, 4)) + pick.sample(range(64), pick.randint(0, 2)):
                near ^= 1 << bit
            prints.add(near)
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp bigint")
    got = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(df, distance, bucket).collect()]
    want = {tuple(sorted((a, b))) for i, a in enumerate(prints) for b in prints[:i] if bin(a ^ b).count("1") <= distance}
    assert len(got) == len(set(got)) and {tuple(sorted(p)) for p in got} == want


def test_one_of_each_keeps_whole_rows(spark):
    rows = [(3, "a b c d", "s"), (1, "A b c d", "t"), (1, "A b c d", "r"), (None, "a b c d", "u"), (9, None, None),
            (8, "", "v"), (7, "something else here", "w"), (7, "something else here", "w"), (None, "only this", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, x string")
    got = sorted((tuple(r) for r in simhash.one_of_each(docs).collect()), key=str)
    assert got == sorted([(1, "A b c d", "r"), (8, "", "v"), (7, "something else here", "w"), (None, "only this", "z")], key=str)


def test_one_of_each_with_any_columns_and_ids(spark):
    rows = [("abc", None, {"k": 1}, {"k": 2}), (None, "abc", {"k": 1}, None), ("b", "x y z w", {"k": 2}, None),
            ("b", "x y z w", {"k": 1}, None), ("b", "x y z w", {"k": 1}, None), ("c", "x y z w", None, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, fp map<string, int>, row map<string, int>")
    got = sorted((r.doc_id or "", r.text, r.fp) for r in simhash.one_of_each(docs).collect())
    assert got == [("", "abc", {"k": 1}), ("abc", None, {"k": 1}), ("b", "x y z w", {"k": 1})]
    assert simhash.one_of_each(docs).columns == docs.columns


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).columns == docs.columns and simhash.one_of_each(docs).count() == 0


def test_column_types(spark):
    df = spark.createDataFrame([(1, "x y z")], "doc_id bigint, text string")
    assert simhash.near_duplicates(df).select(F.hex("fp")).count() == 1
