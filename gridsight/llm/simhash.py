"""SimHash near-duplicates, found by one-wildcard variants of few segments.

A fingerprint of 64 bits is cut into ``distance // 2 + 1`` segments. Of two fingerprints within the
distance, some segment differs by one bit at most, so the two agree on one of that segment's variants
with a single bit left out. Every distinct fingerprint is indexed under its 64 variants; equal variants
give candidates, which the full bit distance verifies.

The index is shuffled once, to meet itself. A variant that more than ``MAX_BUCKET`` fingerprints share
gives no pairs as it is: its members are dealt again by bit groups of which a linked pair must agree on one whole (``distance + 1`` groups that
cover all bits), and again by other groups, until buckets are small. That is exact, and a row meets
``MAX_BUCKET`` others at most.

Cases: a NULL or wordless text has fingerprint 0 and is linked like any other; equal texts share a
fingerprint and are one vertex; a component's id is its least doc_id, NULL where it has none; an empty
table gives no rows. Columns of the documents other than the id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsight.llm.common import blocks, kept, pieces, utf8
from gridsight.llm.components import connected

#: Words to a shingle, bits by which linked fingerprints may differ, seed of the shingle hash.
SHINGLE, DISTANCE, SEED = 3, 2, 42
#: Fingerprints that one index entry may hold before it is dealt again.
MAX_BUCKET = 512
#: After so many rounds at most a few of the 64 bits are free, which bounds a bucket by itself.
ROUNDS = 7

#: Lower case for A-Z; a space for white space.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
#: The bits of each byte, least first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of all shingles, repeats included, a part of the text at a time."""
    digest, join, tail, short = xxhash.xxh64_intdigest, b" ".join, [], True
    for part in pieces(text.translate(_PLAIN)):
        words = tail + part.split()
        runs = zip(*(words[i:] for i in range(shingle)))
        count = max(len(words) - shingle + 1, 0)
        if count:
            yield np.fromiter((digest(join(run), SEED) for run in runs), np.uint64, count)
        short &= not count
        tail = words[len(words) - shingle + 1:] if len(words) >= shingle else words
    if short and tail:
        yield np.array([digest(join(tail), SEED)], np.uint64)


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text: bits that over half of its shingle hashes have."""
    out = np.zeros(len(texts), np.uint64)
    for start, end in blocks(texts):
        ones = np.zeros((end - start, 64), np.int64)
        total = np.zeros(end - start, np.int64)
        held, owner, size = [], [], 0

        def count() -> None:
            if not held:
                return
            hashes = np.concatenate(held).view(np.uint8).reshape(-1, 8)
            at = np.repeat(owner, [len(h) for h in held]) * 256
            for byte in range(8):
                seen = np.bincount(at + hashes[:, byte], minlength=len(total) * 256)
                ones[:, byte * 8:byte * 8 + 8] += seen.reshape(-1, 256) @ _BITS

        for i in range(start, end):
            for hashes in shingle_hashes(texts[i], shingle):
                held.append(hashes)
                owner.append(i - start)
                total[i - start] += len(hashes)
                size += len(hashes)
                if size > 1 << 18:
                    count()
                    held, owner, size = [], [], 0
        count()
        bits = (2 * ones > total[:, None]).astype(np.uint8)
        out[start:end] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprint(text: str | Column = "text", shingle: int = SHINGLE) -> Column:
    """The text's fingerprint as a signed 64-bit number."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints(texts.to_pylist(), shingle).view(np.int64))

    return simhash(utf8(text))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _near(distance: int) -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance


def _segments(distance: int) -> list[tuple[int, int]]:
    """First bit and end of each segment."""
    many = distance // 2 + 1
    return [(64 * i // many, 64 * (i + 1) // many) for i in range(many)]


def _mask(low: int, high: int) -> int:
    return (1 << high) - (1 << low)


def _variants(fp: Column, low: int, high: int) -> list[Column]:
    """The segment's keys: its bits in their place without one of them, and elsewhere which one."""
    out = []
    for bit in range(low, high):
        rest = fp.bitwiseAND(F.lit(_signed(_mask(low, high) & ~(1 << bit))))
        place = 0 if low >= 6 else high
        out.append(rest.bitwiseOR(F.lit(_signed(bit << place))) if place <= 58 else F.xxhash64(rest, F.lit(bit)))
    return out


def _groups(level: int, distance: int) -> list[int]:
    """The 64 bits dealt into ``distance + 1`` masks, differently for each level."""
    many = distance + 1
    order = sorted(range(64), key=lambda bit: xxhash.xxh64_intdigest(bytes([bit]), level))
    return [sum(1 << bit for bit in order[i::many]) for i in range(many)]


def _pairs(index: DataFrame, distance: int) -> DataFrame:
    """Linked pairs among the fingerprints of equal keys."""
    one, two = (index.select("key", F.col("fp").alias(side)) for side in "ab")
    met = one.join(two, "key").where((F.col("a") < F.col("b")) & _near(distance))
    return kept(met.select("a", "b").distinct(), "pairs")


def _crowded(prints: DataFrame, index: DataFrame, distance: int, max_bucket: int) -> DataFrame:
    """Keys of the index that more than ``max_bucket`` fingerprints have. Such a key's members have at
    most two values of its segment, so one value has over half as many; values are counted first, one a
    segment, and only keys of frequent values are counted themselves."""
    bounds = _segments(distance)
    values = F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(_mask(*b)))) for b in bounds))
    frequent = kept(
        prints.select(F.posexplode(values).alias("segment", "value")).groupBy("segment", "value").count()
        .where(F.col("count") > max_bucket // 2), "frequent")
    if frequent.isEmpty():
        return frequent.select(F.col("value").alias("key"))
    keys = None
    for segment, (low, high) in enumerate(bounds):
        own = frequent.where(F.col("segment") == segment).select(
            F.explode(F.array(*_variants(F.col("value"), low, high))).alias("key"))
        keys = own if keys is None else keys.unionByName(own)
    counts = index.join(keys.distinct(), "key", "left_semi").groupBy("key").count()
    return kept(counts.where(F.col("count") > max_bucket).select("key"), "crowded")


def links(prints: DataFrame, distance: int = DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints in column ``fp`` that differ by ``distance``
    bits at most; every such pair, once."""
    fp = F.col("fp")
    keys = [key for low, high in _segments(distance) for key in _variants(fp, low, high)]
    index = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    crowded = _crowded(prints, index, distance, max_bucket)
    if crowded.isEmpty():
        return _pairs(index, distance)
    out = _pairs(index.join(crowded, "key", "left_anti"), distance)
    index = kept(index.join(crowded, "key", "left_semi"), "index")
    for level in range(1, ROUNDS + 1):
        groups = F.array(*(fp.bitwiseAND(F.lit(_signed(m))) for m in _groups(level, distance)))
        index = index.select("fp", "key", F.posexplode(groups).alias("part", "bits")).select(
            "fp", F.xxhash64("key", "part", "bits").alias("key"))
        sizes = kept(index.groupBy("key").count().where("count > 1"), "sizes")
        members = kept(index.join(sizes, "key"), "members")
        small = members if level == ROUNDS else members.where(F.col("count") <= max_bucket)
        out = out.unionByName(_pairs(small, distance))
        index = members.where(F.col("count") > max_bucket).select("fp", "key")
        if level == ROUNDS or index.isEmpty():
            break
    return out.distinct()


def components(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, component, component_id) for every distinct ``fp`` of the rows: the component's least
    fingerprint, which names it, and the least ``doc_id`` among its rows."""
    prints = kept(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    roots = connected(links(prints.select("fp"), distance)).withColumnRenamed("vertex", "fp")
    named = kept(
        prints.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("component")), "named")
    least = kept(named.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    return kept(named.select("fp", "component").join(least, "component"), "components")


def near_duplicates(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """doc_id, fp, component and component_id of every document."""
    rows = kept(docs.select("doc_id", fingerprint(text, shingle).alias("fp")), "fingerprints")
    return rows.join(components(rows, distance), "fp")


def one_of_each(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the least doc_id, in its
    own columns, of any types. Rows that repeat that id with another text give way to the one with the lesser
    text hash, rows that repeat both to the least when all columns are written as text."""
    parts = [F.col("doc_id").isNull(), F.col("doc_id"), F.col(text).isNull(), F.col(text)]
    name = F.struct(F.xxhash64(*parts).alias("x"), F.xxhash64(*reversed(parts)).alias("y"))
    rows = kept(docs.select("doc_id", name.alias("row"), fingerprint(text, shingle).alias("fp")), "fingerprints")
    first = rows.join(components(rows, distance), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    counted = first.groupBy("component", "row").agg(F.count(F.lit(1)).alias("n"))
    chosen = kept(counted.groupBy("component").agg(F.min(F.struct("row", "n")).alias("c")).select("c.row.x", "c.row.y", "c.n"), "chosen")
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), name.alias("row")).select(
        "doc", F.col("row.x").alias("x"), F.col("row.y").alias("y"))
    out = named.join(chosen.where("n = 1"), ["x", "y"], "left_semi").select("doc")
    repeated = chosen.where("n > 1")
    if not repeated.isEmpty():
        again = named.join(repeated, ["x", "y"], "left_semi")
        out = out.unionByName(again.groupBy("x", "y").agg(F.min_by("doc", F.col("doc").cast("string")).alias("doc")).select("doc"))
    return out.select("doc.*")
