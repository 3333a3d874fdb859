"""Phrases whose words stand together more often than their parts alone would, mined with stripes.

A stripe is a prefix's counter of the words that come next: (lang, prefix, segment, next words, counts). Map tasks, each of
several splits, build stripes from blocks of whole texts, the shuffle brings the stripes of a prefix together, and they are
merged elementwise: counts of the same next word are added. The merged stripes hold all that is asked: an
entry is the count of the phrase (prefix, next word), the largest entry of a stripe is the most frequent
extension of its prefix to the right, and the largest entry by (prefix without its first word, next word)
that to the left. The words themselves are the stripe of the empty prefix.

Stripes are built in four passes over the texts: words, pairs of frequent words, phrases of three words whose
pairs are all frequent, and longer phrases whose parts of three words are all frequent. A phrase is no more
frequent than its parts, so nothing is lost; once most pairs of a corpus are frequent, only the third pass sees
nearly every place of it. What is frequent reaches the tasks as a bitmap of ``SLOTS`` hash slots, which is ``SLOTS / 8`` bytes
at any corpus size; a slot shared by chance lets through a phrase that the exact counts drop later. A prefix
with ``HOT`` occurrences or more (a second bitmap) has its stripe dealt to ``SEGMENTS`` tasks by the next
word, so a stripe in one task has fewer than ``HOT`` entries, or a share of a frequent one.

Cases: a NULL or empty text has no words; a NULL lang is ``und``; a text is read whole in parts of
``BLOCK`` words and more that overlap; repeated rows count again; equal scores go to the more frequent phrase, then
to the first in byte order; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsight.llm.common import kept, pieces

#: Least occurrences of a phrase, most words of it, rows of a language's report.
LEAST, LONGEST, TOP = 100, 5, 2000
#: Bits of a bitmap (8 MB); occurrences of a prefix from which its stripe is dealt out, and to how many tasks.
SLOTS, HOT, SEGMENTS = 1 << 26, 1 << 18, 64
#: Words that a task counts at a time; distinct words and pairs of a language whose counts it holds, and places of
#: frequent parts whose phrases it counts together.
BLOCK, WORDS, HELD, RUNS = 1 << 18, 1 << 20, 1 << 21, 1 << 20
#: Words that are not frequent, of a language, that a task remembers as such.
RARE = 1 << 16
#: Splits of the input that a task counts together, where every core has a task all the same.
SPLITS = 4
#: Stands for a break between pieces among a text's words.
BREAK = b"."

#: Lower case for A-Z; a break for each mark that ends a piece; a space for a tab.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else BREAK[0] if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
#: A phrase's hash takes in its words' hashes one after the other, times this.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STRIPES = "lang string, prefix string, segment int, next array<string>, counts array<bigint>"


class _Numbers(dict):
    """Words' numbers in the order they are met. With a bitmap of ``frequent`` words all others have the
    break's, 0, as no frequent phrase holds them, and take no memory but that of the ``RARE`` met last."""

    def __init__(self, lang: str, frequent: np.ndarray | None):
        super().__init__({BREAK: 0})
        self.words, self._own, self._rare = [BREAK], lang.encode() + b"\n", 0
        self._frequent = None if frequent is None else memoryview(frequent)

    def __missing__(self, word: bytes) -> int:
        if self._frequent is not None:
            slot = xxhash.xxh64_intdigest(self._own + word) % (len(self._frequent) * 8)
            if not self._frequent[slot >> 3] >> (slot & 7) & 1:
                if self._rare == RARE:
                    self.clear()
                    self.update(zip(self.words, range(len(self.words))))
                    self._rare = 0
                self._rare += 1
                self[word] = 0
                return 0
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


def _blocks(
    batches: Iterator[pa.RecordBatch], block: int = BLOCK, most: int = WORDS, *, frequent: np.ndarray | None = None
) -> Iterator[tuple[str, list[bytes], np.ndarray, int, bool]]:
    """(lang, distinct words so far, their places in some of the texts, stop, done); place 0 is a break, or
    a word that is not ``frequent``. Phrases that begin before ``stop`` are the block's: the last words of a cut text begin the next block
    too. After a block that is ``done`` (at the end, or beyond ``most`` words) places are numbered anew."""
    held: dict[str, tuple[_Numbers, list[int]]] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if lang not in held:
                held[lang] = _Numbers(lang, frequent), []
            ids, places = held[lang]
            for part in pieces((text or b"").translate(_PLAIN).replace(BREAK, b" " + BREAK + b" ")):
                if len(places) > block:
                    stop = len(places) - LONGEST + 1
                    yield lang, ids.words, np.array(places, np.int64), stop, False
                    del places[:stop]
                places += [ids[w] for w in part.split()]
            places.append(0)
            if len(places) > block or len(ids.words) > most:
                yield lang, ids.words, np.array(places, np.int64), len(places), len(ids.words) > most
                places.clear()
                if len(ids.words) > most:
                    del held[lang]
    for lang, (ids, places) in held.items():
        yield lang, ids.words, np.array(places, np.int64), len(places), True


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    own = lang.encode() + b"\n"
    return np.fromiter((xxhash.xxh64_intdigest(own + w) for w in words), np.uint64, len(words))


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes % np.uint64(len(bitmap) * 8)
    return bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 == 1


def _stripes(lang: str, names: pa.Array, hot: np.ndarray, prefix: np.ndarray, following: np.ndarray,
             counts: np.ndarray, words: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Entries (prefix among ``names``, following word, count) as stripes, those of hot prefixes in segments."""
    segment = np.zeros(len(prefix), np.int64)
    spread = hot[prefix]
    if spread.any():
        deal = np.fromiter((xxhash.xxh64_intdigest(w, 1) % SEGMENTS for w in words), np.int64, len(words))
        segment[spread] = deal[following[spread]]
    order = np.lexsort((segment, prefix))
    prefix, segment, following, counts = prefix[order], segment[order], following[order], counts[order]
    first = np.flatnonzero(np.r_[True, (np.diff(prefix) != 0) | (np.diff(segment) != 0)])[: len(prefix)]
    texts = pa.array(words, pa.string())
    for at in range(0, len(first), 1 << 14):
        rows = first[at:at + (1 << 14)]
        end = first[at + (1 << 14)] if at + (1 << 14) < len(first) else len(prefix)
        ends = np.r_[rows - rows[0], end - rows[0]].astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array([lang]).take(pa.array(np.zeros(len(rows), np.int64))), names.take(pa.array(prefix[rows])),
            pa.array(segment[rows].astype(np.int32)),
            pa.ListArray.from_arrays(ends, texts.take(pa.array(following[rows[0]:end]))),
            pa.ListArray.from_arrays(ends, pa.array(counts[rows[0]:end])),
        ], names=["lang", "prefix", "segment", "next", "counts"])


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stripe of the empty prefix; its entry for a break holds the number of all words."""
    sums: dict[str, np.ndarray] = {}
    for lang, words, places, stop, done in _blocks(batches):
        counts = np.bincount(places[:stop], minlength=len(words))
        before = sums.pop(lang, counts[:0])
        counts[:len(before)] += before
        if not done:
            sums[lang] = counts
            continue
        counts[0] = counts[1:].sum()
        follow = np.flatnonzero(counts)
        yield from _stripes(lang, pa.array([""]), np.array([True]), np.zeros(len(follow), np.int64), follow, counts[follow], words)


def _known(hashes: dict[str, np.ndarray], lang: str, words: list[bytes], done: bool) -> np.ndarray:
    """The words' hashes; only those of new words are computed."""
    own = hashes.pop(lang, np.empty(0, np.uint64))
    own = np.concatenate([own, _hashes(lang, words[len(own):])])
    if not done:
        hashes[lang] = own
    return own


def _pairs(
    batches: Iterator[pa.RecordBatch], found: np.ndarray, hot: np.ndarray, *, frequent: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Stripes of one-word prefixes, of ``frequent`` words only, which are what was ``found`` before."""
    hashes, sums = {}, {}
    for lang, words, places, stop, done in _blocks(batches, frequent=frequent):
        own = _known(hashes, lang, words, done)
        both = np.flatnonzero((places[:-1] > 0) & (places[1:] > 0))
        both = both[both < stop]
        parts = [*sums.pop(lang, []), np.unique(places[both] << 32 | places[both + 1], return_counts=True)]
        if len(parts) > 8 or done:
            parts = [_summed(parts)]
        if not done and len(parts[0][0]) < HELD:
            sums[lang] = parts
            continue
        keys, counts = _summed(parts)
        yield from _stripes(lang, pa.array(words, pa.string()), _marked(hot, own), keys >> 32, keys & 0xFFFFFFFF, counts, words)


def _runs(places: np.ndarray, part: np.ndarray, known: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places within parts of ``known`` words, of which ``part`` says where they begin, that follow one
    another; whether a phrase that begins at a place is this block's, and whether a part begins there. Places of
    a part stay side by side, so parts that begin at two neighbours kept overlap."""
    chained = part & (np.r_[False, part[:-1]] | np.r_[part[1:], False])
    inside = chained.copy()
    for more in range(1, known):
        inside[more:] |= chained[:-more]
    kept_at = np.flatnonzero(inside)
    return places[kept_at], kept_at < stop, chained[kept_at]


def _longer(
    batches: Iterator[pa.RecordBatch], found: np.ndarray, hot: np.ndarray, known: int, longest: int, *,
    frequent: np.ndarray | None = None
) -> Iterator[pa.RecordBatch]:
    """Stripes of phrases of more than ``known`` and up to ``longest`` words, whose parts of ``known`` words were all
    ``found`` to be frequent, as their words are."""
    hashes, held = {}, {}
    for lang, words, places, stop, done in _blocks(batches, frequent=frequent):
        own = _known(hashes, lang, words, done)
        part, folded = np.zeros(len(places), bool), np.zeros(max(len(places) - known + 1, 0), np.uint64)
        part[:len(folded)] = True
        for more in range(known):
            each = places[more:more + len(folded)]
            folded = folded * _STEP + own[each]
            part[:len(folded)] &= each > 0
        part[:len(folded)] &= _marked(found, folded)
        runs = [*held.pop(lang, []), _runs(places, part, known, stop)]
        if done or sum(len(r[0]) for r in runs) > RUNS:
            yield from _phrases(lang, words, own, hot, known, longest, *(np.concatenate(x) for x in zip(*runs)))
        else:
            held[lang] = runs


def _phrases(
    lang: str, words: list[bytes], own: np.ndarray, hot: np.ndarray, known: int, longest: int,
    places: np.ndarray, begins: np.ndarray, part: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Stripes of prefixes of ``known`` words and more in runs of places."""
    at = np.flatnonzero(part)
    texts = pa.array(words, pa.string())
    joined = lambda names, one, two: pc.binary_join_element_wise(names.take(pa.array(one)), texts.take(pa.array(two)), " ")
    # The phrase that begins at each place, as its number among those found, and whether there is one.
    code, good = np.zeros(len(places), np.int64), part & begins
    numbers, names, hashes = places[at], texts, own
    for more in range(1, known):
        found, numbers = np.unique(numbers * len(words) + places[at + more], return_inverse=True)
        one, two = found // len(words), found % len(words)
        names, hashes = joined(names, one, two), hashes[one] * _STEP + own[two]
    code[at] = numbers
    spread = _marked(hot, hashes)
    for size in range(known + 1, longest + 1):
        reach = np.flatnonzero(good[:known - size] & part[size - known:])
        if not len(reach):
            return
        keys = code[reach] * len(words) + places[reach + size - 1]
        found, numbers, counts = np.unique(keys, return_inverse=True, return_counts=True)
        used, prefix = np.unique(found // len(words), return_inverse=True)
        following = found % len(words)
        names = names.take(pa.array(used))
        yield from _stripes(lang, names, spread[used], prefix, following, counts, words)
        # A longer prefix is dealt out where the one it begins with is: it is no more frequent.
        names, spread = joined(names, prefix, following), spread[used][prefix]
        code, good = np.zeros(len(places), np.int64), np.zeros(len(places), bool)
        code[reach], good[reach] = numbers, True


def _merged(stripes: DataFrame, least: int) -> DataFrame:
    """Entries (lang, prefix, following, f) of the elementwise sums of stripes that reach ``least``, and the numbers of
    all words. Stripes are shuffled as such and stay where their prefix and segment were dealt."""
    dealt = stripes.repartition("lang", "prefix", "segment")
    entries = dealt.select("lang", "prefix", "segment", F.inline(F.arrays_zip(F.col("next").alias("following"), F.col("counts").alias("f"))))
    sums = entries.groupBy("lang", "prefix", "segment", "following").agg(F.sum("f").alias("f"))
    return sums.where((F.col("f") >= least) | (F.col("following") == BREAK.decode())).drop("segment")


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """Hash slots of (lang, phrase), one bit each; ``SLOTS / 64`` numbers reach the driver at most."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            size = [p.count(" ") + 1 for p in names]
            hashes = np.fromiter((xxhash.xxh64_intdigest(f"{g}\n{w}".encode()) for g, p in zip(langs, names) for w in p.split(" ")),
                                 np.uint64, sum(size))
            last = np.cumsum(size, dtype=np.int64)
            folded, at = np.zeros(len(size), np.uint64), last - size
            for place in range(max(size, default=0)):
                more = at + place < last
                folded[more] = folded[more] * _STEP + hashes[at[more] + place]
            yield pa.RecordBatch.from_arrays([pa.array((folded % np.uint64(SLOTS)).astype(np.int64))], names=["slot"])

    slot = F.col("slot")
    cells = phrases.select("lang", "phrase").mapInArrow(slots, "slot bigint").groupBy(
        F.shiftright(slot, 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits"))
    found = cells.toArrow()
    out = np.zeros(SLOTS // 64, np.int64)
    out[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def _gathered(texts: DataFrame) -> DataFrame:
    """The texts in fewer tasks: one that counts more of them makes each stripe once, not once for every split.
    For a plain scan this runs nothing."""
    cores, splits = texts.sparkSession.sparkContext.defaultParallelism, texts.rdd.getNumPartitions()
    return texts.coalesce(max(cores, -(-splits // SPLITS)))


def _named(entries: DataFrame, purpose: str) -> DataFrame:
    phrase = F.when(F.col("prefix") == "", F.col("following")).otherwise(F.concat_ws(" ", "prefix", "following"))
    # What is frequent is little beside the stripes it was found in: a few files, not one for each of their tasks.
    return kept(entries.select("lang", "prefix", "following", phrase.alias("phrase"), "f").hint("rebalance"), purpose)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, prefix, following, phrase, f) of every phrase of up to ``LONGEST`` words that occurs ``least``
    times, and (lang, n), the words of each language."""
    spark = docs.sparkSession
    texts = _gathered(docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text")))
    words, total = _named(_merged(texts.mapInArrow(_words, _STRIPES), least), "words"), F.col("following") == BREAK.decode()
    totals, found = words.where(total).select("lang", F.col("f").alias("n")), words.where(~total)
    tables, frequent = [found], None
    for build in (_pairs, partial(_longer, known=2, longest=3), partial(_longer, known=3, longest=LONGEST)):
        marks = spark.sparkContext.broadcast((_bitmap(found), _bitmap(found.where(F.col("f") >= HOT))))
        frequent = frequent or marks  # of the words
        stripes = texts.mapInArrow(
            lambda batches, build=build, marks=marks, frequent=frequent: build(batches, *marks.value, frequent=frequent.value[0]),
            _STRIPES)
        found = _named(_merged(stripes, least), "phrases")
        tables.append(found)
    return reduce(DataFrame.unionByName, tables), totals


def _score(a: str, n: str, left: str, right: str):
    """floor(1000 * a * n / (l * r)), exact: products of up to 38 digits."""
    wide = f"CAST(CAST({a} AS DECIMAL(18,0)) * CAST({n} AS DECIMAL(16,0)) AS DECIMAL(34,0)) * CAST(1000 AS DECIMAL(4,0))"
    return F.expr(f"({wide}) div (CAST({left} AS DECIMAL(18,0)) * CAST({right} AS DECIMAL(18,0)))")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases of two words and
    more that no longer phrase contains as often: ``a`` the phrase's count, ``l`` and ``r`` those of its parts
    at the cut that scores least."""
    phrases, totals = frequent_phrases(docs, text, lang, least)
    longer = phrases.where(F.size(F.split("phrase", " ")) > 2)
    inner = longer.select("lang", F.explode(F.array(
        F.col("prefix"), F.expr("substring(phrase, locate(' ', phrase) + 1)"))).alias("phrase"), "f")
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    own = phrases.where("prefix != ''").select("lang", "phrase", F.col("f").alias("a"))
    own = own.join(most, ["lang", "phrase"], "left").where("most IS NULL OR 100 * most < 100 * a").drop("most")
    parts = own.withColumn("words", F.split("phrase", " ")).select(
        "lang", "phrase", "a", F.posexplode(F.expr("""transform(sequence(1, size(words) - 1), k -> struct(
            array_join(slice(words, 1, k), ' ') AS head, array_join(slice(words, k + 1, size(words)), ' ') AS tail))""")
        ).alias("k", "cut")).select("lang", "phrase", "a", "k", "cut.*")
    count = phrases.select("lang", F.col("phrase").alias("part"), "f")
    cuts = parts.join(count.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"]).join(
        count.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    scored = cuts.join(F.broadcast(totals), "lang").withColumn("score", _score("a", "n", "l", "r"))
    least_cut = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    ranked = least_cut.select("lang", "phrase", "cut.*").withColumn("rank", F.expr(
        "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)"))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
