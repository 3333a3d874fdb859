"""Benchmark decontamination: a broadcast set of test n-grams is held against every training window.

The benchmark's windows are numbered word sequences. Their hashes are broadcast in blocks of a fixed
number of windows (``MAX_WINDOWS``), so that no broadcast grows with the benchmark; a larger benchmark
takes several passes over the documents. A document is read once per block: words become numbers of
the block's vocabulary, window hashes are computed for the whole block of text at once, and each match
of a hash is verified word for word.

Cases: a NULL or wordless text has no words and no hits; a NULL or wordless item has no windows;
repeated items count once by their id, and an item without an id counts as one with the id ``''``;
repeated documents are judged one by one; an empty benchmark hits nothing. Columns of the documents are
kept under their own names, whatever they are, but for one named like the result, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsight.llm.common import WORD_BYTES, blocks, checkpointed, offsets, pieces, unused, utf8, words_of

#: Words to a window.
WINDOW = 10
#: Windows broadcast at once: about 100 bytes each, so 100 MB at most.
MAX_WINDOWS = 1_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_RESULT = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"
_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each item id and distinct window: its words, space-separated."""

    @F.arrow_udf("array<binary>")
    def windows(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            words = words_of(text)
            last = max(len(words) - window, 0) + 1 if words else 0
            out.append([b" ".join(words[i:i + window]) for i in range(last)])
        return pa.array(out, pa.list_(pa.binary()))

    return benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.explode(windows(utf8("text"))).alias("window"),
    ).distinct()


class WindowSet:
    """Windows as rows of word numbers, sorted by hash for each length."""

    def __init__(self, windows: list[bytes], items: list[str]) -> None:
        self.vocabulary: dict[bytes, int] = {b"|": -2}
        self.items = sorted(set(items))
        at = {item: i for i, item in enumerate(self.items)}
        found: dict[bytes, list[int]] = {}
        for window, item in zip(windows, items):
            found.setdefault(window, []).append(at[item])
        by_length: dict[int, list] = {}
        for window, owners in found.items():
            words = window.split(b" ")
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            by_length.setdefault(len(words), []).append((numbers, owners))
        self.lengths = {}
        for length, rows in by_length.items():
            ids = np.array([r[0] for r in rows], np.int64)
            hashes = _hashes(ids.T)
            order = np.argsort(hashes, kind="stable")
            owners = [rows[i][1] for i in order]
            self.lengths[length] = (
                hashes[order], ids[order], offsets([len(o) for o in owners]),
                np.array([i for o in owners for i in o], np.int64),
            )

    def matches(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each window length: positions of matches in a run of word numbers, and which
        window matched there. Numbers below 0 are words that no window has, or ends of texts."""
        unknown = offsets(ids < 0)
        for length, (hashes, rows, _, _) in self.lengths.items():
            if len(ids) < length:
                continue
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            value = _hashes([ids[at + j] for j in range(length)]) if len(at) else np.empty(0, np.uint64)
            first = np.searchsorted(hashes, value)
            while len(at):
                same = first < len(hashes)
                same[same] = hashes[first[same]] == value[same]
                at, value, first = at[same], value[same], first[same]
                equal = np.ones(len(at), bool)
                for j in range(length):
                    equal &= rows[first, j] == ids[at + j]
                yield length, at[equal], first[equal]
                at, value, first = at[~equal], value[~equal], first[~equal] + 1

    def scan(self, texts: list[bytes]) -> list[tuple[int, list, list]]:
        """(words, hit spans in words, items) of each text."""
        numbers, get = [], self.vocabulary.get
        for part in pieces(b" | ".join(t.translate(WORD_BYTES) for t in texts)):
            words = part.split()
            numbers.append(np.fromiter(map(get, words, repeat(-1)), np.int64, len(words)))
        ids = np.concatenate(numbers)
        ends = np.append(np.flatnonzero(ids == -2), len(ids))
        starts = np.append(0, ends[:-1] + 1)
        change = np.zeros(len(ids) + 1, np.int64)
        pairs = [np.empty((0, 2), np.int64)]
        for length, at, which in self.matches(ids):
            np.add.at(change, at, 1)
            np.add.at(change, at + length, -1)
            begin, owners = self.lengths[length][2:]
            count = begin[which + 1] - begin[which]
            inside = np.arange(count.sum()) - np.repeat(offsets(count)[:-1], count)
            items = owners[np.repeat(begin[which], count) + inside]
            pairs.append(np.stack([np.repeat(np.searchsorted(ends, at), count), items], 1))
        edges = np.diff((np.cumsum(change) > 0).astype(np.int8), prepend=0)
        opens, closes = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        out = [(int(e - s), [], []) for s, e in zip(starts, ends)]
        for text, s, e in zip(np.searchsorted(ends, opens).tolist(), opens.tolist(), closes.tolist()):
            out[text][1].append((s - int(starts[text]), e - int(starts[text])))
        for text, item in np.unique(np.concatenate(pairs), axis=0).tolist():
            out[text][2].append(self.items[item])
        return out


def _hashes(columns) -> np.ndarray:
    value = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        value = (value + column.astype(np.uint64) + np.uint64(1)) * _MIX
        value ^= value >> np.uint64(29)
    return value


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(shared) -> Column:
    @F.arrow_udf(_RESULT)
    def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        windows = shared.value
        for texts, before in batches:
            texts, before = texts.to_pylist(), before.to_pylist()
            rows = [r for s, e in blocks(texts) for r in windows.scan(texts[s:e])]
            for i, old in enumerate(before):
                if old is not None:
                    spans = [(x["start"], x["end"]) for x in old["spans"]]
                    rows[i] = (rows[i][0], _merged(spans + rows[i][1]), sorted({*old["items"], *rows[i][2]}))
            yield pa.array(
                [{"n_words": n, "spans": [{"start": s, "end": e} for s, e in spans], "items": items}
                 for n, spans, items in rows], _ARROW)

    return scan


def mark_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
    max_windows: int = MAX_WINDOWS, into: str = "leaks",
) -> DataFrame:
    """The documents with a struct ``into``: words, merged word spans that occur in the benchmark,
    and the items whose windows occur (ids as text, sorted)."""
    spark = docs.sparkSession
    windows = checkpointed(benchmark_windows(benchmark, window))
    parts = max(1, -(-windows.count() // max_windows))
    out = docs.withColumn(into, F.lit(None).cast(_RESULT))
    for part in range(parts):
        rows = windows.where(F.pmod(F.xxhash64("item", "window"), F.lit(parts)) == part).toArrow()
        shared = spark.sparkContext.broadcast(
            WindowSet(rows["window"].to_pylist(), rows["item"].to_pylist()))
        out = out.withColumn(into, _scan(shared)(utf8(text), F.col(into)))
        if parts > 1:
            out = checkpointed(out)
    return out


def n_hit(leaks: str = "leaks") -> Column:
    """Words inside hit spans."""
    return F.aggregate(F.col(f"{leaks}.spans"), F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Only documents without a word of the benchmark's windows, in their own columns."""
    into = unused(docs, "_leaks")
    return mark_leaks(docs, benchmark, text, window, into=into).where(F.size(f"{into}.spans") == 0).drop(into)


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """All documents, without the hit spans: from a span's first word to the end of its last."""
    into = unused(docs, "_leaks")

    @F.arrow_udf("binary")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for content, hits in zip(texts.to_pylist(), spans.to_pylist()):
            plain, at, word, rest = content.translate(WORD_BYTES), 0, -1, []
            bounds = [x for s in hits for x in (s["start"], s["end"] - 1)]
            begin = 0
            for k, wanted in enumerate(bounds):
                while word < wanted:
                    first = at
                    while plain[first:first + 1] == b" ":
                        first += 1
                    end = plain.find(b" ", first)
                    at, word = (end if end >= 0 else len(plain)), word + 1
                    start = first
                if k % 2 == 0:
                    rest.append(content[begin:start])
                else:
                    begin = at
            out.append(b"".join([*rest, content[begin:]]))
        return pa.array(out, pa.binary())

    marked = mark_leaks(docs, benchmark, text, window, into=into)
    changed = F.size(f"{into}.spans") > 0
    clean = cut(F.when(changed, utf8(text)).otherwise(F.lit(b"")),
                F.when(changed, F.col(f"{into}.spans")).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>")))
    return marked.withColumn(text, F.when(changed, clean.cast("string")).otherwise(F.col(text))).drop(into)
