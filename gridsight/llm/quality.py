"""Quality rules: plain counts, and a calibrated logistic regression over hashed n-grams.

The features of a text are the frequencies of its byte trigrams (A-Z lowered) and of its words and word
pairs, each hashed into ``BUCKETS``. The labelled rows that are learnt from are a bounded sample
(``MAX_TRAIN``, by hash of the id); one in ``FOLDS`` of them is kept back to fit the calibration, which
turns the raw score into a probability of label 1. Texts are scored whole, in Arrow batches, and held
against fixed thresholds.

Cases: a NULL, empty or blank text has no words, fails the base rules and is not kept; labels that are
NULL or not 0 or 1, and rows without an id, teach nothing; equal texts with equal labels count once;
with one label only, or none, every text has the same probability; repeated documents are judged one by
one; an empty table gives no rows. A document's other columns are kept and never used; one named like
the result is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsight.llm.common import blocks, offsets, utf8

#: Fixed values of the rules: least words, most percent of words in repeated 3-word windows.
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 50, 3, 50
#: Least probability of label 1 at which a document is kept.
KEEP = 0.5
#: Labelled documents that are learnt from at most; buckets of each kind of feature; part kept back.
MAX_TRAIN, BUCKETS, FOLDS = 4_000, 1 << 16, 5

_SPACE = bytes((9, 10, 11, 12, 13, 32))
_NOT_CODE_POINTS = _SPACE + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
_COUNTS = pa.struct([(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])


class Model(NamedTuple):
    grams: np.ndarray
    words: np.ndarray
    intercept: float
    slope: float
    shift: float


def repeated_words(ids: np.ndarray, vocabulary: int, window: int = WINDOW) -> int:
    """Words that lie in a window of words that occurs twice or more, first occurrence included."""
    count = len(ids) - window + 1
    if count < 2:
        return 0
    key, span = ids[:count].astype(np.int64), vocabulary
    for i in range(1, window):
        if span * vocabulary >= 1 << 62:
            found, key = np.unique(key, return_inverse=True)
            span = len(found)
        key = key * vocabulary + ids[i:count + i]
        span *= vocabulary
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    again = np.zeros(count, bool)
    again[order[:-1][same]] = True
    again[order[1:][same]] = True
    covered = np.zeros(len(ids), bool)
    for i in range(window):
        covered[i:count + i] |= again
    return int(covered.sum())


class Block:
    """Words of several texts as numbers of one vocabulary, text after text."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = texts
        known: dict[bytes, int] = {}
        parts = []
        for text in texts:
            words = text.split()
            parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
        self.ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
        self.starts = offsets([len(p) for p in parts])
        self.known = known

    def counts(self) -> list[dict]:
        out = []
        for i, text in enumerate(self.texts):
            ids = self.ids[self.starts[i]:self.starts[i + 1]]
            lines = [x for x in text.split(b"\n") if x and not x.isspace()]
            out.append({
                "n_words": len(ids), "word_chars": len(text.translate(None, _NOT_CODE_POINTS)),
                "n_symbols": len(text) - len(text.translate(None, _SYMBOLS)),
                "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated_words(ids, len(self.known)),
            })
        return out

    def features(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Buckets of byte trigrams and of words and pairs, each with the texts' offsets."""
        data = np.frombuffer(b"".join(t.translate(_LOWER) for t in self.texts), np.uint8).astype(np.uint64)
        bounds = offsets([len(t) for t in self.texts])
        grams = _buckets(data[:-2] | data[1:-1] << np.uint64(8) | data[2:] << np.uint64(16)) if len(data) > 2 else data[:0].astype(np.int64)
        whole = np.ones(len(grams), bool)
        for end in bounds[1:-1].tolist():
            whole[max(end - 2, 0):end] = False
        kept_before = offsets(whole)
        gram_bounds = kept_before[np.minimum(bounds, len(grams))]
        hashes = np.fromiter((zlib.crc32(w.translate(_LOWER)) for w in self.known), np.uint64, len(self.known))[self.ids]
        single = _buckets(hashes)
        pairs = _buckets(hashes[:-1] * np.uint64(0x100000001B3) + hashes[1:] + np.uint64(1)) if len(hashes) > 1 else single[:0]
        inside = np.ones(len(pairs), bool)
        inside[[e - 1 for e in self.starts[1:-1].tolist() if 0 < e <= len(pairs)]] = False
        pair_bounds = offsets(inside)[np.minimum(self.starts, len(pairs))]
        return (grams[whole], gram_bounds), _interleaved(single, self.starts, pairs[inside], pair_bounds)


def _buckets(value: np.ndarray) -> np.ndarray:
    return ((value * _MIX) >> _SHIFT).astype(np.int64)


def _interleaved(one, one_bounds, two, two_bounds) -> tuple[np.ndarray, np.ndarray]:
    """Two runs for each text, one behind the other."""
    bounds = one_bounds + two_bounds
    out = np.empty(len(one) + len(two), np.int64)
    out[np.arange(len(one)) + np.repeat(two_bounds[:-1], np.diff(one_bounds))] = one
    out[np.arange(len(two)) + np.repeat(one_bounds[1:], np.diff(two_bounds))] = two
    return out, bounds


def _means(weights: np.ndarray, run: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    buckets, bounds = run
    upto = np.concatenate([[0.0], np.cumsum(weights[buckets])])
    return (upto[bounds[1:]] - upto[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)


def raw_scores(block: Block, model: Model) -> np.ndarray:
    grams, words = block.features()
    return model.intercept + _means(model.grams, grams) + _means(model.words, words)


def probabilities(raw: np.ndarray, model: Model) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.slope * raw + model.shift, -700, 700)))


def _rows(texts: list[bytes]) -> Iterator[Block]:
    for start, end in blocks(texts):
        yield Block(texts[start:end])


def _count(texts: Column) -> Column:
    @F.arrow_udf("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint>")
    def count(batch: pa.Array) -> pa.Array:
        return pa.array([r for b in _rows(batch.to_pylist()) for r in b.counts()], _COUNTS)

    return count(texts)


def _judge(shared) -> Column:
    @F.arrow_udf("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,quality:double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            out = []
            for block in _rows(texts.to_pylist()):
                good = probabilities(raw_scores(block, model), model).tolist()
                out += [row | {"quality": p} for row, p in zip(block.counts(), good)]
            yield pa.array(out, pa.struct([*_COUNTS, ("quality", pa.float64())]))

    return judge


def sample(docs: DataFrame, labels: DataFrame, label: str, text: str, max_train: int) -> DataFrame:
    """(y, back, grams, gram_share, words, word_share) of up to ``max_train`` labelled rows: buckets and
    frequencies; ``back`` marks those kept back."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("y"), (fold == 0).alias("back"))
    chosen = usable.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_train)

    @F.arrow_udf("struct<grams:array<int>,gram_share:array<float>,words:array<int>,word_share:array<float>>")
    def hashed(texts: pa.Array) -> pa.Array:
        out = []
        for block in _rows(texts.to_pylist()):
            runs = block.features()
            for i in range(len(block.texts)):
                row = {}
                for name, (buckets, bounds) in zip(("gram", "word"), runs):
                    found, seen = np.unique(buckets[bounds[i]:bounds[i + 1]], return_counts=True)
                    row |= {f"{name}s": found.astype(np.int32), f"{name}_share": (seen / max(seen.sum(), 1)).astype(np.float32)}
                out.append(row)
        ints, floats = pa.list_(pa.int32()), pa.list_(pa.float32())
        return pa.array(out, pa.struct([("grams", ints), ("gram_share", floats), ("words", ints), ("word_share", floats)]))

    rows = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    once = rows.groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("m"), "y").agg(
        F.first("text").alias("text"), F.min("back").alias("back"))
    # An id that many rows share would bring all their texts.
    bounded = once.orderBy("m", "y").limit(max_train)
    return bounded.select("m", "y", "back", hashed(utf8("text")).alias("x")).select("m", "y", "back", "x.*")


def _descend(row, column, value, y, size: int, rounds: int, ridge: float) -> np.ndarray:
    """Weights and intercept of least log loss plus ridge."""
    theta, mean, square = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        z = theta[-1] + np.bincount(row, theta[column] * value, len(y))
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
        slope = np.append(np.bincount(column, error[row] * value, size), error.sum())
        slope[:-1] += ridge * theta[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        theta -= 0.5 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return theta


def _platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the raw scores of kept-back rows probabilities, by Newton steps on
    smoothed labels."""
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    x = np.stack([raw, np.ones(len(raw))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta -= np.linalg.solve(curve, x.T @ (p - goal) + 1e-3 * (beta - [1.0, 0.0]))
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text",
        max_train: int = MAX_TRAIN, rounds: int = 120, ridge: float = 1e-7) -> Model:
    rows = sample(docs, labels, label, text, max_train).toArrow().sort_by([("m", "ascending"), ("y", "ascending")])
    y = rows["y"].to_numpy().astype(float)
    back = rows["back"].to_numpy(zero_copy_only=False).astype(bool)
    share = (y.sum() + 1) / (len(y) + 2)
    flat = Model(np.zeros(BUCKETS), np.zeros(BUCKETS), float(np.log(share / (1 - share))), 1.0, 0.0)
    if len(set(y[~back])) < 2:
        return flat
    parts = []
    for name, shift in (("gram", 0), ("word", BUCKETS)):
        lists, shares = rows[f"{name}s"].combine_chunks(), rows[f"{name}_share"].combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        parts.append((np.repeat(np.arange(len(y)), counts), lists.flatten().to_numpy() + shift, shares.flatten().to_numpy()))
    row, column, value = (np.concatenate(p) for p in zip(*parts))
    del rows, parts
    learn = ~back[row]
    place = np.cumsum(~back) - 1
    theta = _descend(place[row[learn]], column[learn], value[learn].astype(float), y[~back], 2 * BUCKETS, rounds, ridge)
    raw = theta[-1] + np.bincount(row, theta[column] * value, len(y))
    slope, shift = _platt(raw[back], y[back]) if len(set(y[back])) == 2 else (1.0, 0.0)
    return Model(theta[:BUCKETS], theta[BUCKETS:-1], float(theta[-1]), slope, shift)


def judged(docs: DataFrame, model: Model, text: str = "text", into: str = "judged") -> DataFrame:
    """The documents with a struct ``into``: the counts, base_failed, quality and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.withColumn(into, _judge(shared)(utf8(text)))
    field = F.col(into).getField
    failed = (field("n_words") < MIN_WORDS) | (100 * field("n_repeat_words") > MAX_REPEAT_PERCENT * field("n_words"))
    good = ~failed & (field("quality") >= KEEP)
    return out.withColumn(into, F.col(into).withField("base_failed", failed).withField("kept", good))


def counted(docs: DataFrame, text: str = "text", into: str = "counts") -> DataFrame:
    """The documents with a struct ``into`` of the plain counts alone."""
    return docs.withColumn(into, _count(utf8(text)))
