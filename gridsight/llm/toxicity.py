"""Toxicity: a logistic regression over words and word beginnings that is penalised for reacting to identity terms.

The labelled texts that are learnt from are a bounded sample (``MAX_TRAIN``, by hash of the id). Words
that tell the classes apart are chosen from counts over that sample. For every sampled text that names a
group, counterfactual texts are made in which the named group is swapped for others of its kind; the loss
adds the squared change of the score under each swap. Texts are scored whole, in Arrow batches, against
the broadcast weights (``MAX_WORDS`` and the identity terms at most).

Cases: a NULL, empty or wordless text has the score of the intercept; labels that are NULL or not 0 or 1,
and rows without an id, teach nothing; equal texts with equal labels count once; without both labels the
score is the smoothed share of label 1; repeated documents are scored one by one; an empty table gives no
rows. A document's other columns are kept and never used; one named like the result is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsight.llm.common import WORD_BYTES, kept, pieces, utf8

#: Labelled documents that are learnt from at most, words with a weight at most, least texts of a word.
MAX_TRAIN, MAX_WORDS, MIN_TEXTS = 12_000, 1_000, 5
#: One id in so many is held out from learning.
FOLDS = 5
#: Lengths in bytes of the word beginnings that are features beside whole words.
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.5
#: Weight of the squared score change under swaps; of the absolute weights.
SWAP_PENALTY, SPARSITY = 10.0, 1e-4
#: Names of groups; a counterfactual puts another name of the same line in a name's place.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male", "transgender"),
    ("gay", "lesbian", "bisexual", "straight", "queer"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "european", "american", "mexican", "chinese", "indian", "russian", "turkish"),
    ("immigrants", "refugees", "foreigners", "natives"), ("disabled", "blind", "deaf"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "deutsche"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "français"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "españoles"),
)


class Model(NamedTuple):
    """Weights of words and of word beginnings (these hold a ``*``); words that have no beginnings."""

    weights: dict[bytes, float]
    intercept: float
    names: frozenset = frozenset()


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether nothing may be learnt from the row; rows without an id are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def features(text: bytes, names: frozenset | dict) -> set[bytes]:
    """The text's distinct words, and the beginnings of those that are no group's name."""
    found: set[bytes] = set()
    for part in pieces(text.translate(WORD_BYTES)):
        found.update(part.split())
    stems = {word[:size] + b"*" for word in found if word not in names for size in STEMS if len(word) >= size}
    return found | stems


def _swaps(identities: tuple) -> dict[bytes, list[bytes]]:
    names = [[name.encode() for name in line] for line in identities]
    return {name: [x for x in line if x != name] for line in names for name in line}


def counterfactuals(words: set[bytes], swaps: dict[bytes, list[bytes]]) -> list[set[bytes]]:
    """The text's words with each group it names swapped for each other of its kind."""
    return [words - {name} | {other} for name in sorted(words & swaps.keys()) for other in swaps[name]]


def sample(
    docs: DataFrame, labels: DataFrame, label: str, text: str, max_train: int, identities: tuple = IDENTITY_TERMS
) -> DataFrame:
    """(label, words) of up to ``max_train`` labelled rows outside the held-out fold."""
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out()).select("doc_id", F.col(label).cast("int").alias("y"))
    chosen = usable.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_train)

    @F.arrow_udf("array<binary>")
    def split(texts: pa.Array) -> pa.Array:
        names = _swaps(identities)
        return pa.array([sorted(features(t, names)) for t in texts.to_pylist()], pa.list_(pa.binary()))

    rows = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    once = rows.groupBy(F.xxhash64("text").alias("x"), F.md5(F.coalesce("text", F.lit(""))).alias("m"), "y").agg(
        F.first("text").alias("text"))
    # An id that many rows share would bring all their texts.
    bounded = once.orderBy("x", "m", "y").limit(max_train)
    return kept(bounded.select("y", split(utf8("text")).alias("words")), "sample")


def informative_words(rows: DataFrame, max_words: int, min_texts: int) -> list[bytes]:
    """Words by the chi-square of their presence and the label, largest first."""
    totals = rows.agg(F.count("*").alias("n"), F.sum("y").alias("n1")).first()
    n, n1 = totals.n, totals.n1 or 0
    if not 0 < n1 < n:
        return []
    counts = rows.select("y", F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("c"), F.sum("y").alias("c1")).where(F.col("c") >= min_texts)
    gap = F.col("c1") * float(n) - F.col("c") * float(n1)
    chi = gap * gap / (F.col("c") * (n - F.col("c")) * float(n1) * float(n - n1) + 1.0)
    best = counts.select("word", chi.alias("chi")).orderBy(F.desc("chi"), "word").limit(max_words)
    return [bytes(r.word) for r in best.collect()]


def _sparse(sets: list, at: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    columns = [sorted(at[w] for w in words if w in at) for words in sets]
    return (np.repeat(np.arange(len(sets)), [len(c) for c in columns]),
            np.array([c for one in columns for c in one], np.int64))


def learn(texts: list[set[bytes]], y: np.ndarray, vocabulary: list[bytes], identities: tuple,
          penalty: float = SWAP_PENALTY, sparsity: float = SPARSITY, rounds: int = 600) -> Model:
    """Weights that minimise class-balanced log loss + penalty * mean squared score change under swaps +
    sparsity * sum of absolute weights, by accelerated proximal gradients."""
    share = (y.sum() + 1) / (len(y) + 2)
    if not vocabulary:
        return Model({}, float(np.log(share / (1 - share))), frozenset(_swaps(identities)))
    swaps = _swaps(identities)
    vocabulary = [*dict.fromkeys([*vocabulary, *swaps])]
    at, size = {word: i for i, word in enumerate(vocabulary)}, len(vocabulary)
    row, column = _sparse(texts, at)
    before, after = [], []
    for words in texts:
        for other in counterfactuals(words, swaps):
            before.append(words & at.keys())
            after.append(other & at.keys())
    plus, minus = _sparse(after, at), _sparse(before, at)
    weight = np.where(y > 0, 1 / (2 * y.sum()), 1 / (2 * (len(y) - y.sum())))

    def forward(theta: np.ndarray) -> np.ndarray:
        return theta[-1] + np.bincount(row, theta[column], len(y))

    def backward(error: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(column, error[row], size), error.sum())

    def swapped(theta: np.ndarray) -> np.ndarray:
        """The gradient of the penalty."""
        if not before:
            return np.zeros_like(theta)
        change = np.bincount(plus[0], theta[plus[1]], len(before)) - np.bincount(minus[0], theta[minus[1]], len(before))
        change *= 2 * penalty / len(before)
        slope = np.bincount(plus[1], change[plus[0]], size) - np.bincount(minus[1], change[minus[0]], size)
        return np.append(slope, 0.0)

    steep = np.ones(size + 1)
    for _ in range(30):
        steep = backward(weight * forward(steep)) / 4 + swapped(steep)
        curvature = np.linalg.norm(steep)
        steep /= curvature
    theta = np.zeros(size + 1)
    ahead, speed = theta, 1.0
    for _ in range(rounds):
        error = weight * (1 / (1 + np.exp(-np.clip(forward(ahead), -50, 50))) - y)
        moved = ahead - (backward(error) + swapped(ahead)) / (1.1 * curvature)
        limit = sparsity / (1.1 * curvature)
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - limit, 0)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead, theta, speed = moved + (speed - 1) / faster * (moved - theta), moved, faster
    return Model({w: float(theta[i]) for w, i in at.items() if theta[i]}, float(theta[-1]), frozenset(swaps))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", max_train: int = MAX_TRAIN,
        max_words: int = MAX_WORDS, min_texts: int = MIN_TEXTS, identities: tuple = IDENTITY_TERMS,
        penalty: float = SWAP_PENALTY) -> Model:
    rows = sample(docs, labels, label, text, max_train, identities)
    vocabulary = informative_words(rows, max_words, min_texts)
    wanted = {*vocabulary, *_swaps(identities)}
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    @F.arrow_udf("array<binary>")
    def known(words: pa.Array) -> pa.Array:
        return pa.array([[w for w in row if w in shared.value] for row in words.to_pylist()], pa.list_(pa.binary()))

    table = rows.select("y", known("words").alias("words")).toArrow()
    order = sorted(zip(table["y"].to_pylist(), table["words"].to_pylist()))
    return learn([set(w) for _, w in order], np.array([y for y, _ in order], float), vocabulary, identities, penalty)


def score(text: str | Column, model: Model, spark) -> Column:
    """The probability of label 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, intercept, names = shared.value
        for texts in batches:
            totals = [
                math.fsum([intercept, *(weights[w] for w in features(t, names) & weights.keys())])
                for t in texts.to_pylist()]
            yield pa.array(1 / (1 + np.exp(-np.clip(totals, -700, 700))), pa.float64())

    return probability(utf8(text))


def scored(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    return docs.withColumn(into, score(text, model, docs.sparkSession))


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Only documents that score below the threshold, in their own columns."""
    model = fit(docs, labels, text=text)
    return docs.where(score(text, model, docs.sparkSession) < threshold)
