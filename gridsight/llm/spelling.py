"""Spelling variants of a corpus's words, by a frontier that walks a trie as a relation.

Two words are near if one inserted, deleted or replaced code point makes one the other. All words lie in
two tries, one over their spellings and one over them backwards: an edit leaves one half of a word as it
is, so a search need not start at the root but where that half ends, where branches are few. A state is
(word, position, node, edited); a node is the spelling that leads to it. The tries go down level by level:
the states at one depth meet that depth's level of the edge table in an equality join. A state without
an edit leaves its own path by a child that its word does not take (replaced, inserted, or one of its
letters skipped), a state with one follows its word. Every word ends in ``END``, so a state that reaches it
is a near word. An edge also says which letters come after it, which ends most states before
they are shuffled.

A level's edges are one row a node, gathered by a map-side combined set: at most alphabet x alphabet short strings,
however many words pass. States of a frequent node are many rows of one join key, which adaptive
execution splits. Words of ``LONG`` code points and more would take a level for each: they are found by
an equality join of hashes of their spellings with one code point left out, verified by edit distance.

Cases: NULL and empty texts have no words; a text of any length is read whole, a word of any length is
compared whole; repeated rows count again; an empty table gives no rows; a NULL id reads as the empty text
where a spelling depends on it; other columns play no part. Equal counts go to the spelling first in
code-point order.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from gridsight.llm.common import kept

#: Letters of a word, its least code points and occurrences, and how many times as frequent a form is.
LETTERS, MIN_LENGTH, MIN_COUNT, RATIO = r"A-Za-zÀ-ÿ", 7, 2, 10
#: Code points from which on a word is found by its hashes instead of the trie.
LONG = 40
#: Ends every spelling; no letter.
END = "."

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def vocabulary(
    docs: DataFrame, text: str = "text", spelling: Callable[[Column], Column] = lambda run: run,
    min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n): the runs of letters in all texts, A-Z in lower case, as ``spelling`` writes them, with
    their occurrences. ``spelling`` may use the documents' columns and may shorten a run, not lengthen it."""
    run = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0)))
    runs = docs.withColumn("run", run).withColumn("run", F.translate("run", UPPER, LOWER))
    words = runs.select(spelling(F.col("run")).alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _sides(words: DataFrame) -> DataFrame:
    """Each word forwards and backwards: spelling with its end, size, the depth from which its own states
    leave its path, and the depth from which a near word's states may use its edges."""
    size = F.length("word")
    half, least = F.expr("length(word) div 2"), F.expr("(length(word) - 1) div 2")
    on = words.select(
        F.lit(False).alias("back"), F.concat("word", F.lit(END)).alias("spelling"), size.alias("size"),
        half.alias("start"), least.alias("low"))
    back = words.select(
        F.lit(True).alias("back"), F.concat(F.reverse("word"), F.lit(END)).alias("spelling"), size.alias("size"),
        (size - half).alias("start"), (size - 1 - least).alias("low"))
    return kept(on.unionByName(back), "sides").withColumns({c: F.col(c).cast("int") for c in ("start", "low")})


def _at(place: Column) -> Column:
    """The letter of a state's word at a position from 0."""
    return F.substring(F.col("spelling"), place + 1, F.lit(1))


def edges(sides: DataFrame, depth: int) -> DataFrame:
    """The edge table at a depth: (back, node, children), a child being the letter of its edge and the
    letters of the edges after it."""
    own = sides.where((F.col("low") <= depth) & (F.col("size") >= depth))
    pairs = own.select(
        "back", F.substring("spelling", 1, depth).alias("node"), F.substring("spelling", depth + 1, 2).alias("two")
    ).groupBy("back", "node").agg(F.collect_set("two").alias("two"))
    letters = F.array_distinct(F.transform("two", lambda t: F.substring(t, 1, 1)))
    after = lambda letter: F.array_join(
        F.transform(F.filter("two", lambda t: F.startswith(t, letter)), lambda t: F.substring(t, 2, 1)), "")
    return pairs.select(
        "back", "node",
        F.transform(letters, lambda letter: F.struct(letter.alias("letter"), after(letter).alias("after"))).alias("children"))


def advance(states: DataFrame, level: DataFrame) -> DataFrame:
    """The states one edge further down, among them those that found a near word (``done``)."""
    at, letter, size, edited = F.col("at"), F.col("letter"), F.col("size"), F.col("edited")
    met = states.join(level, ["back", "node"]).select(*states.columns, F.inline("children"))
    met = met.where(edited == (letter == _at(at)))
    further = lambda place: F.contains("after", _at(place))
    moves = F.array(
        F.when(edited & further(at + 1), at + 1).when(~edited & (letter != END) & further(at), at),
        F.when(~edited & (letter != END) & (at < size) & further(at + 1), at + 1),
        F.when(~edited & (at < size) & (letter == _at(at + 1)) & ((letter == END) | further(at + 2)), at + 2))
    moved = met.select("back", "spelling", "size", "node", "letter", F.explode(moves).alias("at"))
    return moved.where("at IS NOT NULL").select(
        "back", "spelling", "size", "at", F.lit(True).alias("edited"),
        F.when(letter == END, F.col("node")).otherwise(F.concat("node", "letter")).alias("node"),
        ((letter == END) | (_at(F.col("at")) == END)).alias("done"))


def _trie_pairs(words: DataFrame) -> DataFrame:
    """Pairs (word, near) found by the tries, level by level; a pair may come twice."""
    sides, frontier, found = _sides(words), None, None
    first, last = sides.agg(F.min("start"), F.max("size")).first()
    for depth in range(first, last + 1):
        own = sides.where((F.col("start") <= depth) & (F.col("size") >= depth)).select(
            "back", "spelling", "size", F.lit(depth).alias("at"), F.lit(False).alias("edited"),
            F.substring("spelling", 1, depth).alias("node"))
        states = own if frontier is None else own.unionByName(frontier)
        moved = kept(advance(states, edges(sides, depth)), "frontier")
        done = moved.where("done").select("back", F.expr("left(spelling, size)").alias("word"), F.col("node").alias("near"))
        found = done if found is None else found.unionByName(done)
        frontier = moved.where("NOT done").drop("done")
    turned = lambda name: F.when(F.col("back"), F.reverse(name)).otherwise(F.col(name)).alias(name)
    return found.select(turned("word"), turned("near"))


def _without_one(word: str) -> np.ndarray:
    """Hashes of the word and of the word without each of its code points, in one pass over it."""
    points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    powers = np.full(len(points), _BASE)
    powers[0] = 1
    sums = np.cumsum(points * np.cumprod(powers), dtype=np.uint64)
    before = np.concatenate([[np.uint64(0)], sums[:-1]])
    return np.append(before + (sums[-1] - sums) * _BACK, sums[-1])


@F.arrow_udf(ArrayType(LongType()))
def shortened(words: pa.Array) -> pa.Array:
    """Per word, the distinct hashes of ``_without_one``."""
    keys = [np.unique(_without_one(w)).view(np.int64) for w in words.to_pylist()]
    ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int64), *keys]))


def _long_pairs(words: DataFrame) -> DataFrame:
    """Pairs (word, near) of words that share a hash, verified by edit distance."""
    keys = words.select("word", F.explode(shortened("word")).alias("key"))
    met = keys.join(keys.withColumnRenamed("word", "near"), "key").where("word != near").select("word", "near").distinct()
    return met.where(F.levenshtein("word", "near", 1) == 1)


def near_words(words: DataFrame, long: int = LONG) -> DataFrame:
    """Every pair (word, near) of different near words, both ways, once. ``words`` holds distinct words
    of two letters or more, none of which contains ``END``."""
    words = kept(words.select("word"), "words")
    longest = words.agg(F.max(F.length("word"))).first()[0]
    if longest is None:
        return words.withColumn("near", F.col("word"))
    short = words.where(F.length("word") <= long)
    pairs = None if short.isEmpty() else _trie_pairs(short)
    if longest >= long:
        rest = _long_pairs(words.where(F.length("word") >= long))
        pairs = rest if pairs is None else pairs.unionByName(rest)
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the end of its chain of forms, by doubling. A form is more
    frequent than its word, so chains have no loops and are short."""
    now = kept(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("end"))
        after = kept(now.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root"), "end"), "roots")
        if after.where("end IS NOT NULL").isEmpty():
            return after.select("word", "root")
        now = after.drop("end")


def variants(words: DataFrame, ratio: int = RATIO, long: int = LONG) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of (word, n): how many words are near, the most
    frequent of them where it is ``ratio`` times as frequent, and the end of the chain of forms."""
    words = kept(words.select("word", "n"), "vocabulary")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = near_words(words, long).join(counts, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near"))).alias("best"))
    taken = -F.col("best.n") >= ratio * F.col("n")
    told = kept(words.join(met, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.n")).alias("form_n")), "forms")
    roots = _roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
