"""Mixing sources to target weights, cut at each source's exact budget.

Every document gets a hash-random key; documents are range-sorted by source and key, running sums of
sizes are taken within each range and moved on by what earlier ranges of the source hold, and a source's
budget is spent in that order: whole epochs first, then documents up to the budget, the one that crosses
it giving only its first words. Totals and targets are one row per source and per source and range; the
documents' texts take no part in the sort.

Cases: a NULL text has size 0; a NULL source is a source of its own, last; rows that repeat id and text
are put in some order, which changes no total; a source without words takes none; an empty table gives no
rows. Other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridsight.llm.common import kept, unused, utf8

#: Weights of the sources in code point order, repeated.
WEIGHTS = (1, 2, 3)
#: Times that a source may be used.
MAX_EPOCHS = 3


def _by_name() -> WindowSpec:
    """Sources by code point, NULL last; one row a source."""
    return Window.orderBy(F.col("source").isNull(), "source")



def size_of(text: str | Column = "text") -> Column:
    """The number of words between ASCII white space; 0 for NULL."""

    @F.arrow_udf("bigint")
    def words(texts: pa.Array) -> pa.Array:
        return pa.array([len(t.split()) for t in texts.to_pylist()], pa.int64())

    return words(utf8(text))


def targets(totals: DataFrame, weights: tuple = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    All words are shared by weight; a source stops at ``most`` times its size and the excess is shared
    again. The sources that stop are the first in order of size per weight, so one pass in that order
    settles all rounds (and one task, which sees one row a source): a source stops while its limit is below its share of what is left for it and
    those after it.
    """
    rank = F.row_number().over(_by_name())
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))
    share = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    ranked = totals.select("source", "source_size", weight.alias("weight")).select(
        "*", left.alias("left"), share.alias("share"))
    free = F.col("source_size") * most * F.col("share") >= F.col("left") * F.col("weight")
    first = F.first(F.when(free, F.struct("left", "share")), ignorenulls=True).over(
        by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = ranked.select("*", free.alias("free"), first.alias("level"))
    return level.select(
        "source", "source_size",
        F.when(F.col("free"), F.col("level.left") * F.col("weight") / F.col("level.share"))
        .otherwise(F.col("source_size") * most).cast("double").alias("target"),
    )


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Running sums of ``size`` within each source of a sorted range."""
    source, total = None, 0
    for rows in batches:
        if not len(rows):
            continue
        sums = rows.groupby("rank", sort=False)["size"].cumsum()
        if rows["rank"].iloc[0] == source:
            sums += (rows["rank"] == source) * total
        source, total = rows["rank"].iloc[-1], int(sums.iloc[-1])
        rows["upto"] = sums
        yield rows


def key_of(text: str = "text", seed: int = 0) -> Column:
    """The row's random key: 16 bytes that depend on its id and text alone."""
    return F.unhex(F.md5(F.concat_ws(
        "|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(text, F.lit("")))))


def mix(
    docs: DataFrame, text: str = "text", weights: tuple = WEIGHTS, most: int = MAX_EPOCHS, seed: int = 0
) -> DataFrame:
    """doc_id, source, key, size, source_size, target, epochs (whole uses), start (words before it in its
    source's order), rest (words of the last, broken epoch) and part (its own words in that) of every
    document."""
    sized = kept(
        docs.select("doc_id", "source", key_of(text, seed).alias("key"), size_of(text).alias("size")), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    goal = kept(
        targets(totals, weights, most).select(
            "*", epochs.alias("epochs"), (budget - epochs * F.col("source_size")).cast("bigint").alias("rest"),
            F.row_number().over(_by_name()).alias("rank")), "targets")
    ranked = sized.join(goal.select(F.col("source").alias("name"), "rank"), F.col("source").eqNullSafe(F.col("name")))
    order = ("rank", "key", "salt")
    numbered = (
        ranked.drop("name").withColumn("salt", F.monotonically_increasing_id())
        .repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
        .withColumn("range", F.spark_partition_id()))
    sums = kept(numbered.mapInPandas(_running, numbered.withColumn("upto", F.lit(0).cast("bigint")).schema), "sums")
    earlier = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = sums.groupBy("rank", "range").agg(F.sum("size").alias("held")).select(
        "rank", "range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("moved"))
    ranges = kept(held.join(goal.drop("source"), "rank"), "ranges")
    placed = sums.join(ranges, ["rank", "range"]).withColumn("start", F.col("moved") + F.col("upto") - F.col("size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start")))
    return placed.select(
        "doc_id", "source", "key", "size", "source_size", "target", "epochs", "start", "rest",
        part.cast("bigint").alias("part"))


def _first_words(text: Column, count: Column) -> Column:
    """The text up to the end of its ``count``-th word."""

    @F.arrow_udf("binary")
    def cut(texts: pa.Array, counts: pa.Array) -> pa.Array:
        out = []
        for content, wanted in zip(texts.to_pylist(), counts.to_pylist()):
            end = 0
            for _, found in zip(range(wanted), re.finditer(rb"[^\x20\x09-\x0D]+", content)):
                end = found.end()
            out.append(content[:end])
        return pa.array(out, pa.binary())

    return cut(utf8(text), count).cast("string")


def mixed_documents(
    docs: DataFrame, text: str = "text", weights: tuple = WEIGHTS, most: int = MAX_EPOCHS, seed: int = 0
) -> DataFrame:
    """The mix itself: a row for each use of a document, with the number of the ``epoch`` and, of a
    document that crosses the budget, only its first words. Where the documents have a column of that
    name, the number's column is ``epoch_``.

    Of the mix only each source's cut is kept, one row a source: the key at which its budget ends. The
    documents are then read once more and decided where they lie; none is shuffled but those with a
    cut's own key. A document without words is not used.
    """
    placed = mix(docs, text, weights, most, seed)
    cuts = kept(
        placed.groupBy("source").agg(
            F.max("epochs").alias("_epochs"), F.max("rest").alias("_rest"),
            F.max(F.when((F.col("start") < F.col("rest")) & (F.col("size") > 0), F.col("key"))).alias("_cut")), "cuts")
    at_cut = placed.join(
        cuts.select(F.col("source").alias("name"), "_cut"),
        F.col("source").eqNullSafe(F.col("name")) & (F.col("key") == F.col("_cut")), "left_semi")
    begins = at_cut.groupBy("source").agg(F.min("start").alias("_begin"))
    cuts = kept(
        cuts.withColumnRenamed("source", "_source").join(
            begins, F.col("_source").eqNullSafe(F.col("source")), "left").drop("source"), "cuts")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("_doc"), F.col("source").alias("_of"), key_of(text, seed).alias("_key")).join(
        cuts, F.col("_of").eqNullSafe(F.col("_source")))
    body = F.col("_doc").getField(text)
    has_words = body.rlike(r"[^\x20\x09-\x0D]")
    whole = F.when(F.col("_key") < F.col("_cut"), F.col("_epochs") + 1).otherwise(F.col("_epochs"))
    uses = F.explode(F.when(whole > 0, F.sequence(F.lit(1).cast("bigint"), whole)))
    complete = keyed.where(has_words).select("_doc", uses.alias("epoch"))
    nth = F.row_number().over(Window.partitionBy("_of", "_key").orderBy(F.col("_rest"))) - 1
    words = size_of(body)
    crossing = (
        keyed.where(has_words & (F.col("_key") == F.col("_cut")))
        .select("*", nth.alias("_nth"), words.alias("_size"))
        .withColumn("_part", F.least(F.col("_size"), F.col("_rest") - F.col("_begin") - F.col("_nth") * F.col("_size")))
        .where("_part > 0")
        .select(F.col("_doc").withField(text, _first_words(body, F.col("_part"))).alias("_doc"),
                (F.col("_epochs") + 1).alias("epoch")))
    return complete.unionByName(crossing).select("_doc.*", F.col("epoch").alias(unused(docs, "epoch")))
