"""Feeder time series: the period panel, labels, lags and input sequences for fault models.

Panels hold one row per feeder and period, so what is gathered of a feeder is bounded by the
calendar however many outages it has. ``lag_features`` and ``has_future_*`` work on raw outage
rows, where one feeder may hold a third of the table: the first two sort the rows into ranges and
carry over the last rows of a range, the third aggregates each feeder's hours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, IntegerType, StructField, StructType

from gridsight.functions.measures import Measure, aggregate
from gridsight.operators.joins import stored, tasks_for
from gridsight.session import shared_dir


def period_start(at: str, unit: str) -> Column:
    return F.date_trunc(unit, F.col(at)).cast("date")


def feeder_panel(
    df: DataFrame,
    feeder: str,
    at: str,
    unit: str,
    measures: list[Measure],
    fault: Column,
) -> DataFrame:
    """One row per feeder and period, quiet periods included, with a 0/1 fault flag.

    Periods run from the table's first to its last. The source is read once: its sums per feeder and
    period are stored, and bounds and feeders are taken from those. The calendar is generated per
    feeder from the two bounds, which come from a one-row subquery; nothing is cross joined.

    A feeder's rows lie together, in as many partitions as the panel's rows ask for: a row is a few bytes,
    so partitions sized by bytes would give the sequences made of them to a task or two.
    """
    step = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month"}[unit]
    rows = df.withColumn("period", period_start(at, unit)).withColumn(
        "is_fault", F.when(fault, 1).otherwise(0)
    )
    seen = stored(
        aggregate(rows, [feeder, "period"], [*measures, Measure("faults", "sum", "is_fault")]), "panel")
    ends = seen.agg(F.min("period").alias("first"), F.max("period").alias("last"))
    calendar = F.sequence(
        ends.select("first").scalar(), ends.select("last").scalar(), F.expr(step)
    )
    spine = seen.select(feeder).distinct().select(feeder, F.explode(calendar).alias("period"))
    counted = ["faults"] + [m.name for m in measures if m.kind in ("count", "sum")]
    periods = F.coalesce(F.size(F.sequence(F.min("period"), F.max("period"), F.expr(step))), F.lit(0))
    tasks = tasks_for(seen.agg(F.approx_count_distinct(feeder) * periods).first()[0])
    dealt = [side.repartition(tasks, feeder, "period") for side in (spine, seen)]
    return (
        dealt[0].join(dealt[1], [feeder, "period"], "left")
        .repartition(tasks, feeder)
        .fillna(0, counted)
        .withColumn("fault", (F.col("faults") > 0).cast("int"))
        .drop("faults")
    )


def calendar_features(panel: DataFrame, period: str = "period") -> DataFrame:
    return panel.withColumns({"year": F.year(period), "month_number": F.month(period)})


def next_period_target(panel: DataFrame, feeder: str, period: str, flag: str) -> DataFrame:
    """The label is the feeder's next fault flag; the last period has none and is dropped."""
    order = Window.partitionBy(feeder).orderBy(period)
    return panel.withColumn("target", F.lead(flag).over(order)).filter(F.col("target").isNotNull())


def _inputs(features: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features])


def _steps(panel: DataFrame, feeder: str, period: str, features: list[str], *more: str) -> DataFrame:
    """A feeder's periods in order, each with its inputs, as one array: as long as the calendar."""
    step = F.struct(F.col(period).alias("period"), _inputs(features).alias("inputs"), *more)
    return panel.groupBy(feeder).agg(F.sort_array(F.collect_list(step)).alias("steps"))


def _run(end: Column, length: int) -> Column:
    """The inputs of the ``length`` periods up to the one at ``end``, counted from 1."""
    return F.slice("steps", end - (length - 1), F.lit(length))["inputs"]


def sliding_sequences(
    panel: DataFrame, feeder: str, period: str, features: list[str], target: str, length: int
) -> DataFrame:
    """Each run of ``length`` periods of a feeder, labelled with the next row's target.

    The ordered periods are gathered once a feeder and runs are sliced from them by position.
    """
    gathered = _steps(panel, feeder, period, features, F.col(target).alias("target"))
    ends = gathered.filter(F.size("steps") > length).select(
        feeder, "steps", F.explode(F.sequence(F.lit(length), F.size("steps") - 1)).alias("end"))
    return ends.select(
        feeder,
        F.element_at("steps", F.col("end"))["period"].alias("last_period"),
        _run(F.col("end"), length).alias("sequence"),
        F.element_at("steps", F.col("end") + 1)["target"].alias("label"),
    ).filter(F.col("label").isNotNull())


def dual_sequences(
    panel: DataFrame,
    feeder: str,
    period: str,
    features: list[str],
    target: str,
    short: int,
    long: int,
) -> DataFrame:
    """A long history and its own most recent part, aligned by feeder and period."""
    rows = sliding_sequences(panel, feeder, period, features, target, long)
    return rows.select(
        feeder,
        "last_period",
        F.slice("sequence", -short, short).alias("short_sequence"),
        F.col("sequence").alias("long_sequence"),
        "label",
    )


def latest_sequences(
    panel: DataFrame, feeder: str, period: str, features: list[str], targets: list, length: int
) -> DataFrame:
    """For every target period, each feeder's last ``length`` periods before it.

    The ordered periods are gathered once a feeder; a target's history ends at the last period
    before it. Feeders with a shorter history give no row.
    """
    wanted = F.array(*[F.lit(t).cast("date") for t in targets])
    before = F.filter("steps", lambda step: F.coalesce(step["period"] < F.col("target_period"), F.lit(True)))
    ends = (
        _steps(panel, feeder, period, features)
        .select(feeder, "steps", F.explode(wanted).alias("target_period"))
        .withColumn("end", F.size(before))
        .filter(F.col("end") >= length)
    )
    return ends.select(
        feeder,
        "target_period",
        F.element_at("steps", F.col("end"))["period"].alias("last_period"),
        _run(F.col("end"), length).alias("sequence"),
    ).filter(F.col("last_period").isNotNull())


def _after_rows(
    df: DataFrame, feeder: str, order: list, value: Column, kind: DataType, names: dict[str, int]
) -> DataFrame:
    """``value`` of the row that lies ``names[name]`` rows before, where it is of the same feeder.

    The rows are sorted by feeder and ``order`` into ranges, whatever a feeder's size, and
    checkpointed, since a range computed anew could be cut elsewhere. Each range tells its last rows
    (feeder and value, as many as the longest step); the last rows before a range are taken from these.
    What reaches the driver is that: a step's length of values for each range. Then every range is
    read once, in order, without another exchange.
    """
    shared_dir(df.sparkSession)
    longest = max(names.values())
    ranges = (
        df.withColumns({"#feeder": F.col(feeder).cast("string"), "#value": value})
        .orderBy(F.col(feeder), *order)
        .withColumn("#range", F.spark_partition_id())
        .checkpoint()
    )
    types = ranges.select("#feeder", "#value").schema
    held = StructType([StructField("#range", IntegerType()), *types.fields])

    def last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = None
        for batch in batches:
            end = batch if end is None else _joined([end, batch])
            end = end.slice(max(0, end.num_rows - longest))
        if end is not None:
            yield end

    ends: dict[int, pa.RecordBatch] = {}
    told = ranges.select("#range", "#feeder", "#value").mapInArrow(last_rows, held).orderBy("#range").toArrow()
    before = told.slice(0, 0).select(["#feeder", "#value"])
    for part in sorted(set(told.column("#range").to_pylist())):
        ends[part] = before.combine_chunks()
        own = told.filter(pc.equal(told.column("#range"), part)).select(["#feeder", "#value"])
        before = pa.concat_tables([before, own])
        before = before.slice(max(0, before.num_rows - longest))
    carried = df.sparkSession.sparkContext.broadcast(ends)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        past = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if past is None:
                past = carried.value[rows.column("#range")[0].as_py()]
            own = rows.select(["#feeder", "#value"]).cast(past.schema)
            seen = pa.concat_tables([past, own]).combine_chunks()
            at = np.arange(past.num_rows, seen.num_rows)
            feeders, values = seen.column("#feeder"), seen.column("#value")
            out = rows.drop_columns(["#range", "#feeder", "#value"])
            for name, back in names.items():
                found = pa.array(at - back, mask=at < back)
                same = pc.fill_null(pc.equal(feeders.take(found), own.column("#feeder")), False)
                out = out.append_column(name, values.take(pc.if_else(same.combine_chunks(), found, None)))
            past = seen.slice(max(0, seen.num_rows - longest))
            yield from out.combine_chunks().to_batches()

    added = [StructField(name, kind) for name in names]
    return ranges.mapInArrow(follow, StructType([*df.schema.fields, *added]))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def lag_features(
    df: DataFrame,
    feeder: str,
    order: list[str],
    value: str,
    lags: int = 7,
    prefix: str | None = None,
) -> DataFrame:
    """``value`` of the feeder's 1..``lags`` previous rows, exact for feeders of any size.

    ``order`` should leave no ties; NULLs come first, as in a window. The rows are exchanged once, into
    sorted ranges (``_after_rows``), so one hour of one feeder, or all its rows without a time, may
    hold any share of the table. Rows without a feeder have no history.
    """
    prefix = prefix or value
    names = {f"{prefix}_lag_{k}": k for k in range(1, lags + 1)}
    return _after_rows(df, feeder, [F.col(c) for c in order], F.col(value), df.select(value).schema[0].dataType, names)


def has_future_rows(df: DataFrame, feeder: str, order: list[str], ahead: int = 7) -> DataFrame:
    """1 where the feeder has at least ``ahead`` later rows.

    In falling order that is the same as an earlier row of the feeder ``ahead`` rows before. Rows
    without a feeder have none.
    """
    falling = [F.col(c).desc() for c in order]
    found = _after_rows(df, feeder, falling, F.lit(1), IntegerType(), {"has_future": ahead})
    return found.fillna(0, ["has_future"])


def has_future_days(
    df: DataFrame, feeder: str, at: str, days: int = 7, chunk: Column | None = None
) -> DataFrame:
    """1 where the feeder has a later row at most ``days`` days ahead.

    Only the feeder's next time matters. Inside a chunk it exists when a row is not the chunk's
    last; otherwise it is the next chunk's first. So the rows themselves need no window.
    """
    chunk = F.date_trunc("hour", F.col(at)) if chunk is None else chunk
    rows = df.withColumn("chunk", chunk)
    order = Window.partitionBy(feeder).orderBy("chunk")
    edges = (
        rows.groupBy(feeder, "chunk")
        .agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"))
        .select(feeder, "chunk", "last_at", F.lead("first_at").over(order).alias("next_at"))
    )
    soon = (F.col(at) < F.col("last_at")) | (
        F.col("next_at") <= F.col(at) + F.make_dt_interval(F.lit(days))
    )
    return (
        rows.join(edges, [feeder, "chunk"], "left")
        .withColumn("has_future", F.coalesce(soon, F.lit(False)).cast("int"))
        .drop("chunk", "last_at", "next_at")
    )


def time_split(panel: DataFrame, period: str, train_share: float = 0.8) -> DataFrame:
    """``train`` before the first period at which the share of earlier rows is reached, else ``test``.

    The cut is found on one row per period, so no global order of the rows is needed.
    """
    so_far = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = panel.groupBy(period).agg(F.count(F.lit(1)).alias("n"))
    reached = counts.select(
        period, F.sum("n").over(so_far).alias("upto"), F.sum("n").over(everything).alias("all")
    ).filter(F.col("upto") > F.col("all") * F.lit(train_share))
    cut = reached.agg(F.min(period).alias("cut")).scalar()
    return panel.withColumn("split", F.when(F.col(period) < cut, "train").otherwise("test"))
