"""Aggregate measures that can be computed in one step or merged from partial groups.

``digits`` states how many decimals a measure carries, as money does. Such a measure is summed as
whole minor units (a ``bigint``), so totals do not depend on the order in which tasks finish and
still use the fast hash aggregate. A time in minutes has no number of decimals: ``units`` = 60000
sums it as whole milliseconds, and ``places`` rounds the finished mean once. Overflow and NaN fail
the job rather than wrapping. Without either the sum is an ordinary double sum.

``aggregate_with_labels`` may be split: ``partial_groups`` can be stored, and ``merged`` finishes
them under the same or coarser keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str  # sum | avg | count | min
    column: str
    digits: int | None = None
    units: int | None = None
    places: int | None = None

    @property
    def scale(self) -> int | None:
        """Whole units to one of the measure's."""
        return self.units or (None if self.digits is None else 10**self.digits)


#: Milliseconds to a minute, and decimals of a mean of minutes.
MINUTE, MINUTE_PLACES = 60_000, 6


def mean_minutes(name: str, column: str) -> Measure:
    """The mean of a time in minutes, exact to the millisecond of each row."""
    return Measure(name, "avg", column, units=MINUTE, places=MINUTE_PLACES)


def totals_and_averages(columns: dict[str, int | None]) -> list[Measure]:
    """``total_x`` and ``avg_x`` for every column; the value is the column's decimals."""
    return [
        Measure(f"{prefix}_{c}", kind, c, digits)
        for c, digits in columns.items()
        for prefix, kind in (("total", "sum"), ("avg", "avg"))
    ]


def _parts(m: Measure) -> dict[str, tuple[Column, Column]]:
    """Name -> (aggregate over rows, aggregate over partial groups)."""
    value = f"`{m.column}`"
    if m.scale and m.kind != "min":
        value = f"CAST(rint({value} * {m.scale}) AS BIGINT)"
    total, rows, low = f"sum#{m.column}", f"rows#{m.column}", f"min#{m.column}"
    summed = {total: (F.expr(f"sum({value})"), F.expr(f"sum(`{total}`)"))}
    counted = {rows: (F.expr(f"count(`{m.column}`)"), F.expr(f"sum(`{rows}`)"))}
    if m.kind == "sum":
        return summed
    if m.kind == "avg":
        return summed | counted
    if m.kind == "count":
        return counted
    return {low: (F.min(f"`{m.column}`"), F.min(f"`{low}`"))}


def _finish(m: Measure, part) -> Column:
    if m.kind == "count":
        return part(f"rows#{m.column}")
    if m.kind == "min":
        return part(f"min#{m.column}")
    total = part(f"sum#{m.column}")
    if m.scale:
        total = total.cast("double") / F.lit(float(m.scale))
    if m.kind == "sum":
        return total
    mean = F.try_divide(total, part(f"rows#{m.column}"))
    return mean if m.places is None else F.round(mean, m.places)


def aggregate(df: DataFrame, keys: list, measures: list[Measure]) -> DataFrame:
    """``groupBy(keys)`` with the measures, map-side combined by Spark."""
    parts = {k: v for m in measures for k, v in _parts(m).items()}
    return df.groupBy(*keys).agg(
        *[_finish(m, lambda name: parts[name][0]).alias(m.name) for m in measures]
    )


def aggregate_with_labels(
    df: DataFrame,
    keys: list[str],
    measures: list[Measure],
    labels: dict[str, str] | None = None,
    top: tuple[str, str, str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Measures per key, with descriptive text and the most frequent value of one column.

    ``labels`` maps output name -> text column that is (nearly) constant within a key; the least
    value is kept. ``top`` = (column, value alias, frequency alias): NULLs are not counted, and
    ties go to the alphabetically first value.

    The first step groups by key plus text columns, so the large pass holds only fixed-width
    buffers and remains a hash aggregate; the second step works on that small result. There is no
    self-join and no window over the rows, and a key with a third of all rows is reduced in every
    map task first.

    ``tasks`` is for many keys with few texts each: that many tasks then do the second step, which sorts, and
    sort each group once; without it the groups are sorted before and after they are shuffled.
    """
    text = [*(labels or {}).values()] + ([top[0]] if top else [])
    groups = partial_groups(df, [*dict.fromkeys([*keys, *text])], measures, top and top[0])
    if tasks:
        groups = groups.repartition(tasks, *keys)
    return merged(groups, keys, measures, labels, top, regroup=len(text) > 1)


def partial_groups(df: DataFrame, keys: list[str], measures: list[Measure], counted: str | None = None) -> DataFrame:
    """Sums and counts per key and text, from which ``merged`` makes the measures; ``counted`` is the
    column, one of the keys, whose most frequent value will be asked for."""
    parts = {k: v for m in measures for k, v in _parts(m).items()}
    first = [v[0].alias(k) for k, v in parts.items()]
    if counted:
        first.append(F.count(F.col(counted)).alias("top#rows"))
    return df.groupBy(*keys).agg(*first)


def merged(
    groups: DataFrame, keys: list[str], measures: list[Measure], labels: dict[str, str] | None = None,
    top: tuple[str, str, str] | None = None, regroup: bool = True,
) -> DataFrame:
    """Measures, labels and the most frequent value per key, from partial groups of finer keys.
    ``regroup=False`` spares a step where the groups are one for each key and value already."""
    labels = labels or {}
    parts = {k: v for m in measures for k, v in _parts(m).items()}
    if top and regroup:
        # A key with two names would otherwise split the frequency of a value between them.
        groups = groups.groupBy(*keys, top[0]).agg(
            *[F.min(c).alias(c) for c in dict.fromkeys(labels.values())],
            *[v[1].alias(k) for k, v in parts.items()],
            F.sum("top#rows").alias("top#rows"),
        )

    second = [F.min(c).alias(name) for name, c in labels.items()]
    second += [_finish(m, lambda name: parts[name][1]).alias(m.name) for m in measures]
    if top:
        best = F.min(F.struct((-F.col("top#rows")).alias("rank"), F.col(top[0]).alias("value")))
        second += [best["value"].alias(top[1]), (-best["rank"]).alias(top[2])]
    return groups.groupBy(*keys).agg(*second)
