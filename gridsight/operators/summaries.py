"""Complaint and outage summaries, per consumer, centre, transformer, feeder, date or month."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsight.functions.measures import (
    Measure,
    aggregate,
    aggregate_with_labels,
    mean_minutes,
    merged,
    partial_groups,
    totals_and_averages,
)

# Decimals carried by each billing measure: money and loads have two, units none.
BILLING_MEASURES = {
    "current_amount": 2,
    "current_units": 0,
    "sanctioned_load": 2,
    "connected_load": 2,
    "irb_amount": 2,
    "irb_units": 0,
}


def complaint_measures(counted: str) -> list[Measure]:
    """Complaints counted by the rows where ``counted`` is present."""
    return [
        Measure("complaints", "count", counted),
        mean_minutes("avg_resolution_minutes", "resolution_minutes"),
    ]


def complaint_summary(
    complaints: DataFrame, keys: list[str], counted: str, labels: dict[str, str] | None = None, tasks: int | None = None
) -> DataFrame:
    if labels:
        return aggregate_with_labels(complaints, keys, complaint_measures(counted), labels, tasks=tasks)
    return aggregate(complaints, keys, complaint_measures(counted))


def outage_measures(punching: bool) -> list[Measure]:
    found = [
        mean_minutes("avg_turnaround_minutes", "turnaround_minutes"),
        mean_minutes("avg_duration_minutes", "duration_minutes"),
        Measure("outages", "count", "outage_id"),
        Measure("rain_frequency", "sum", "rain"),
    ]
    if punching:
        found.append(mean_minutes("avg_punching_delay", "punching_delay"))
    return found


def outage_summary(
    outages: DataFrame,
    keys: list[str],
    punching: bool = False,
    labels: dict[str, str] | None = None,
) -> DataFrame:
    """Outage measures with the most frequent reason, in one pass over the outages."""
    return aggregate_with_labels(
        outages, keys, outage_measures(punching), labels, TOP_FAULT
    )


TOP_FAULT = ("reason", "top_fault", "top_fault_frequency")


def outage_parts(outages: DataFrame, keys: list[str]) -> DataFrame:
    """What a summary of outages under these or coarser keys can be made of."""
    return partial_groups(outages, [*keys, "reason"], outage_measures(False), "reason")


def outage_summary_of_parts(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The outage summary per key; frequencies of a fault add up over what a key is made of."""
    return merged(parts, keys, outage_measures(False), None, TOP_FAULT)


def most_frequent(df: DataFrame, keys: list[str], value: str, name: str, frequency: str) -> DataFrame:
    return aggregate_with_labels(df, keys, [], None, (value, name, frequency))


def billing_totals(
    billing: DataFrame, keys: list[str], labels: dict[str, str] | None = None, measures=None
) -> DataFrame:
    """Sum and average of the billing measures; the fact is reduced before anything is joined."""
    return aggregate_with_labels(
        billing, keys, totals_and_averages(measures or BILLING_MEASURES), labels
    )


def consumer_totals(billing: DataFrame) -> DataFrame:
    return billing_totals(billing, ["account", "year", "month"])


def weekly_rollup(df: DataFrame, at: str, sums: list[Measure]) -> DataFrame:
    """Totals per calendar year and ISO week, so 2024-12-30 is (2024, 1)."""
    weeks = df.withColumns({"year": F.year(at), "week": F.weekofyear(at)})
    return aggregate(weeks, ["year", "week"], sums).orderBy("year", "week")
