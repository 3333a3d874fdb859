"""Cross-source dimensions: billing joined with complaint and outage summaries.

Every join meets a side that is already one row per join key, so no join can multiply rows and a
key with very many billing rows is reduced to one row before it is shuffled to the join. Join
strategies are left to Catalyst, which broadcasts a summary only when its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsight.functions.measures import merged, partial_groups, totals_and_averages
from gridsight.operators.joins import join_summary
from gridsight.operators.summaries import BILLING_MEASURES, billing_totals, outage_summary_of_parts

COMPLAINT_COLUMNS = ["complaints", "avg_resolution_minutes"]
OUTAGE_COLUMNS = [
    "outages",
    "top_fault",
    "top_fault_frequency",
    "avg_turnaround_minutes",
    "avg_duration_minutes",
    "rain_frequency",
]
MONTH = ["year", "month"]

CONSUMER_ATTRIBUTES = [
    "billing_month", "business_partner", "consumer_type", "consumer_name", "postal_code",
    "billing_class", "phase", "oip", "premise_type", "ibc_name", "ibc_code", "bcm",
    "irb_amount", "irb_units", "sanctioned_load", "connected_load",
    "current_amount", "current_units",
]

#: Attributes that some extracts, and the supplied tables, do not have.
NOT_SUPPLIED = [
    "business_partner", "postal_code", "billing_class", "phase", "oip", "premise_type", "bcm",
]


def with_summary(billing: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Billing rows that have complaints or outages under the same keys, with those."""
    return join_summary(billing, summary, keys)


def one_row_per_key(df: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """The columns of the row with the least ``order`` value, so no row mixes two sources."""
    picked = F.min_by(F.struct(*columns), F.col(order))
    return df.groupBy(*keys).agg(picked.alias("picked")).select(*keys, "picked.*")


def consumer_dim(
    billing: DataFrame,
    summary: DataFrame,
    attributes: list[str] = CONSUMER_ATTRIBUTES,
    order: str | None = None,
    optional: list[str] = (),
) -> DataFrame:
    """Billing attributes and complaints per account and month.

    An account has one billing row a month, so a plain join is enough; where that does not hold,
    ``order`` names the column whose least value chooses the row. Both sides are then hashed on
    the same three keys, which the join reuses. Every attribute must be there but the ``optional``
    ones, so that a renamed column does not vanish unseen.
    """
    keys = ["account", *MONTH]
    if absent := [c for c in attributes if c not in billing.columns and c not in optional]:
        raise ValueError(f"billing has no columns {absent}")
    present = [c for c in attributes if c in billing.columns]
    side = one_row_per_key(billing, keys, present, order) if order else billing.select(*keys, *present)
    return side.join(summary, keys, "inner")


def billing_parts(billing: DataFrame) -> DataFrame:
    """Partial groups of billing per centre code, name, region and month, which both centre dimensions and
    the names a code goes by are made of."""
    keys = ["ibc_code", "ibc_name", "region", *MONTH]
    return partial_groups(billing, keys, totals_and_averages(BILLING_MEASURES))


def centre_dim_of_parts(parts: DataFrame, summary: DataFrame, key: str = "ibc_code") -> DataFrame:
    """Billing totals per centre and month with the summary's measures beside them.

    ``summary`` holds one row per centre and month and any of the complaint and outage columns.
    """
    labels = {"ibc_name": "ibc_name", "region": "region"}
    if key != "ibc_code":
        labels = {"ibc_code": "ibc_code", "region": "region"}
    totals = merged(parts, [key, *MONTH], totals_and_averages(BILLING_MEASURES), labels)
    return with_billing_month(totals.join(summary, [key, *MONTH], "inner"))


def centre_dim(billing: DataFrame, summary: DataFrame, key: str = "ibc_code") -> DataFrame:
    return centre_dim_of_parts(billing_parts(billing), summary, key)


def transformer_dim(billing: DataFrame, summary: DataFrame) -> DataFrame:
    labels = {"ibc_code": "ibc_code", "ibc_name": "ibc_name", "region": "region"}
    totals = billing_totals(billing, ["pmt", *MONTH], labels)
    return with_billing_month(totals.join(summary, ["pmt", *MONTH], "inner"))


def with_billing_month(dim: DataFrame) -> DataFrame:
    """The month's first day, the date axis of a dimension."""
    return dim.withColumn("billing_month", F.make_date("year", "month", F.lit(1)))


def outages_by_code(parts: DataFrame, codes: DataFrame) -> DataFrame:
    """Outage summary per centre code and month, from parts per centre name.

    ``codes`` has ibc_name, ibc_code, year and month, in any number of rows; a name stands for its least
    code of the month, so the result of a month does not depend on which others are loaded with it. The
    parts of all names of a code are added up, faults by their frequencies.
    """
    keys = ["ibc_name", *MONTH]
    code = codes.dropna().groupBy(*keys).agg(F.min("ibc_code").alias("ibc_code"))
    named = parts.dropna(subset=keys).join(code, keys)
    return outage_summary_of_parts(named, ["ibc_code", *MONTH])


def complaints_beside_outages(outages: DataFrame, complaints: DataFrame, keys: list[str]) -> DataFrame:
    """Full join on shared names: keys known to only one side keep their own row."""
    return outages.join(complaints, keys, "full")


def complaints_with_outages(outages: DataFrame, complaints: DataFrame, keys: list[str]) -> DataFrame:
    return outages.join(complaints, keys, "inner")
