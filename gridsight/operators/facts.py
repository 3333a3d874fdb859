"""Fact tables that join sources with many rows per key on both sides.

Joining first would multiply every billing row by every payment; each side is therefore summed to
the join key beforehand, which gives the same totals without the blow-up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridsight.functions.measures import Measure, aggregate, aggregate_with_labels, mean_minutes
from gridsight.operators.cleaning import quoted, surrogate_key
from gridsight.operators.joins import join_summary

# The billing extract's tax, benefit and import columns.
TAX_TERMS = [
    "Tariff", "GST", "GST (Further 1%)", "GST (Extra 5%)", "GST_Retailer",
    "GST on Retailers (5 %)", "GST on Retailers (7.5 %)", "Income Tax", "Income Tax Surcharge",
    "Normal GST on import", "WithHolding GST -IMP", "WithHolding ITax-IMP", "Surcharge",
    "Surcharge_1", "GST on Marble", "Electricity Duty", "Additional Surcharge", "MUCT (KMC)",
]
BENEFIT_TERMS = [
    "Emp Benefit -Officer", "Free Benefit Amount", "PM Relief", "PM Relief Res. Comm.",
    "Award Winner Benefit", "ISP Adj.", "Fuel Adj. Charges", "Sales Tax Adjustment",
    "Uniform Qtr.Adj. on Import", "Deferred FCA Adj. Im", "Deferred FCA Adjustm",
    "ISPA Adj. Ind. Peak", "Quarterly Adj.", "Uniform Quatrly Adj.",
    "New Qtr Adj Import Off Peak", "New Qtr Adj Import Peak", "New Qtr Adj Export Off Peak",
    "New Qtr Adj Export Peak", "Quarterly Adj. Curre",
]
IMPORT_TERMS = [
    "Import-OffPeak Units", "Import-On Peak Units", "Import Units Off Peak – Current",
    "Import Units Non-TOU – Current", "Consp-Non TOD-Import",
]
SURCHARGE_TERMS = ["Surcharge", "Surcharge_1", "Additional Surcharge"]


def sum_of_terms(names: list[str]) -> Column:
    """Row total of the named columns; a missing term counts as zero."""
    return reduce(Column.__add__, [F.coalesce(quoted(n), F.lit(0.0)) for n in names])


def billing_and_recovery(billing: DataFrame, recovery: DataFrame, digits: int = 2) -> DataFrame:
    """Per document, account and due date: billed, taxed, recovered, outstanding.

    ``billing``: document, account, due_date, issue_date, net_amount, units_billed,
    energy_charges and the term columns. ``recovery``: account, document_date, total_amount.
    GST counts once, the surcharge is the sum of the surcharge terms, and recovered money is the
    account's total. The mean payment time over all billing-payment pairs of an account equals
    the mean payment day less the mean issue day, so no pair is ever formed.
    """
    terms = {
        "tax_amount": TAX_TERMS,
        "benefit_adjustments": BENEFIT_TERMS,
        "import_amount": IMPORT_TERMS,
        "surcharge_amount": SURCHARGE_TERMS,
    }
    rows = billing.filter(F.col("account").isNotNull()).select(
        "document", "account", "due_date", "net_amount", "units_billed", "energy_charges",
        F.unix_date("issue_date").alias("issue_day"),
        *[sum_of_terms(names).alias(name) for name, names in terms.items()],
    )
    money = ["net_amount", "energy_charges", *terms]
    billed = aggregate(
        rows,
        ["document", "account", "due_date"],
        [Measure(c, "sum", c, digits) for c in money]
        + [Measure("units_billed", "sum", "units_billed", 0), Measure("issue_day", "avg", "issue_day")],
    )
    paid = aggregate(
        recovery.filter(F.col("account").isNotNull()).select(
            "account", "total_amount", F.unix_date("document_date").alias("paid_day")
        ),
        ["account"],
        [Measure("recovery_amount", "sum", "total_amount", digits), Measure("paid_day", "avg", "paid_day")],
    )
    fact = join_summary(billed, paid, ["account"]).select(
        "document", "account", "due_date",
        F.col("net_amount").alias("total_amount"),
        "tax_amount",
        "recovery_amount",
        (F.col("net_amount") - F.col("recovery_amount")).alias("outstanding_amount"),
        (F.col("paid_day") - F.col("issue_day")).alias("avg_payment_days"),
        "units_billed", "benefit_adjustments", "import_amount", "energy_charges", "surcharge_amount",
    )
    return surrogate_key(fact, ["document", "account", "due_date"], "fact_key")


def network_and_losses(
    tickets: DataFrame,
    feeders: DataFrame,
    energy: DataFrame,
    transformers: DataFrame,
    power: DataFrame,
    digits: int = 2,
) -> DataFrame:
    """Per feeder, device, transformer and ticket: faults, power and resolution time.

    ``tickets``: ticket, feeder, dts, subject, unplanned, emergency, resolution_minutes;
    ``energy``: feeder, device; ``power``: device, active_kw, reactive_kvar. Tickets and power
    readings are summed before they meet. Created energy is power alone; unplanned faults have a
    column of their own; the common fault is the most frequent subject.
    """
    faults = aggregate_with_labels(
        tickets,
        ["feeder", "dts", "ticket"],
        [
            Measure("faults", "count", "subject"),
            Measure("unplanned_faults", "sum", "unplanned"),
            Measure("emergencies", "count", "emergency"),
            Measure("tickets_processed", "count", "ticket"),
            mean_minutes("avg_resolution_minutes", "resolution_minutes"),
        ],
        None,
        ("subject", "common_fault", "common_fault_frequency"),
    )
    readings = aggregate(
        power,
        ["device"],
        [
            Measure("energy_created", "sum", "active_kw", digits),
            Measure("energy_transmitted", "sum", "reactive_kvar", digits),
        ],
    )
    powered = energy.select("feeder", "device").distinct().join(readings, "device", "inner")
    known = faults.join(transformers, "dts", "left_semi").join(feeders, "feeder", "left_semi")
    return join_summary(known, powered, ["feeder"])


def recovery_by_date(billing: DataFrame, recovery: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Billed and recovered money on the same keys, and recovered as a share of billed.

    Both sides are one row per key before the join. The share is ``recovered / billed * 100``.
    """
    billed = aggregate(billing, keys, [Measure("billed", "sum", "billed", 2)])
    recovered = aggregate(recovery, keys, [Measure("recovered", "sum", "recovered", 2)])
    joined = billed.join(recovered, keys, how)
    return joined.withColumn(
        "recovery_percentage", F.try_divide("recovered", "billed") * 100
    )


KPI_KEYS = ["date", "customer", "product", "agent", "equipment", "location"]


def kpi_fact(df: DataFrame, keys: list[str] = KPI_KEYS) -> DataFrame:
    """Money, service and fault indicators per date, customer, product, agent, equipment, place."""
    return aggregate(
        df,
        keys,
        [
            Measure("amount_due", "sum", "due", 2),
            Measure("amount_paid", "sum", "paid", 2),
            Measure("days_overdue", "sum", "overdue_days"),
            Measure("interactions", "count", "interaction"),
            Measure("avg_resolution_hours", "avg", "resolution_hours", 2),
            Measure("avg_satisfaction", "avg", "satisfaction", 2),
            Measure("faults", "sum", "fault"),
            Measure("downtime", "sum", "downtime", 2),
            Measure("maintenance_cost", "sum", "cost", 2),
        ],
    )


def join_weather(outages: DataFrame, weather: DataFrame) -> DataFrame:
    """Outages beside the weather of their day; a day without weather keeps its outages.

    Weather is a stored table of one row per date; its size is left for Catalyst to judge.
    """
    return outages.join(weather, "date", "left")
