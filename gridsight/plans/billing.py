"""Billing extract to billing fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsight.functions import parsing
from gridsight.operators import cleaning

# Columns of the billing extract that the fact does not keep.
DROPPED = [
    "A <=(366)", "B (365)-(1)", "C 0-30", "D 31-60", "E 61-90", "F 91-120", "G 121-150",
    "H 151-180", "I 181-210", "J 211-240", "K 241-270", "L 271-300", "M 301-330", "N 331-360",
    "O 361-390", "P 391-420", "Q 421-450", "R 451-480", "S 481-510", "T 511-540", "U 541-570",
    "V 571-600", "W 601-630", "X 631-660", "Y 1021-1050", "Y 1051-1080", "Y 1081-1110",
    "Y 1111-1140", "Y 1141-1170", "Y 1171-1200", "Y 1201-1230", "Y 1231-1260", "Y 1261-1460",
    "Y 1461-1825", "Y 661-690", "Y 691-720", "Y 721-750", "Y 751-780", "Y 781-810", "Y 811-840",
    "Y 841-870", "Y 871-900", "Y 901-930", "Y 931-960", "Y 961-990", "Y 991-1020", "Z >=1826",
    "Key Date", "Legacy Account Number", "Legacy Move In Date", "Contract", "Move-In Date",
    "Move-Out Date", "PIBC", "DCIBC", "DC OIP", "DC Rate Category", "CA Creation Date",
    "Contract Creation Date", "ConsumerCounter", "Last SIR Number", "Last SIR CreatedOn",
    "AverageUnits", "AverageAmount", "AdjustedUnits", "AdjustedAmount", "AssessedUnits",
    "AssessedAmount", "FICAMonth", "OpeningBalance", "MigrationBalance", "BankCharges",
    "WriteOff", "PreviousYearAllowance", "DownPaymentRequest", "DownPayment",
    "OutstandingDownPayment", "MNCVAdjustment", "MNCVPayment", "MNCVClearingAmount",
    "Set Aside Amount", "Set Aside Code", "Installement Number", "Installement Amount", "Agency",
    "Schedule Number", "PSC Consumer IBC", "Adjustment", "IBCTransfer", "ClearingAmount", "",
    "PSC Location", "PSC Department", "PSC Classification", "PSC Ministry", "PSC Sub-Department",
]

# Extract column -> fact column.
NAMES = {
    "AccountContract": "account", "Business Partner": "business_partner",
    "Customer Name": "consumer_name", "Consumer Type": "consumer_type",
    "Postal Code": "postal_code", "Billing Class": "billing_class", "Phase": "phase",
    "OIP": "oip", "Premise Type": "premise_type", "BCM": "bcm", "IBC": "ibc_code",
    "IBCName": "ibc_name", "Region": "region", "PMT": "pmt",
    "Last Payment Date": "last_payment_at", "CurrentAmount": "current_amount",
    "CurrentUnits": "current_units", "IRBRevisedAmount": "irb_revised_amount",
    "IRBDetectionAmount": "irb_detection_amount", "IRBRevisedUnits": "irb_revised_units",
    "IRBDetectionUnits": "irb_detection_units", "RegularAmount": "regular_amount",
    "RegularUnits": "regular_units", "Last Payment Amount": "last_payment_amount",
    "Sanctioned Load": "sanctioned_load", "Connected Load": "connected_load",
}

DOUBLES = ["current_amount", "irb_revised_amount", "irb_detection_amount", "regular_amount",
           "last_payment_amount", "sanctioned_load", "connected_load"]
WHOLE = ["pmt", "current_units", "irb_revised_units", "irb_detection_units", "regular_units"]


def clean_billing(raw: DataFrame) -> DataFrame:
    """Active contracts of any number of months, typed, with calendar and adjustment totals.

    ``raw`` holds text columns under the extract's names plus ``billing_month`` (``YYYYMM``).
    Columns outside the known list stay as they are.
    """
    kept = cleaning.keep_active(cleaning.drop_columns(raw, DROPPED), "Status")
    named = cleaning.null_placeholders(kept).withColumnsRenamed(NAMES)
    present = set(named.columns)
    typed = cleaning.cast_columns(
        named,
        {c: "double" for c in DOUBLES if c in present} | {c: "bigint" for c in WHOLE if c in present},
    )
    dated = typed.withColumn("last_payment_at", parsing.month_abbr_date(F.col("last_payment_at")))
    totals = cleaning.add_sums(
        dated,
        {
            "irb_amount": ("irb_revised_amount", "irb_detection_amount"),
            "irb_units": ("irb_revised_units", "irb_detection_units"),
        },
    )
    return cleaning.billing_calendar(cleaning.payment_calendar(totals, "last_payment_at"))
