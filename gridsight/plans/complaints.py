"""Complaint extract to complaint fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsight.functions import parsing
from gridsight.operators import cleaning

# Columns of the complaint extract that the fact does not keep.
DROPPED = [
    "LastDCDate", "LastDCRecovery", "HTDispatchedDateTime", "ForwardedToHTDateTime", "Key",
    "LastSIRCreatedOn", "Remarks", "ClosedOnInteractionDateTime", "CompletionRemarks",
    "%IntervalKey", "MNCcode", "Subject Group", "Contract", "Contract Account", "GroundTATNum",
]

# The extract's columns by the form their text has.
TIMES = ["UDATETIME", "CompletedDateTime", "ClosedDateTime", "InProcessDateTime", "OpenDateTime",
         "CREATED_AT"]
CLOCKS = ["GroundTATHrs", "TimeElapsedCompleted", "TimeElapsedClosed", "O to I", "I to C"]
HOURS = ["GroundTAT", "TargetTAT"]
SLASH_DATES = ["DueDate", "IssueDate"]
COMMA_NUMBERS = ["UnitBilled", "Last Payment Amount"]

# Extract column -> fact column for the columns the summaries use.
NAMES = {
    "CREATED_AT": "created_time",  # first, as it differs from the new name below in case alone
    "AccountContract": "account", "IBCName": "ibc_name", "IBCCode": "ibc_code", "Year": "year",
    "Month": "month", "PMT": "pmt", "PMT Name": "pmt_name", "Feeder ID": "feeder_id",
    "Feeder Name": "feeder_name", "StarCustomer": "star_customer", "CREATED_DATE": "created_at",
    "GroundTAT(minutes)": "resolution_minutes",
}


def clean_complaints(raw: DataFrame) -> DataFrame:
    """Complaints of active consumers, typed; durations become minutes."""
    kept = cleaning.drop_columns(raw, DROPPED).filter(F.col("ConsumerStatus") == "ACT")
    text = cleaning.null_placeholders(kept)
    present = set(text.columns)

    def typed(names: list[str], parse, suffix: str = "") -> dict:
        return {n + suffix: parse(cleaning.quoted(n)) for n in names if n in present}

    minutes = typed(CLOCKS, parsing.clock_minutes, "(minutes)") | typed(
        HOURS, parsing.hours_as_minutes, "(minutes)"
    )
    fact = text.withColumns(
        typed(TIMES, parsing.month_abbr_timestamp)
        | typed(["CREATED_DATE"], parsing.month_abbr_date)
        | typed(SLASH_DATES, parsing.day_month_year)
        | typed(COMMA_NUMBERS, parsing.number_with_commas)
        | typed(["Month"], parsing.month_number)
        | typed(["Year"], lambda c: c.try_cast("int"))
        | typed(["PMT"], lambda c: c.try_cast("bigint"))
        | minutes
    ).drop(*CLOCKS, *HOURS)
    return fact.withColumnsRenamed(NAMES)
