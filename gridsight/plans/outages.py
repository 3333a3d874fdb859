"""Outage extract to outage fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsight.functions import parsing
from gridsight.operators import cleaning

# Columns of the outage extract that the fact does not keep.
DROPPED = [
    "pt_name", "load", "Relay", "planned_sd_Id", "faultstr", "consumer_count_fdr", "saifi",
    "saidi", "_c36", "_c37", "_c38", "_c39", "_c40", "_c41", "_c42", "_c43", "_c44",
]
TIMES = ["punchCreateAt", "punchCloseAt", "Createdon", "lastupdatedon"]

# Extract column -> fact column for the columns the summaries use.
NAMES = {
    "outage_Id": "outage_id", "Createdon": "created_at", "IBC": "ibc_name", "fdr_Id": "feeder_id",
    "fdr_name": "feeder_name", "TAT": "turnaround_minutes", "PunchingDelay": "punching_delay",
    "duration": "duration_minutes", "initialoffreason": "reason", "israintripping": "rain",
    "isemergency": "emergency",
}


def clean_outages(raw: DataFrame) -> DataFrame:
    """Typed outages. Rows whose turnaround or punching delay is text other than digits go.

    The turnaround is tested before placeholders become NULL and the punching delay after, so a
    ``.`` removes the row in the first and is "no value" in the second.
    """
    rows = cleaning.keep_digits_or_null(cleaning.drop_columns(raw, DROPPED), "TAT")
    rows = cleaning.keep_digits_or_null(cleaning.null_placeholders(rows), "PunchingDelay")
    present = set(rows.columns)
    return rows.withColumns(
        {c: parsing.outage_timestamp(cleaning.quoted(c)) for c in TIMES if c in present}
        | {
            "IBC": parsing.respell(F.col("IBC"), parsing.CENTRE_SPELLINGS),
            "duration": parsing.clock_minutes(F.col("duration")),
            "isemergency": parsing.blank_as_zero(F.col("isemergency")),
            "israintripping": parsing.yes_flag(F.col("israintripping")),
            "fdr_Id": F.col("fdr_Id").try_cast("int"),
        }
    ).withColumnsRenamed(NAMES)
