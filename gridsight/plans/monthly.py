"""The monthly loads: from new billing, complaint and outage rows to every table they feed.

Each load replaces its months in the fact, in the summaries made of it and in every dimension that those
feed, whichever source comes first or late: complaints and outages that arrive after their month was
billed refresh the dimensions of that month. All tables are partitioned by month (``YYYYMM``); a load
reads and writes its own months only. A month that a load names but leaves without rows becomes
empty in every table, and rows without a month are stored apart.

A load writes all its tables before the first is replaced (``sources.journal``): it takes effect as a
whole, may be repeated under its name without effect, and can be undone.

Dimensions are made from stored partial groups where they can be: billing per centre code, name and
region, complaints per code and name, outages per name and reason, and the latter two by date and
feeder. The date and feeder tables follow the same months; a row's date lies in the month it is billed or reported under.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from gridsight.functions import parsing
from gridsight.functions.measures import merged, partial_groups
from gridsight.operators import cleaning, dimensions as dims, summaries
from gridsight.operators.joins import tasks_for
from gridsight.plans.billing import clean_billing
from gridsight.sources import journal, tables

MONTH = ["year", "month"]
MONTH_LOAD = "year * 100 + month"

#: What the summaries need of the facts, for sources of which nothing has landed.
COMPLAINT_FACT = """account string, ibc_code string, ibc_name string, pmt bigint, pmt_name string, star_customer string,
year int, month int, resolution_minutes double"""
OUTAGE_FACT = """outage_id bigint, ibc_name string, reason string, turnaround_minutes double, duration_minutes double,
rain int, year int, month int"""


def complaint_dims(complaints: DataFrame, tasks: int | None = None) -> dict[str, DataFrame]:
    """Summaries of the complaint fact, one per grain that billing joins on. That many ``tasks`` finish those per
    consumer and per transformer, which hold the most rows."""
    summary = summaries.complaint_summary
    return {
        "crm_consumer_dim": summary(
            complaints, ["account", *MONTH], "account", {"star_customer": "star_customer"}, tasks
        ),
        "crm_ibc_dim": cleaning.require_keys(
            summary(complaints, ["ibc_code", *MONTH], "ibc_name", {"ibc_name": "ibc_name"}),
            ["ibc_code", *MONTH],
        ),
        "crm_ibc_names": complaints.select("ibc_name", "ibc_code", *MONTH).dropna().distinct(),
        "crm_pmt_dim": summary(complaints, ["pmt", *MONTH], "ibc_name", {"pmt_name": "pmt_name"}, tasks),
    }


def outage_dims(outages: DataFrame) -> dict[str, DataFrame]:
    """The parts of outages that dimensions are made of."""
    return {"oms_ibc_parts": summaries.outage_parts(outages, ["ibc_name", *MONTH])}


def _dated(rows: DataFrame) -> DataFrame | None:
    """The rows with their date, if they say when and on which feeder."""
    if "feeder_id" not in rows.columns or not {"date", "created_at"} & set(rows.columns):
        return None
    return rows if "date" in rows.columns else rows.withColumn("date", F.to_date("created_at"))


def complaint_days(complaints: DataFrame) -> dict[str, DataFrame]:
    """Complaints by date and centre, and by date and feeder."""
    if (dated := _dated(complaints)) is None:
        return {}
    return {
        "crm_ibc_date": summaries.complaint_summary(dated, ["date", "ibc_name", *MONTH], "date"),
        "crm_feeder_date": summaries.complaint_summary(dated, ["date", "feeder_id", *MONTH], "feeder_id"),
    }


def outage_days(outages: DataFrame) -> dict[str, DataFrame]:
    """Partial groups of outages by date and centre, and by date and feeder; ``oms_days`` finishes them."""
    dated = _dated(outages)
    if dated is None or "punching_delay" not in dated.columns:
        return {}
    parts = lambda keys: partial_groups(dated, [*keys, "reason"], summaries.outage_measures(True), "reason")
    return {
        "oms_ibc_date_parts": parts(["date", "ibc_name", *MONTH]),
        "oms_feeder_date_parts": parts(["date", "feeder_id", "feeder_name", *MONTH]),
    }


def oms_days(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Outages by date and centre, and by date and feeder, from their parts."""
    finish = lambda name, keys, labels: merged(
        parts[name], keys, summaries.outage_measures(True), labels, summaries.TOP_FAULT)
    return {
        "oms_ibc_date": finish("oms_ibc_date_parts", ["date", "ibc_name", *MONTH], None),
        "oms_feeder_date": finish("oms_feeder_date_parts", ["date", "feeder_id", *MONTH], {"feeder_name": "feeder_name"}),
    }


def feeder_outages(spark: SparkSession, base: str, months: list[int] | None = None) -> DataFrame:
    """Outages per feeder over all loaded months, or those given, from the stored parts."""
    parts = tables.read_table(spark, f"{base}/oms_feeder_date_parts")
    if months is not None:
        parts = parts.filter(F.col(tables.LOAD).isin(months))
    return merged(parts, ["feeder_id", "feeder_name"], summaries.outage_measures(True), None, summaries.TOP_FAULT)


def _dims(
    billing: DataFrame, parts: DataFrame, crm: dict[str, DataFrame], oms: DataFrame, season: bool
) -> dict[str, DataFrame]:
    """The five dimensions, from billing rows, their partial groups, and summaries of the same months."""
    gate = cleaning.complaint_season if season else lambda rows: rows
    centre = crm["crm_ibc_dim"].drop("ibc_name")
    # Outages know a centre by name only; its code in a month comes from billing and complaints.
    codes = parts.select("ibc_name", "ibc_code", *MONTH).unionByName(crm["crm_ibc_names"])
    both = dims.complaints_with_outages(dims.outages_by_code(oms, codes), centre, ["ibc_code", *MONTH])
    named = cleaning.require_keys(summaries.outage_summary_of_parts(oms, ["ibc_name", *MONTH]), MONTH)
    return {
        "consumer_dim": dims.consumer_dim(gate(billing), crm["crm_consumer_dim"], optional=dims.NOT_SUPPLIED),
        "ibc_crm_ageing_dim": dims.centre_dim_of_parts(gate(parts), centre),
        "ibc_all_dim": dims.centre_dim_of_parts(gate(parts), both),
        "pmt_crm_ageing_dim": dims.transformer_dim(gate(billing), crm["crm_pmt_dim"]),
        "ibc_oms_ageing_dim": dims.centre_dim_of_parts(parts, named, key="ibc_name"),
    }


def billing_dims(
    billing: DataFrame, complaints: DataFrame, outages: DataFrame, season: bool = False
) -> dict[str, DataFrame]:
    """The five cross-source dimensions for the billing rows given, of any months.

    Complaint joins see only months for which complaints exist, as inner joins do; ``season=True``
    further keeps April to September alone. ``outages`` needs year and month.
    """
    oms = outage_dims(outages)["oms_ibc_parts"]
    return _dims(billing, dims.billing_parts(billing), complaint_dims(complaints), oms, season)


def load_complaints(
    complaints: DataFrame, base: str, months: list[int] | None = None, batch: str | None = None, season: bool = False
) -> dict[str, str]:
    """Land cleaned complaints and refresh all that their months feed.

    ``months`` (``YYYYMM``) names months to replace beside those of the rows, so that a month whose
    rows are all gone becomes empty. Rows without a month go to ``rejects/complaints/<batch>``. A
    ``batch`` that is in place already changes nothing. Returns the path of every table.
    """
    return _load(complaints, base, "complaints", F.expr(MONTH_LOAD), None, months, batch, season)


def load_outages(
    outages: DataFrame, base: str, months: list[int] | None = None, batch: str | None = None, season: bool = False
) -> dict[str, str]:
    """Land cleaned outages with year and month, as ``load_complaints`` does complaints."""
    return _load(outages, base, "outages", F.expr(MONTH_LOAD), None, months, batch, season)


def load_months(raw: DataFrame, base: str, batch: str | None = None, season: bool = False) -> dict[str, str]:
    """Land raw billing rows in the fact under ``base`` and refresh all that their months feed.

    ``raw`` may hold any months, late ones too; the months are gathered while its text is read for
    the fact. Rows without a month are stored under ``rejects/billing/<batch>``. Complaints and outages
    that have not landed count as none. Returns the path of every table.
    """
    text = cleaning.quoted("billing_month")
    month = parsing.billing_year(text) * 100 + parsing.billing_month(text)
    return _load(raw, base, "billing", month, clean_billing, None, batch, season)


def _load(
    rows: DataFrame, base: str, kind: str, month: Column, clean: Callable[[DataFrame], DataFrame] | None,
    months: list[int] | None, batch: str | None, season: bool,
) -> dict[str, str]:
    spark, name = rows.sparkSession, f"{kind}-{batch or uuid.uuid4().hex}"
    load = journal.begin(spark, base, name)
    if load is None:
        done = next(e for e in journal.loads(spark, base) if e.name == journal.plain_name(name) and e.state == "published")
        return {table: f"{base}/{table}" for table in done.plan}
    paths, beside, rejects = {}, [], f"{base}/rejects/{kind}/{batch or load.name}"
    if clean is None:
        # The fact has all rows, so its folders tell the months; rows without one are moved apart, not read again.
        load.stage(kind, _monthly(rows))
        named, lost = load.staged_months(kind)
        if lost:
            journal.replace_folder(spark, lost, rejects)
    else:
        seen, found = Observation(kind), [
            F.collect_set("load month").alias("months"), F.count_if(F.col("load month").isNull()).alias("lost")]
        observed = rows.withColumn("load month", month).observe(seen, *found)
        load.stage(kind, _monthly(clean(observed.filter(F.col("load month").isNotNull()).drop("load month"))))
        try:
            named, lost = seen.get["months"], seen.get["lost"]
        except Py4JJavaError:  # no row can be active, so the read was optimized away and observed nothing
            named, lost = rows.withColumn("load month", month).agg(*found).first()
        if lost:
            beside.append(lambda: tables.write_replace(rows.filter(month.isNull()), rejects))
    if lost:
        paths["rejects"] = rejects
    months = sorted({*named, *(months or [])})
    landed = load.rows(kind, months)
    derived = {
        "billing": lambda: {"billing_parts": dims.billing_parts(landed)},
        "complaints": lambda: complaint_dims(landed, tasks_for(landed.count())) | complaint_days(landed),
        "outages": lambda: outage_dims(landed) | outage_days(landed),
    }[kind]
    load.stage_all({table: _monthly(made) for table, made in derived().items()}, *beside)
    refreshed = _refreshed_days(load, months, kind, season) | _refreshed_dims(load, months, kind, season)
    load.stage_all({table: _monthly(made) for table, made in refreshed.items()})
    load.publish(months)
    return paths | {table: f"{base}/{table}" for table in load.plan}


def _monthly(rows: DataFrame) -> DataFrame:
    return rows.withColumn(tables.LOAD, F.expr(MONTH_LOAD))


def _refreshed_days(load: journal.Load, months: list[int], kind: str, season: bool) -> dict[str, DataFrame]:
    """The date and feeder tables of the months, if complaints or outages changed and both are dated."""
    if kind == "billing":
        return {}
    names = ["oms_ibc_date_parts", "oms_feeder_date_parts", "crm_ibc_date", "crm_feeder_date"]
    found = load.rows_of(names, months)
    parts, crm = ({name: found[name] for name in some} for some in (names[:2], names[2:]))
    if any(rows is None for rows in parts.values()):
        return {}
    made = oms_days(parts)
    out = made if kind == "outages" else {}
    if any(rows is None for rows in crm.values()):
        return out
    beside = dims.complaints_beside_outages
    return out | {
        "date_ibc_crm_oms": beside(made["oms_ibc_date"], crm["crm_ibc_date"], ["date", "ibc_name", *MONTH]),
        "date_feeder_crm_oms": beside(made["oms_feeder_date"], crm["crm_feeder_date"], ["date", "feeder_id", *MONTH]),
    }


def _refreshed_dims(load: journal.Load, months: list[int], kind: str, season: bool) -> dict[str, DataFrame]:
    """The dimensions of the months, once billing has landed."""
    if not load.holds("billing") or not load.holds("billing_parts"):
        return {}  # before the rest is listed for nothing
    names = ["crm_consumer_dim", "crm_ibc_dim", "crm_ibc_names", "crm_pmt_dim"]
    found = load.rows_of(["billing", "billing_parts", "oms_ibc_parts", *names], months)
    billing, parts, oms = found["billing"], found["billing_parts"], found["oms_ibc_parts"]
    spark = load.spark
    crm = {name: found[name] for name in names}
    if any(rows is None for rows in crm.values()):
        crm = complaint_dims(spark.createDataFrame([], COMPLAINT_FACT))
    if oms is None:
        oms = outage_dims(spark.createDataFrame([], OUTAGE_FACT))["oms_ibc_parts"]
    return _dims(billing, parts, crm, oms, season)


def undo_loads(spark: SparkSession, base: str, batch: str | None) -> list[str]:
    """Undo all loads after the one named (all, for None), in every table at once; their names."""
    return journal.undo_after(spark, base, batch and journal.plain_name(batch))
