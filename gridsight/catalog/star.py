"""Summaries, joins, dimensions and facts on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsight.catalog.bindings import (
    Tables,
    billing,
    complaints,
    outages,
    sql_average,
    sql_mean,
    sql_total,
    with_views,
)
from gridsight.catalog.registry import query
from gridsight.functions.measures import Measure, merged, partial_groups
from gridsight.operators import cleaning, dimensions as dims, facts, summaries
from gridsight.operators.joins import join_summary, stored, tasks_for

MONTH = ["year", "month"]

# --- SQL pieces -------------------------------------------------------------------------------

COMPLAINT_SQL = f"count({{counted}}) AS complaints, {sql_mean('resolution_minutes')} AS avg_resolution_minutes"


def complaint_sql(keys: str, counted: str, labels: str = "") -> str:
    return f"SELECT {keys}, {labels}{COMPLAINT_SQL.format(counted=counted)} FROM complaints GROUP BY {keys}"


def outage_sql(keys: str, punching: bool = False, labels: str = "") -> str:
    delay = f", {sql_mean('punching_delay')} AS avg_punching_delay" if punching else ""
    on = " AND ".join(f"s.{k} = f.{k}" for k in keys.split(", "))
    shown = ", ".join(f"s.{k}" for k in keys.split(", "))
    return f"""SELECT {shown}, s.* EXCLUDE ({keys}), f.top_fault, f.top_fault_frequency
FROM (SELECT {keys}, {labels}{sql_mean('turnaround_minutes')} AS avg_turnaround_minutes,
  {sql_mean('duration_minutes')} AS avg_duration_minutes, count(outage_id) AS outages,
  CAST(sum(rain) AS BIGINT) AS rain_frequency{delay} FROM outages GROUP BY {keys}) s
LEFT JOIN (SELECT {keys}, reason AS top_fault, n AS top_fault_frequency FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, reason) AS place FROM (
    SELECT {keys}, reason, count(reason) AS n FROM outages GROUP BY {keys}, reason)) WHERE place = 1) f
ON {on}"""


TOTALS_SQL = ", ".join(
    f"{sql_total(c, d)} AS total_{c}, {sql_average(c, d)} AS avg_{c}"
    for c, d in summaries.BILLING_MEASURES.items()
)


def totals_sql(keys: str, labels: list[str]) -> str:
    text = "".join(f"min({c}) AS {c}, " for c in labels)
    return f"SELECT {keys}, {text}{TOTALS_SQL} FROM billing GROUP BY {keys}"


# --- complaint and outage summaries -----------------------------------------------------------


@query("crm_consumer_summary", with_views(["complaints"], complaint_sql(
    "account, year, month", "account", "min(star_customer) AS star_customer, ")))
def _(t):
    return summaries.complaint_summary(
        complaints(t), ["account", *MONTH], "account", {"star_customer": "star_customer"}
    )


@query("crm_ibc_summary", with_views(["complaints"], complaint_sql(
    "ibc_name, ibc_code, year, month", "ibc_name")))
def _(t):
    keys = ["ibc_name", "ibc_code", *MONTH]
    return cleaning.require_keys(
        summaries.complaint_summary(complaints(t), keys, "ibc_name"), ["ibc_name", *MONTH]
    )


@query("crm_pmt_summary", with_views(["complaints"], complaint_sql(
    "pmt, pmt_name, year, month", "ibc_name")))
def _(t):
    return summaries.complaint_summary(complaints(t), ["pmt", "pmt_name", *MONTH], "ibc_name")


@query("crm_date_summary", with_views(["complaints"], complaint_sql(
    "date, ibc_code, ibc_name", "date")))
def _(t):
    return summaries.complaint_summary(complaints(t), ["date", "ibc_code", "ibc_name"], "date")


@query("crm_feeder_summary", with_views(["complaints"], complaint_sql(
    "date, feeder_id, feeder_name", "feeder_id")))
def _(t):
    return summaries.complaint_summary(complaints(t), ["date", "feeder_id", "feeder_name"], "feeder_id")


@query("oms_ibc_month", with_views(["outages"], outage_sql("ibc_name, year, month")))
def _(t):
    return cleaning.require_keys(summaries.outage_summary(outages(t), ["ibc_name", *MONTH]), MONTH)


@query("oms_ibc_date", with_views(["outages"], outage_sql("ibc_name, date", True)))
def _(t):
    return summaries.outage_summary(outages(t), ["ibc_name", "date"], True)


@query("oms_feeder_date", with_views(["outages"], outage_sql(
    "line_id, date", True, "min(feeder_name) AS feeder_name, ")))
def _(t):
    return summaries.outage_summary(
        outages(t), ["line_id", "date"], True, {"feeder_name": "feeder_name"}
    )


@query("oms_month", with_views(["outages"], outage_sql("year, month")))
def _(t):
    return summaries.outage_summary(outages(t), MONTH)


@query("oms_date", with_views(["outages"], outage_sql("date")))
def _(t):
    return summaries.outage_summary(outages(t), ["date"])


@query("oms_feeder", with_views(["outages"], outage_sql("line_id, feeder_name")))
def _(t):
    return summaries.outage_summary(outages(t), ["line_id", "feeder_name"])


@query("most_frequent_per_group", with_views(["outages"], """
SELECT ibc_name, date, reason AS top_fault, n AS top_fault_frequency FROM (
  SELECT *, row_number() OVER (PARTITION BY ibc_name, date ORDER BY n DESC, reason) AS place FROM (
    SELECT ibc_name, date, reason, count(reason) AS n FROM outages GROUP BY 1, 2, 3)) WHERE place = 1"""))
def _(t):
    return summaries.most_frequent(
        outages(t), ["ibc_name", "date"], "reason", "top_fault", "top_fault_frequency"
    )


@query("left_join_mode", with_views(["outages"], """
SELECT g.*, f.reason AS top_fault FROM (
  SELECT line_id, count(outage_id) AS outages FROM outages GROUP BY line_id) g
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY n DESC, reason) AS place
  FROM (SELECT line_id, reason, count(reason) AS n FROM outages GROUP BY 1, 2)) WHERE place = 1) f
ON g.line_id = f.line_id"""))
def _(t):
    """A summary beside its most frequent value: one aggregation in place of the left join."""
    return summaries.aggregate_with_labels(
        outages(t), ["line_id"], [Measure("outages", "count", "outage_id")], None,
        ("reason", "top_fault", "frequency"),
    ).drop("frequency")


# --- billing joined with summaries ------------------------------------------------------------


def _consumer(t: Tables) -> DataFrame:
    return summaries.complaint_summary(
        complaints(t), ["account", *MONTH], "account", {"star_customer": "star_customer"}
    )


def _centre(t: Tables) -> DataFrame:
    return summaries.complaint_summary(complaints(t), ["ibc_code", *MONTH], "ibc_name")


def _transformer(t: Tables) -> DataFrame:
    return summaries.complaint_summary(
        complaints(t), ["pmt", *MONTH], "ibc_name", {"pmt_name": "pmt_name"}
    )


def _centre_faults(t: Tables) -> DataFrame:
    return summaries.outage_summary(outages(t), ["ibc_name", *MONTH])


def _centre_both(t: Tables) -> DataFrame:
    named = summaries.complaint_summary(
        complaints(t), ["ibc_name", *MONTH], "ibc_name", {"ibc_code": "ibc_code"}
    )
    return dims.complaints_with_outages(_centre_faults(t), named, ["ibc_name", *MONTH])


def _centre_both_by_code(t: Tables, codes: DataFrame) -> DataFrame:
    """Complaints and outages of each code; ``codes`` are those that billing has. Complaints are read once."""
    parts = summaries.outage_parts(outages(t), ["ibc_name", *MONTH])
    measures = summaries.complaint_measures("ibc_name")
    crm = stored(partial_groups(complaints(t), ["ibc_code", "ibc_name", *MONTH], measures))
    known = codes.unionByName(crm.select("ibc_name", "ibc_code", *MONTH))
    centre = merged(crm, ["ibc_code", *MONTH], measures)
    return dims.complaints_with_outages(dims.outages_by_code(parts, known), centre, ["ibc_code", *MONTH])


BOTH_SQL = f"""SELECT o.*, c.ibc_code, c.complaints, c.avg_resolution_minutes
FROM ({outage_sql("ibc_name, year, month")}) o JOIN ({complaint_sql(
    "ibc_name, year, month", "ibc_name", "min(ibc_code) AS ibc_code, ")}) c
USING (ibc_name, year, month)"""

ROW = ["document", "account", "ibc_code", "ibc_name", "pmt", "year", "month", "current_amount"]
ROW_SQL = ", ".join(f"b.{c}" for c in ROW)


def row_join_sql(summary: str, keys: list[str], columns: list[str]) -> str:
    on = " AND ".join(f"b.{k} = s.{k}" for k in keys)
    shown = "".join(f", s.{c}" for c in columns)
    return f"SELECT {ROW_SQL}{shown} FROM billing b JOIN ({summary}) s ON {on}"


@query("join_fact_consumer_dim", with_views(["billing", "complaints"], row_join_sql(
    complaint_sql("account, year, month", "account"), ["account", *MONTH], dims.COMPLAINT_COLUMNS)))
def _(t):
    joined = dims.with_summary(billing(t), _consumer(t), ["account", *MONTH])
    return joined.select(*ROW, *dims.COMPLAINT_COLUMNS)


@query("join_fact_ibc_crm", with_views(["billing", "complaints"], row_join_sql(
    complaint_sql("ibc_code, year, month", "ibc_name"), ["ibc_code", *MONTH], dims.COMPLAINT_COLUMNS)))
def _(t):
    joined = dims.with_summary(billing(t), _centre(t), ["ibc_code", *MONTH])
    return joined.select(*ROW, *dims.COMPLAINT_COLUMNS)


@query("join_fact_ibc_crm_oms", with_views(["billing", "complaints", "outages"], row_join_sql(
    BOTH_SQL, ["ibc_code", *MONTH], dims.COMPLAINT_COLUMNS + dims.OUTAGE_COLUMNS)))
def _(t):
    codes = billing(t).select("ibc_name", "ibc_code", *MONTH)
    joined = dims.with_summary(billing(t), _centre_both_by_code(t, codes), ["ibc_code", *MONTH])
    return joined.select(*ROW, *dims.COMPLAINT_COLUMNS, *dims.OUTAGE_COLUMNS)


@query("join_fact_pmt_crm", with_views(["billing", "complaints"], row_join_sql(
    complaint_sql("pmt, year, month", "ibc_name"), ["pmt", *MONTH], dims.COMPLAINT_COLUMNS)))
def _(t):
    joined = dims.with_summary(billing(t), _transformer(t), ["pmt", *MONTH])
    return joined.select(*ROW, *dims.COMPLAINT_COLUMNS)


@query("join_fact_ibc_oms", with_views(["billing", "outages"], row_join_sql(
    outage_sql("ibc_name, year, month"), ["ibc_name", *MONTH], dims.OUTAGE_COLUMNS)))
def _(t):
    joined = dims.with_summary(billing(t), _centre_faults(t), ["ibc_name", *MONTH])
    return joined.select(*ROW, *dims.OUTAGE_COLUMNS)


@query("consumer_dim", with_views(["billing", "complaints"], f"""
SELECT b.account, b.year, b.month, b.billing_month, b.consumer_type, b.consumer_name, b.ibc_name,
  b.ibc_code, b.irb_amount, b.irb_units, b.sanctioned_load, b.connected_load, b.current_amount,
  b.current_units, s.star_customer, s.complaints, s.avg_resolution_minutes
FROM (SELECT *, row_number() OVER (PARTITION BY account, year, month ORDER BY document) AS place
  FROM billing) b JOIN ({complaint_sql("account, year, month", "account",
  "min(star_customer) AS star_customer, ")}) s
ON b.account = s.account AND b.year = s.year AND b.month = s.month WHERE b.place = 1"""))
def _(t):
    """An account may have several orders a month here, so the lowest document stands for it."""
    return dims.consumer_dim(billing(t), _consumer(t), order="document", optional=dims.NOT_SUPPLIED)


def centre_sql(key: str, labels: list[str], summary: str, columns: list[str]) -> str:
    shown = "".join(f", s.{c}" for c in columns)
    return f"""SELECT b.*{shown}, make_date(b.year, b.month, 1) AS billing_month FROM ({totals_sql(f"{key}, year, month", labels)}) b
JOIN ({summary}) s ON b.{key} = s.{key} AND b.year = s.year AND b.month = s.month"""


@query("ibc_crm_ageing_dim", with_views(["billing", "complaints"], centre_sql(
    "ibc_code", ["ibc_name", "region"], complaint_sql("ibc_code, year, month", "ibc_name"),
    dims.COMPLAINT_COLUMNS)))
def centre_dimension(t):
    return dims.centre_dim(billing(t), _centre(t))


@query("ibc_all_dim", with_views(["billing", "complaints", "outages"], centre_sql(
    "ibc_code", ["ibc_name", "region"], BOTH_SQL, dims.COMPLAINT_COLUMNS + dims.OUTAGE_COLUMNS)))
def _(t):
    """Billing is read once: its partial groups hold the totals and the names of each code."""
    parts = stored(dims.billing_parts(billing(t)))
    codes = parts.select("ibc_name", "ibc_code", *MONTH)
    return dims.centre_dim_of_parts(parts, _centre_both_by_code(t, codes))


@query("pmt_crm_ageing_dim", with_views(["billing", "complaints"], centre_sql(
    "pmt", ["ibc_code", "ibc_name", "region"],
    complaint_sql("pmt, year, month", "ibc_name", "min(pmt_name) AS pmt_name, "),
    ["pmt_name", *dims.COMPLAINT_COLUMNS])))
def _(t):
    return dims.transformer_dim(billing(t), _transformer(t))


@query("ibc_oms_ageing_dim", with_views(["billing", "outages"], centre_sql(
    "ibc_name", ["ibc_code", "region"], outage_sql("ibc_name, year, month"), dims.OUTAGE_COLUMNS)))
def _(t):
    return dims.centre_dim(billing(t), _centre_faults(t), key="ibc_name")


@query("consumer_totals", with_views(["billing"], totals_sql("account, year, month", [])))
def _(t):
    return summaries.consumer_totals(billing(t))


# --- complaints beside outages ----------------------------------------------------------------


def _date_complaints(t: Tables) -> DataFrame:
    return summaries.complaint_summary(complaints(t), ["date", "ibc_name"], "date")


def _feeder_complaints(t: Tables) -> DataFrame:
    return summaries.complaint_summary(complaints(t), ["date", "feeder_id"], "feeder_id")


@query("outer_join_date", with_views(["complaints", "outages"], f"""
SELECT date, ibc_name, o.outages, c.complaints
FROM ({outage_sql("ibc_name, date", True)}) o
FULL JOIN ({complaint_sql("date, ibc_name", "date")}) c USING (date, ibc_name)"""))
def _(t):
    faults = summaries.outage_summary(outages(t), ["date", "ibc_name"], True)
    joined = dims.complaints_beside_outages(faults, _date_complaints(t), ["date", "ibc_name"])
    return joined.select("date", "ibc_name", "outages", "complaints")


@query("outer_join_feeder", with_views(["complaints", "outages"], f"""
SELECT date, feeder_id, o.outages, c.complaints
FROM ({outage_sql("feeder_id, date", True)}) o
FULL JOIN ({complaint_sql("date, feeder_id", "feeder_id")}) c USING (date, feeder_id)"""))
def _(t):
    faults = summaries.outage_summary(outages(t), ["date", "feeder_id"], True)
    joined = dims.complaints_beside_outages(faults, _feeder_complaints(t), ["date", "feeder_id"])
    return joined.select("date", "feeder_id", "outages", "complaints")


@query("date_ibc_crm_oms", with_views(["complaints", "outages"], f"""
SELECT date, ibc_name, o.* EXCLUDE (date, ibc_name), c.* EXCLUDE (date, ibc_name)
FROM ({outage_sql("ibc_name, date", True)}) o
FULL JOIN ({complaint_sql("date, ibc_name", "date")}) c USING (date, ibc_name)"""))
def _(t):
    """Every date and centre known to either source keeps its own row."""
    faults = summaries.outage_summary(outages(t), ["date", "ibc_name"], True)
    return dims.complaints_beside_outages(faults, _date_complaints(t), ["date", "ibc_name"])


@query("date_feeder_crm_oms", with_views(["complaints", "outages"], f"""
SELECT date, feeder_id, o.* EXCLUDE (date, feeder_id), c.* EXCLUDE (date, feeder_id)
FROM ({outage_sql("feeder_id, date", True, "min(feeder_name) AS feeder_name, ")}) o
FULL JOIN ({complaint_sql("date, feeder_id", "feeder_id")}) c USING (date, feeder_id)"""))
def _(t):
    faults = summaries.outage_summary(
        outages(t), ["date", "feeder_id"], True, {"feeder_name": "feeder_name"}
    )
    return dims.complaints_beside_outages(faults, _feeder_complaints(t), ["date", "feeder_id"])


@query("join_ibc_dims", with_views(["complaints", "outages"],
    f"SELECT ibc_name, year, month, outages, complaints FROM ({BOTH_SQL})"))
def _(t):
    return _centre_both(t).select("ibc_name", *MONTH, "outages", "complaints")


@query("ibc_oms_crm_dim", with_views(["complaints", "outages"], BOTH_SQL))
def _(t):
    return _centre_both(t)


@query("distinct_keys", with_views(["billing", "outages"], """
SELECT name, coalesce(in_left, 0) AS in_left, coalesce(in_right, 0) AS in_right
FROM (SELECT DISTINCT account AS name, 1 AS in_left FROM billing) a
FULL JOIN (SELECT DISTINCT CAST(line_id AS VARCHAR) AS name, 1 AS in_right FROM outages) b USING (name)"""))
def _(t):
    lines = outages(t).select(F.col("line_id").cast("string").alias("line"))
    return cleaning.distinct_names(billing(t), "account", lines, "line")


# --- facts ------------------------------------------------------------------------------------

ALL_TERMS = list(dict.fromkeys(facts.TAX_TERMS + facts.BENEFIT_TERMS + facts.IMPORT_TERMS))


def term_sql(name: str) -> str:
    """Term i is the order value's whole part modulo i + 2, and missing in every seventh order."""
    i = ALL_TERMS.index(name)
    return (
        f"CASE WHEN o_orderkey % 7 <> {i % 7} "
        f"THEN CAST(floor(o_totalprice) AS BIGINT) % {i + 2} ELSE 0 END"
    )


def billing_documents(t: Tables) -> DataFrame:
    terms = [
        F.when(
            F.col("o_orderkey") % 7 != i % 7,
            (F.floor("o_totalprice") % (i + 2)).cast("double"),
        ).alias(name)
        for i, name in enumerate(ALL_TERMS)
    ]
    issued = F.col("o_orderdate").cast("date")
    return t.orders.select(
        F.col("o_orderkey").alias("document"),
        F.col("o_custkey").alias("account"),
        issued.alias("issue_date"),
        F.date_add(issued, 15).alias("due_date"),
        F.col("o_totalprice").alias("net_amount"),
        F.floor(F.col("o_totalprice") / 100).alias("units_billed"),
        F.floor(F.col("o_totalprice") / 2).cast("double").alias("energy_charges"),
        *terms,
    )


def payments(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("account"),
        F.col("l_shipdate").cast("date").alias("document_date"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def _terms(names: list[str]) -> str:
    return "CAST(" + " + ".join(term_sql(n) for n in names) + " AS DOUBLE)"


PAYMENT_SQL = f"""SELECT o_custkey AS account, {sql_total('l_extendedprice')} AS recovery_amount,
  avg(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS paid_day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""


@query("fact_billing_and_recovery", f"""
SELECT o_orderkey AS document, o_custkey AS account, CAST(o_orderdate AS DATE) + 15 AS due_date,
  o_totalprice AS total_amount, {_terms(facts.TAX_TERMS)} AS tax_amount, p.recovery_amount,
  o_totalprice - p.recovery_amount AS outstanding_amount,
  p.paid_day - date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS avg_payment_days,
  floor(o_totalprice / 100) AS units_billed, {_terms(facts.BENEFIT_TERMS)} AS benefit_adjustments,
  {_terms(facts.IMPORT_TERMS)} AS import_amount, floor(o_totalprice / 2) AS energy_charges,
  {_terms(facts.SURCHARGE_TERMS)} AS surcharge_amount,
  md5(concat_ws('|', length(CAST(o_orderkey AS VARCHAR)) || ':' || o_orderkey,
    length(CAST(o_custkey AS VARCHAR)) || ':' || o_custkey,
    '10:' || CAST(CAST(o_orderdate AS DATE) + 15 AS VARCHAR))) AS fact_key
FROM orders JOIN ({PAYMENT_SQL}) p ON o_custkey = p.account""")
def _(t):
    return facts.billing_and_recovery(billing_documents(t), payments(t))


@query("join_billing_recovery_by_account", f"""
SELECT b.account, b.billed, p.recovered FROM (
  SELECT o_custkey AS account, {sql_total('o_totalprice')} AS billed FROM orders GROUP BY 1) b
JOIN (SELECT o_custkey AS account, {sql_total('l_extendedprice')} AS recovered
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) p ON b.account = p.account""")
def _(t):
    joined = facts.recovery_by_date(
        billing_documents(t).select("account", F.col("net_amount").alias("billed")),
        payments(t).select("account", F.col("total_amount").alias("recovered")),
        ["account"],
    )
    return joined.drop("recovery_percentage")


def _posted(t: Tables):
    billed = t.orders.select(
        F.col("o_orderdate").cast("date").alias("posting_date"), F.col("o_totalprice").alias("billed")
    )
    recovered = t.lineitem.select(
        F.col("l_shipdate").cast("date").alias("posting_date"),
        F.col("l_extendedprice").alias("recovered"),
    )
    return billed, recovered


POSTED_SQL = f"""(SELECT CAST(o_orderdate AS DATE) AS posting_date, {sql_total('o_totalprice')} AS billed
  FROM orders GROUP BY 1) b {{how}} JOIN (SELECT CAST(l_shipdate AS DATE) AS posting_date,
  {sql_total('l_extendedprice')} AS recovered FROM lineitem GROUP BY 1) r USING (posting_date)"""


@query("join_billing_recovery_by_date",
    f"SELECT posting_date, billed, recovered FROM {POSTED_SQL.format(how='')}")
def _(t):
    return facts.recovery_by_date(*_posted(t), ["posting_date"]).drop("recovery_percentage")


@query("recovery_percentage", f"""SELECT posting_date, billed, recovered,
  recovered / nullif(billed, 0) * 100 AS recovery_percentage FROM {POSTED_SQL.format(how='')}""")
def recovery_percentage(t):
    return facts.recovery_by_date(*_posted(t), ["posting_date"])


@query("outer_join_recovery", f"""
SELECT ibc_code, posting_date, billed, recovered, recovered / nullif(billed, 0) * 100 AS recovery_percentage
FROM (SELECT c_nationkey AS ibc_code, CAST(o_orderdate AS DATE) AS posting_date,
    {sql_total('o_totalprice')} AS billed
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) b
FULL JOIN (SELECT c_nationkey AS ibc_code, CAST(l_shipdate AS DATE) AS posting_date,
    {sql_total('l_extendedprice')} AS recovered
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2) r USING (ibc_code, posting_date)""")
def _(t):
    centre = t.customer.select("c_custkey", F.col("c_nationkey").alias("ibc_code"))
    billed = t.orders.join(centre, F.col("o_custkey") == F.col("c_custkey")).select(
        "ibc_code", F.col("o_orderdate").cast("date").alias("posting_date"),
        F.col("o_totalprice").alias("billed"),
    )
    recovered = payments(t).join(centre, F.col("account") == F.col("c_custkey")).select(
        "ibc_code", F.col("document_date").alias("posting_date"),
        F.col("total_amount").alias("recovered"),
    )
    return facts.recovery_by_date(billed, recovered, ["ibc_code", "posting_date"], "full")


def _network(t: Tables) -> dict[str, DataFrame]:
    """Tickets are order lines, feeders suppliers, transformers parts, devices nations, and a
    device's power readings its customers' balances."""
    # Groups by ticket need no further exchange, and nearly every line is one: a task holds its lines' groups.
    lines = t.lineitem.repartition(tasks_for(t.lineitem.count()), "l_orderkey")
    tickets = lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("ticket"),
        F.col("l_suppkey").alias("feeder"),
        F.col("l_partkey").alias("dts"),
        F.col("l_returnflag").alias("subject"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("unplanned"),
        F.when(F.col("l_quantity") > 25, "emergency").alias("emergency"),
        ((F.datediff("l_shipdate", "o_orderdate") * 86400 + F.col("l_linenumber") * 7).cast("double") / 60)
        .alias("resolution_minutes"),
    )
    return {
        "tickets": tickets,
        "feeders": t.supplier.select(F.col("s_suppkey").alias("feeder")),
        "energy": t.supplier.select(
            F.col("s_suppkey").alias("feeder"), F.col("s_nationkey").alias("device")
        ),
        "transformers": t.part.select(F.col("p_partkey").alias("dts")),
        "power": t.customer.select(
            F.col("c_nationkey").alias("device"),
            F.col("c_acctbal").alias("active_kw"),
            F.floor("c_acctbal").alias("reactive_kvar"),
        ),
    }


POWER_SQL = f"""(SELECT c_nationkey AS device, {sql_total('c_acctbal')} AS energy_created,
  {sql_total('floor(c_acctbal)')} AS energy_transmitted FROM customer GROUP BY 1)"""


@query("join_network_5way", f"""
SELECT l_orderkey AS ticket, l_linenumber AS line, l_suppkey AS feeder, l_partkey AS dts, p.device,
  p.energy_created FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN part ON l_partkey = p_partkey JOIN {POWER_SQL} p ON p.device = s_nationkey""")
def _(t):
    """Ticket rows beside their feeder's device and its power, without multiplying tickets."""
    n = _network(t)
    readings = facts.aggregate(n["power"], ["device"], [Measure("energy_created", "sum", "active_kw", 2)])
    powered = n["feeders"].join(n["energy"], "feeder").join(readings, "device")
    tickets = t.lineitem.select(
        F.col("l_orderkey").alias("ticket"), F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("feeder"), F.col("l_partkey").alias("dts"),
    )
    return join_summary(tickets.join(n["transformers"], "dts"), powered, ["feeder"]).select(
        "ticket", "line", "feeder", "dts", "device", "energy_created"
    )


@query("fact_network_and_losses", f"""
WITH tickets AS (SELECT l_orderkey AS ticket, l_suppkey AS feeder, l_partkey AS dts,
  l_returnflag AS subject, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS unplanned,
  CASE WHEN l_quantity > 25 THEN 'emergency' END AS emergency,
  CAST(date_diff('day', o_orderdate, l_shipdate) * 86400 + l_linenumber * 7 AS DOUBLE) / 60 AS resolution_minutes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT g.*, f.subject AS common_fault, f.n AS common_fault_frequency, p.device, p.energy_created,
  p.energy_transmitted
FROM (SELECT feeder, dts, ticket, count(subject) AS faults, CAST(sum(unplanned) AS BIGINT) AS unplanned_faults,
  count(emergency) AS emergencies, count(ticket) AS tickets_processed,
  round(avg(resolution_minutes), 6) AS avg_resolution_minutes
  FROM tickets GROUP BY 1, 2, 3) g
JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feeder, dts, ticket ORDER BY n DESC, subject)
  AS place FROM (SELECT feeder, dts, ticket, subject, count(subject) AS n FROM tickets GROUP BY 1, 2, 3, 4))
  WHERE place = 1) f ON g.feeder = f.feeder AND g.dts = f.dts AND g.ticket = f.ticket
JOIN supplier ON g.feeder = s_suppkey JOIN part ON g.dts = p_partkey
JOIN {POWER_SQL} p ON p.device = s_nationkey""")
def _(t):
    n = _network(t)
    return facts.network_and_losses(
        n["tickets"], n["feeders"], n["energy"], n["transformers"], n["power"]
    )


@query("weekly_rollup", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(week(o_orderdate) AS INTEGER) AS week,
  CAST(sum(CAST(floor(o_totalprice / 100) AS BIGINT)) AS BIGINT) AS total_regular_units,
  {sql_total('o_totalprice')} AS total_last_payment FROM orders GROUP BY 1, 2 ORDER BY 1, 2""")
def _(t):
    rows = t.orders.withColumn("units", F.floor(F.col("o_totalprice") / 100))
    return summaries.weekly_rollup(
        rows, "o_orderdate",
        [Measure("total_regular_units", "sum", "units"),
         Measure("total_last_payment", "sum", "o_totalprice", 2)],
    )


@query("kpi_fact", f"""
WITH service AS (SELECT CAST(o_orderdate AS DATE) AS date, o_custkey AS customer, l_partkey AS product,
  l_suppkey AS agent, s_nationkey AS equipment, c_nationkey AS location, l_extendedprice AS due,
  CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END AS paid,
  greatest(date_diff('day', o_orderdate, l_shipdate), 0) AS overdue_days, l_linenumber AS interaction,
  l_quantity AS resolution_hours, l_discount AS satisfaction,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS fault, l_quantity AS downtime, l_tax AS cost
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey)
SELECT date, customer, product, agent, equipment, location, {sql_total('due')} AS amount_due,
  {sql_total('paid')} AS amount_paid, CAST(sum(overdue_days) AS BIGINT) AS days_overdue,
  count(interaction) AS interactions, {sql_average('resolution_hours')} AS avg_resolution_hours,
  {sql_average('satisfaction')} AS avg_satisfaction, CAST(sum(fault) AS BIGINT) AS faults,
  {sql_total('downtime')} AS downtime, {sql_total('cost')} AS maintenance_cost
FROM service GROUP BY 1, 2, 3, 4, 5, 6""")
def _(t):
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    late = F.greatest(F.datediff("l_shipdate", "o_orderdate"), F.lit(0))
    return facts.kpi_fact(
        rows.select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_custkey").alias("customer"),
            F.col("l_partkey").alias("product"),
            F.col("l_suppkey").alias("agent"),
            F.col("s_nationkey").alias("equipment"),
            F.col("c_nationkey").alias("location"),
            F.col("l_extendedprice").alias("due"),
            F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_extendedprice")).alias("paid"),
            late.alias("overdue_days"),
            F.col("l_linenumber").alias("interaction"),
            F.col("l_quantity").alias("resolution_hours"),
            F.col("l_discount").alias("satisfaction"),
            F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("fault"),
            F.col("l_quantity").alias("downtime"),
            F.col("l_tax").alias("cost"),
        )
    )


@query("join_outage_weather", with_views(["outages"], f"""
SELECT outage_id, line_id, date, w.temp, w.precip FROM outages LEFT JOIN (
  SELECT CAST(l_shipdate AS DATE) AS date, {sql_average('l_quantity')} AS temp, {sql_total('l_tax')} AS precip
  FROM lineitem GROUP BY 1) w USING (date)"""))
def _(t):
    """Daily weather is stood in for by daily figures of ``lineitem``."""
    weather = facts.aggregate(
        t.lineitem.withColumn("date", F.col("l_shipdate").cast("date")), ["date"],
        [Measure("temp", "avg", "l_quantity", 2), Measure("precip", "sum", "l_tax", 2)],
    )
    return facts.join_weather(outages(t), stored(weather)).select("outage_id", "line_id", "date", "temp", "precip")
