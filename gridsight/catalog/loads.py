"""Extract scans, table lifecycle, arrivals and whole loads on the supplied tables.

Files are made by Spark from the supplied tables in a new folder under the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from gridsight.catalog import bindings
from gridsight.catalog.bindings import VIEWS, Tables, sql_total, weekly_scores, with_views
from gridsight.catalog.registry import query
from gridsight.catalog.star import centre_sql, complaint_sql, outage_sql
from gridsight.operators import dimensions as dims, summaries
from gridsight.plans.billing import clean_billing
from gridsight.plans.complaints import clean_complaints
from gridsight.plans.monthly import (
    billing_dims, feeder_outages, load_complaints, load_months, load_outages, undo_loads,
)
from gridsight.plans.outages import clean_outages
from gridsight.session import new_folder
from gridsight.sources import checks, extracts, journal, tables
from gridsight.streaming import arrivals

ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


def _text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _order_text(t: Tables) -> DataFrame:
    return _text(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))


def _orders_typed(df: DataFrame) -> DataFrame:
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in types.items()})


def _yearly(t: Tables) -> DataFrame:
    """Orders with the year as their load."""
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("day"), F.year("o_orderdate").alias(tables.LOAD),
    )


YEARLY_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day,
  CAST(year(o_orderdate) AS INTEGER) AS load_id FROM orders"""


# --- scans ------------------------------------------------------------------------------------


@query("scan_pipe_csv", ORDER_SQL)
def _(t):
    rows = _order_text(t)
    path = extracts.write_extract(rows, new_folder(t.spark, "pipe"), "extract", "|")
    return _orders_typed(extracts.scan_delimited(t.spark, path, rows.columns, "|"))


@query("scan_comma_csv", ORDER_SQL)
def _(t):
    path = extracts.write_extract(_order_text(t), new_folder(t.spark, "comma"), "extract", ",")
    return _orders_typed(extracts.scan_delimited(t.spark, path))


@query("billing_month_from_path", """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN
  strftime(o_orderdate, '%Y%m') END AS billing_month FROM orders""")
def _(t):
    """Months come from the folder name; files without one give NULL, and are the rejects."""
    month = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyyMM"))
    rows = t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus",
        F.coalesce(month, F.lit("unknown")).alias("yyyymm"),
    )
    path = extracts.write_extract(rows, new_folder(t.spark, "months"), "Ageing", by="yyyymm")
    scanned = extracts.scan_billing(t.spark, path, ["o_orderkey", "o_orderstatus"])
    return scanned.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), "billing_month")


@query("scan_table", "SELECT * FROM customer")
def _(t):
    return tables.read_table(t.spark, f"{t.folder}/customer.parquet")


@query("register_views", f"""SELECT c_mktsegment, {sql_total('o_totalprice')} AS billed
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def _(t):
    tables.register_views({"billing_data": t.orders, "consumer_data": t.customer})
    return t.spark.sql("""SELECT c_mktsegment,
        CAST(sum(CAST(rint(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS billed
      FROM billing_data JOIN consumer_data ON o_custkey = c_custkey GROUP BY c_mktsegment""")


CHECKED_SQL = """SELECT *, amount IS NOT NULL AND amount > 0 AS has_amount, coalesce(status IN ('F', 'O'), FALSE) AS has_status,
  account IS NOT NULL AS has_account FROM (SELECT CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS amount,
    o_orderstatus AS status, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS account FROM orders)"""
RULES_SQL = {"amount": "has_amount", "status": "has_status", "account": "has_account"}


@query("load_checks", "\nUNION ALL ".join(
    f"""SELECT '{rule}' AS rule, count(*) AS rows, count(*) FILTER (WHERE NOT {good}) AS broken,
  count(*) FILTER (WHERE NOT {good}) <= CAST({most} AS DOUBLE) * count(*) AS within_bound,
  count(*) FILTER (WHERE NOT {good}) AS quarantined,
  count(*) FILTER (WHERE has_amount AND has_status AND has_account) AS kept FROM ({CHECKED_SQL})"""
    for (rule, good), most in zip(RULES_SQL.items(), (0.5, 0.001, 0.5))))
def _(t):
    """Text of which some is bad: what each rule counted while writing, beside what lies in the quarantine."""
    key = F.col("o_orderkey")
    rows = _text(t.orders.select(
        F.when(key % 11 != 0, F.col("o_totalprice").cast("string")).otherwise("n/a").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.when(key % 13 != 0, F.col("o_custkey").cast("string")).otherwise("?").alias("account")))
    path = extracts.write_extract(rows, new_folder(t.spark, "checked"), "extract", "|")
    scanned = extracts.scan_delimited(t.spark, path, rows.columns, "|")
    typed = scanned.withColumns({"amount": F.col("amount").try_cast("double"), "account": F.col("account").try_cast("bigint")})
    checked = checks.checked_write(typed, new_folder(t.spark, "kept"), [
        checks.Rule("amount", F.col("amount") > 0, 0.5), checks.Rule("status", F.col("status").isin("F", "O"), 0.001),
        checks.Rule("account", F.col("account").isNotNull(), 0.5)], refuse=False)
    bad = checked.quarantined().select(F.explode(checks.BROKEN).alias("rule")).groupBy("rule").agg(F.count("*").alias("quarantined"))
    kept = checked.kept().agg(F.count("*")).scalar()
    return checked.report().drop("most").join(bad, "rule", "left").fillna(0, ["quarantined"]).withColumn("kept", kept)


# --- tables -----------------------------------------------------------------------------------


@query("write_replace", YEARLY_SQL)
def _(t):
    """The second write replaces the first, whose rows were only half."""
    path = new_folder(t.spark, "replaced")
    tables.write_replace(_yearly(t).filter("o_orderstatus = 'F'"), path, tables.LOAD)
    tables.write_replace(_yearly(t), path, tables.LOAD)
    return tables.read_table(t.spark, path)


@query("write_append", YEARLY_SQL)
def _(t):
    path = new_folder(t.spark, "appended")
    tables.write_append(_yearly(t).filter("load_id < 1999"), path)
    tables.write_append(_yearly(t).filter("load_id >= 1999"), path)
    return tables.read_table(t.spark, path)


@query("save_as_table_overwrite", YEARLY_SQL)
def _(t):
    name = f"orders_{uuid.uuid4().hex}"
    return tables.save_as_table(_yearly(t), name, new_folder(t.spark, "saved"))


@query("delete_by_predicate", f"""SELECT * FROM ({YEARLY_SQL}) WHERE load_id <> 2000
AND NOT (o_orderstatus <> 'F' AND o_totalprice > 250000)""")
def _(t):
    """One delete empties a load and so removes it; the other rewrites every remaining load."""
    path = new_folder(t.spark, "deleted")
    tables.write_replace(_yearly(t), path, tables.LOAD)
    tables.delete_where(t.spark, path, F.year("day") == 2000)
    tables.delete_where(t.spark, path, ~F.col("o_orderstatus").like("F") & (F.col("o_totalprice") > 250000))
    return tables.read_table(t.spark, path)


@query("load_history", """SELECT CAST(year(o_orderdate) AS INTEGER) AS load_id, count(*) AS rows,
  CAST(min(o_orderdate) AS DATE) AS first_at, CAST(max(o_orderdate) AS DATE) AS last_at
FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 100""")
def _(t):
    path = tables.write_replace(_yearly(t), new_folder(t.spark, "history"), tables.LOAD)
    return tables.load_history(tables.read_table(t.spark, path), "day")


@query("rollback_load", f"SELECT * FROM ({YEARLY_SQL}) WHERE load_id <= 1998")
def _(t):
    path = tables.write_replace(_yearly(t), new_folder(t.spark, "rolled"), tables.LOAD)
    tables.rollback_to(t.spark, path, 1998)
    return tables.read_table(t.spark, path)


@query("read_as_of", f"SELECT * FROM ({YEARLY_SQL}) WHERE load_id <= 1997")
def _(t):
    path = tables.write_replace(_yearly(t), new_folder(t.spark, "asof"), tables.LOAD)
    return tables.as_of(tables.read_table(t.spark, path), 1997)


@query("idempotent_append", f"""
WITH keyed AS (SELECT *, CASE WHEN o_orderkey % 50 <> 3 THEN o_orderkey // 2 END AS key FROM ({YEARLY_SQL})),
base AS (SELECT * FROM keyed WHERE load_id < 1999),
late AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY o_orderkey) AS place FROM keyed WHERE load_id >= 1998)
SELECT * FROM base UNION ALL SELECT * EXCLUDE (place) FROM late WHERE place = 1
  AND NOT EXISTS (SELECT 1 FROM base WHERE base.key IS NOT DISTINCT FROM late.key)""")
def _(t):
    """The second load overlaps the first, repeats keys, has NULL ones, and arrives twice."""
    path = new_folder(t.spark, "idempotent")
    key = F.when(F.col("o_orderkey") % 50 != 3, F.expr("o_orderkey div 2"))
    rows = _yearly(t).withColumn("key", key)
    tables.write_append(rows.filter("load_id < 1999"), path)
    for _ in range(2):
        tables.idempotent_append(rows.filter("load_id >= 1998"), path, ["key"], ["o_orderkey"])
    return tables.read_table(t.spark, path)


@query("evolve_schema", """SELECT o_orderkey AS document, o_custkey % 100 AS pmt,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority FROM orders""")
def _(t):
    """Old loads have a narrow key and a column since dropped; new ones have another column."""
    old = t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("document"), (F.col("o_custkey") % 100).cast("int").alias("pmt"),
        F.lit("x").alias("dropped"),
    )
    new = t.orders.filter("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("document"), (F.col("o_custkey") % 100).alias("pmt"),
        F.col("o_orderpriority").alias("priority"),
    )
    target = StructType([
        StructField("document", LongType()), StructField("pmt", LongType()),
        StructField("priority", StringType()),
    ])
    return tables.evolve([old, new], target)


@query("load_predictions", with_views(["weekly_scores"],
    "SELECT feeder AS fdr_id, probability AS predicted_probability, fault AS actual_fault FROM weekly_scores"))
def _(t):
    folder = new_folder(t.spark, "predictions")
    names = ["fdr_Id", "Prediction Probability", "Actual Fault"]
    made = weekly_scores(t).select(
        *[F.col(a).cast("string").alias(b) for a, b in zip(["feeder", "probability", "fault"], names)]
    )
    extracts.export_csv(made, f"{folder}/csv")
    scanned = extracts.scan_delimited(t.spark, f"{folder}/csv", names)
    typed = scanned.select(
        F.col("fdr_Id").try_cast("bigint").alias("fdr_id"),
        F.col("`Prediction Probability`").try_cast("double").alias("predicted_probability"),
        F.col("`Actual Fault`").try_cast("int").alias("actual_fault"),
    )
    return tables.read_table(t.spark, tables.write_replace(typed, f"{folder}/table"))


def _scan_tasks(table: DataFrame) -> int:
    """How many tasks read a table; for a plain scan this runs nothing."""
    return table.rdd.getNumPartitions()


def _exported(t: Tables, files: int | None = None, spread: bool = False) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = extracts.export_csv(rows, new_folder(t.spark, "export"), files, spread)
    return _orders_typed(extracts.scan_delimited(t.spark, path))


@query("export_csv", ORDER_SQL)
def _(t):
    return _exported(t)


@query("export_csv_few_files", ORDER_SQL)
def _(t):
    """A quarter of the files there would be, but 20 at least."""
    return _exported(t, max(20, _scan_tasks(t.orders) // 4))


@query("export_csv_many_files", ORDER_SQL)
def _(t):
    """Twice the files there would be, but 100 at least, by a shuffle."""
    return _exported(t, max(100, 2 * _scan_tasks(t.orders)), spread=True)


@query("repartition_cache", YEARLY_SQL)
def _(t):
    """Rows gathered by their partition before a partitioned write; nothing is cached, since the
    result is read once."""
    path = new_folder(t.spark, "gathered")
    tables.gather_for_write(_yearly(t), tables.LOAD).write.partitionBy(tables.LOAD).parquet(path)
    return tables.read_table(t.spark, path)


@query("incremental_filter", """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >
  (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < DATE '2000-02-15')""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    loaded = rows.filter(F.col("o_orderdate") < F.to_date(F.lit("2000-02-15")))
    return tables.newer_rows(rows, loaded, "o_orderdate")


# --- raw extracts to facts --------------------------------------------------------------------


def raw_billing(t: Tables) -> DataFrame:
    """Billing rows under the extract's own headings, as dirty text, with the file's month."""
    known = bindings.billing(t)
    text = lambda c: F.col(c).cast("string")
    return known.select(
        text("account").alias("AccountContract"),
        F.when(F.col("status") == "F", "ACT").otherwise(F.col("status")).alias("Status"),
        text("ibc_code").alias("IBC"),
        F.col("ibc_name").alias("IBCName"),
        F.when(F.col("region") == "ASIA", "Undefined").otherwise(F.col("region")).alias("Region"),
        text("pmt").alias("PMT"),
        F.coalesce(F.col("consumer_type"), F.lit("-")).alias("Consumer Type"),
        F.col("consumer_name").alias("Customer Name"),
        text("document").alias("Premise Type"),
        F.date_format("issue_date", "d-MMM-yy").alias("Last Payment Date"),
        text("current_amount").alias("CurrentAmount"),
        text("current_units").alias("CurrentUnits"),
        F.coalesce(text("irb_revised_amount"), F.lit(".")).alias("IRBRevisedAmount"),
        text("irb_detection_amount").alias("IRBDetectionAmount"),
        text("irb_revised_units").alias("IRBRevisedUnits"),
        text("irb_detection_units").alias("IRBDetectionUnits"),
        text("sanctioned_load").alias("Sanctioned Load"),
        text("connected_load").alias("Connected Load"),
        F.lit("0").alias("C 0-30"),
        F.lit("7").alias("Contract"),
        F.date_format("issue_date", "yyyyMM").alias("yyyymm"),
    )


def landed_billing(t: Tables) -> DataFrame:
    rows = raw_billing(t)
    path = extracts.write_extract(rows, new_folder(t.spark, "billing"), "Ageing", by="yyyymm")
    return clean_billing(extracts.scan_billing(t.spark, path, [c for c in rows.columns if c != "yyyymm"]))


@query("clean_billing_extract", with_views(["billing"], """
SELECT account, document, billing_month, year, month, ibc_code, ibc_name,
  CASE WHEN region <> 'ASIA' THEN region END AS region, pmt, consumer_type, issue_date AS payment_date,
  year AS payment_year, month AS payment_month, current_amount, current_units, irb_amount, irb_units,
  sanctioned_load, CAST(connected_load AS DOUBLE) AS connected_load
FROM billing WHERE status = 'F'"""))
def _(t):
    """Monthly pipe-delimited files to the cleaned billing fact, in one pass over all months."""
    return landed_billing(t).select(
        "account", F.col("premise_type").cast("bigint").alias("document"), "billing_month", "year",
        "month", "ibc_code", "ibc_name", "region", "pmt", "consumer_type", "payment_date",
        "payment_year", "payment_month", "current_amount", "current_units", "irb_amount",
        "irb_units", "sanctioned_load", "connected_load",
    )


@query("clean_complaint_extract", with_views(["complaints"], """
SELECT ticket, account, ibc_name, ibc_code, CAST(date AS TIMESTAMP) AS created_at, year,
  CASE WHEN ticket % 4 <> 0 THEN month END AS month, pmt, pmt_name, feeder_name, star_customer,
  resolution_minutes, CAST(ticket % 50 AS DOUBLE) * 60 + ticket % 60 + CAST(0.5 AS DOUBLE) AS elapsed
FROM complaints"""))
def _(t):
    known = bindings.complaints(t)
    text = lambda c: F.col(c).cast("string")
    raw = known.select(
        text("ticket").alias("Ticket No."), text("account").alias("AccountContract"),
        F.lit("ACT").alias("ConsumerStatus"), F.col("ibc_name").alias("IBCName"),
        F.col("ibc_code").alias("IBCCode"), F.date_format("date", "dd-MMM-yy").alias("CREATED_DATE"),
        text("year").alias("Year"),
        F.when(F.col("ticket") % 4 == 0, "Not found").otherwise(F.date_format("date", "MMM")).alias("Month"),
        text("pmt").alias("PMT"), F.col("pmt_name").alias("PMT Name"),
        F.col("feeder_name").alias("Feeder Name"), F.col("star_customer").alias("StarCustomer"),
        (F.col("resolution_minutes") / 60).cast("string").alias("GroundTAT"),
        F.format_string("%d:%d:30", F.col("ticket") % 50, F.col("ticket") % 60).alias("O to I"),
        F.lit("x").alias("Remarks"),
    )
    path = extracts.write_extract(raw, new_folder(t.spark, "complaints"), "complaints", "|")
    fact = clean_complaints(extracts.scan_delimited(t.spark, path, raw.columns, "|"))
    return fact.select(
        F.col("`Ticket No.`").cast("bigint").alias("ticket"), "account", "ibc_name", "ibc_code",
        "created_at", "year", "month", "pmt", "pmt_name", "feeder_name", "star_customer",
        "resolution_minutes", F.col("`O to I(minutes)`").alias("elapsed"),
    )


@query("clean_outage_extract", with_views(["outages"], """
SELECT outage_id, date_trunc('second', created_at) AS created_at, ibc_name, feeder_id, feeder_name, reason,
  turnaround_minutes, punching_delay, rain,
  CAST(turnaround_minutes AS DOUBLE) / 60 AS duration_minutes,
  CASE WHEN outage_id % 3 = 0 THEN 1 ELSE 0 END AS emergency FROM outages WHERE outage_id % 13 <> 0"""))
def _(t):
    """One outage in thirteen has text for a turnaround, which removes it by rule."""
    known = bindings.outages(t)
    whole = lambda c: F.col(c).cast("bigint").cast("string")
    raw = known.select(
        whole("outage_id").alias("outage_Id"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("Createdon"),
        F.col("ibc_name").alias("IBC"), F.col("feeder_id").cast("string").alias("fdr_Id"),
        F.col("feeder_name").alias("fdr_name"),
        F.coalesce(F.col("reason"), F.lit("Undefined")).alias("initialoffreason"),
        F.when(F.col("outage_id") % 13 == 0, "LL").otherwise(whole("turnaround_minutes")).alias("TAT"),
        F.coalesce(whole("punching_delay"), F.lit("-")).alias("PunchingDelay"),
        F.format_string("0:0:%d", F.col("turnaround_minutes").cast("bigint")).alias("duration"),
        F.when(F.col("rain") == 1, "YES").otherwise("NO").alias("israintripping"),
        F.when(F.col("outage_id") % 3 == 0, "1").when(F.col("outage_id") % 3 == 1, " ").alias("isemergency"),
        F.lit("x").alias("Relay"),
    )
    path = extracts.write_extract(raw, new_folder(t.spark, "outages"), "outages", ",")
    fact = clean_outages(extracts.scan_delimited(t.spark, path, raw.columns))
    return fact.withColumn("outage_id", F.col("outage_id").cast("bigint"))


ACTIVE = VIEWS["billing"] + " WHERE o_orderstatus = 'F'"


@query("monthly_load", f"WITH billing AS ({ACTIVE} AND month(o_orderdate) BETWEEN 4 AND 9), complaints AS ({VIEWS['complaints']})\n" + centre_sql(
    "ibc_code", ["ibc_name"], complaint_sql("ibc_code, year, month", "ibc_name"), dims.COMPLAINT_COLUMNS))
def _(t):
    """From landed billing files to the centre dimension, through the whole monthly load; of the
    months from April to September, as the season gate has it."""
    made = billing_dims(landed_billing(t), bindings.complaints(t), bindings.outages(t), season=True)
    return made["ibc_crm_ageing_dim"].drop("region")


@query("incremental_months", f"WITH billing AS ({ACTIVE}), complaints AS ({VIEWS['complaints']})\n" + centre_sql(
    "ibc_code", ["ibc_name"], complaint_sql("ibc_code, year, month", "ibc_name"), dims.COMPLAINT_COLUMNS))
def _(t):
    """Months land in two loads that overlap by a year; the dimension equals that of one load."""
    rows = raw_billing(t).withColumnRenamed("yyyymm", "billing_month")
    base = new_folder(t.spark, "star")
    load_complaints(bindings.complaints(t), base)
    load_outages(bindings.outages(t), base)
    for some in (F.col("billing_month") < "199900", F.col("billing_month") > "199800"):
        paths = load_months(rows.filter(some), base)
    return tables.read_table(t.spark, paths["ibc_crm_ageing_dim"]).drop("region", tables.LOAD)


# The month that the second load of ``_load_all`` empties, and the source rows that have no month.
EMPTIED, NO_MONTH = 199805, 97


def _two_names(df: DataFrame, parity: str) -> DataFrame:
    """Every centre under two names: odd rows have the second."""
    second = F.when(F.col(parity) % 2 == 1, F.concat("ibc_name", F.lit(" II"))).otherwise(F.col("ibc_name"))
    return df.withColumn("ibc_name", second)


def _two_names_sql(view: str, parity: str) -> str:
    return f"""SELECT * REPLACE (CASE WHEN {parity} % 2 = 1 THEN ibc_name || ' II' ELSE ibc_name END AS ibc_name)
FROM ({VIEWS[view]})"""


def _load_all(t: Tables) -> dict[str, str]:
    """All tables after three loads: complaints and outages; every billing month, some rows without
    one; and a correction after which a month has no active row left."""
    base = new_folder(t.spark, "star")
    load_complaints(_two_names(bindings.complaints(t), "ticket"), base)
    load_outages(_two_names(bindings.outages(t), "outage_id"), base)
    raw = raw_billing(t).withColumnRenamed("yyyymm", "billing_month").withColumns({
        "IBCName": F.when(F.col("Premise Type").cast("bigint") % 2 == 1, F.concat("IBCName", F.lit(" II")))
        .otherwise(F.col("IBCName")),
        "billing_month": F.when(F.col("Premise Type").cast("bigint") % NO_MONTH != 0, F.col("billing_month")),
    })
    paths = load_months(raw, base, "all")
    corrected = raw.filter(F.col("billing_month") == str(EMPTIED)).withColumn("Status", F.lit("INA"))
    return paths | load_months(corrected, base, "corrected") | {"rejects": paths["rejects"]}


LOADED_SQL = f"""WITH billing AS (SELECT * FROM ({_two_names_sql("billing", "document")})
  WHERE status = 'F' AND document % {NO_MONTH} <> 0 AND year * 100 + month <> {EMPTIED}),
complaints AS ({_two_names_sql("complaints", "ticket")}),
outages AS ({_two_names_sql("outages", "outage_id")})
"""
# A centre name's code in a month, as that month's billing and complaints know it.
CODED_SQL = """SELECT outages.*, c.ibc_code FROM outages JOIN (
  SELECT ibc_name, year, month, min(ibc_code) AS ibc_code FROM (
    SELECT ibc_name, ibc_code, year, month FROM billing
    UNION ALL SELECT ibc_name, ibc_code, year, month FROM complaints) GROUP BY 1, 2, 3) c
  USING (ibc_name, year, month)"""


def _of_load(t: Tables, name: str) -> DataFrame:
    return tables.read_table(t.spark, _load_all(t)[name]).drop("region", tables.LOAD)


@query("monthly_load_billing", LOADED_SQL + """SELECT account, document, billing_month, year, month, ibc_code, ibc_name,
  current_amount, sanctioned_load FROM billing""")
def _(t):
    return _of_load(t, "billing").select(
        "account", F.col("premise_type").cast("bigint").alias("document"), "billing_month", "year", "month",
        "ibc_code", "ibc_name", "current_amount", "sanctioned_load")


@query("monthly_load_rejects", f"""SELECT o_orderkey AS document, CAST(NULL AS VARCHAR) AS billing_month
FROM orders WHERE o_orderkey % {NO_MONTH} = 0""")
def _(t):
    """Rows without a month, active or not, as they came."""
    rejects = tables.read_table(t.spark, _load_all(t)["rejects"])
    return rejects.select(F.col("`Premise Type`").cast("bigint").alias("document"), "billing_month")


@query("monthly_load_consumer", LOADED_SQL + f"""SELECT b.account, b.year, b.month, b.document, b.billing_month,
  b.ibc_name, b.current_amount, s.star_customer, s.complaints, s.avg_resolution_minutes
FROM billing b JOIN ({complaint_sql("account, year, month", "account", "min(star_customer) AS star_customer, ")}) s
ON b.account = s.account AND b.year = s.year AND b.month = s.month""")
def _(t):
    return _of_load(t, "consumer_dim").select(
        "account", "year", "month", F.col("premise_type").cast("bigint").alias("document"), "billing_month",
        "ibc_name", "current_amount", "star_customer", *dims.COMPLAINT_COLUMNS)


@query("monthly_load_centre", LOADED_SQL + centre_sql(
    "ibc_code", ["ibc_name"], complaint_sql("ibc_code, year, month", "ibc_name"), dims.COMPLAINT_COLUMNS))
def _(t):
    return _of_load(t, "ibc_crm_ageing_dim")


@query("monthly_load_all", LOADED_SQL + f", coded AS ({CODED_SQL})\n" + centre_sql("ibc_code", ["ibc_name"], f"""SELECT c.*, o.* EXCLUDE (ibc_code, year, month)
FROM ({complaint_sql("ibc_code, year, month", "ibc_name")}) c
JOIN ({outage_sql("ibc_code, year, month").replace("FROM outages", "FROM coded")}) o
ON c.ibc_code = o.ibc_code AND c.year = o.year AND c.month = o.month""",
    dims.COMPLAINT_COLUMNS + dims.OUTAGE_COLUMNS))
def _(t):
    """Complaints and outages of a code, whatever its names."""
    return _of_load(t, "ibc_all_dim")


@query("monthly_load_pmt", LOADED_SQL + centre_sql("pmt", ["ibc_code", "ibc_name"],
    complaint_sql("pmt, year, month", "ibc_name", "min(pmt_name) AS pmt_name, "),
    ["pmt_name", *dims.COMPLAINT_COLUMNS]))
def _(t):
    return _of_load(t, "pmt_crm_ageing_dim")


@query("monthly_load_oms", LOADED_SQL + centre_sql(
    "ibc_name", ["ibc_code"], outage_sql("ibc_name, year, month"), dims.OUTAGE_COLUMNS))
def _(t):
    return _of_load(t, "ibc_oms_ageing_dim")


@query("load_complaints", with_views(["complaints"], complaint_sql(
    "ibc_code, year, month", "ibc_name", "min(ibc_name) AS ibc_name, ")))
def _(t):
    """Complaints land twice; the second load replaces the first, summaries too."""
    base = new_folder(t.spark, "complaints")
    load_complaints(bindings.complaints(t).filter("ticket % 2 = 0"), base)
    paths = load_complaints(bindings.complaints(t), base)
    return tables.read_table(t.spark, paths["crm_ibc_dim"]).drop(tables.LOAD)


@query("load_outages", with_views(["outages"], outage_sql("ibc_name, year, month")))
def _(t):
    """The stored parts of outages, made into the summary of each centre and month."""
    paths = load_outages(bindings.outages(t), new_folder(t.spark, "outages"))
    parts = tables.read_table(t.spark, paths["oms_ibc_parts"])
    return summaries.outage_summary_of_parts(parts, ["ibc_name", "year", "month"])


def _daily(t: Tables, later: bool) -> str:
    """The base after outages and complaints landed in loads of overlapping months, in the order asked for."""
    base = new_folder(t.spark, "daily")
    crm = lambda: load_complaints(bindings.complaints(t), base)
    if not later:
        crm()
    load_outages(bindings.outages(t).filter("month < 8 AND outage_id % 2 = 0"), base)
    for some in ("month < 8", "month > 6"):
        load_outages(bindings.outages(t).filter(some), base)
    if later:
        crm()
    return base


def _daily_table(t: Tables, name: str, later: bool) -> DataFrame:
    return tables.read_table(t.spark, f"{_daily(t, later)}/{name}").drop(tables.LOAD, "year", "month")


@query("monthly_feeder_date", with_views(["outages"], outage_sql(
    "feeder_id, date", True, "min(feeder_name) AS feeder_name, ")))
def _(t):
    """Outages by feeder and date, kept up by three loads that overlap."""
    return _daily_table(t, "oms_feeder_date", False)


@query("monthly_date_ibc", with_views(["complaints", "outages"], f"""
SELECT date, ibc_name, o.* EXCLUDE (date, ibc_name), c.* EXCLUDE (date, ibc_name)
FROM ({outage_sql("ibc_name, date", True)}) o
FULL JOIN ({complaint_sql("date, ibc_name", "date")}) c USING (date, ibc_name)"""))
def _(t):
    """Complaints land first; each outage load refreshes the days of its months."""
    base = _daily(t, False)
    # Months of complaints alone are refreshed when complaints land after outages.
    load_complaints(bindings.complaints(t), base)
    return tables.read_table(t.spark, f"{base}/date_ibc_crm_oms").drop(tables.LOAD, "year", "month")


@query("monthly_date_feeder", with_views(["complaints", "outages"], f"""
SELECT date, feeder_id, o.* EXCLUDE (date, feeder_id), c.* EXCLUDE (date, feeder_id)
FROM ({outage_sql("feeder_id, date", True, "min(feeder_name) AS feeder_name, ")}) o
FULL JOIN ({complaint_sql("date, feeder_id", "feeder_id")}) c USING (date, feeder_id)"""))
def _(t):
    """Complaints land last and refresh the days of outages that are there."""
    return _daily_table(t, "date_feeder_crm_oms", True)


@query("monthly_feeder_total", with_views(["outages"], outage_sql("feeder_id, feeder_name", True)))
def _(t):
    """Outages per feeder over all months, added up from the stored parts."""
    return feeder_outages(t.spark, _daily(t, False))


@query("late_complaints", f"WITH billing AS ({ACTIVE}), complaints AS ({VIEWS['complaints']}), outages AS ({VIEWS['outages']}), coded AS ({CODED_SQL})\n" + centre_sql(
    "ibc_code", ["ibc_name"], f"""SELECT c.*, o.* EXCLUDE (ibc_code, year, month)
FROM ({complaint_sql("ibc_code, year, month", "ibc_name")}) c
JOIN ({outage_sql("ibc_code, year, month").replace("FROM outages", "FROM coded")}) o
ON c.ibc_code = o.ibc_code AND c.year = o.year AND c.month = o.month""",
    dims.COMPLAINT_COLUMNS + dims.OUTAGE_COLUMNS))
def _(t):
    """Billing lands before anything else, then some complaints of a year, outages, and all complaints."""
    base = new_folder(t.spark, "late")
    load_months(raw_billing(t).withColumnRenamed("yyyymm", "billing_month"), base)
    load_complaints(bindings.complaints(t).filter("year = 1998 AND ticket % 2 = 0"), base)
    load_outages(bindings.outages(t), base)
    load_complaints(bindings.complaints(t), base)
    return tables.read_table(t.spark, f"{base}/ibc_all_dim").drop("region", tables.LOAD)


@query("undone_loads", f"WITH billing AS ({ACTIVE}), complaints AS ({VIEWS['complaints']})\n" + centre_sql(
    "ibc_code", ["ibc_name"], complaint_sql("ibc_code, year, month", "ibc_name"), dims.COMPLAINT_COLUMNS))
def _(t):
    """Two wrong loads, of billing and of complaints, are undone in all their tables at once."""
    base = new_folder(t.spark, "undone")
    load_complaints(bindings.complaints(t), base, batch="good")
    rows = raw_billing(t).withColumnRenamed("yyyymm", "billing_month")
    load_months(rows, base, "good")
    load_months(rows.filter("billing_month LIKE '1998%' AND CurrentAmount LIKE '1%'"), base, "wrong")
    load_complaints(bindings.complaints(t).filter("year > 1996 AND ticket % 3 = 0"), base, batch="wrong")
    undo_loads(t.spark, base, "billing-good")
    return tables.read_table(t.spark, f"{base}/ibc_crm_ageing_dim").drop("region", tables.LOAD)


@query("load_journal", f"""SELECT 'complaints' AS kind, year * 100 + month AS month, 'published' AS state
FROM (SELECT DISTINCT year, month FROM ({VIEWS['complaints']}))
UNION ALL SELECT 'outages', year * 100 + month, 'undone' FROM (SELECT DISTINCT year, month FROM ({VIEWS['outages']}))""")
def _(t):
    """The months of the fact that each load replaced, and whether it still holds."""
    base = new_folder(t.spark, "journal")
    load_complaints(bindings.complaints(t), base, batch="one")
    load_outages(bindings.outages(t), base, batch="two")
    undo_loads(t.spark, base, "complaints-one")
    return journal.history(t.spark, base).where(F.col("load").startswith(F.col("table"))).select(
        F.col("table").alias("kind"), "month", "state")


# --- arrivals ---------------------------------------------------------------------------------

EVENT_SQL = "SELECT event_id, user_id, event_type, value FROM events"
EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def _spread(rows: DataFrame, least: int, table: DataFrame) -> DataFrame:
    """At least ``least`` partitions, and as many as the table has beyond that."""
    return rows.repartition(max(least, _scan_tasks(table)))


def _landing(t: Tables, files: int = 4) -> str:
    """A landing folder holding events as billing files, and files of another kind."""
    landing = f"{new_folder(t.spark, 'landing')}/in"
    rows = _text(t.events.select(*EVENT_COLUMNS))
    extracts.publish_extract(_spread(rows, files, t.events), landing, "Ageing_202401")
    extracts.publish_extract(rows.filter("event_type = 'error'"), landing, "Other_202401")
    return landing


def _typed_events(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "event_id": F.col("event_id").try_cast("bigint"), "user_id": F.col("user_id").try_cast("bigint"),
        "value": F.col("value").try_cast("double"),
    })


def _drain(t: Tables, landing: str, one_at_a_time: bool = True, target: str | None = None) -> str:
    target = target or f"{landing}-table"
    files = arrivals.arriving_files(
        t.spark, landing, EVENT_COLUMNS, one_file_at_a_time=one_at_a_time
    )
    arrivals.finish(
        arrivals.load_arrivals(files, target, f"{landing}-checkpoint", _typed_events)
    )
    return target


def _events_of(t: Tables, path: str) -> DataFrame:
    return tables.read_table(t.spark, path).select(*EVENT_COLUMNS)


@query("stream_file_source", EVENT_SQL)
def _(t):
    return _events_of(t, _drain(t, _landing(t), one_at_a_time=False))


@query("one_file_per_batch", EVENT_SQL)
def _(t):
    return _events_of(t, _drain(t, _landing(t, 2)))


@query("exactly_once_files", EVENT_SQL)
def _(t):
    """A second run finds nothing new, and a third only the file that came in between."""
    landing = f"{new_folder(t.spark, 'landing')}/in"
    rows = _text(t.events.select(*EVENT_COLUMNS))
    extracts.publish_extract(rows.filter("event_type <> 'view'"), landing, "Ageing_202401")
    target = _drain(t, landing)
    _drain(t, landing, target=target)
    extracts.publish_extract(rows.filter("event_type = 'view'"), landing, "Ageing_202402")
    return _events_of(t, _drain(t, landing, target=target))


@query("drain_and_stop", "SELECT count(*) AS rows, TRUE AS ended FROM events")
def _(t):
    landing = _landing(t, 2)
    files = arrivals.arriving_files(t.spark, landing, EVENT_COLUMNS, one_file_at_a_time=False)
    running = arrivals.load_arrivals(files, f"{landing}-table", f"{landing}-checkpoint")
    arrivals.finish(running)
    loaded = tables.read_table(t.spark, f"{landing}-table")
    return loaded.agg(F.count(F.lit(1)).alias("rows")).withColumn("ended", F.lit(not running.isActive))


@query("stable_file_rule", EVENT_SQL)
def _(t):
    """A file half written beside the landing folder is not seen; renaming it in makes it whole."""
    landing = _landing(t, 2)
    rows = _text(t.events.select(*EVENT_COLUMNS))
    rows.write.option("header", True).option("sep", "|").csv(f"{landing}-staging/Ageing_209901")
    return _events_of(t, _drain(t, landing, one_at_a_time=False))


@query("completion_marker", "SELECT TRUE AS finished_in_time, count(*) AS rows FROM events")
def _(t):
    landing = _landing(t, 2)
    files = arrivals.arriving_files(t.spark, landing, EVENT_COLUMNS, one_file_at_a_time=False)
    running = arrivals.load_arrivals(files, f"{landing}-table", f"{landing}-checkpoint")
    finished = arrivals.wait_until_done(running, 600)
    loaded = tables.read_table(t.spark, f"{landing}-table")
    return loaded.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(finished).alias("finished_in_time"), "rows")


@query("file_arrival_ingest", with_views(["billing"], f"""
SELECT billing_month, {sql_total('current_amount')} AS current_amount, count(*) AS bills
FROM billing WHERE status = 'F' GROUP BY 1"""))
def _(t):
    """Billing files arrive, each is cleaned as it lands, and the fact is summed."""
    rows = raw_billing(t)
    landing = f"{new_folder(t.spark, 'landing')}/in"
    dated = rows.withColumnRenamed("yyyymm", "Batch Month")
    extracts.publish_extract(_spread(dated, 2, t.orders), landing, "Ageing_all")
    columns = dated.columns

    def load(batch: DataFrame) -> DataFrame:
        return clean_billing(batch.withColumn("billing_month", F.col("`Batch Month`")).drop("Batch Month"))

    files = arrivals.arriving_files(t.spark, landing, columns)  # all that have arrived, in one batch
    arrivals.finish(arrivals.load_arrivals(files, f"{landing}-table", f"{landing}-checkpoint", load))
    cents = F.rint(F.col("current_amount") * 100).cast("bigint")
    return (
        tables.read_table(t.spark, f"{landing}-table")
        .groupBy("billing_month")
        .agg((F.sum(cents).cast("double") / 100).alias("current_amount"), F.count(F.lit(1)).alias("bills"))
    )


def _whole(column: str):
    return F.col(column).cast("bigint").cast("string")


def _landed_kinds(t: Tables) -> str:
    """A landing folder with outages first, then two months of billing, then complaints, as their extracts are; each
    arrives as a folder of the files that its tasks wrote."""
    landing = f"{new_folder(t.spark, 'landing')}/in"
    known = bindings.outages(t)
    extracts.publish_folder(known.select(
        _whole("outage_id").alias("outage_Id"), F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("Createdon"),
        F.col("ibc_name").alias("IBC"), F.col("feeder_id").cast("string").alias("fdr_Id"),
        F.col("feeder_name").alias("fdr_name"), F.coalesce("reason", F.lit("Undefined")).alias("initialoffreason"),
        _whole("turnaround_minutes").alias("TAT"), F.coalesce(_whole("punching_delay"), F.lit("-")).alias("PunchingDelay"),
        F.format_string("0:0:%d", F.col("turnaround_minutes").cast("bigint")).alias("duration"),
        F.when(F.col("rain") == 1, "YES").otherwise("NO").alias("israintripping"), F.lit("1").alias("isemergency"),
    ), landing, "OMS_all", ",")
    bills = raw_billing(t)
    for month in ("199901", "199902"):
        extracts.publish_folder(bills.filter(F.col("yyyymm") == month).drop("yyyymm"), landing, f"Ageing_{month}", "|")
    crm = bindings.complaints(t)
    extracts.publish_folder(crm.select(
        F.col("account").alias("AccountContract"), F.lit("ACT").alias("ConsumerStatus"), F.col("ibc_name").alias("IBCName"),
        F.col("ibc_code").alias("IBCCode"), F.date_format("date", "dd-MMM-yy").alias("CREATED_DATE"),
        F.col("year").cast("string").alias("Year"), F.date_format("date", "MMM").alias("Month"),
        F.col("pmt").cast("string").alias("PMT"), F.col("pmt_name").alias("PMT Name"),
        F.col("feeder_id").cast("string").alias("Feeder ID"), F.col("feeder_name").alias("Feeder Name"),
        F.col("star_customer").alias("StarCustomer"), (F.col("resolution_minutes") / 60).cast("string").alias("GroundTAT"),
    ), landing, "CRM_all", "|")
    return landing


@query("arrivals_to_star", f"""WITH billing AS ({ACTIVE} AND year(o_orderdate) = 1999 AND month(o_orderdate) < 3),
complaints AS ({VIEWS['complaints']}),
outages AS (SELECT * REPLACE (CAST(turnaround_minutes AS DOUBLE) / 60 AS duration_minutes) FROM ({VIEWS['outages']})),
coded AS ({CODED_SQL})
""" + centre_sql("ibc_code", ["ibc_name"], f"""SELECT c.*, o.* EXCLUDE (ibc_code, year, month)
FROM ({complaint_sql("ibc_code, year, month", "ibc_name")}) c
JOIN ({outage_sql("ibc_code, year, month").replace("FROM outages", "FROM coded")}) o
ON c.ibc_code = o.ibc_code AND c.year = o.year AND c.month = o.month""",
    dims.COMPLAINT_COLUMNS + dims.OUTAGE_COLUMNS))
def _(t):
    """Files of three kinds arrive out of order and each runs the monthly load; a lost checkpoint repeats
    them all without effect."""
    landing = _landed_kinds(t)
    base = new_folder(t.spark, "star")
    for checkpoint in ("first", "again"):
        paths = arrivals.arriving_paths(t.spark, landing)
        arrivals.finish(arrivals.run_arrivals(paths, base, f"{landing}-{checkpoint}"))
    return tables.read_table(t.spark, f"{base}/ibc_all_dim").drop("region", tables.LOAD)
