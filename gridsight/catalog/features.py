"""Feeder panels, sequences, lags, scaling and encoding on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsight.catalog.bindings import Tables, outages, with_views
from gridsight.catalog.registry import query
from gridsight.functions.measures import Measure
from gridsight.operators import panel, learning
from gridsight.operators.joins import stored
from gridsight.session import new_folder

MEASURES = [Measure("n", "count", "id"), Measure("amount", "sum", "amount", 0)]


def daily_rows(t: Tables) -> DataFrame:
    """Outages of each line by day; an ``error`` is a fault."""
    return t.events.select(
        F.col("user_id").alias("feeder"), F.col("ts").alias("at"), F.col("event_id").alias("id"),
        F.floor("value").alias("amount"), (F.col("event_type") == "error").alias("fault_row"),
    )


def service_rows(t: Tables) -> DataFrame:
    """A longer series: order lines of each supplier; large finished returns are faults."""
    fault = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_quantity") > 40)
    return t.lineitem.select(
        F.col("l_suppkey").alias("feeder"), F.col("l_shipdate").alias("at"),
        F.col("l_orderkey").alias("id"), F.floor("l_quantity").alias("amount"),
        fault.alias("fault_row"),
    )


def panel_of(rows: DataFrame, unit: str) -> DataFrame:
    return panel.feeder_panel(rows, "feeder", "at", unit, MEASURES, F.col("fault_row"))


ROWS_SQL = {
    "daily": """SELECT user_id AS feeder, ts AS occurred, CAST(floor(value) AS BIGINT) AS amount,
  event_type = 'error' AS fault_row FROM events""",
    "service": """SELECT l_suppkey AS feeder, l_shipdate AS occurred, CAST(floor(l_quantity) AS BIGINT) AS amount,
  l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity > 40 AS fault_row FROM lineitem""",
}
STEPS = {"day": "1 DAY", "week": "7 DAY", "month": "1 MONTH"}


def panel_sql(rows: str, unit: str) -> str:
    return f"""seen AS (SELECT feeder, CAST(date_trunc('{unit}', occurred) AS DATE) AS period, count(*) AS n,
  CAST(sum(amount) AS DOUBLE) AS amount, count(*) FILTER (WHERE fault_row) AS faults
  FROM ({ROWS_SQL[rows]}) GROUP BY 1, 2),
spine AS (SELECT feeder, CAST(unnest(generate_series(CAST((SELECT min(period) FROM seen) AS TIMESTAMP),
  CAST((SELECT max(period) FROM seen) AS TIMESTAMP), INTERVAL {STEPS[unit]})) AS DATE) AS period
  FROM (SELECT DISTINCT feeder FROM seen)),
panel AS (SELECT feeder, period, coalesce(n, 0) AS n, coalesce(amount, 0) AS amount,
  CASE WHEN coalesce(faults, 0) > 0 THEN 1 ELSE 0 END AS fault
  FROM spine LEFT JOIN seen USING (feeder, period)),
labelled AS (SELECT *, target AS t FROM (
  SELECT *, lead(fault) OVER (PARTITION BY feeder ORDER BY period) AS target FROM panel)
  WHERE target IS NOT NULL)"""


def _panel_query(name: str, rows, key: str, unit: str):
    @query(name, f"WITH {panel_sql(key, unit)} SELECT * FROM panel")
    def _(t):
        return panel_of(rows(t), unit)


_panel_query("feeder_period_panel", daily_rows, "daily", "day")
_panel_query("feeder_month_panel", service_rows, "service", "month")
_panel_query("feeder_week_panel", service_rows, "service", "week")


@query("calendar_features", f"""WITH {panel_sql('service', 'month')}
SELECT *, CAST(year(period) AS INTEGER) AS year, CAST(month(period) AS INTEGER) AS month_number FROM panel""")
def _(t):
    return panel.calendar_features(panel_of(service_rows(t), "month"))


def labelled(t: Tables, unit: str) -> DataFrame:
    rows = daily_rows(t) if unit == "day" else service_rows(t)
    return panel.next_period_target(panel_of(rows, unit), "feeder", "period", "fault")


@query("next_period_target", f"""WITH {panel_sql('daily', 'day')}
SELECT feeder, period, n, amount, fault, target FROM labelled""")
def _(t):
    return labelled(t, "day")


def steps_text(column: str, length: int):
    """A sequence of (n, amount) as ``n:amount,n:amount,...``, to compare it with SQL. The steps are named one
    by one, since a lambda is interpreted, and takes a copy of each row that Spark had not to make so far."""
    part = lambda at, of: F.col(column)[at][of].cast("bigint").cast("string")
    return F.concat_ws(",", *[F.concat_ws(":", part(at, 0), part(at, 1)) for at in range(length)])


def sequence_sql(length: int) -> str:
    step = "CAST(CAST(n AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(amount AS BIGINT) AS VARCHAR)"
    return f"""list({step}) OVER (PARTITION BY feeder ORDER BY period
  ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW)"""


def _sequence_query(name: str, key: str, unit: str, length: int):
    @query(name, f"""WITH {panel_sql(key, unit)}
SELECT feeder, last_period, array_to_string(s, ',') AS steps, label FROM (
  SELECT feeder, period AS last_period, {sequence_sql(length)} AS s,
    lead(target) OVER (PARTITION BY feeder ORDER BY period) AS label FROM labelled)
WHERE len(s) = {length} AND label IS NOT NULL""")
    def _(t):
        rows = panel.sliding_sequences(
            labelled(t, unit), "feeder", "period", ["n", "amount"], "target", length
        )
        return rows.select("feeder", "last_period", steps_text("sequence", length).alias("steps"), "label")


_sequence_query("sliding_sequences", "service", "month", 12)
_sequence_query("sliding_sequences_weekly", "service", "week", 10)


@query("dual_sequences", f"""WITH {panel_sql('service', 'week')}
SELECT feeder, last_period, array_to_string(a, ',') AS short_steps, array_to_string(b, ',') AS long_steps,
  label FROM (SELECT feeder, period AS last_period, {sequence_sql(5)} AS a, {sequence_sql(45)} AS b,
    lead(target) OVER (PARTITION BY feeder ORDER BY period) AS label FROM labelled)
WHERE len(b) = 45 AND label IS NOT NULL""")
def _(t):
    rows = panel.dual_sequences(
        labelled(t, "week"), "feeder", "period", ["n", "amount"], "target", 5, 45
    )
    return rows.select(
        "feeder", "last_period", steps_text("short_sequence", 5).alias("short_steps"),
        steps_text("long_sequence", 45).alias("long_steps"), "label",
    )


TARGETS = ["2001-01-01", "2001-01-08", "2001-01-15", "2001-01-22"]


@query("latest_sequence", f"""WITH {panel_sql('service', 'week')},
targets AS (SELECT CAST(unnest({TARGETS}) AS DATE) AS target_period),
history AS (SELECT feeder, target_period, period AS last_period, s, row_number() OVER (
    PARTITION BY feeder, target_period ORDER BY period DESC) AS back
  FROM (SELECT *, {sequence_sql(12)} AS s FROM panel) JOIN targets ON period < target_period)
SELECT feeder, target_period, last_period, array_to_string(s, ',') AS steps
FROM history WHERE back = 1 AND len(s) = 12""")
def _(t):
    rows = panel.latest_sequences(
        panel_of(service_rows(t), "week"), "feeder", "period", ["n", "amount"], TARGETS, 12
    )
    return rows.select("feeder", "target_period", "last_period", steps_text("sequence", 12).alias("steps"))


@query("lag_features", "SELECT event_id, user_id, " + ", ".join(
    f"lag(value, {k}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_lag_{k}"
    for k in range(1, 8)) + " FROM events")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return panel.lag_features(rows, "user_id", ["ts", "event_id"], "value").drop("ts", "value")


@query("has_future_event", """SELECT event_id, user_id, CASE WHEN lead(event_id, 7) OVER (
  PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 0 ELSE 1 END AS has_future FROM events""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts")
    return panel.has_future_rows(rows, "user_id", ["ts", "event_id"]).drop("ts")


@query("has_future_event_days", """SELECT event_id, user_id, CASE WHEN min(ts) OVER (
  PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING
  AND INTERVAL 7 DAY FOLLOWING) IS NULL THEN 0 ELSE 1 END AS has_future FROM events""")
def _(t):
    rows = t.events.select("event_id", "user_id", "ts")
    return panel.has_future_days(rows, "user_id", "ts").drop("ts")


@query("minmax_scale", """WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT o_orderkey, (o_totalprice - (SELECT lo FROM r)) / ((SELECT hi FROM r) - (SELECT lo FROM r)) AS o_totalprice,
  CAST(0 AS DOUBLE) AS constant FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.lit(3.0).alias("constant"))
    return learning.MinMaxScale.fit(rows, ["o_totalprice", "constant"]).transform(rows)


@query("encode_categories", with_views(["outages"], """SELECT outage_id,
  dense_rank() OVER (ORDER BY coalesce(reason, 'nan')) - 1 AS reason,
  dense_rank() OVER (ORDER BY feeder_name) - 1 AS feeder_name FROM outages"""))
def _(t):
    rows = outages(t).select("outage_id", "reason", "feeder_name")
    return learning.encode_categories(rows, ["reason", "feeder_name"])


@query("index_key", """SELECT o_orderkey, o_custkey, account_index FROM orders JOIN (
  SELECT o_custkey, row_number() OVER (ORDER BY n DESC, CAST(o_custkey AS VARCHAR)) - 1 AS account_index
  FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)) USING (o_custkey)""")
def _(t):
    return learning.index_key(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", "account_index")


FIRST_YEARS = 1996


def _fitted_sql(order: str) -> str:
    """Codes of the accounts of the first years, then of the accounts that later years add."""
    return f"""WITH seen AS (SELECT CAST(o_custkey AS VARCHAR) AS label,
  count(*) FILTER (WHERE year(o_orderdate) < {FIRST_YEARS}) AS early, count(*) AS n FROM orders GROUP BY 1),
known AS (SELECT label, row_number() OVER (ORDER BY {order.replace('n ', 'early ')}) - 1 AS code FROM seen WHERE early > 0),
added AS (SELECT label, (SELECT count(*) FROM known) + row_number() OVER (ORDER BY {order}) - 1 AS code
  FROM seen WHERE early = 0)
SELECT o_orderkey, coalesce(known.code, -1) AS before, coalesce(known.code, added.code) AS account
FROM orders LEFT JOIN known ON known.label = CAST(o_custkey AS VARCHAR)
LEFT JOIN added ON added.label = CAST(o_custkey AS VARCHAR)"""


def _fitted(t: Tables, by_count: bool) -> DataFrame:
    """All orders, coded by the table fitted on the first years and by the same table once extended."""
    rows = t.orders.select("o_orderkey", "o_orderdate", F.col("o_custkey").alias("account"))
    path = new_folder(t.spark, "codes")
    learning.extend_codes(rows.filter(F.year("o_orderdate") < FIRST_YEARS), ["account"], path, by_count)
    before = learning.apply_codes(rows, ["account"], path).select("o_orderkey", F.col("account").alias("before"))
    before = stored(before, "coded")
    learning.extend_codes(rows, ["account"], path, by_count)
    return learning.apply_codes(rows, ["account"], path).drop("o_orderdate").join(before, "o_orderkey")


@query("encode_fitted", _fitted_sql("label"))
def _(t):
    return _fitted(t, by_count=False)


@query("index_fitted", _fitted_sql("n DESC, label"))
def _(t):
    return _fitted(t, by_count=True)


@query("ordered_split", f"""WITH {panel_sql('service', 'month')},
counts AS (SELECT period, count(*) AS c FROM panel GROUP BY 1),
cut AS (SELECT min(period) AS cutoff FROM (SELECT period, sum(c) OVER (ORDER BY period) AS upto,
  sum(c) OVER () AS total FROM counts) WHERE upto > total * CAST(0.8 AS DOUBLE))
SELECT feeder, period, CASE WHEN period < (SELECT cutoff FROM cut) THEN 'train' ELSE 'test' END AS split
FROM panel""")
def _(t):
    rows = panel_of(service_rows(t), "month").select("feeder", "period")
    return panel.time_split(rows, "period")
