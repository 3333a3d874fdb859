"""The supplied tables seen as the utility's sources.

``orders`` are billing rows, ``customer`` the consumers, ``nation`` the billing centres (IBC) and
``region`` theirs; ``lineitem`` are complaints and payments, ``supplier`` the transformers (PMT);
``events`` are outages of feeder ``user_id``. Outages lie 25 years after the other tables, so
their time is moved back by that to make the sources overlap in January 1999. Each binding has a
DuckDB twin in ``VIEWS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


class Tables:
    """``t.orders`` reads ``<folder>/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        found = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, found)  # a query that names a table twice lists its files once
        return found


VIEWS = {}

VIEWS["billing"] = """
SELECT o_orderkey AS document, CAST(o_custkey AS VARCHAR) AS account, o_orderstatus AS status,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS billing_month,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(o_orderdate AS DATE) AS issue_date,
  CAST(c_nationkey AS VARCHAR) AS ibc_code, n_name AS ibc_name, r_name AS region,
  c_mktsegment AS consumer_type, c_name AS consumer_name, o_custkey % 100 AS pmt,
  o_totalprice AS current_amount, CAST(floor(o_totalprice / 100) AS BIGINT) AS current_units,
  c_acctbal AS sanctioned_load, CAST(floor(o_totalprice / 1000) AS BIGINT) AS connected_load,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN c_acctbal END AS irb_revised_amount,
  o_totalprice AS irb_detection_amount,
  o_orderkey % 7 AS irb_revised_units, o_custkey % 5 AS irb_detection_units,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN c_acctbal END + o_totalprice AS irb_amount,
  o_orderkey % 7 + o_custkey % 5 AS irb_units
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def billing(t: Tables) -> DataFrame:
    centres = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    consumers = t.customer.join(centres, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = t.orders.join(consumers, F.col("o_custkey") == F.col("c_custkey"))
    revised = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("c_acctbal"))
    return rows.select(
        F.col("o_orderkey").alias("document"),
        F.col("o_custkey").cast("string").alias("account"),
        F.col("o_orderstatus").alias("status"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("billing_month"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("o_orderdate").cast("date").alias("issue_date"),
        F.col("c_nationkey").cast("string").alias("ibc_code"),
        F.col("n_name").alias("ibc_name"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("consumer_type"),
        F.col("c_name").alias("consumer_name"),
        (F.col("o_custkey") % 100).alias("pmt"),
        F.col("o_totalprice").alias("current_amount"),
        F.floor(F.col("o_totalprice") / 100).alias("current_units"),
        F.col("c_acctbal").alias("sanctioned_load"),
        F.floor(F.col("o_totalprice") / 1000).alias("connected_load"),
        revised.alias("irb_revised_amount"),
        F.col("o_totalprice").alias("irb_detection_amount"),
        (F.col("o_orderkey") % 7).alias("irb_revised_units"),
        (F.col("o_custkey") % 5).alias("irb_detection_units"),
        (revised + F.col("o_totalprice")).alias("irb_amount"),
        (F.col("o_orderkey") % 7 + F.col("o_custkey") % 5).alias("irb_units"),
    )


VIEWS["complaints"] = """
SELECT o_orderkey * 10 + l_linenumber AS ticket, CAST(o_custkey AS VARCHAR) AS account,
  CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(c_nationkey AS VARCHAR) AS ibc_code, n_name AS ibc_name,
  l_suppkey AS pmt, s_name AS pmt_name, s_nationkey AS feeder_id,
  'FDR-' || s_nationkey AS feeder_name, c_mktsegment AS star_customer,
  CAST(date_diff('day', o_orderdate, l_shipdate) * 86400 + l_linenumber * 7 AS DOUBLE) / 60 AS resolution_minutes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON l_suppkey = s_suppkey"""


def complaints(t: Tables) -> DataFrame:
    consumers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    # Orders meet their consumers first, so that the lines, the largest table, are shuffled once and not again.
    billed = t.orders.join(consumers, F.col("o_custkey") == F.col("c_custkey"))
    rows = t.lineitem.join(billed, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(
        (F.col("o_orderkey") * 10 + F.col("l_linenumber")).alias("ticket"),
        F.col("o_custkey").cast("string").alias("account"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("c_nationkey").cast("string").alias("ibc_code"),
        F.col("n_name").alias("ibc_name"),
        F.col("l_suppkey").alias("pmt"),
        F.col("s_name").alias("pmt_name"),
        F.col("s_nationkey").alias("feeder_id"),
        F.concat(F.lit("FDR-"), F.col("s_nationkey")).alias("feeder_name"),
        F.col("c_mktsegment").alias("star_customer"),
        ((F.datediff("l_shipdate", "o_orderdate") * 86400 + F.col("l_linenumber") * 7).cast("double") / 60)
        .alias("resolution_minutes"),
    )


VIEWS["outages"] = """
SELECT event_id AS outage_id, ts - INTERVAL 25 YEAR AS created_at,
  CAST(ts - INTERVAL 25 YEAR AS DATE) AS date,
  CAST(year(ts) - 25 AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(user_id % 25 AS INTEGER) AS feeder_id, 'FDR-' || (user_id % 25) AS feeder_name,
  user_id AS line_id, n_name AS ibc_name,
  CASE WHEN event_type <> 'view' THEN event_type END AS reason,
  floor(value) AS turnaround_minutes, value AS duration_minutes,
  CASE WHEN event_type <> 'click' THEN floor(value / 2) END AS punching_delay,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS rain
FROM events JOIN nation ON user_id % 25 = n_nationkey"""


def outages(t: Tables) -> DataFrame:
    rows = t.events.withColumn("centre", (F.col("user_id") % 25).cast("int"))
    at = F.col("ts") - F.make_ym_interval(F.lit(25))
    return rows.join(t.nation, F.col("centre") == F.col("n_nationkey")).select(
        F.col("event_id").alias("outage_id"),
        at.alias("created_at"),
        at.cast("date").alias("date"),
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        F.col("centre").alias("feeder_id"),
        F.concat(F.lit("FDR-"), F.col("centre")).alias("feeder_name"),
        F.col("user_id").alias("line_id"),
        F.col("n_name").alias("ibc_name"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("reason"),
        F.floor("value").cast("double").alias("turnaround_minutes"),
        F.col("value").alias("duration_minutes"),
        F.when(F.col("event_type") != "click", F.floor(F.col("value") / 2).cast("double")).alias(
            "punching_delay"
        ),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("rain"),
    )


VIEWS["weekly_scores"] = """
SELECT user_id AS feeder, CAST(date_trunc('week', ts) AS DATE) AS week,
  CAST(count(*) FILTER (WHERE event_type = 'error') + 1 AS DOUBLE)
    / CAST(count(*) + 2 AS DOUBLE) AS probability,
  CAST(sum(CASE WHEN event_type = 'error' THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END) > 3000
    AS INTEGER) AS fault
FROM events GROUP BY 1, 2"""


def weekly_scores(t: Tables) -> DataFrame:
    """A stand-in score (share of errors) and label (long error time) per feeder and week."""
    error = F.col("event_type") == "error"
    cents = F.when(error, F.rint(F.col("value") * 100).cast("bigint")).otherwise(0)
    return (
        t.events.groupBy(
            F.col("user_id").alias("feeder"), F.date_trunc("week", "ts").cast("date").alias("week")
        )
        .agg(F.count_if(error).alias("errors"), F.count(F.lit(1)).alias("n"), F.sum(cents).alias("cents"))
        .select(
            "feeder",
            "week",
            ((F.col("errors") + 1).cast("double") / (F.col("n") + 2).cast("double")).alias("probability"),
            (F.col("cents") > 3000).cast("int").alias("fault"),
        )
    )


def with_views(names: list[str], body: str) -> str:
    """``body`` with the named views in front as common table expressions."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names) + "\n" + body


def sql_total(column: str, digits: int = 2) -> str:
    unit = f"CAST(round({column} * {10**digits}) AS BIGINT)"
    return f"(CAST(sum({unit}) AS DOUBLE) / {float(10**digits)})"


def sql_mean(column: str) -> str:
    """A plain mean, rounded once."""
    return f"round(avg({column}), 6)"


def sql_average(column: str, digits: int = 2) -> str:
    return f"({sql_total(column, digits)} / count({column}))"
