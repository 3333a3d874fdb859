"""Cleaning steps and scalar functions on text made from the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridsight.catalog.bindings import billing, outages, with_views
from gridsight.catalog.registry import query
from gridsight.functions import parsing
from gridsight.operators import cleaning


@query("drop_columns", "SELECT event_id, ts, user_id, event_type, value FROM events")
def _(t):
    return cleaning.drop_columns(t.events, ["props", "not_in_the_table"])


@query("filter_active", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'F'""")
def _(t):
    return cleaning.keep_active(t.orders, "o_orderstatus", "F")


@query("null_placeholders", """SELECT o_orderkey,
  CASE WHEN o_orderkey % 5 < 4 THEN NULL ELSE nullif(o_orderpriority, '4-NOT SPECIFIED') END AS priority,
  o_orderstatus FROM orders""")
def _(t):
    marks = F.array(*[F.lit(p) for p in parsing.PLACEHOLDERS])
    place = (F.col("o_orderkey") % 5).cast("int")
    dirty = F.coalesce(F.get(marks, place), F.col("o_orderpriority")).alias("priority")
    rows = t.orders.select("o_orderkey", dirty, "o_orderstatus")
    return cleaning.null_placeholders(rows, [*parsing.PLACEHOLDERS, "4-NOT SPECIFIED"])


@query("numeric_or_null_filter", """SELECT event_id,
  CASE WHEN event_type <> 'view' THEN floor(value) END AS delay
FROM events WHERE event_type NOT IN ('error', 'click')""")
def _(t):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", "LL")
        .when(kind == "click", F.concat(F.floor("value").cast("string"), F.lit(".5")))
        .when(kind != "view", F.floor("value").cast("string"))
    )
    return cleaning.keep_digits_or_null(t.events.select("event_id", text.alias("delay")), "delay")


@query("parse_month_abbr_ts", """SELECT event_id,
  try_strptime(CASE WHEN event_type <> 'error' THEN strftime(ts, '%-d-%b-%y') END, '%d-%b-%y') AS day,
  try_strptime(CASE WHEN event_type <> 'error' THEN strftime(ts, '%d-%b-%y %H:%M:%S') END,
    '%d-%b-%y %H:%M:%S') AS moment FROM events""")
def _(t):
    bad = F.col("event_type") == "error"
    day = F.when(bad, "LL").otherwise(F.date_format("ts", "d-MMM-yy"))
    moment = F.when(bad, "31-Foo-24 1").otherwise(F.date_format("ts", "dd-MMM-yy HH:mm:ss"))
    return t.events.select(
        "event_id",
        parsing.month_abbr_date(day).alias("day"),
        parsing.month_abbr_timestamp(moment).alias("moment"),
    )


@query("parse_dmy_ts", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN
  CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) END AS due FROM orders""")
def _(t):
    kind = F.col("o_orderkey") % 3
    text = (
        F.when(kind == 0, F.date_format("o_orderdate", "d/M/yyyy"))
        .when(kind == 1, F.date_format("o_orderdate", "dd/MM/yy"))
        .otherwise("31/31/2020")
    )
    return t.orders.select("o_orderkey", parsing.day_month_year(text).alias("due"))


@query("parse_multi_format_ts", """SELECT event_id, CASE event_id % 3
  WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN date_trunc('second', ts) END AS created_at FROM events""")
def _(t):
    kind = F.col("event_id") % 3
    text = (
        F.when(kind == 0, F.date_format("ts", "M/d/yyyy H:mm"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy/MM/dd"))
    )
    return t.events.select("event_id", parsing.outage_timestamp(text).alias("created_at"))


@query("month_token_replace", """SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS paid_at FROM orders""")
def _(t):
    text = F.date_format("o_orderdate", "dd-MMM-yy")
    return t.orders.select("o_orderkey", parsing.month_abbr_date(text).alias("paid_at"))


@query("hhmmss_to_minutes", """SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN
  CAST(cents // 3600 AS DOUBLE) * 60 + cents // 60 % 60 + (cents % 60) / CAST(60 AS DOUBLE) END AS minutes
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)""")
def _(t):
    cents = F.rint(F.col("value") * 100).cast("bigint")
    clock = F.format_string(
        "%d:%02d:%02d", F.floor(cents / 3600), F.floor(cents / 60) % 60, cents % 60
    )
    text = (
        F.when(F.col("event_type") == "error", "abc").when(F.col("event_type") == "view", "1:02").otherwise(clock)
    )
    return t.events.select("event_id", parsing.clock_minutes(text).alias("minutes"))


@query("hours_to_minutes", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'R' THEN l_quantity * 60 END AS minutes FROM lineitem""")
def _(t):
    text = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_quantity").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", parsing.hours_as_minutes(text).alias("minutes"))


@query("month_abbr_to_number", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN
  CAST(month(o_orderdate) AS INTEGER) END AS month FROM orders""")
def _(t):
    name = F.date_format("o_orderdate", "MMM")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.lower(name)).otherwise(name)
    return t.orders.select("o_orderkey", parsing.month_number(text).alias("month"))


@query("strip_commas_to_double", """SELECT o_orderkey,
  CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS amount FROM orders""")
def _(t):
    text = F.when(F.col("o_orderkey") % 6 == 0, "n,a").otherwise(F.format_number("o_totalprice", 2))
    return t.orders.select("o_orderkey", parsing.number_with_commas(text).alias("amount"))


@query("cast_columns", """SELECT CAST(o_custkey AS VARCHAR) AS account, o_orderkey AS document,
  o_totalprice AS amount, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 100 END AS pmt FROM orders""")
def _(t):
    pmt = (F.col("o_custkey") % 100).cast("string")
    rows = t.orders.select(
        F.col("o_custkey").alias("account"),
        F.col("o_orderkey").alias("document"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.when(F.col("o_orderkey") % 2 == 0, pmt).otherwise(F.concat(F.lit("P"), pmt)).alias("pmt"),
    )
    return cleaning.cast_columns(rows, {"account": "string", "amount": "double", "pmt": "bigint"})


@query("irb_totals", with_views(["billing"], "SELECT document, irb_amount, irb_units FROM billing"))
def _(t):
    rows = billing(t).drop("irb_amount", "irb_units")
    return cleaning.add_sums(
        rows,
        {
            "irb_amount": ("irb_revised_amount", "irb_detection_amount"),
            "irb_units": ("irb_revised_units", "irb_detection_units"),
        },
    ).select("document", "irb_amount", "irb_units")


@query("billing_calendar", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CASE WHEN o_orderkey % 11 = 0 THEN 13 ELSE CAST(month(o_orderdate) AS INTEGER) END AS month,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS billing_month
FROM orders""")
def _(t):
    month = F.when(F.col("o_orderkey") % 11 == 0, "13").otherwise(F.date_format("o_orderdate", "MM"))
    text = F.concat(F.date_format("o_orderdate", "yyyy"), month)
    return cleaning.billing_calendar(t.orders.select("o_orderkey", text.alias("billing_month")))


@query("payment_calendar", """SELECT event_id, CAST(ts AS DATE) AS payment_date,
  CAST(year(ts) AS INTEGER) AS payment_year, CAST(month(ts) AS INTEGER) AS payment_month FROM events""")
def _(t):
    return cleaning.payment_calendar(t.events.select("event_id", "ts"), "ts").drop("ts")


@query("harmonise_names", """SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'Liaqatabad'
  WHEN 1 THEN 'F.B. Area' ELSE n_name END AS ibc_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    variant = (
        F.when(F.col("c_nationkey") == 0, "Liaquatabad")
        .when(F.col("c_nationkey") == 1, "FB Area")
        .otherwise(F.col("n_name"))
    )
    return rows.select(
        "c_custkey", parsing.respell(variant, parsing.CENTRE_SPELLINGS).alias("ibc_name")
    )


@query("flag_coercion", """SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 0
  WHEN 'error' THEN 1 END AS emergency, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS rain
FROM events""")
def _(t):
    kind = F.col("event_type")
    emergency = F.when(kind == "click", "  ").when(kind == "error", "1").when(kind != "view", "maybe")
    rain = F.when(kind == "purchase", "YES").when(kind == "signup", "yes")
    return t.events.select(
        "event_id",
        parsing.blank_as_zero(emergency).alias("emergency"),
        parsing.yes_flag(rain).alias("rain"),
    )


@query("require_keys", with_views(["outages"], """SELECT outage_id, reason, punching_delay FROM outages
WHERE reason IS NOT NULL AND punching_delay IS NOT NULL"""))
def _(t):
    rows = outages(t).select("outage_id", "reason", "punching_delay")
    return cleaning.require_keys(rows, ["reason", "punching_delay"])


@query("nonzero_nonnull_filter", with_views(["billing"], """
SELECT document, irb_revised_amount, irb_revised_units, irb_detection_units FROM billing
WHERE irb_revised_amount IS NOT NULL AND irb_revised_amount <> 0 AND irb_revised_units <> 0
  AND irb_detection_units <> 0"""))
def _(t):
    columns = ["irb_revised_amount", "irb_revised_units", "irb_detection_units"]
    return cleaning.all_present_and_nonzero(billing(t).select("document", *columns), columns)


@query("rename_select", """SELECT l_orderkey AS document, l_extendedprice AS recovered,
  o_orderpriority AS priority FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("document"), "l_extendedprice")
    heads = t.orders.select(F.col("o_orderkey").alias("document"), F.col("o_orderpriority").alias("priority"))
    joined = lines.join(heads, ["document"], "inner")
    return joined.withColumnRenamed("l_extendedprice", "recovered").select("document", "recovered", "priority")


ZEROS = ["total_irb_amount", "total_irb_units", "avg_irb_amount", "avg_irb_units",
         "total_sanctioned_load", "total_connected_load", "avg_sanctioned_load", "avg_connected_load",
         "total_current_amount", "total_current_units", "avg_current_amount", "avg_current_units"]


@query("typed_zero_columns", "SELECT c_custkey, " + ", ".join(
    f"CAST(0 AS DOUBLE) AS {c}" for c in ZEROS) + " FROM customer")
def _(t):
    return cleaning.zero_columns(t.customer.select("c_custkey"), ZEROS)


@query("surrogate_key", """SELECT l_orderkey, l_linenumber, part, supplier,
  md5(concat_ws('|', length(CAST(l_orderkey AS VARCHAR)) || ':' || l_orderkey,
    length(CAST(l_linenumber AS VARCHAR)) || ':' || l_linenumber,
    coalesce(length(part) || ':' || part, '-'), coalesce(length(supplier) || ':' || supplier, '-'))) AS row_key
FROM (SELECT l_orderkey, l_linenumber,
  CASE l_linenumber % 4 WHEN 0 THEN l_partkey || '|' || l_suppkey WHEN 1 THEN '' WHEN 2 THEN CAST(l_partkey AS VARCHAR) END AS part,
  CASE l_linenumber % 4 WHEN 1 THEN CAST(l_suppkey AS VARCHAR) WHEN 2 THEN '' END AS supplier FROM lineitem)""")
def _(t):
    """Parts of the key that are NULL, empty or hold the separator."""
    line, text = F.col("l_linenumber") % 4, lambda c: F.col(c).cast("string")
    part = F.when(line == 0, F.concat_ws("|", text("l_partkey"), text("l_suppkey"))).when(line == 1, "").when(line == 2, text("l_partkey"))
    supplier = F.when(line == 1, text("l_suppkey")).when(line == 2, "")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", part.alias("part"), supplier.alias("supplier"))
    return cleaning.surrogate_key(rows, rows.columns)


@query("season_gate", with_views(["billing"],
    "SELECT document, year, month FROM billing WHERE month BETWEEN 4 AND 9"))
def _(t):
    return cleaning.complaint_season(billing(t)).select("document", "year", "month")


PROFILED = {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderstatus": "string",
            "priority": "string"}


@query("profile_counts", """
WITH p AS (SELECT *, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders)
""" + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{kind}' AS column_type, count(*) AS rows, count({c}) AS present,
  {f'count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL)' if kind == 'string' else 0}
  AS not_numeric FROM p""" for c, kind in PROFILED.items()))
def _(t):
    priority = parsing.null_placeholder(F.col("o_orderpriority"), ["4-NOT SPECIFIED"])
    return cleaning.profile(
        t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", priority.alias("priority"))
    )


@query("profile_before_after", """SELECT count(*) AS rows_before,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS rows_after, 6 AS columns_before, 5 AS columns_after
FROM orders""")
def _(t):
    return cleaning.before_and_after(t.orders, cleaning.keep_active(t.orders, "o_orderstatus", "F"))


@query("drop_null_rows", with_views(["outages"], """SELECT outage_id, reason, punching_delay, turnaround_minutes
FROM outages WHERE reason IS NOT NULL AND punching_delay IS NOT NULL"""))
def _(t):
    return cleaning.drop_null_rows(
        outages(t).select("outage_id", "reason", "punching_delay", "turnaround_minutes")
    )


@query("select_features", """SELECT l_extendedprice, l_discount, l_tax, l_quantity FROM lineitem""")
def _(t):
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"]
    return t.lineitem.select(*cleaning.feature_columns(t.lineitem, ids))


@query("month_slice", """SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= DATE '1998-03-01' AND o_orderdate < DATE '1998-04-01'""")
def _(t):
    return cleaning.month_slice(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "1998-03")


@query("before_period", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < DATE '1998-03-01'")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return cleaning.before_period(rows, "o_orderdate", F.to_date(F.lit("1998-03-01")))


# --- scalar functions -------------------------------------------------------------------------


@query("scalar_text", r"""SELECT o_orderkey, replace(o_orderpriority, '-', '') AS replaced,
  regexp_matches(o_orderpriority, '^[0-9]+-[A-Z]+$') AS one_word, o_orderpriority LIKE '%LOW' AS is_low,
  substring(o_orderpriority, 1, 2) AS head, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS padded,
  o_orderstatus || '/' || o_orderpriority AS joined, CAST(length(o_orderpriority) AS INTEGER) AS letters,
  split_part(o_orderpriority, '-', 2) AS tail, regexp_extract(o_orderpriority, '-([A-Z]+)', 1) AS word,
  o_orderstatus IN ('F', 'O') AS listed FROM orders""")
def _(t):
    text = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        F.regexp_replace(text, "-", "").alias("replaced"),
        text.rlike("^[0-9]+-[A-Z]+$").alias("one_word"),
        text.like("%LOW").alias("is_low"),
        F.substring(text, 1, 2).alias("head"),
        F.lpad(F.month("o_orderdate").cast("string"), 2, "0").alias("padded"),
        F.concat("o_orderstatus", F.lit("/"), text).alias("joined"),
        F.length(text).alias("letters"),
        F.get(F.split(text, "-"), F.lit(1)).alias("tail"),
        F.regexp_extract(text, "-([A-Z]+)", 1).alias("word"),
        F.col("o_orderstatus").isin("F", "O").alias("listed"),
    )


@query("scalar_time", """SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year,
  CAST(month(l_shipdate) AS INTEGER) AS month, CAST(week(l_shipdate) AS INTEGER) AS week,
  CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days,
  CAST(date_diff('second', o_orderdate, l_shipdate) AS DOUBLE) / 60 AS minutes,
  CAST(l_shipdate AS DATE) AS day, strftime(l_shipdate, '%Y-%m') AS year_month,
  CAST(try_strptime(strftime(l_shipdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsed,
  TRUE AS clock_runs FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    shipped, ordered = F.col("l_shipdate"), F.col("o_orderdate")
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        F.year(shipped).alias("year"),
        F.month(shipped).alias("month"),
        F.weekofyear(shipped).alias("week"),
        F.datediff(shipped, ordered).alias("days"),
        parsing.minutes_between(ordered, shipped).alias("minutes"),
        shipped.cast("date").alias("day"),
        F.date_format(shipped, "yyyy-MM").alias("year_month"),
        parsing.day_month_year(F.date_format(shipped, "dd/MM/yyyy")).cast("date").alias("parsed"),
        (F.localtimestamp() > shipped).alias("clock_runs"),
    )


@query("scalar_values", """SELECT o_orderkey, o_totalprice + 1 AS plus, o_totalprice - 1 AS minus,
  o_totalprice * 2 AS doubled, o_totalprice / nullif(o_custkey % 3, 0) AS divided,
  TRY_CAST(o_orderpriority AS DOUBLE) AS not_a_number, CAST(o_custkey AS INTEGER) AS as_int,
  CAST(o_custkey AS VARCHAR) AS as_text, hex(CAST(o_orderpriority AS BLOB)) AS as_bytes,
  CASE WHEN o_orderstatus = 'F' THEN 'closed' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'part' END AS state,
  o_orderpriority IS NULL AS missing, 7 AS seven FROM orders""")
def _(t):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        (price + 1).alias("plus"),
        (price - 1).alias("minus"),
        (price * 2).alias("doubled"),
        F.try_divide(price, F.col("o_custkey") % 3).alias("divided"),
        F.col("o_orderpriority").try_cast("double").alias("not_a_number"),
        F.col("o_custkey").try_cast("int").alias("as_int"),
        F.col("o_custkey").cast("string").alias("as_text"),
        F.hex(F.col("o_orderpriority").cast("binary")).alias("as_bytes"),
        F.when(status == "F", "closed").when(status == "O", "open").otherwise("part").alias("state"),
        F.col("o_orderpriority").isNull().alias("missing"),
        F.lit(7).alias("seven"),
    )


# --- sorts and sets ---------------------------------------------------------------------------


@query("order_by_keys", "SELECT user_id, ts, event_id FROM events ORDER BY user_id, ts, event_id")
def _(t):
    return t.events.select("user_id", "ts", "event_id").orderBy("user_id", "ts", "event_id")


@query("limit_sample", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def _(t):
    return t.orders.orderBy("o_orderkey").limit(5)


@query("top_k_desc", """SELECT o_orderkey, o_orderdate FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100""")
def _(t):
    newest = t.orders.select("o_orderkey", "o_orderdate").orderBy(
        F.col("o_orderdate").desc(), F.col("o_orderkey").desc()
    )
    return newest.limit(100)


@query("union_all", """SELECT o_custkey AS account, 'billed' AS kind FROM orders
UNION ALL SELECT c_custkey, 'registered' FROM customer""")
def _(t):
    billed = t.orders.select(F.col("o_custkey").alias("account"), F.lit("billed").alias("kind"))
    known = t.customer.select(F.lit("registered").alias("kind"), F.col("c_custkey").alias("account"))
    return billed.unionByName(known)


@query("set_intersect_diff", """
SELECT 'both' AS side, id FROM (SELECT c_custkey AS id FROM customer INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT 'silent', id FROM (SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders)""")
def _(t):
    known = t.customer.select(F.col("c_custkey").alias("id"))
    billed = t.orders.select(F.col("o_custkey").alias("id"))
    both = known.intersect(billed).select(F.lit("both").alias("side"), "id")
    return both.unionByName(known.subtract(billed).select(F.lit("silent").alias("side"), "id"))


@query("dedupe_ids", "SELECT DISTINCT user_id FROM events")
def _(t):
    return t.events.select("user_id").distinct()
