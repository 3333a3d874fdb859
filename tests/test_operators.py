"""Rules that plain agreement with SQL on clean data would not show."""

import random

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import Observation, functions as F

from gridsight.catalog import QUERIES, bindings, star
from gridsight.functions.measures import Measure, aggregate, aggregate_with_labels, mean_minutes
from gridsight.operators import cleaning, dimensions as dims, evaluation as ev, facts, joins, learning, panel, summaries


# --- aggregates -------------------------------------------------------------------------------


def test_top_value_ties_and_missing(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "w"), ("a", "w"), ("a", "x"), ("a", None), ("b", None), ("c", None), ("c", "z")],
        "k string, v string",
    )
    assert rows(summaries.most_frequent(df, ["k"], "v", "top", "n")) == [("a", "w", 2), ("b", None, 0), ("c", "z", 1)]


def test_top_value_with_two_names_for_a_key(spark):
    df = spark.createDataFrame(
        [(1, "n1", "x", 1.0), (1, "n2", "x", 2.0), (1, "n2", "y", 4.0), (1, "n1", "y", None), (1, "n2", "x", 0.5)],
        "k int, name string, v string, m double",
    )
    measures = [Measure("s", "sum", "m", 2), Measure("a", "avg", "m", 2), Measure("n", "count", "m")]
    got = aggregate_with_labels(df, ["k"], measures, {"name": "name"}, ("v", "top", "times"))
    assert rows(got, "k", "name", "s", "a", "n", "top", "times") == [(1, "n1", 7.5, 1.875, 4, "x", 3)]


def test_two_steps_equal_one_step(spark):
    rng = random.Random(7)
    data = [(rng.randint(0, 5) if rng.random() > 0.35 else 0, rng.choice("pqr"), rng.choice(["u", "v", None]),
             round(rng.uniform(0, 100), 2) if rng.random() > 0.1 else None) for _ in range(3000)]
    df = spark.createDataFrame(data, "k int, name string, v string, m double")
    measures = [Measure("s", "sum", "m", 2), Measure("a", "avg", "m", 2), Measure("n", "count", "m"),
                Measure("lo", "min", "m")]
    one = aggregate(df, ["k"], measures)
    two = aggregate_with_labels(df, ["k"], measures, {"name": "name"}, ("v", "top", "t")).select(*one.columns)
    assert rows(one) == rows(two)


def test_all_missing_measure(spark):
    df = spark.createDataFrame([(1, None)], "k int, m double")
    got = aggregate(df, ["k"], [Measure("s", "sum", "m", 2), Measure("a", "avg", "m", 2), Measure("n", "count", "m")])
    assert rows(got) == [(1, None, None, 0)]


def test_iso_week_at_year_end(spark):
    df = spark.sql("SELECT DATE '2024-12-30' AS d, 5L AS u UNION ALL SELECT DATE '2024-01-02', 7L")
    got = summaries.weekly_rollup(df, "d", [Measure("u", "sum", "u")])
    assert rows(got) == [(2024, 1, 12)]


# --- dimensions and facts ---------------------------------------------------------------------


def billing(spark):
    columns = ("account string, ibc_code string, ibc_name string, region string, year int, month int, "
               "current_amount double, current_units bigint, sanctioned_load double, connected_load bigint, "
               "irb_amount double, irb_units bigint")
    data = [("1", "10", "A", "N", 2023, 4, 10.0, 1, 1.0, 1, 1.0, 1), ("2", "10", "A", "N", 2023, 4, 20.0, 3, 1.0, 1, None, None)]
    return spark.createDataFrame(data, columns)


def test_code_with_two_names_does_not_inflate_sums(spark):
    complaints = spark.createDataFrame(
        [("10", "A", 2023, 4, 60.0), ("10", "A old", 2023, 4, 120.0), ("10", "A", 2023, 4, None)],
        "ibc_code string, ibc_name string, year int, month int, resolution_minutes double",
    )
    summary = summaries.complaint_summary(complaints, ["ibc_code", "year", "month"], "ibc_name")
    got = dims.centre_dim(billing(spark), summary)
    assert rows(got, "ibc_code", "total_current_amount", "avg_current_units", "total_irb_amount",
                "complaints", "avg_resolution_minutes") == [("10", 30.0, 2.0, 1.0, 3, 90.0)]


def test_full_join_keeps_keys_of_either_side(spark):
    outages = spark.createDataFrame([("d1", "A", 1), ("d2", "B", 2)], "date string, ibc string, outages int")
    complaints = spark.createDataFrame([("d2", "B", 5), ("d3", "C", 6), ("d4", "C", 7)], "date string, ibc string, complaints int")
    got = dims.complaints_beside_outages(outages, complaints, ["date", "ibc"])
    assert rows(got) == [("d1", "A", 1, None), ("d2", "B", 2, 5), ("d3", "C", None, 6), ("d4", "C", None, 7)]


def test_chosen_row_is_one_row(spark):
    df = spark.createDataFrame([(1, 2, "a", "z"), (1, 1, "b", None)], "k int, o int, x string, y string")
    assert rows(dims.one_row_per_key(df, ["k"], ["x", "y"], "o")) == [(1, "b", None)]


def test_payment_time_equals_that_of_all_pairs(spark):
    terms = dict.fromkeys(facts.TAX_TERMS + facts.BENEFIT_TERMS + facts.IMPORT_TERMS, 1.0)
    bills = pd.DataFrame([
        {"document": d, "account": a, "due_date": pd.Timestamp("2023-02-01").date(),
         "issue_date": pd.Timestamp(i).date(), "net_amount": n, "units_billed": 1, "energy_charges": 2.0, **terms}
        for d, a, i, n in [(1, 7, "2023-01-01", 100.0), (1, 7, "2023-01-03", 50.0), (2, 8, "2023-01-01", 10.0)]
    ])
    paid = pd.DataFrame([
        {"account": 7, "document_date": pd.Timestamp(x).date(), "total_amount": v}
        for x, v in [("2023-01-05", 30.0), ("2023-01-09", 40.0), ("2023-01-20", 5.0)]
    ])
    pairs = bills.merge(paid, on="account")
    days = (pd.to_datetime(pairs.document_date) - pd.to_datetime(pairs.issue_date)).dt.days.mean()
    partly = spark.createDataFrame(bills).withColumn("GST", F.when(F.col("net_amount") != 50, F.col("GST")))
    got = facts.billing_and_recovery(partly, spark.createDataFrame(paid)).collect()
    assert len(got) == 1
    row = got[0]
    assert row.avg_payment_days == pytest.approx(days)
    assert (row.total_amount, row.recovery_amount, row.outstanding_amount) == (150.0, 75.0, 75.0)
    assert (row.tax_amount, row.units_billed, row.surcharge_amount) == (18.0 + 17.0, 2.0, 6.0)


def test_surrogate_key_is_stable(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    one = rows(cleaning.surrogate_key(df, ["k", "v"]))
    assert one == rows(cleaning.surrogate_key(df.repartition(3), ["k", "v"])) and len({r[2] for r in one}) == 2


# --- cleaning ---------------------------------------------------------------------------------


def test_active_filter_drops_missing_status(spark):
    df = spark.createDataFrame([(1, "ACT"), (2, "INA"), (3, None)], "k int, Status string")
    assert rows(cleaning.keep_active(df, "Status")) == [(1,)]


def test_digit_filter_removes_rows(spark):
    df = spark.createDataFrame([("12",), ("1.5",), ("LL",), ("",), (None,)], "TAT string")
    assert rows(cleaning.keep_digits_or_null(df, "TAT")) == [(None,), (12.0,)]


def test_profile(spark):
    df = spark.createDataFrame([("1", 1), ("x", None), (None, 3)], "t string, n int")
    assert rows(cleaning.profile(df)) == [("n", "int", 3, 2, 0), ("t", "string", 3, 2, 1)]


# --- panels -----------------------------------------------------------------------------------


def events(spark):
    """Feeder 1 holds a third of the rows, all within a few hours; feeder 9 has single rows days apart."""
    rng = random.Random(3)
    data, start = [], pd.Timestamp("2024-01-01")
    for i in range(900):
        feeder = 1 if i % 3 == 0 else rng.randint(2, 8)
        span = 3 * 3600 if feeder == 1 else 20 * 86400
        value = None if rng.random() < 0.1 else round(rng.uniform(0, 9), 2)
        data.append((i, feeder, start + pd.Timedelta(seconds=rng.randint(0, span)), value))
    for j in range(10):
        data.append((1000 + j, 9, start + pd.Timedelta(days=4 * j), float(j)))
    pdf = pd.DataFrame(data, columns=["id", "feeder", "at", "v"])
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return df.withColumn("at", F.col("at").cast("timestamp_ntz")), pdf.sort_values(["feeder", "at", "id"])


def test_lags_cross_chunks(spark):
    df, pdf = events(spark)
    got = panel.lag_features(df, "feeder", ["at", "id"], "v").toPandas().set_index("id")
    for k in range(1, 8):
        want = pdf.assign(w=pdf.groupby("feeder")["v"].shift(k)).set_index("id")["w"]
        have = got[f"v_lag_{k}"].astype(float).reindex(want.index)
        pd.testing.assert_series_equal(have, want, check_names=False)


@pytest.fixture
def four_ranges(spark):
    """No range is joined with its neighbour, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def burst(spark):
    """All rows of feeder a in one minute, half of them without a time; b after it, one row without a feeder."""
    return spark.range(400).select(
        F.when(F.col("id") == 399, None).when(F.col("id") % 40 == 0, "b").otherwise("a").alias("f"),
        F.when(F.col("id") % 2 == 0, F.timestamp_seconds(F.col("id") % 60)).alias("at"), "id",
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), "id")).alias("v"), F.array("id").alias("kept"))


def test_a_burst_is_split_over_ranges(spark, four_ranges):
    df = burst(spark)
    got = panel.lag_features(df, "f", ["at", "id"], "v", 7)
    plan = got._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan
    largest = max(got.groupBy(F.spark_partition_id()).count().toPandas()["count"])
    assert largest < 200
    order = "OVER (PARTITION BY f ORDER BY at, id)"
    want = df.selectExpr("*", *[
        f"CASE WHEN f IS NOT NULL THEN lag(v, {k}) {order} END AS v_lag_{k}" for k in range(1, 8)])
    assert rows(got) == rows(want)


def test_later_rows_of_a_burst(spark, four_ranges):
    df = burst(spark)
    want = df.selectExpr("*", """CAST(f IS NOT NULL AND lead(id, 90) OVER (PARTITION BY f ORDER BY at, id)
      IS NOT NULL AS INT) AS has_future""")
    assert rows(panel.has_future_rows(df, "f", ["at", "id"], 90)) == rows(want)


def test_lags_reach_over_ranges_of_single_rows(spark, four_ranges):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(4)], "f string, at int, v double")
    got = panel.lag_features(df, "f", ["at"], "v", 3)
    assert rows(got, "at", "v_lag_1", "v_lag_3") == [(0, None, None), (1, 0.0, None), (2, 1.0, None), (3, 2.0, 0.0)]


def test_lags_of_no_rows(spark):
    none = spark.createDataFrame([], "f string, at int, v string")
    got = panel.lag_features(none, "f", ["at"], "v", 2)
    assert got.columns == ["f", "at", "v", "v_lag_1", "v_lag_2"] and got.count() == 0
    assert panel.has_future_rows(none, "f", ["at"]).count() == 0


def test_sequences_carry_no_arrays_through_a_window(spark):
    got = panel.sliding_sequences(series(spark, {"a": [0, 1, 0, 1]}), "f", "p", ["x"], "flag", 2)
    assert "Window" not in got._jdf.queryExecution().toString()
    assert [(r.last_period, r.label) for r in got.orderBy("last_period").collect()] == [(1, 0), (2, 1)]


def test_a_panel_has_tasks_by_its_rows(spark, monkeypatch):
    """40 feeders by 30 days, however few bytes they are."""
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    df = spark.sql("SELECT CAST(id % 40 AS INT) AS f, date_add(DATE'2024-01-01', CAST(id % 30 AS INT)) AS at, 1L AS v FROM range(1200)")
    got = panel.feeder_panel(df, "f", "at", "day", [Measure("n", "count", "v")], F.lit(False))
    assert got.rdd.getNumPartitions() >= 10 and got.count() == 1200
    none = panel.feeder_panel(df.limit(0), "f", "at", "day", [Measure("n", "count", "v")], F.lit(False))
    assert none.count() == 0


def test_tickets_have_tasks_by_their_lines(spark, folder, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 10)
    for name, columns in (
        ("lineitem", "id AS l_orderkey, id AS l_partkey, id AS l_suppkey, 1 AS l_linenumber, 30D AS l_quantity, 'R' AS l_returnflag, 'F' AS l_linestatus, DATE'2024-01-02' AS l_shipdate"),
        ("orders", "id AS o_orderkey, DATE'2024-01-01' AS o_orderdate"), ("supplier", "id AS s_suppkey, id AS s_nationkey"),
        ("part", "id AS p_partkey"), ("customer", "id AS c_nationkey, 1D AS c_acctbal"),
    ):
        spark.sql(f"SELECT {columns} FROM range(40)").write.parquet(f"{folder}/{name}.parquet")
    assert star._network(bindings.Tables(spark, folder))["tickets"].rdd.getNumPartitions() >= 4
    assert QUERIES["fact_network_and_losses"](spark, folder).count() == 40


def test_no_feeder_has_no_history(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) AS f, timestamp_ntz'2024-01-01 00:00:00' AS at, id, 1.0D AS v FROM range(3)")
    got = panel.lag_features(df, "f", ["at", "id"], "v", 2)
    assert got.count() == 3 and got.filter("v_lag_1 IS NOT NULL").count() == 0


@pytest.mark.parametrize("ahead", [1, 7])
def test_future_rows(spark, ahead):
    df, pdf = events(spark)
    want = pdf.assign(w=pdf.groupby("feeder")["id"].shift(-ahead).notna().astype(int)).set_index("id")["w"]
    got = panel.has_future_rows(df, "feeder", ["at", "id"], ahead).toPandas().set_index("id")["has_future"]
    assert (got.reindex(want.index) == want).all()


@pytest.mark.parametrize("days", [1, 7])
def test_future_days(spark, days):
    df, pdf = events(spark)
    got = panel.has_future_days(df, "feeder", "at", days).toPandas().set_index("id")["has_future"]
    for feeder, part in pdf.groupby("feeder"):
        for r in part.itertuples():
            later = part["at"][(part["at"] > r.at) & (part["at"] <= r.at + pd.Timedelta(days=days))]
            assert got[r.id] == int(len(later) > 0)


def test_quiet_periods_have_flag_zero(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, timestamp_ntz'2024-01-15 00:00:00', true),
      (2, timestamp_ntz'2024-04-01 00:00:00', false), (1, timestamp_ntz'2024-03-01 00:00:00', false) AS t(f, at, bad)""")
    got = panel.feeder_panel(df, "f", "at", "month", [Measure("n", "count", "at")], F.col("bad"))
    assert [(r.f, r.period.month, r.n, r.fault) for r in got.orderBy("f", "period").collect()] == [
        (1, 1, 1, 1), (1, 2, 0, 0), (1, 3, 1, 0), (1, 4, 0, 0), (2, 1, 0, 0), (2, 2, 0, 0), (2, 3, 0, 0), (2, 4, 1, 0)]


def series(spark, flags):
    return spark.createDataFrame([(f, i, x, float(i)) for f, xs in flags.items() for i, x in enumerate(xs)],
                                 "f string, p int, flag int, x double")


def test_sequence_label_lies_two_periods_on(spark):
    flags = {"a": [0, 1, 0, 1, 1, 0], "exact": [0, 1, 1], "short": [1, 0]}
    got = panel.sliding_sequences(panel.next_period_target(series(spark, flags), "f", "p", "flag"), "f", "p", ["x"], "target", 3)
    # Inputs are periods 0..2 and the label is the flag of period 4; period 1..3 would need period 5.
    assert [(r.f, r.last_period, [s[0] for s in r.sequence], r.label) for r in got.orderBy("f", "last_period").collect()] == [
        ("a", 2, [0.0, 1.0, 2.0], 1), ("a", 3, [1.0, 2.0, 3.0], 0)]


def test_dual_histories_are_aligned(spark):
    labelled = panel.next_period_target(series(spark, {"a": [0, 1, 0, 1, 1, 0, 1]}), "f", "p", "flag")
    got = panel.dual_sequences(labelled, "f", "p", ["x"], "target", 2, 4).orderBy("last_period").collect()
    assert [([s[0] for s in r.short_sequence], [s[0] for s in r.long_sequence]) for r in got] == [
        ([2.0, 3.0], [0.0, 1.0, 2.0, 3.0]), ([3.0, 4.0], [1.0, 2.0, 3.0, 4.0])]


def test_latest_sequence_of_every_target(spark):
    df = spark.sql("""SELECT f, date_add(DATE '2024-01-01', CAST(id AS INT)) AS p, CAST(id AS DOUBLE) AS x
      FROM range(6) JOIN (VALUES ('a'), ('b')) t(f) WHERE f = 'a' OR id < 2""")
    got = panel.latest_sequences(df, "f", "p", ["x"], ["2024-01-04", "2024-01-20", "2024-01-02"], 3)
    assert [(r.f, str(r.target_period), [s[0] for s in r.sequence]) for r in got.orderBy("target_period").collect()] == [
        ("a", "2024-01-04", [0.0, 1.0, 2.0]), ("a", "2024-01-20", [3.0, 4.0, 5.0])]


def test_split_by_time(spark):
    df = spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id % 10 AS INT)) AS p FROM range(100)")
    got = panel.time_split(df, "p").groupBy("split").agg(F.count("*"), F.max("p"), F.min("p")).orderBy("split").collect()
    assert [(r[0], r[1]) for r in got] == [("test", 20), ("train", 80)] and got[1][2] < got[0][3]


# --- evaluation -------------------------------------------------------------------------------


def score(tp, fp, fn):
    p, r = tp / (tp + fp + 1e-9), tp / (tp + fn + 1e-9)
    return 2 * (p * r) / (p + r + 1e-9)


def scored(spark, n=400):
    rng = random.Random(11)
    data = [(i, i % 4, rng.choice([rng.random(), rng.randint(0, 100) / 100]), rng.randint(0, 1)) for i in range(n)]
    return data, spark.createDataFrame(data, "id int, week int, p double, y int")


def brute(data):
    table = []
    for h in range(10, 90):
        t = h / 100
        tp = sum(p > t and y == 1 for *_, p, y in data)
        fp = sum(p > t and y == 0 for *_, p, y in data)
        fn = sum(p <= t and y == 1 for *_, p, y in data)
        table.append((t, tp, fp, fn, score(tp, fp, fn)))
    return table


def test_threshold_table_equals_brute_force(spark):
    data, df = scored(spark)
    got = ev.threshold_table(df, "p", "y", []).orderBy("threshold").collect()
    assert [(r.threshold, r.tp, r.fp, r.fn, r.f1_score) for r in got] == brute(data)


def test_best_threshold_per_week(spark):
    data, df = scored(spark)
    for r in ev.best_threshold(df, "p", "y", ["week"]).collect():
        table = brute([d for d in data if d[1] == r.week])
        best = max(range(80), key=lambda i: (table[i][4], -i))
        assert r.threshold == table[best][0]


def test_first_best_threshold_wins(spark):
    df = spark.createDataFrame([(0.95, 1), (0.05, 0)], "p double, y int")
    assert [r.threshold for r in ev.best_threshold(df, "p", "y").collect()] == [0.1]


def test_published_counts(spark):
    """192 feeders: 112 found, 19 false alarms, 8 missed, 53 quiet."""
    df = spark.range(192).select(
        F.col("id").alias("f"),
        F.when(F.col("id") < 131, 0.9).otherwise(0.7).alias("p"),
        F.when((F.col("id") < 112) | F.col("id").between(131, 138), 1).otherwise(0).alias("y"),
    )
    flagged = ev.threshold_label(df, "p", 0.7).filter("predicted = 1")
    board = ev.scoreboard(ev.outcomes(flagged, df.filter("y = 1"), ["f"]), []).first()
    assert (board.correct_predictions, board.incorrect_predictions, board.missed_failures) == (112, 19, 8)
    assert [round(x, 4) for x in (board.precision, board.recall, board.f1_score)] == [0.8550, 0.9333, 0.8924]
    assert board.score_percent == 77.5


def test_missing_probability_is_below_any_threshold(spark):
    df = spark.createDataFrame([(0.5,), (None,), (float("nan"),), (0.25,)], "p double")
    assert sorted(r.predicted for r in ev.threshold_label(df, "p", 0.25).collect()) == [0, 0, 0, 1]
    table = ev.threshold_table(df.withColumn("y", F.lit(1)), "p", "y", []).filter("threshold = 0.3").first()
    assert (table.tp, table.fn) == (1, 3)


def test_merge_pairs_each_week_once(spark):
    df = spark.sql("SELECT f, w, 0.5D AS p, 1 AS y FROM (VALUES (1), (2)) a(f) JOIN (VALUES (1), (2), (3)) b(w)")
    assert ev.merge_predictions(df.drop("y"), df.drop("p"), ["f", "w"]).count() == 6


# --- learning ---------------------------------------------------------------------------------


def test_scale_is_fitted_on_train_only(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (5.0, None)], "a double, c double")
    scale = learning.MinMaxScale.fit(df.filter("a < 4"), ["a", "c"])
    assert rows(scale.transform(df)) == [(0.0, 0.0), (1.0, 0.0), (2.0, None)]


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_codes_with_and_without_broadcast(spark, monkeypatch, bound):
    monkeypatch.setattr(learning, "BROADCAST_BYTES", bound)
    data = [(i, random.Random(i).choice(["b", "a", None, "z", "nb"]), str(i % 3)) for i in range(60)]
    df = spark.createDataFrame(data, "id int, x string, y string")
    place = {v: i for i, v in enumerate(sorted({str(d[1]) if d[1] else "nan" for d in data}))}
    got = learning.encode_categories(df, ["x", "y"])
    assert {r.id: (r.x, r.y) for r in got.collect()} == {i: (place[x or "nan"], int(y)) for i, x, y in data}


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_key_index_by_frequency(spark, monkeypatch, bound):
    monkeypatch.setattr(learning, "BROADCAST_BYTES", bound)
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "k string")
    assert rows(learning.index_key(df, "k", "i")) == [(None, None), ("a", 1), ("b", 2), ("c", 0), ("c", 0)]


def test_positions_over_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(7)
    got = learning._positions(df, ["v"], "place").orderBy("place").collect()
    assert [r.place for r in got] == list(range(5000)) and [r.v for r in got] == sorted(r.v for r in got)


def test_classifier_learns_a_plain_rule(spark):
    df = spark.range(400).select(
        "id", F.array(F.array((F.col("id") % 2).cast("double")), F.array(F.lit(1.0))).alias("sequence"),
        (F.col("id") % 2).alias("label"))
    got = learning.score_batch(learning.fit_fault_classifier(df), df)
    assert got.filter((F.col("predicted_probability") > 0.5).cast("int") != F.col("label")).count() == 0


def test_segments(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("account"),
                                 (F.col("id") % 3 * 100 + F.rand(1)).alias("a"), F.rand(2).alias("b"))
    fitted = learning.fit_segments(df, ["a", "b"])
    assigned = fitted.assign(df)
    assert assigned.select("segment").distinct().count() == 3
    assert fitted.centres(spark).count() == 3 and -1 <= learning.silhouette(assigned) <= 1


def test_consumers_without_a_measure_are_kept(spark):
    df = spark.range(41).select("id", F.when(F.col("id") != 7, F.col("id") % 3 * 100.0).alias("a"), F.rand(2).alias("b"))
    assigned = learning.fit_segments(df, ["a", "b"]).assign(df)
    assert assigned.count() == 41 and [r.id for r in assigned.filter("segment IS NULL").collect()] == [7]


def test_mean_minutes_are_those_of_the_rows(spark):
    df = spark.createDataFrame([(1, 10 / 60), (1, 10 / 60), (2, 0.4), (2, 0.4), (2, None)], "k int, m double")
    assert rows(aggregate(df, ["k"], [mean_minutes("avg_m", "m")])) == [(1, 0.166667), (2, 0.4)]


def test_surrogate_keys_of_different_keys_differ(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a|b", "c"), ("a", "b|c"), ("-", "x"), ("1:a", None)], "a string, b string")
    assert cleaning.surrogate_key(df, ["a", "b"]).select("row_key").distinct().count() == 6


def test_missing_consumer_attributes_fail(spark):
    df = spark.createDataFrame([("1", 2023, 4)], "account string, year int, month int")
    with pytest.raises(ValueError, match="consumer_name"):
        dims.consumer_dim(df, df, optional=dims.NOT_SUPPLIED)


def test_panel_reads_its_source_once(spark, folder):
    spark.range(50).select(F.col("id").alias("f"), F.timestamp_seconds(F.col("id") * 86400).alias("at")).write.parquet(f"{folder}/src")
    got = panel.feeder_panel(spark.read.parquet(f"{folder}/src"), "f", "at", "week", [Measure("n", "count", "f")], F.lit(True))
    assert got.count() == 50 * 8 and f"{folder}/src" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert f"{folder}/src" not in got._jdf.queryExecution().executedPlan().toString()


# --- code tables and outside models -------------------------------------------------------------


def test_codes_stay_when_new_values_come(spark, folder):
    first = spark.createDataFrame([("b", 1), ("a", 1), (None, 2)], "k string, v int")
    later = spark.createDataFrame([("aa", 1), ("b", 3), ("a", 2), ("aa", None)], "k string, v int")
    path = f"{folder}/codes"
    learning.extend_codes(first, ["k", "v"], path)
    known = rows(learning.read_codes(spark, path))
    assert known == [("k", "a", 0), ("k", "b", 1), ("k", "nan", 2), ("v", "1", 0), ("v", "2", 1)]
    assert rows(learning.apply_codes(later, ["k", "v"], path)) == [(-1, -1), (-1, 0), (0, 1), (1, -1)]
    learning.extend_codes(later, ["k", "v"], path)
    learning.extend_codes(later, ["k", "v"], path)  # adds nothing
    assert rows(learning.read_codes(spark, path)) == sorted([*known, ("k", "aa", 3), ("v", "3", 2), ("v", "nan", 3)])
    assert rows(learning.apply_codes(first, ["k", "v"], path)) == [(0, 0), (1, 0), (2, 1)]


def test_codes_by_count_and_of_no_rows(spark, folder):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string")
    path = f"{folder}/codes"
    learning.extend_codes(df.limit(0), ["k"], path, by_count=True)
    assert rows(learning.apply_codes(df, ["k"], path, unseen=-9)) == [(-9,)] * 4
    learning.extend_codes(df, ["k"], path, by_count=True)
    assert rows(learning.read_codes(spark, path), "label", "code") == [("a", 1), ("b", 0), ("c", 2)]


def test_outside_model(spark, folder):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 1.0), (3, float("nan"), 1.0)], "id int, a double, b double")
    path = learning.store_linear(spark, {"a": 0.5, "b": 2.0}, -1.0, f"{folder}/model")
    assert rows(learning.score_with(df, ["b", "a"], path), "id", "score") == [(1, 6.0), (2, None), (3, None)]
    assert learning.score_with(df.limit(0), ["b", "a"], path).count() == 0
    with pytest.raises(Exception, match="takes"):
        learning.score_with(df, ["a"], path).collect()


def test_rolling_evaluation_finds_a_signal_and_holds_back_the_last_fold(spark):
    rng = random.Random(11)
    data = []
    for feeder in range(25):
        for month in range(1, 13):
            x, flag = rng.random(), float(rng.random() < 0.4)
            label = int(x > 0.6) if rng.random() < 0.9 else int(x <= 0.6)
            data.append((feeder, f"2024-{month:02d}-01", [[rng.random(), 0.0], [x, flag]], label))
    df = spark.createDataFrame(data, "feeder int, day string, sequence array<array<double>>, label int")
    df = df.withColumn("day", F.col("day").cast("date"))
    cuts, trained = ["2024-07-01", "2024-09-01", "2024-11-01"], []

    def fit(known):
        trained.append(str(known.agg(F.max("day")).first()[0]))
        return learning.fit_fault_classifier(known)

    scored = learning.rolling_scores(df, "day", cuts, {"regression": fit, "trees": learning.fit_boosted_trees})
    assert trained == ["2024-04-01", "2024-06-01"]  # labels of later rows lie beyond the cut
    assert rows(scored.groupBy("model", "fold").count()) == [
        ("regression", 0, 50), ("regression", 1, 50), ("trees", 0, 50), ("trees", 1, 50)]
    held = df.filter("day >= '2024-07-01' AND day < '2024-11-01'").withColumn("fold", F.when(F.month("day") < 9, 0).otherwise(1))
    rules = F.array(
        F.struct(F.lit("last_flag").alias("model"), F.col("sequence")[1][1].alias("predicted_probability")),
        F.struct(F.lit("always").alias("model"), F.lit(1.0).alias("predicted_probability")))
    simple = held.select("feeder", "day", "label", "fold", F.inline(rules))
    got = ev.choose_by_folds(scored.unionByName(simple), "predicted_probability", "label", 1)
    f1 = {r.model: r.held_out_f1 for r in got.collect()}
    assert got.filter("chosen").first().model in ("regression", "trees")
    assert min(f1["regression"], f1["trees"]) > 0.7 > max(f1["always"], f1["last_flag"])


def test_the_held_out_fold_has_no_part_in_the_choice(spark):
    lines = [("a", 0, 0.5, 1), ("a", 0, 0.3, 0), ("a", 1, 0.2, 1), ("b", 0, 0.9, 0), ("b", 0, 0.2, 1), ("b", 1, 0.9, 1)]
    df = spark.createDataFrame(lines, "model string, fold int, p double, label int")
    got = ev.choose_by_folds(df, "p", "label", 1)
    assert [(r.model, r.threshold, round(r.mean_f1, 3), round(r.held_out_f1, 3), r.chosen) for r in got.orderBy("model").collect()] == [
        ("a", 0.3, 1.0, 0.0, True), ("b", 0.1, 0.667, 1.0, False)]


def test_scoring_in_a_session_that_has_observed_rows(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    df = spark.createDataFrame([(i, [[float(i % 2)]], i % 2) for i in range(20)], "id int, sequence array<array<double>>, label int")
    got = learning.score_batch(learning.fit_fault_classifier(df), df)
    assert got.filter("(predicted_probability > 0.5) = (label = 1)").count() == 20
