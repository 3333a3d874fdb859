"""Extracts, table lifecycle, arrivals and the plans from raw text to facts."""

import datetime as dt
import os
import re
import threading
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gridsight.plans.billing import clean_billing
from gridsight.plans.complaints import clean_complaints
from gridsight.plans.monthly import billing_dims, load_complaints, load_months, load_outages, undo_loads
from gridsight.plans.outages import clean_outages
from gridsight.session import new_folder
from gridsight.sources import checks, extracts, journal, tables
from gridsight.streaming import arrivals


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


# --- extracts ---------------------------------------------------------------------------------


def test_months_of_many_files(spark, folder):
    write(f"{folder}/Ageing_202303.csv", "A|B\n1|x\n")
    write(f"{folder}/Ageing_202304.csv", "A|B\n2|y\n")
    write(f"{folder}/Ageing.csv", "A|B\n3|z\n")
    scanned = extracts.scan_billing(spark, folder, ["A", "B"])
    good, rejects = extracts.split_rejects(scanned, "billing_month")
    assert rows(good) == [("1", "x", "202303"), ("2", "y", "202304")] and rows(rejects) == [("3", "z", None)]


def test_moved_columns_fail(spark, folder):
    write(f"{folder}/a.csv", "B|A\n1|x\n")
    with pytest.raises(Exception, match="header"):
        extracts.scan_delimited(spark, folder, ["A", "B"], "|").collect()


def test_files_still_changing_are_left_out(spark, folder):
    write(f"{folder}/old.csv", "A\n1\n")
    write(f"{folder}/new.csv", "A\n2\n")
    os.utime(f"{folder}/old.csv", (time.time() - 100, time.time() - 100))
    assert rows(extracts.scan_delimited(spark, folder, ["A"], settle_seconds=35)) == [("1",)]
    assert len(rows(extracts.scan_delimited(spark, folder, ["A"]))) == 2


@pytest.mark.parametrize("files, spread, parts", [(1, False, 1), (5, True, 5), (None, False, 3)])
def test_export_file_count(spark, folder, files, spread, parts):
    path = extracts.export_csv(spark.range(100).repartition(3), f"{folder}/out", files, spread)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == parts
    assert extracts.scan_delimited(spark, path).count() == 100


# --- tables -----------------------------------------------------------------------------------


def loads(spark, low, high):
    return spark.range(low, high).select("id", (F.col("id") % 3).cast("int").alias("kind"), F.floor(F.col("id") / 10).cast("int").alias("load_id"))


def test_append_twice_is_append_once(spark, folder):
    path = tables.write_append(loads(spark, 0, 30), f"{folder}/t")
    assert tables.idempotent_append(loads(spark, 20, 50), path, ["id"]) == 20
    assert tables.idempotent_append(loads(spark, 20, 50), path, ["id"]) == 0
    assert tables.read_table(spark, path).count() == 50


def test_append_with_missing_and_repeated_keys(spark, folder):
    path = tables.write_append(loads(spark, 0, 5).withColumn("id", F.when(F.col("id") != 3, F.col("id"))), f"{folder}/t")
    new = spark.createDataFrame([(None, 1, 0), (9, 2, 0), (9, 1, 1), (2, 0, 0)], "id bigint, kind int, load_id int")
    assert tables.idempotent_append(new, path, ["id"], ["kind"]) == 1
    assert tables.idempotent_append(new, path, ["id"], ["kind"], within=F.col("load_id") <= 1) == 0
    assert rows(tables.read_table(spark, path).filter("id = 9")) == [(9, 1, 1)]


def test_replacing_a_load_keeps_the_others(spark, folder):
    path = tables.write_append(loads(spark, 0, 30), f"{folder}/t")
    for _ in range(2):
        tables.replace_loads(loads(spark, 10, 15), path)
    assert rows(tables.read_table(spark, path).groupBy("load_id").count()) == [(0, 10), (1, 5), (2, 10)]


def test_delete_keeps_rows_with_unknown_predicate(spark, folder):
    df = loads(spark, 0, 30).withColumn("kind", F.when(F.col("id") != 5, F.col("kind")))
    path = tables.write_append(df, f"{folder}/t")
    untouched = {f for f in os.listdir(f"{path}/load_id=2")}
    assert tables.delete_where(spark, path, (F.col("kind") == 2) & (F.col("load_id") < 2)) == [0, 1]
    left = {r.id for r in tables.read_table(spark, path).collect()}
    assert left == {i for i in range(30) if i == 5 or i >= 20 or i % 3 != 2}
    assert {f for f in os.listdir(f"{path}/load_id=2")} == untouched


def test_delete_that_empties_a_load(spark, folder):
    path = tables.write_append(loads(spark, 0, 30), f"{folder}/t")
    assert tables.delete_where(spark, path, F.col("id").between(10, 19)) == [1]
    assert {r.load_id for r in tables.read_table(spark, path).collect()} == {0, 2}


def test_history_and_rollback(spark, folder):
    path = tables.write_append(loads(spark, 0, 30), f"{folder}/t")
    assert [(r.load_id, r.rows, r.last_at) for r in tables.load_history(tables.read_table(spark, path), "id").collect()] == [
        (2, 10, 29), (1, 10, 19), (0, 10, 9)]
    assert tables.as_of(tables.read_table(spark, path), 1).count() == 20
    assert tables.rollback_to(spark, path, 0) == [1, 2]
    assert tables.read_table(spark, path).count() == 10


def test_loads_with_awkward_names(spark, folder):
    df = spark.createDataFrame([(1, "a:b c"), (2, "a:b c"), (3, "z%2F/y")], "id int, load_id string")
    path = tables.write_append(df, f"{folder}/t")
    assert tables.delete_where(spark, path, F.col("id") < 3) == ["a:b c"]
    assert rows(tables.read_table(spark, path)) == [(3, "z%2F/y")]
    assert tables.rollback_to(spark, path, "b") == ["z%2F/y"]


def test_schema_of_old_and_new_loads(spark):
    target = StructType([StructField("a", LongType()), StructField("b", StringType())])
    old = spark.createDataFrame([(1, "gone")], "a int, c string")
    new = spark.createDataFrame([(2, "x")], "a bigint, b string")
    got = tables.evolve([old, new], target)
    assert got.schema.fields[0].dataType == LongType() and rows(got) == [(1, None), (2, "x")]


def test_newer_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "at")
    assert tables.newer_rows(df, df.filter("at < 7"), "at").count() == 3
    assert tables.newer_rows(df, df.filter("at < 0"), "at").count() == 10


def test_shared_folder_is_the_one_named(spark):
    assert new_folder(spark, "x").startswith(
        f"{spark.conf.get('spark.checkpoint.dir')}/gridsight-{spark.sparkContext.applicationId}/x-")


# --- arrivals ---------------------------------------------------------------------------------


def drain(spark, landing, base, one=True):
    files = arrivals.arriving_files(spark, landing, ["A", "B"], one_file_at_a_time=one)
    running = arrivals.load_arrivals(files, f"{base}/table", f"{base}/checkpoint")
    arrivals.finish(running, 120)
    return running


def test_arrivals(spark, folder):
    landing = f"{folder}/in"
    write(f"{landing}/Ageing_202303.csv", "A|B\n1|x\n2|y\n")
    write(f"{landing}/Ageing_202304.CSV", "A|B\n3|z\n")
    write(f"{landing}/Other_202303.csv", "A|B\n9|q\n")
    write(f"{landing}/Ageing_202303.txt", "A|B\n9|q\n")
    first = drain(spark, landing, folder)
    assert len([p for p in first.recentProgress if p.numInputRows]) == 2
    table = lambda: rows(tables.read_table(spark, f"{folder}/table"), "A", "B", "billing_month", "load_id")
    expected = [("1", "x", "202303", "Ageing_202303"), ("2", "y", "202303", "Ageing_202303"), ("3", "z", "202304", "Ageing_202304")]
    assert table() == expected
    drain(spark, landing, folder)
    assert table() == expected
    write(f"{landing}/Ageing_202302.csv", "A|B\n0|late\n")
    drain(spark, landing, folder, one=False)
    assert table() == [("0", "late", "202302", "Ageing_202302"), *expected]


def test_replayed_batch_changes_nothing(spark, folder):
    write(f"{folder}/in/Ageing_202303.csv", "A|B\n1|x\n")
    files = lambda: arrivals.arriving_files(spark, f"{folder}/in", ["A", "B"])
    for checkpoint in ("one", "two"):  # a lost checkpoint replays everything
        arrivals.finish(arrivals.load_arrivals(files(), f"{folder}/t", f"{folder}/{checkpoint}"), 120)
    assert tables.read_table(spark, f"{folder}/t").count() == 1


def test_published_files_are_whole(spark, folder):
    names = extracts.publish_extract(spark.range(10).repartition(2), f"{folder}/in", "Ageing_202303")
    assert [os.path.basename(n) for n in names] == ["Ageing_202303-0.csv", "Ageing_202303-1.csv"]
    assert sorted(f for f in os.listdir(f"{folder}/in") if f.endswith(".csv")) == ["Ageing_202303-0.csv", "Ageing_202303-1.csv"]


# --- plans ------------------------------------------------------------------------------------

BILLING = ["AccountContract", "Status", "IBC", "IBCName", "Region", "PMT", "Last Payment Date", "CurrentAmount",
           "CurrentUnits", "IRBRevisedAmount", "IRBDetectionAmount", "IRBRevisedUnits", "IRBDetectionUnits",
           "Sanctioned Load", "Connected Load", "C 0-30", "Contract", "Consumer Type", "Customer Name"]


def raw_billing(spark):
    make = lambda **over: {"AccountContract": "1", "Status": "ACT", "IBC": "10", "IBCName": "F.B. Area", "Region": "R1",
        "PMT": "77", "Last Payment Date": "5-Mar-23", "CurrentAmount": "10.5", "CurrentUnits": "3",
        "IRBRevisedAmount": "1.5", "IRBDetectionAmount": "2.5", "IRBRevisedUnits": "1", "IRBDetectionUnits": "2",
        "Sanctioned Load": "7.5", "Connected Load": "6", "C 0-30": "9", "Contract": "8", "Consumer Type": "T",
        "Customer Name": "N", "billing_month": "202304"} | over
    data = [make(), make(AccountContract="2", IRBRevisedAmount="."), make(AccountContract="3", Status="INA"),
            make(AccountContract="4", Status=None), make(AccountContract="5", Region="Undefined", billing_month="202310"),
            make(AccountContract="6", IBCName="-", PMT="Not found", **{"Last Payment Date": "05-Mar-23"})]
    columns = [*BILLING, "billing_month"]
    return spark.createDataFrame([tuple(d[c] for c in columns) for d in data], extracts.text_schema(columns))


def test_billing_plan(spark):
    fact = clean_billing(raw_billing(spark))
    assert not {"C 0-30", "Contract", "Status"} & set(fact.columns)
    day = dt.date(2023, 3, 5)
    assert rows(fact, "account", "region", "irb_amount", "irb_units", "year", "month", "billing_month", "payment_date") == [
        ("1", "R1", 4.0, 3, 2023, 4, dt.date(2023, 4, 1), day),
        ("2", "R1", None, 3, 2023, 4, dt.date(2023, 4, 1), day),
        ("5", None, 4.0, 3, 2023, 10, dt.date(2023, 10, 1), day),
        ("6", "R1", 4.0, 3, 2023, 4, dt.date(2023, 4, 1), day)]
    assert fact.filter("account = '6'").first().pmt is None and fact.first().sanctioned_load == 7.5


COMPLAINTS = ["AccountContract", "ConsumerStatus", "IBCName", "IBCCode", "CREATED_DATE", "CREATED_AT", "Year", "Month", "PMT",
              "PMT Name", "Feeder ID", "Feeder Name", "StarCustomer", "GroundTAT", "TargetTAT", "O to I", "UnitBilled",
              "DueDate", "Key"]


def raw_complaints(spark):
    make = lambda **over: {"AccountContract": "1", "ConsumerStatus": "ACT", "IBCName": "F.B. Area", "IBCCode": "10",
        "CREATED_DATE": "07-Apr-23", "CREATED_AT": "07-Apr-23 10:20:30", "Year": "2023", "Month": "Apr", "PMT": "77",
        "PMT Name": "T77", "Feeder ID": "5", "Feeder Name": "F5", "StarCustomer": "Y", "GroundTAT": "2", "TargetTAT": "x",
        "O to I": "1:02:03", "UnitBilled": "1,234.5", "DueDate": "01/05/23", "Key": "k"} | over
    data = [make(), make(GroundTAT="4", IBCName="FB old"), make(AccountContract="2", ConsumerStatus="INA"),
            make(AccountContract=None, Month="apr"), make(AccountContract="9", IBCName="Not found")]
    return spark.createDataFrame([tuple(d[c] for c in COMPLAINTS) for d in data], extracts.text_schema(COMPLAINTS))


def test_complaint_plan(spark):
    fact = clean_complaints(raw_complaints(spark))
    first = fact.filter("resolution_minutes = 120 AND account = '1'").first()
    assert fact.count() == 4 and "Key" not in fact.columns
    assert (first.month, first.pmt, first["O to I(minutes)"], first.UnitBilled) == (4, 77, 62.05, 1234.5)
    assert first["TargetTAT(minutes)"] is None and first.DueDate == dt.datetime(2023, 5, 1)
    assert first.created_time == dt.datetime(2023, 4, 7, 10, 20, 30)
    assert fact.filter("account IS NULL").first().month is None


OUTAGES = ["outage_Id", "Createdon", "IBC", "fdr_Id", "fdr_name", "TAT", "PunchingDelay", "duration", "initialoffreason",
           "israintripping", "isemergency", "Relay", "_c36"]


def raw_outages(spark):
    make = lambda **over: {"outage_Id": "1", "Createdon": "4/2/2023 9:05", "IBC": "FB Area", "fdr_Id": "5", "fdr_name": "F5",
        "TAT": "12", "PunchingDelay": "3", "duration": "0:30:00", "initialoffreason": "tree", "israintripping": "YES",
        "isemergency": "1", "Relay": "r", "_c36": None} | over
    data = [make(), make(outage_Id="2", TAT="1.5"), make(outage_Id="3", TAT="LL"), make(outage_Id="4", TAT=""),
            make(outage_Id="5", TAT=None, Createdon="2023-04-02 10:00:00", isemergency=" ", israintripping="NO"),
            make(outage_Id="6", PunchingDelay="-", Createdon="bad", isemergency=None, initialoffreason="."),
            make(outage_Id="7", TAT=".")]
    return spark.createDataFrame([tuple(d[c] for c in OUTAGES) for d in data], extracts.text_schema(OUTAGES))


def test_outage_plan(spark):
    fact = clean_outages(raw_outages(spark))
    assert not {"Relay", "_c36"} & set(fact.columns)
    assert rows(fact, "outage_id", "created_at", "ibc_name", "turnaround_minutes", "punching_delay", "duration_minutes", "rain", "emergency", "reason") == [
        ("1", dt.datetime(2023, 4, 2, 9, 5), "F.B. Area", 12.0, 3.0, 30.0, 1, 1, "tree"),
        ("5", dt.datetime(2023, 4, 2, 10), "F.B. Area", None, 3.0, 30.0, 0, 0, "tree"),
        ("6", None, "F.B. Area", 12.0, None, 30.0, 1, 0, None)]


def test_monthly_load_from_raw_text(spark):
    outages = clean_outages(raw_outages(spark)).withColumns({"year": F.year("created_at"), "month": F.month("created_at")})
    made = billing_dims(clean_billing(raw_billing(spark)), clean_complaints(raw_complaints(spark)), outages)
    assert rows(made["consumer_dim"], "account", "year", "month", "complaints", "avg_resolution_minutes") == [("1", 2023, 4, 2, 180.0)]
    assert rows(made["ibc_crm_ageing_dim"], "ibc_code", "month", "total_current_amount", "complaints") == [("10", 4, 31.5, 2)]
    centre = made["ibc_all_dim"].collect()
    assert [(r.ibc_code, r.total_current_amount, r.outages, r.top_fault) for r in centre] == [("10", 31.5, 2, "tree")]
    assert rows(made["pmt_crm_ageing_dim"], "pmt", "pmt_name", "total_current_amount", "complaints") == [(77, "T77", 21.0, 2)]
    assert rows(made["ibc_oms_ageing_dim"], "ibc_name", "month", "total_current_amount", "outages", "avg_duration_minutes") == [
        ("F.B. Area", 4, 21.0, 2, 30.0)]


def test_repeated_and_late_months(spark, folder):
    outages = clean_outages(raw_outages(spark)).withColumns({"year": F.year("created_at"), "month": F.month("created_at")})
    raw = raw_billing(spark)
    load_complaints(clean_complaints(raw_complaints(spark)), folder)
    load_outages(outages, folder)
    count = lambda paths, name: tables.read_table(spark, paths[name]).count()
    paths = load_months(raw.filter("billing_month = '202310'"), folder)
    assert count(paths, "billing") == 1
    for _ in range(2):
        paths = load_months(raw.filter("billing_month = '202304'"), folder)
        assert (count(paths, "billing"), count(paths, "consumer_dim"), count(paths, "ibc_oms_ageing_dim")) == (4, 1, 1)
    corrected = raw.filter("billing_month = '202304' AND AccountContract = '1'")
    load_months(corrected, folder)
    assert count(paths, "billing") == 2
    assert rows(tables.read_table(spark, paths["ibc_crm_ageing_dim"]), "load_id", "total_current_amount") == [(202304, 10.5)]
    load_months(corrected.withColumn("Status", F.lit("INA")), folder)
    for name in ("billing", "consumer_dim", "ibc_crm_ageing_dim", "ibc_all_dim", "pmt_crm_ageing_dim", "ibc_oms_ageing_dim"):
        schema = "load_id int"
        assert spark.read.schema(schema).parquet(paths[name]).filter("load_id = 202304").count() == 0, name


def test_rows_without_a_month_are_kept_apart(spark, folder):
    raw = raw_billing(spark)
    load_complaints(clean_complaints(raw_complaints(spark)), folder)
    load_outages(clean_outages(raw_outages(spark)).withColumns({"year": F.year("created_at"), "month": F.month("created_at")}), folder)
    lost = raw.withColumn("billing_month", F.when(F.col("AccountContract") > "2", F.col("billing_month")).otherwise(F.lit(None)))
    paths = load_months(lost, folder, "batch1")
    assert tables.read_table(spark, paths["rejects"]).count() == 2 and tables.read_table(spark, paths["billing"]).count() == 2
    assert tables.read_table(spark, f"{folder}/rejects/outages/*").count() == 1


def test_load_reads_only_its_months(spark, folder):
    load_complaints(clean_complaints(raw_complaints(spark)), folder)
    stored = journal.begin(spark, folder, "next").rows("crm_ibc_dim", [202304])
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "202304" in plan.split("PartitionFilters: [")[1].split("]")[0]


DIMS = ("consumer_dim", "ibc_crm_ageing_dim", "ibc_all_dim", "pmt_crm_ageing_dim", "ibc_oms_ageing_dim")


def dated_outages(spark):
    return clean_outages(raw_outages(spark)).withColumns({"year": F.year("created_at"), "month": F.month("created_at")})


def snapshot(spark, folder):
    """Every row of every table under a base."""
    return {name: rows(spark.read.parquet(f"{folder}/{name}")) for name in sorted(os.listdir(folder))
            if not name.startswith("_") and name != "rejects" and any("=" in n for n in os.listdir(f"{folder}/{name}"))}


def test_sources_in_any_order(spark, folder):
    """Billing before complaints and outages, even before anything, ends in the same tables."""
    load = {
        "c": lambda base: load_complaints(clean_complaints(raw_complaints(spark)), base),
        "o": lambda base: load_outages(dated_outages(spark), base),
        "b": lambda base: load_months(raw_billing(spark), base),
    }
    found = {}
    for order in ("cob", "bco"):
        for kind in order:
            load[kind](f"{folder}/{order}")
        found[order] = snapshot(spark, f"{folder}/{order}")
    assert found["cob"] == found["bco"] and set(DIMS) < set(found["cob"])
    paths = load["b"](f"{folder}/alone")
    assert set(DIMS) < set(paths) and snapshot(spark, f"{folder}/alone")["billing"] == found["cob"]["billing"]


class Stop(Exception):
    pass


@pytest.mark.parametrize("moves", [1, 6])
def test_stopped_load_is_finished_by_the_next(spark, folder, monkeypatch, moves):
    """The driver stops after some months have changed places; the next load puts the others in place."""
    for base in ("whole", "cut"):
        load_complaints(clean_complaints(raw_complaints(spark)), f"{folder}/{base}", batch="c")
        load_outages(dated_outages(spark), f"{folder}/{base}", batch="o")
        load_months(raw_billing(spark).filter("AccountContract = '1'"), f"{folder}/{base}", "first")
    before = snapshot(spark, f"{folder}/cut")
    load_months(raw_billing(spark), f"{folder}/whole", "second")
    move, left = journal._Files.move, [moves]

    def stopping(self, old, new):
        if "load_id=" in old:
            if not left[0]:
                raise Stop
            left[0] -= 1
        move(self, old, new)

    monkeypatch.setattr(journal._Files, "move", stopping)
    with pytest.raises(Stop):
        load_months(raw_billing(spark), f"{folder}/cut", "second")
    monkeypatch.undo()
    assert {r.state for r in journal.history(spark, f"{folder}/cut").filter("load = 'billing-second'").collect()} == {"staged"}
    assert journal.resume(spark, f"{folder}/cut") == ["billing-second"]
    assert snapshot(spark, f"{folder}/cut") == snapshot(spark, f"{folder}/whole")
    load_months(raw_billing(spark).limit(0), f"{folder}/cut", "second")  # in place: changes nothing
    assert snapshot(spark, f"{folder}/cut") == snapshot(spark, f"{folder}/whole")
    left[0] = moves
    monkeypatch.setattr(journal._Files, "move", stopping)
    with pytest.raises(Stop):
        undo_loads(spark, f"{folder}/cut", "billing-first")
    monkeypatch.undo()
    journal.resume(spark, f"{folder}/cut")
    assert snapshot(spark, f"{folder}/cut") == before
    assert undo_loads(spark, f"{folder}/cut", None) == ["billing-first", "outages-o", "complaints-c"]
    assert snapshot(spark, f"{folder}/cut") == {}


def test_failed_load_changes_nothing(spark, folder):
    load_complaints(clean_complaints(raw_complaints(spark)), folder, batch="c")
    before = snapshot(spark, folder)
    bad = clean_complaints(raw_complaints(spark)).withColumn("month", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        load_complaints(bad, folder, batch="bad")
    assert snapshot(spark, folder) == before and journal.resume(spark, folder) == []
    assert [load.name for load in journal.loads(spark, folder)] == ["complaints-c"]
    journal.forget(spark, folder, "complaints-c")
    assert snapshot(spark, folder) == before


def test_a_name_may_change_its_code(spark, folder):
    """Name N has code 20 in April and 10 in May: both months have their outages, however they are loaded."""
    complaints = spark.createDataFrame(
        [(str(i), code, "N", 2023, m, 77, "T", "Y", 1.0) for i, (m, code) in enumerate([(4, "20"), (5, "10")])],
        "account string, ibc_code string, ibc_name string, year int, month int, pmt bigint, pmt_name string, star_customer string, resolution_minutes double")
    outages = spark.createDataFrame(
        [(m, "N", "tree", 1.0, 1.0, 0, 2023, m) for m in (4, 5)],
        "outage_id bigint, ibc_name string, reason string, duration_minutes double, turnaround_minutes double, rain int, year int, month int")
    one = raw_billing(spark).filter("AccountContract = '1'").withColumn("IBCName", F.lit("N"))
    raw = one.withColumns({"IBC": F.lit("20")}).unionByName(
        one.withColumns({"IBC": F.lit("10"), "billing_month": F.lit("202305")}))
    load_complaints(complaints, folder)
    load_outages(outages, folder)
    load_months(raw, folder)
    together = rows(tables.read_table(spark, f"{folder}/ibc_all_dim"))
    for month in ("202305", "202304"):
        load_months(raw.filter(F.col("billing_month") == month), folder)
    assert rows(tables.read_table(spark, f"{folder}/ibc_all_dim")) == together
    assert rows(tables.read_table(spark, f"{folder}/ibc_all_dim"), "ibc_code", "month", "outages") == [("10", 5, 1), ("20", 4, 1)]


def test_files_of_three_kinds_run_the_load(spark, folder):
    """A file replaced in the landing folder is a new load; other names run nothing."""
    landing, base = f"{folder}/in", f"{folder}/star"

    def run():
        arrivals.finish(arrivals.run_arrivals(arrivals.arriving_paths(spark, landing), base, f"{folder}/checkpoint"), 300)

    for df, name, sep in ((raw_billing(spark).filter("billing_month = '202304'").drop("billing_month"), "Ageing_202304", "|"),
                          (raw_outages(spark), "OMS_x", ","), (raw_complaints(spark), "CRM_x", "|"), (raw_complaints(spark), "Other", "|")):
        extracts.publish_extract(df.coalesce(1), landing, name, sep)
    run()
    assert rows(tables.read_table(spark, f"{base}/ibc_all_dim"), "ibc_code", "complaints", "outages") == [("10", 2, 3)]  # an empty turnaround reads as none
    loaded = len(journal.loads(spark, base))
    run()
    assert loaded == 3 and len(journal.loads(spark, base)) == 3


def test_a_folder_of_files_is_one_load(spark, folder):
    """Complaints of one month in files of several tasks: no file replaces another's rows, whatever a batch holds."""
    landing, base = f"{folder}/in.csv", f"{folder}/star"
    extracts.publish_folder(raw_complaints(spark).repartition(2), landing, "CRM_x")
    extracts.publish_extract(raw_outages(spark).coalesce(1), landing, "OMS_x", ",")
    assert sum(name.endswith(".csv") for name in os.listdir(f"{landing}/CRM_x.csv")) == 2
    for checkpoint, files in (("first", 1), ("again", 100)):
        paths = arrivals.arriving_paths(spark, landing, files)
        arrivals.finish(arrivals.run_arrivals(paths, base, f"{folder}/{checkpoint}"), 300)
    assert len(journal.loads(spark, base)) == 2
    load_complaints(clean_complaints(raw_complaints(spark)), f"{folder}/plain")
    assert rows(tables.read_table(spark, f"{base}/crm_ibc_dim")) == rows(tables.read_table(spark, f"{folder}/plain/crm_ibc_dim"))
    with pytest.raises(OSError, match="could not publish"):
        extracts.publish_folder(raw_complaints(spark), landing, "CRM_x")


def test_tables_of_a_load_are_written_side_by_side(spark, folder):
    """One write that fails is raised after the others have ended; none is in the plan."""
    load, meet = journal.begin(spark, folder, "x"), threading.Barrier(2, timeout=60)
    replace = tables.replace_loads

    def both(df, path):
        meet.wait()
        return replace(df, path)

    good = spark.createDataFrame([(1, 202301)], f"v int, {tables.LOAD} int")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "replace_loads", both)
        load.stage_all({"a": good, "b": good})
        assert list(load.plan) == ["a", "b"] and rows(load.rows("b", [202301])) == [(1,)]
        bad = good.withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
        with pytest.raises(Exception, match="broken"):
            load.stage_all({"c": bad, "d": good})
    assert list(load.plan) == ["a", "b"] and os.path.isdir(f"{load.folder}/new/d/{tables.LOAD}=202301")


def test_centre_with_two_names_has_one_row(spark):
    """Eight complaints and two outages of one code under two names: all are counted, once."""
    complaints = spark.createDataFrame(
        [(str(i), "10", "A" if i < 3 else "B", 2023, 10, 77, "T", "Y", 0.4) for i in range(8)],
        "account string, ibc_code string, ibc_name string, year int, month int, pmt bigint, pmt_name string, star_customer string, resolution_minutes double")
    outages = spark.createDataFrame(
        [(1, "A", "tree", 10 / 60, 1.0, 0, 2023, 10), (2, "B", "tree", 10 / 60, 1.0, 0, 2023, 10), (3, "B", "wind", 10 / 60, 1.0, 1, 2023, 10)],
        "outage_id bigint, ibc_name string, reason string, duration_minutes double, turnaround_minutes double, rain int, year int, month int")
    billing = clean_billing(raw_billing(spark)).filter("account = '5'").withColumn("ibc_name", F.lit("A"))
    billing = billing.unionByName(billing.withColumn("ibc_name", F.lit("B")))
    made = billing_dims(billing, complaints, outages)
    both = made["ibc_all_dim"].collect()
    assert [(r.ibc_code, r.complaints, r.outages, r.top_fault, r.top_fault_frequency, r.avg_resolution_minutes, r.avg_duration_minutes) for r in both] == [
        ("10", 8, 3, "tree", 2, 0.4, 0.166667)]
    assert both[0].billing_month == dt.date(2023, 10, 1)
    assert [(r.ibc_code, r.complaints) for r in made["ibc_crm_ageing_dim"].collect()] == [("10", 8)]
    assert billing_dims(billing, complaints, outages, season=True)["ibc_all_dim"].count() == 0


def test_each_loaded_query_makes_its_own_loads(spark, folder, monkeypatch):
    from gridsight.catalog import QUERIES, loads

    made = []

    def load(t):
        made.append(1)
        spark.createDataFrame([(len(made), "x")], "`Premise Type` int, billing_month string").write.parquet(f"{folder}/{len(made)}")
        return {"rejects": f"{folder}/{len(made)}"}

    monkeypatch.setattr(loads, "_load_all", load)
    seen = [QUERIES["monthly_load_rejects"](spark, "/root/testdata/sf0.001").first().document for _ in range(2)]
    assert seen == [1, 2]


# --- checked writes -----------------------------------------------------------------------------


def checked_rows(spark, folder):
    write(f"{folder}/in/a.csv", "a|b\n1|x\n-2|x\nbad|\n|y\n5|z\n")
    scanned = extracts.scan_delimited(spark, f"{folder}/in", ["a", "b"], "|")
    return scanned.withColumn("a", F.col("a").try_cast("int"))


def test_broken_rows_are_set_apart_by_the_writing_job(spark, folder):
    df = checked_rows(spark, folder)
    rules = [checks.Rule("positive", F.col("a") > 0), checks.Rule("named", F.col("b").isNotNull())]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checked", "")
    got = checks.checked_write(df, f"{folder}/out", rules)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs.getJobIdsForGroup("checked")) == 1  # the text is read once
    assert rows(got.kept()) == [(1, "x"), (5, "z")]
    assert rows(got.quarantined(), "a", "b", "broken_rules") == [
        (None, None, ["positive", "named"]), (None, "y", ["positive"]), (-2, "x", ["positive"])]
    assert rows(got.report()) == [("named", 5, 1, 1.0, True), ("positive", 5, 3, 1.0, True)]


def test_a_load_beyond_its_bound_is_refused(spark, folder):
    df = checked_rows(spark, folder)
    at_bound = [checks.Rule("positive", F.col("a") > 0, 0.6)]
    assert checks.checked_write(df, f"{folder}/at", at_bound).refused() == []
    with pytest.raises(checks.TooManyBroken, match="positive"):
        checks.checked_write(df, f"{folder}/over", [checks.Rule("positive", F.col("a") > 0, 0.59)])


@pytest.mark.parametrize("known", [True, False])
def test_checks_of_no_rows(spark, folder, known):
    df = spark.createDataFrame([], "a int") if known else spark.range(5).selectExpr("CAST(id AS INT) AS a").filter("a > 9")
    got = checks.checked_write(df, f"{folder}/out", [checks.Rule("r", F.col("a") > 0, 0.0)])
    assert got.kept().count() == 0 and got.kept().columns == ["a"] and got.refused() == []
    assert rows(got.report()) == [("r", 0, 0, 0.0, True)]


def test_tables_of_a_load_change_places_side_by_side(spark, folder, monkeypatch):
    """A month of one table waits for a month of another, in putting in place and in undoing."""
    import threading

    rows = spark.createDataFrame([(1, 202301)], f"x int, {tables.LOAD} int")
    for number in ("1", "2"):
        load = journal.begin(spark, folder, number)
        load.stage_all({"a": rows, "b": rows})
        if number == "2":
            found = load.rows_of(["a", "b", "c"], [202301])
            assert [found[name] is None for name in ("a", "b", "c")] == [False, False, True]
        both, plain = threading.Barrier(2, timeout=20), journal._Files.move

        def move(self, old, new, both=both, plain=plain):
            if tables.LOAD in old:
                both.wait()
            plain(self, old, new)

        with monkeypatch.context() as patch:
            patch.setattr(journal._Files, "move", move)
            load.publish([202301])
            if number == "2":
                assert journal.undo_after(spark, folder, "1") == ["2"]
    assert [e.state for e in journal.loads(spark, folder)] == ["published", "undone"]
    assert tables.read_table(spark, f"{folder}/a").count() == tables.read_table(spark, f"{folder}/b").count() == 1


def test_rows_of_complaints_are_read_once(spark, folder):
    """Rows without a month too, which replace what lies under their batch."""
    many = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(name):
        many.add(1)
        return name

    raw = clean_complaints(raw_complaints(spark))
    known = raw.count()
    some = raw.withColumn("month", F.when(F.col("account") > "1", F.col("month")))
    lost = some.filter("month IS NULL").count()
    assert 0 < lost < known
    os.makedirs(f"{folder}/rejects/complaints/50%20/old")  # left by a driver that stopped before its plan was written
    paths = load_complaints(some.withColumn("ibc_name", passed("ibc_name")), folder, batch="50%20")
    assert many.value == known
    rejects = tables.read_table(spark, f"{folder}/rejects/complaints/*")
    assert os.listdir(f"{folder}/rejects/complaints") == ["50%20"] and not os.path.exists(f"{paths['rejects']}/old")
    assert sorted(rejects.columns) == sorted(some.columns) and rejects.count() == lost
    assert tables.read_table(spark, paths["complaints"]).count() == known - lost


def test_nothing_is_listed_for_dimensions_before_billing(spark, folder, monkeypatch):
    listed, plain = [], journal.Load.rows_of
    monkeypatch.setattr(journal.Load, "rows_of", lambda self, names, months: listed.extend(names) or plain(self, names, months))
    load_complaints(clean_complaints(raw_complaints(spark)), folder)
    assert "crm_consumer_dim" not in listed
    load_months(raw_billing(spark), folder)
    assert "crm_consumer_dim" in listed


def test_tasks_of_large_summaries_follow_the_rows(spark):
    """Same summary, and its second step is dealt to the tasks asked for."""
    from gridsight.plans.monthly import complaint_dims

    crm = clean_complaints(raw_complaints(spark))
    plain, dealt = complaint_dims(crm), complaint_dims(crm, 7)
    for name in ("crm_consumer_dim", "crm_pmt_dim"):
        assert rows(plain[name]) == rows(dealt[name])
        plan = dealt[name]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert re.search(r"hashpartitioning\([^)]*, 7\), REPARTITION_BY_NUM", plan) and plan.count("Exchange") == 2
