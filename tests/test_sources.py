"""Raw files in, typed facts out: dialects, nesting, overlap, landing."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import conform as c
from evenkeel.sources import landing, readers
from evenkeel.sources.contracts import ALARM_COLUMNS, CONTRACTS, PLAN_COLUMNS, WORK_ORDER_COLUMNS, resolve

SITES = [
    {"site_id": "site_mill", "display_name": "Mill", "customer_name": "Paper Co", "erp": {"customer_no": 1, "customer_site_no": 11}},
    {"site_id": "site_yard", "display_name": "Yard", "customer_name": "Paper Co", "erp": {"customer_no": 1, "customer_site_no": 12}},
    {"site_id": "site_house", "display_name": "North House", "customer_name": "Homes", "building_name": "North House",
     "property": {"property_id": "p1", "file_slug": "north_house", "child_property_ids": ["p1a"]}},
]


@pytest.fixture(scope="module")
def sites(spark):
    return c.crosswalk(spark, SITES)


def csv(path, columns, rows, sep=",", encoding="utf-8"):
    def cell(v):
        text = str(v)
        return '"' + text.replace('"', '""') + '"' if sep in text or "\n" in text else text

    lines = [sep.join(columns)] + [sep.join(cell(r.get(k, "NULL")) for k in columns) for r in rows]
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))


def test_dialects(spark, tmp_path):
    csv(tmp_path / "bom.csv", ["ALERT_EVENT_ID", "Priority"], [{"ALERT_EVENT_ID": 5701, "Priority": 60}], encoding="utf-8-sig")
    csv(tmp_path / "win.csv", ["WO_NO", "WORK_INVOICABLE"], [{"WO_NO": 123, "WORK_INVOICABLE": "EPÄTOSI"}], ";", "cp1252")
    csv(tmp_path / "plain.csv", ["A", "B"], [{"A": "ä", "B": 1}, {"A": "b", "B": 2}])
    got = {r.file_name: (r.encoding, r.delimiter, r.header, r.data_lines) for r in readers.csv_dialects(spark, str(tmp_path)).collect()}
    assert got == {"bom.csv": ("utf-8", ",", "ALERT_EVENT_ID,Priority", 1),
                   "win.csv": ("cp1252", ";", "WO_NO;WORK_INVOICABLE", 1), "plain.csv": ("utf-8", ",", "A,B", 2)}


def test_cp1252_text_is_exact(spark, tmp_path):
    csv(tmp_path / "w.csv", ["WO_NO", "TEXT"], [{"WO_NO": 1, "TEXT": "EPÄTOSI – “10 €” Žižkov"}], ";", "cp1252")
    assert readers.read_erp_csv(spark, str(tmp_path)).first()["TEXT"] == "EPÄTOSI – “10 €” Žižkov"


def test_quoted_cells_and_null_literals(spark, tmp_path):
    csv(tmp_path / "a.csv", ["K", "T"], [{"K": 1, "T": "one, two\nthree"}, {"K": "NULL", "T": "x"}], encoding="utf-8-sig")
    rows = {r["T"]: r["K"] for r in readers.read_erp_csv(spark, str(tmp_path)).collect()}
    assert rows == {"one, two\nthree": "1", "x": None}


ALARM = {c: "1" for c in ALARM_COLUMNS} | {
    "CUSTOMER_NO": 1, "CUSTOMER_SITE_NO": 11, "EVENT_TIME": "2024-07-01 12:00:00.000", "EVENT_CLOSED_TIME": "NULL",
    "LOOP": "  L1 ", "ALERT_TYPE": "PALO", "Priority": 60, "LOG_ONLY": "L", "WORKORDER_NO": "NULL"}


def test_alarms(spark, sites, tmp_path):
    rows = [ALARM | {"ALERT_EVENT_ID": 1}, ALARM | {"ALERT_EVENT_ID": 2, "WORKORDER_NO": 12345, "CUSTOMER_SITE_NO": 99},
            ALARM | {"ALERT_EVENT_ID": 3, "Priority": 42}, ALARM | {"ALERT_EVENT_ID": 4, "Priority": "NULL", "LOG_ONLY": "NULL"},
            ALARM | {"ALERT_EVENT_ID": 5, "EVENT_TIME": "garbage"}]
    csv(tmp_path / "alarms.csv", ALARM_COLUMNS, rows, encoding="utf-8-sig")
    out = c.conform_alarms(readers.read_erp_csv(spark, str(tmp_path)), sites)
    got = {r.alert_event_id: r for r in out.collect()}
    assert got[1].site_id == "site_mill" and got[1].loop == "L1" and got[1].is_log_only and not got[1].has_work_order
    assert got[1].event_time_utc == dt.datetime(2024, 7, 1, 9)
    assert got[2].workorder_no == 12345 and got[2].site_id is None and got[2].mapping_status == "unmapped"
    assert got[3].issues == ["invalid priority"] and got[4].issues == [] and got[4].priority is None
    assert got[5].issues == ["bad event_time"]
    clean, bad = c.split_clean(out)
    assert clean.count() + bad.count() == len(rows) and bad.count() == 2
    with pytest.raises(Exception, match="invalid priority"):
        c.conform_alarms(readers.read_erp_csv(spark, str(tmp_path)), sites, strict=True).collect()


def test_duplicate_keys_and_bad_times_are_named(spark, sites, tmp_path):
    csv(tmp_path / "alarms.csv", ALARM_COLUMNS, [ALARM | {"ALERT_EVENT_ID": i} for i in (1, 2, 2)], encoding="utf-8-sig")
    raw = readers.read_erp_csv(spark, str(tmp_path))
    assert sorted(r.issues for r in c.conform_alarms(raw, sites).collect()) == [[]] + [["duplicate alert_event_id"]] * 2
    with pytest.raises(Exception, match="duplicate alert_event_id"):
        c.conform_alarms(raw, sites, strict=True).collect()
    point = "struct<t:string,v:double,key:string,src:string>"
    incident = ("struct<id:string,node_id:string,created_at:string,updated_at:string,event_type:string,priority:string,"
                "status:string,category:string,points:double,description:string,internal:boolean,include_in_report:boolean>")
    child = f"struct<id:string,readings:map<string,struct<data:array<{point}>>>,incidents:array<{incident}>>"
    both = f"id:string,readings:map<string,struct<data:array<{point}>>>,incidents:array<{incident}>,children:array<{child}>"
    points = [("2024-01-01T00:00:00+00:00", 1.0, "k", "s")] * 2 + [("never", 2.0, "k", "s")]
    event = ("i", "n", "2024-01-01T00:00:00+00:00", "soon", "e", "p", "s", "c", 1.0, "d", None, None)
    props = spark.createDataFrame([(("p1", {"m": (points,)}, [event], None),)], f"property struct<{both}>")
    assert sorted(r.issues for r in c.conform_readings(props, sites).collect()) == [
        ["bad timestamp"], ["duplicate reading_id"], ["duplicate reading_id"]]
    assert [r.issues for r in c.conform_incidents(props, sites).collect()] == [["bad updated_at"]]
    with pytest.raises(Exception, match="bad timestamp"):
        c.conform_readings(props, sites, strict=True).collect()


def test_work_orders(spark, sites, tmp_path):
    base = {k: "NULL" for k in WORK_ORDER_COLUMNS} | {
        "CUSTOMER_NO": 1, "CUSTOMER_SITE_NO": 12, "CONTRACT": "KH", "WORK_ORDER_DESCRIPTION": "Testi työ",
        "WORK_STARTED_DATETIME": "2.12.2019 10:00", "WORK_FINISHED_DATETIME": "2019-12-04 22:00:00", "WORK_INVOICABLE": "TOSI",
        "WORKTIME_HOURS": "1,5", "PRIORITY_ID": "3", "IS_SLA_VIOLATION": "1"}
    rows = [base | {"WO_NO": 1, "WORK_FINISHED_DAYS": "2.16.00"}, base | {"WO_NO": 2, "IS_SLA_VIOLATION": "NULL", "WORK_INVOICABLE": "NULL"},
            base | {"WO_NO": 3, "WORK_INVOICABLE": "maybe"}, base | {"WO_NO": 4, "WORK_FINISHED_DATETIME": "NULL"}]
    csv(tmp_path / "wo.csv", WORK_ORDER_COLUMNS, rows, ";", "cp1252")
    got = {r.wo_no: r for r in c.conform_work_orders(readers.read_erp_csv(spark, str(tmp_path)), sites).collect()}
    assert got[1].work_finished_days == 2.16 and got[1].is_sla_violation and got[1].is_invoicable and got[1].worktime_hours == 1.5
    assert got[1].work_order_description == "Testi työ" and got[1].site_id == "site_yard" and got[1].issues == []
    assert got[1].work_started_at_utc == dt.datetime(2019, 12, 2, 8)
    assert got[2].work_finished_days == 2.5 and not got[2].is_sla_violation and not got[2].is_invoicable
    assert got[3].issues == ["bad invoicable"] and got[4].issues == ["missing finish"]


def test_maintenance_plans_keep_latest(spark, sites, tmp_path):
    base = {k: "NULL" for k in PLAN_COLUMNS} | {"PM_NO": 430388, "CUSTOMER_NO": 1, "CUSTOMER_SITE_NO": 11, "PRIORITY_ID": 3}
    csv(tmp_path / "p.csv", PLAN_COLUMNS, [base | {"LAST_UPDATED": "2024-01-01 00:00:00", "ACTION_DESCR": "Act Old"},
                                           base | {"LAST_UPDATED": "1.2.2024 10:00", "ACTION_DESCR": "Act New"}], encoding="utf-8-sig")
    rows = c.conform_maintenance_plans(readers.read_erp_csv(spark, str(tmp_path)), sites).collect()
    assert [(r.pm_no, r.action_descr, r.site_id) for r in rows] == [("430388", "Act New", "site_mill")]


def property_document(pid, child=None):
    point = lambda t: {"t": t, "v": 1.5, "key": "m1", "src": "auto"}
    readings = {"electricity_kWh": {"data": [point("2021-02-10 12:00:00+00")]}, "odd": {"data": [point("2021-02-10T12:05:00+00:00")]}}
    incident = {"id": f"i-{pid}", "node_id": "n", "created_at": "2021-02-10 12:00:00+00", "updated_at": "2021-02-10 12:00:00+00",
                "event_type": "fault", "priority": "immediate", "status": "resolved", "category": "c", "points": 2, "description": "d"}
    body = {"id": pid, "readings": readings, "incidents": [incident], "nodes": [{"id": "n", "name": "x", "type": "t", "tags": ""}]}
    if child:
        body["children"] = [{"id": child, "readings": {"water_m3": {"data": [point("2021-02-10 12:00:00+00")]}}, "incidents": []}]
    return {"property": body}


def test_property_documents(spark, sites, tmp_path):
    for pid, child in (("p1", "p1a"), ("unknown", None)):
        (tmp_path / f"{pid}.json").write_text(json.dumps(property_document(pid, child)))
    (tmp_path / "p1.json.meta.json").write_text("{}")
    props = readers.read_properties(spark, str(tmp_path))
    rows = c.conform_readings(props, sites).collect()
    assert {r.reading_id for r in c.conform_readings(props, sites, spread=4).collect()} == {r.reading_id for r in rows}
    assert len(rows) == 5 and len({r.reading_id for r in rows}) == 5
    child = next(r for r in rows if r.property_id == "p1a")
    assert child.parent_property_id == "p1" and child.site_id == "site_house" and child.unit == "m3"
    assert {r.mapping_status for r in rows if r.property_id == "unknown"} == {"unmapped"}
    assert next(r.unit for r in rows if r.metric == "odd") == "unknown"
    incidents = {r.incident_id: r for r in c.conform_incidents(props, sites).collect()}
    assert incidents["i-p1"].is_resolved and incidents["i-p1"].include_in_report and not incidents["i-p1"].is_internal
    counts = {r["property"]["id"]: r.n for r in props.withColumn("n", landing.property_records()).collect()}
    assert counts == {"p1": 5, "unknown": 4}
    (tmp_path / "metadata.json").write_text(json.dumps({"properties": ["p1", "unknown", "p3"]}))
    files = landing.source_records(spark, "BMS", str(tmp_path)).collect()
    assert sorted((r.source_name, r.source_file.split("/")[-1], r.row_count) for r in files) == [
        ("building_automation", "metadata.json", 3), ("building_automation", "p1.json", 5), ("building_automation", "unknown.json", 4)]


def test_occupancy(spark, sites, tmp_path):
    record = {"month": 12, "weekday": 1, "site_connection_ok": None, "floor": "1", "floor_id": 5, "occupancy": list(range(24))}
    for name in ("North_House_2026-05-27_123944-normalized.json", "North_House_2026-05-27_123944.json"):
        (tmp_path / name).write_text(json.dumps([record]))
    out = c.conform_occupancy(readers.read_occupancy(spark, str(tmp_path)), sites, ["North House"])
    rows = out.collect()
    assert len(rows) == 48 and {r.year for r in rows} == {2025} and {r.site_id for r in rows} == {"site_house"}
    assert {r.value_type for r in rows} == {"normalized", "raw_count"} and len({r.occupancy_id for r in rows}) == 48
    assert all(r.issues == [] for r in rows)
    twice = readers.read_source(spark, "elevators", str(tmp_path)).where("file_name NOT LIKE '%normalized%'")
    twice = twice.unionByName(twice)
    bad = c.conform_occupancy(twice, sites, ["North House"]).collect()
    assert len(bad) == 48 and all(r.issues == ["duplicate occupancy_id"] for r in bad)
    with pytest.raises(Exception, match="duplicate occupancy_id"):
        c.conform_occupancy(twice, sites, ["North House"], strict=True).collect()
    (tmp_path / "North_House_2.json").write_text(json.dumps([record | {"occupancy": [1, 2]}]))
    with pytest.raises(Exception, match="24 hourly"):
        readers.read_occupancy(spark, str(tmp_path)).collect()


def test_utilization_overlap_keeps_later_export(spark, tmp_path):
    (tmp_path / "Room_Utilization_010124-020124.csv").write_text("asset,2024-01-01,2024-01-02\nLetto,10.5,20.0\nKarhu,0,5.5\n")
    (tmp_path / "Room_Utilization_020124-030124.csv").write_text('asset,2024-01-02,2024-01-03\nLetto,99.0,n/a\n"Hall, big",1,2\n')
    out = c.conform_utilization(readers.read_wide_csv(spark, str(tmp_path)), "site_mill")
    got = {(r.asset_name, str(r.utilization_date)): r.utilization_pct for r in out.collect()}
    files = landing.source_records(spark, "utilization", str(tmp_path)).collect()
    assert sorted(r.row_count for r in files) == [2, 2]
    with pytest.raises(KeyError, match="unknown source"):
        readers.read_source(spark, "lifts", str(tmp_path))
    assert got == {("Letto", "2024-01-01"): 10.5, ("Letto", "2024-01-02"): 99.0, ("Letto", "2024-01-03"): None,
                   ("Karhu", "2024-01-01"): 0.0, ("Karhu", "2024-01-02"): 5.5, ("Hall, big", "2024-01-02"): 1.0, ("Hall, big", "2024-01-03"): 2.0}


def test_utilization_needs_its_asset_column(spark, tmp_path):
    (tmp_path / "Room_Utilization_010124-020124.csv").write_text("room,2024-01-01\nLetto,1\n")
    with pytest.raises(Exception, match="expected column asset"):
        readers.read_wide_csv(spark, str(tmp_path)).collect()


def test_landing_ledger_and_manifest(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    csv(raw / "alarms_20260527.csv", ["A"], [{"A": 1}, {"A": 2}])
    csv(raw / "alarms_2026-05-28.csv", ["A"], [{"A": 3}])
    rows = spark.read.option("header", True).csv(str(raw))
    ledger = landing.file_ledger(rows, resolve("alarms"), "2026-06-05")
    got = {r.dest_file: (str(r.export_date), r.row_count) for r in ledger.collect()}
    assert got == {"alarms_20260527.csv": ("2026-05-27", 2), "alarms_2026-05-28.csv": ("2026-05-28", 1)}
    manifest = landing.partition_manifest(ledger).first()
    assert (manifest.file_count, manifest.total_row_count) == (2, 3)
    landing.land_rows(rows, str(tmp_path / "bronze"), resolve("alarms"), "2026-06-05")
    assert landing.read_landed(spark, str(tmp_path / "bronze"), "erp_alarms", "2026-06-05").count() == 3


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("site_id", (F.col("id") % 2).cast("string"))
    table = landing.publish(df, str(tmp_path / "gold"), "numbers_view", partition_by=["site_id"], sort_by=["site_id", "id"])
    assert table.count() == 10 and spark.sql("SELECT count(*) FROM numbers_view WHERE site_id = '1'").first()[0] == 5
    meta = landing.quarantine(df, str(tmp_path / "q"), "silver", "numbers", "check", "why", "run1", limit=3).first()
    assert meta.row_count == 10 and spark.read.parquet(meta.path).count() == 3
    landing.write_report(df, str(tmp_path / "report"), "2026-06-05")
    assert spark.read.json(str(tmp_path / "report")).count() == 10


def test_registry():
    assert resolve(" Maintenance ").name == "maintenance_plans" and len(CONTRACTS) == 6
    assert len(resolve("occupancy").raw_schema().fields) == 6
    with pytest.raises(KeyError):
        resolve("nothing")


def test_dimensions(spark, sites):
    dims = {r.site_id: r for r in c.dim_site(sites).collect()}
    assert dims["site_mill"].customer_id == "cust_paper_co" and dims["site_mill"].country == "FI"
    customers = {r.customer_id: r.erp_customer_no for r in c.dim_customer(sites).collect()}
    assert customers == {"cust_paper_co": 1, "cust_homes": None}


def test_property_metrics_name_broken_documents(spark, tmp_path):
    whole = property_document("p1", "p1a")
    (tmp_path / "p1.json").write_text(json.dumps(whole, indent=1))
    (tmp_path / "many.json").write_text("\n".join([json.dumps(property_document("p2")), "{broken", json.dumps({"property": {"readings": {}}}),
                                                   json.dumps({"property": {"id": "bare"}}), ""]))
    (tmp_path / "empty.json").write_text(" ")
    (tmp_path / "p1.json.meta.json").write_text("{}")
    rows = readers.read_property_metrics(spark, str(tmp_path)).collect()
    named = sorted((r.property_id, r.parent_property_id or "", r.metric, len(r.data)) for r in rows if r.issue is None)
    assert named == [("p1", "", "electricity_kWh", 1), ("p1", "", "odd", 1), ("p1a", "p1", "water_m3", 1),
                     ("p2", "", "electricity_kWh", 1), ("p2", "", "odd", 1)]
    issues = sorted((r.source_file.rsplit("/", 1)[1], r.issue) for r in rows if r.issue)
    assert issues == [("empty.json", "empty document"), ("many.json", "broken document"), ("many.json", "no property id")]
    points = readers.read_property_metrics(spark, str(tmp_path)).where("property_id = 'p1a'").select(F.inline("data")).first()
    assert (points.t, points.v, points.key) == ("2021-02-10 12:00:00+00", 1.5, "m1")


def test_files_land_once_and_unchanged(spark, tmp_path):
    raw, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    raw.mkdir()
    (raw / "a.csv").write_bytes(b"\xff\x00\r\nbytes")
    (raw / "b.csv").write_bytes(b"b")
    first = landing.land_files(spark, str(raw), bronze, resolve("alarms"), "2026-06-05")
    assert sorted((r.dest_file, r.byte_size) for r in first.collect()) == [("a.csv", 9), ("b.csv", 1)]
    assert landing.land_files(spark, str(raw), bronze, resolve("alarms"), "2026-06-06").count() == 0
    (raw / "a.csv").write_bytes(b"other")
    again = landing.land_files(spark, str(raw), bronze, resolve("alarms"), "2026-06-06").collect()
    assert [(r.dest_file, str(r.ingest_date)) for r in again] == [("a.csv", "2026-06-06")]
    stored = {(r.dest_file, bytes(r.content)) for r in spark.read.parquet(bronze).collect()}
    assert stored == {("a.csv", b"\xff\x00\r\nbytes"), ("b.csv", b"b"), ("a.csv", b"other")}


def test_published_tables_prune_partitions(spark, tmp_path):
    df = spark.range(1000).withColumn("site_id", (F.col("id") % 5).cast("string"))
    landing.publish(df, str(tmp_path / "gold"), "pruned_view", partition_by=["site_id"], sort_by=["site_id", "id"])
    plan = readers.read_table(spark, str(tmp_path / "gold"), site="3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(site_id" in plan


def test_quarantine_counts_while_it_writes(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        calls.add(1)
        return x

    bad = spark.range(0, 500, 1, 7).select(seen("id").alias("id"))
    for limit, kept in ((None, 500), (20, 20)):
        before = calls.value
        meta = landing.quarantine(bad, str(tmp_path / "q"), "silver", "t", f"c{limit}", "why", "r", limit=limit).first()
        assert meta.row_count == 500 and spark.read.parquet(meta.path).count() == kept
        assert calls.value - before == 500


def test_property_documents_are_counted_where_they_are_read(spark):
    from evenkeel.catalogue import QUERIES

    out = QUERIES["property_record_counts"](spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and out.count() == 1500
