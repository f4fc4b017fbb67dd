"""Marts, index, dispatch, assignment, cleaning, calendar, serving."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from evenkeel.functions import CREW
from evenkeel.operators.intervals import open_by_expansion, open_by_sweep, reversed_intervals
from evenkeel.operators.rolling import use_streaks
from evenkeel.plans import decisions as d
from evenkeel.plans import features as f
from evenkeel.plans import marts as m
from evenkeel.plans import serving as s
from evenkeel.plans.reliability import reliability_index


def test_sweep_equals_expansion(spark):
    rows = [("a", "2024-01-01", "2024-01-03"), ("a", "2024-01-02", "2024-01-02"), ("a", "2024-01-10", "2024-01-11"),
            ("b", "2024-01-05", "2024-01-04"), ("b", "2024-02-27", "2024-03-02"), ("b", None, "2024-01-01"), ("a", "2024-01-01", "2024-01-03")]
    df = spark.createDataFrame(rows, "site STRING, f STRING, t STRING").select("site", F.to_date("f").alias("f"), F.to_date("t").alias("t"))
    args = (["site"], "f", "t", "day", "n")
    sweep, expansion = open_by_sweep(df, *args), open_by_expansion(df, *args)
    assert sorted(sweep.collect()) == sorted(expansion.collect())
    assert {(r.site, str(r.day)): r.n for r in sweep.collect()}[("a", "2024-01-02")] == 3
    assert reversed_intervals(df, "f", "t").count() == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_are_limited_before_the_shuffle(spark):
    """A hot key sends each task's best rows on, not all of its rows."""
    from evenkeel.operators.latest import first_per_key, keep_latest

    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    for out in (keep_latest(df, ["k"], ["id"]), first_per_key(df, ["k"], [F.col("id").desc()], 120)):
        plan = plan_of(out)
        assert plan.count("WindowGroupLimit") == 2
        assert plan.rindex("Partial") > plan.index("Exchange hashpartitioning")
    assert {(r.k, r.id) for r in keep_latest(df, ["k"], ["id"]).collect()} == {(0, 999), (1, 997), (2, 998)}


def test_sorting_spreads_a_hot_key(spark):
    from evenkeel.operators.latest import sorted_by_key

    df = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("k"), "id")
    rows = sorted_by_key(df, "k", "id").withColumn("part", F.spark_partition_id()).collect()
    assert [(r.k, r.id) for r in rows] == sorted((r.k, r.id) for r in rows)
    spread = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = {r.part for r in sorted_by_key(df, "k", "id").withColumn("part", F.spark_partition_id()).collect() if r.k == "hot"}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", spread)
    assert len(parts) > 4


def test_filters_and_columns_reach_the_scan(spark):
    from evenkeel.sources.readers import read_table

    plan = plan_of(read_table(spark, "/root/testdata/sf0.001/customer.parquet", "BUILDING", "c_mktsegment").select("c_custkey"))
    assert "EqualTo(c_mktsegment,BUILDING)" in plan and "c_acctbal" not in plan


def test_split_cut_is_pushed_down(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    train, test = f.time_split(orders, "o_orderdate", "o_orderkey")
    assert train.count() + test.count() == orders.count()
    assert "LessThan(o_orderdate" in plan_of(train) and "Join" not in plan_of(train)


def test_orders_in_one_pass(spark):
    rows = [("a", "2024-01-01", "2024-01-03", True), ("a", "2024-01-03", "2024-01-02", True), ("a", "2024-01-10", "2024-01-10", False),
            (None, "2024-01-01", "2024-01-01", True), ("b", "2024-01-05", None, True), ("a", "2024-01-02", "2024-01-03", None)]
    df = spark.createDataFrame(rows, "site_id STRING, f STRING, t STRING, is_sla_violation BOOLEAN").select(
        "site_id", F.to_timestamp("f").alias("work_started_at_utc"), F.to_timestamp("t").alias("work_finished_at_utc"), "is_sla_violation")
    one = {(r.site_id, str(r.signal_date)): (r.open_work_orders, r.sla_violations) for r in m.work_order_rows(df).collect()}
    assert one == {("a", "2024-01-01"): (1, 0), ("a", "2024-01-02"): (2, 1), ("a", "2024-01-03"): (2, 1), ("a", "2024-01-10"): (1, 0)}


def test_daily_signals_with_one_source_has_all_columns(spark):
    alarms = spark.createDataFrame([("s1", "PALO", 60), ("s1", None, 1), ("s1", "LVIS", None), (None, "PALO", 1)],
                                   "site_id STRING, alert_type STRING, priority INT").withColumn("event_time_utc", F.lit("2024-01-01").cast("timestamp"))
    rows = m.daily_signals(alarms=alarms).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.alarm_count, r.fire_alarm_count, r.hvac_alarm_count, r.open_work_orders, r.electricity_kwh) == (3, 2, 1, 0, None)


def test_daily_signals_is_one_aggregation(spark):
    """Five sources, each read once, and nothing joined but what makes an order."""
    from evenkeel.catalogue.registry import Tables

    plan = Tables(spark, "/root/testdata/sf0.001").daily()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # orders ⋈ customer
    assert "Union" in plan


def test_occupancy_on_every_matching_date(spark):
    profiles = spark.createDataFrame([("s", 2026, 2, 7, "normalized", 3.0), ("s", 2026, 2, 7, "raw_count", 9.0)],
                                     "site_id STRING, year INT, month INT, weekday INT, value_type STRING, occupancy_value DOUBLE")
    assert [str(r.signal_date) for r in m.occupancy_rows(profiles).collect()] == ["2026-02-01"]
    assert m.occupancy_rows(profiles, every_matching_date=True).count() == 4


def test_empty_timeline_has_the_schema(spark):
    assert m.event_timeline(spark).columns[0] == "event_id" and m.event_timeline(spark).count() == 0


def test_index_is_bounded_and_renormalises(spark):
    days = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=i)) for s in ("erp", "iot") for i in range(60)]
    rows = [(site, day, *((i % 9, i % 3, i % 2, None, 0, 0) if site == "erp" else (0, 0, 0, float(50 + i % 13), i % 4, i % 2)))
            for i, (site, day) in enumerate(days)]
    daily = spark.createDataFrame(rows, "site_id STRING, signal_date DATE, alarm_count BIGINT, fire_alarm_count BIGINT, hvac_alarm_count BIGINT, "
                                        "electricity_kwh DOUBLE, incident_count BIGINT, unresolved_incident_count BIGINT")
    out = reliability_index(daily).collect()
    assert len(out) == 120
    values = [r.reliability_risk_index for r in out]
    assert all(v is not None and 0 <= v <= 100 for v in values)
    assert all(r.energy_anomaly is None and r.incident_pressure is None for r in out if r.site_id == "erp")
    assert all(r.maintenance_risk is None and r.alarm_pressure is None for r in out if r.site_id == "iot")


@pytest.fixture(scope="module")
def queue(spark):
    kinds = ["Cleaning services"] * 10 + ["Repairs and maintenance electrical", "Winter maintenance of outdoor areas",
                                          "Periodic maintenance ventilation", "Security services", None, "Workplace and premises services"]
    rows = [(i, "s1", k, str(i % 6), i / 20.0, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i % 3 == 0) for i, k in enumerate(kinds)]
    scored = spark.createDataFrame(rows, "wo_no BIGINT, site_id STRING, work_type_eng STRING, priority_id_str STRING, "
                                         "breach_probability DOUBLE, work_started_at_utc TIMESTAMP, is_sla_violation BOOLEAN")
    return d.dispatch_queue(scored)


def test_assignment(queue):
    rows = d.assign_tasks(queue).collect()
    by_role = {r.work_type_eng: r.role for r in rows}
    assert by_role["Cleaning services"] == "Cleaner" and by_role[None] == "Technician"
    assert by_role["Repairs and maintenance electrical"] == "Electrician"
    assert all(r.assigned_to in CREW[r.role] for r in rows)
    cleaners = [r.assigned_to for r in rows if r.role == "Cleaner"]
    assert sorted(cleaners.count(c) for c in CREW["Cleaner"]) == [5, 5]


def test_assignment_is_greedy_least_loaded(queue):
    """Dealing in turn equals giving each job to the least-loaded member in order."""
    got = {r.wo_no: r.assigned_to for r in d.assign_tasks(queue).collect()}
    load = {w: 0 for members in CREW.values() for w in members}
    for r in sorted(d.assign_tasks(queue).collect(), key=lambda r: (-r.breach_risk_pct, r.wo_no)):
        worker = min(CREW[r.role], key=lambda w: load[w])
        load[worker] += 1
        assert got[r.wo_no] == worker


def test_assignment_agrees_for_one_site(queue):
    a = {r.wo_no: r.assigned_to for r in d.assign_tasks(queue).collect()}
    b = {r.wo_no: r.assigned_to for r in d.assign_tasks(queue, by=()).collect()}
    assert a == b


def test_roles_without_a_crew_share_the_fallback(spark):
    rows = [(i, "s", kind, 90.0 - i) for i, kind in enumerate(["Security services", "Repairs and maintenance electrical",
                                                              "Winter maintenance", "Cleaning services"])]
    df = spark.createDataFrame(rows, "wo_no INT, site_id STRING, work_type_eng STRING, breach_risk_pct DOUBLE")
    got = {r.wo_no: r.assigned_to for r in d.assign_tasks(df, {"Cleaner": ["c"], "Technician": ["t1", "t2"]}).collect()}
    assert got == {0: "t1", 1: "t2", 2: "t1", 3: "c"}
    assert {r.assigned_to for r in d.assign_tasks(df, {"Technician": ["t"]}).collect()} == {"t"}
    assert {r.assigned_to for r in d.assign_tasks(df, {"Technician": []}).collect()} == {None}


def test_queue_keeps_all_rows(queue, spark):
    assert queue.count() == 16 and [r.queue_rank for r in queue.orderBy("queue_rank").collect()] == list(range(1, 17))


def test_cleaning_priority(spark):
    days = [dt.date(2024, 1, i) for i in range(1, 7)]
    use = {"busy": [90, 90, 90, 90, 90, 90], "broken": [50, 50, None, 20, 30, 40], "absent_today": [80, 80, 80, 80, 80, "gone"], "idle": [0, 0, 0, 0, 0, 5]}
    rows = [(room, day, None if v is None else float(v)) for room, vs in use.items() for day, v in zip(days, vs) if v != "gone"]
    df = spark.createDataFrame(rows, "asset_name STRING, utilization_date DATE, utilization_pct DOUBLE")
    got = {r.room: r for r in d.cleaning_priority(df).collect()}
    assert (got["busy"].accumulation_days, got["busy"].urgency_score, got["busy"].recommendation) == (5, 92.0, "CLEAN")
    assert (got["broken"].accumulation_days, got["broken"].urgency_score) == (2, 37.0)
    assert (got["absent_today"].today_pct, got["absent_today"].rolling_3d_mean, got["absent_today"].accumulation_days) == (0.0, 53.3, 5)
    assert got["idle"].recommendation == "SKIP"
    early = {r.room: r for r in d.cleaning_priority(df, target=F.lit("2024-01-02").cast("date")).collect()}
    assert early["busy"].accumulation_days == 1 and early["busy"].rolling_3d_mean == 90.0
    streaks = {r.asset_name: r.streak for r in use_streaks(df, "asset_name", "utilization_date", "utilization_pct", F.lit("2024-01-06").cast("date"), 10.0).collect()}
    assert streaks == {"busy": 5, "broken": 2, "absent_today": 5}


def test_calendar(spark, queue):
    index = spark.createDataFrame(
        [("s1", dt.date(2023, 6, 5) + dt.timedelta(days=i), 75.0) for i in range(40)] + [("s1", dt.date(2024, 5, 30), 90.0)],
        "site_id STRING, signal_date DATE, reliability_risk_index DOUBLE")
    portfolio = d.portfolio_today(index)
    today = F.lit("2024-05-30").cast("date")
    rows = d.maintenance_calendar(portfolio, queue, index, today).collect()
    kinds = {k: [r for r in rows if r.kind == k] for k in ("inspection", "work order", "risk window")}
    assert [str(r.start_date) for r in kinds["inspection"]] == ["2024-05-31"]
    starts = sorted(r.start_date for r in kinds["work order"])
    assert starts[0] == dt.date(2024, 5, 31) and all(day.weekday() < 5 for day in starts) and len(set(starts)) == len(starts)
    assert all(r.start_date.weekday() == 0 and (r.end_date - r.start_date).days == 5 for r in kinds["risk window"])
    assert len(kinds["risk window"]) == 4


def test_site_reliability_includes_the_boundary_day(spark):
    columns = ["maintenance_risk", "alarm_pressure", "energy_anomaly", "incident_pressure"]
    index = spark.createDataFrame([("a", dt.date(2024, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(60)],
                                  "site_id STRING, signal_date DATE, reliability_risk_index DOUBLE").withColumns({c: F.lit(0.0) for c in columns})
    assert s.site_reliability(index, "a", 30).count() == 31
    assert s.site_reliability(index, "nobody").count() == 0


def test_leakage_guard(spark):
    df = spark.createDataFrame([(1, 2.0)], "wo_no INT, worktime_hours DOUBLE")
    with pytest.raises(f.LeakageError):
        f.assert_no_leakage(df, ["site_id"])
    with pytest.raises(f.LeakageError):
        f.assert_no_leakage(df.drop("worktime_hours"), ["worktime_hours"])


def test_time_split_is_chronological_disjoint_complete(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i // 40)) for i in range(1001)]
    df = spark.createDataFrame(rows, "wo_no BIGINT, work_started_at_utc TIMESTAMP")
    train, test = f.time_split(df)
    assert train.count() == 801 and test.count() == 200
    assert f.shared_ids(train, test).count() == 0
    assert train.agg(F.max("work_started_at_utc")).first()[0] <= test.agg(F.min("work_started_at_utc")).first()[0]


def test_feature_matrix_keeps_columns_with_enough_values(spark):
    rows = [("a", dt.date(2024, 1, i + 1), float(i), None if i > 1 else 5.0) for i in range(10)]
    df = spark.createDataFrame(rows, "site_id STRING, signal_date DATE, x DOUBLE, y DOUBLE")
    out = f.site_feature_matrix(df, ["x", "y"]).collect()
    assert all(r.usable == ["x"] and r.y is None for r in out)


def test_as_of_context_reaches_back_to_the_last_day(spark):
    from evenkeel.operators.joins import as_of_context

    orders = spark.sql("""SELECT * FROM VALUES (1, 's', TIMESTAMP '2024-01-05 10:00'), (2, 's', TIMESTAMP '2024-01-05 23:00'),
        (3, 's', TIMESTAMP '2024-03-01 00:00'), (4, 's', TIMESTAMP '2024-01-01 09:00'), (5, 't', TIMESTAMP '2024-01-05 10:00'),
        (6, NULL, TIMESTAMP '2024-01-05 10:00'), (7, 's', NULL), (8, 's', TIMESTAMP '2024-01-06 10:00') AS o(id, site_id, at)""")
    daily = spark.sql("""SELECT * FROM VALUES ('s', DATE '2024-01-01', 1), ('s', DATE '2024-01-05', CAST(NULL AS INT)),
        ('s', DATE '2024-02-01', 3), ('u', DATE '2024-01-01', 9) AS d(site_id, signal_date, n)""")
    out = as_of_context(orders, daily, "at", {"last_n": "n"})
    assert out.columns == ["id", "site_id", "at", "last_n"]
    assert {r.id: r.last_n for r in out.collect()} == {1: 1, 2: 1, 3: 3, 4: None, 5: None, 6: None, 7: None, 8: None}
    assert as_of_context(orders, daily.where("false"), "at", {"last_n": "n"}).where("last_n IS NULL").count() == 8
