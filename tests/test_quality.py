"""Checks: pass and fail counts, severities, quarantine, rerun comparison."""

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import quality as q
from evenkeel.operators.quality import Check


def run(df, *checks, references=None):
    return {r.check_id: r for r in q.run_checks(df, "silver", "t", checks, references).collect()}


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1, "a", 0.0, "site_a"), (1, "b", 50.0, None), (2, None, 101.0, "site_x")],
                                 "k INT, t STRING, pct DOUBLE, site_id STRING")


def test_unique(numbers):
    r = run(numbers, Check("u", "unique", ("k",)), Check("ok", "unique", ("k", "pct")))
    assert not r["u"].passed and r["u"].failed_count == 2 and r["ok"].passed
    assert q.failing_rows(numbers, Check("u", "unique", ("k",))).count() == 2


def test_null_keys_are_duplicates_too(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k INT")
    assert run(df, Check("u", "unique", ("k",)))["u"].failed_count == 2
    assert q.failing_rows(df, Check("u", "unique", ("k",))).count() == 2


def test_enum(spark):
    df = spark.createDataFrame([(1,), (99,), (42,), (None,)], "p INT")
    r = run(df, Check("e", "enum", ("p",), options={"allowed": q.ALARM_PRIORITIES}))["e"]
    assert not r.passed and r.failed_count == 1


def test_range(numbers):
    r = run(numbers, Check("r", "range", ("pct",), options={"low": 0.0, "high": 100.0}))["r"]
    assert not r.passed and r.failed_count == 1


def test_missing_column_is_skipped_or_fails(numbers):
    r = run(numbers, Check("e", "enum", ("gone",), options={"allowed": (1,)}), Check("q", "required", ("k", "gone")),
            Check("m", "mapping", ("gone",), options={"min_rate": 0.9, "strict": True}))
    assert r["e"].passed and not r["q"].passed and not r["m"].passed


def test_mapping(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "site_id STRING")
    r = run(df, Check("m", "mapping", ("site_id",), options={"min_rate": 0.99}))["m"]
    assert not r.passed and r.actual == 50.0 and r.failed_count == 2


def test_mapping_of_absent_source_is_a_warning(spark):
    df = spark.createDataFrame([("a", "x")], "site_id STRING, source_system STRING")
    r = run(df, Check("m", "mapping", ("site_id",), options={"min_rate": 0.99, "source": "y"}))["m"]
    assert r.passed and r.severity == "warning"


def test_a_missing_reference_table_fails(numbers):
    r = run(numbers, Check("f", "reference", ("site_id",), options={"table": "dim_site"}))["f"]
    assert not r.passed and "missing" in r.message


def test_reference(spark, numbers):
    sites = spark.createDataFrame([("site_a",)], "site_id STRING")
    check = Check("f", "reference", ("site_id",), options={"table": "dim_site"})
    r = run(numbers, check, references={"dim_site": sites})["f"]
    assert not r.passed and r.failed_count == 1 and r.total_count == 2
    assert q.failing_rows(numbers, check, {"dim_site": sites}).count() == 1
    empty = numbers.withColumn("site_id", F.lit(None).cast("string"))
    r = run(empty, check, references={"dim_site": sites})["f"]
    assert r.passed and r.severity == "warning"


def test_required(numbers):
    r = run(numbers, Check("q", "required", ("k", "t")))["q"]
    assert not r.passed and r.failed_count == 1


def test_email_scan(spark):
    df = spark.createDataFrame([("user@example.com", 1), ("[NAME]", 2), (None, 3)], "t STRING, n INT")
    assert run(df, Check("p", "pii"))["p"].failed_count == 1


def test_conditional_range(spark):
    df = spark.createDataFrame([("normalized", 11.0), ("raw_count", -1.0), ("raw_count", 500.0), ("normalized", 10.0)],
                               "value_type STRING, occupancy_value DOUBLE")
    r = run(df, Check("c", "kind_range", ("occupancy_value",), options={"kind": "value_type"}))["c"]
    assert not r.passed and r.failed_count == 2


def test_row_count(spark):
    check = lambda n: Check("n", "row_count", options={"rows": n, "tolerance": 0.005})
    assert run(spark.range(18702), check(18702))["n"].passed
    assert not run(spark.range(100), check(18702))["n"].passed
    assert run(spark.range(0), check(0))["n"].passed


def test_literal_nulls(spark):
    df = spark.createDataFrame([("NULL", 1), ("x", 2)], "t STRING, n INT")
    assert run(df, Check("l", "literal_null"))["l"].failed_count == 1


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "k INT, t STRING, site_id STRING")
    r = run(df, Check("u", "unique", ("k",)), Check("q", "required", ("k",)), Check("p", "pii"),
            Check("m", "mapping", ("site_id",), options={"min_rate": 0.9}))
    assert all(x.passed for x in r.values())


def test_one_scan_for_all_count_checks(numbers):
    checks = [Check(f"r{i}", "range", ("pct",), options={"low": 0.0, "high": float(i)}) for i in range(20)]
    plan = q.run_checks(numbers, "silver", "t", checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_overall_and_missing_table(spark, numbers):
    results = q.run_layer(spark, "silver", {"t": numbers, "gone": None},
                          {"t": [Check("w", "unique", ("k",), "warn")], "gone": [Check("x", "unique", ("k",))]})
    verdict = q.overall(results).first()
    assert (verdict.overall, verdict.errors, verdict.warnings) == ("FAIL", 1, 1)
    only_warning = q.overall(results.where("table_name = 't'")).first()
    assert only_warning.overall == "PASS"


def test_idempotency(spark, numbers):
    before = q.content_snapshot({"t": numbers})
    assert q.idempotency(before, q.content_snapshot({"t": numbers.repartition(4)}), ("row_count", "content_hash")).count() == 0
    changed = q.content_snapshot({"t": numbers.withColumn("pct", F.col("pct") + 1)})
    assert q.idempotency(before, changed).count() == 0
    assert q.idempotency(before, changed, ("content_hash",)).count() == 1


def test_specs_cover_all_marts():
    assert set(q.GOLD_SPECS) == {"site_daily_signals", "event_timeline", "fact_work_order", "site_rolling_context"}
    assert len(q.SILVER_SPECS) == 9


def test_unknown_criterion():
    with pytest.raises(ValueError):
        q.criterion({"id": "x", "table": "t"})
