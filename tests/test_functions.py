"""Scalar expressions: the cleaning cases of messy exports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from evenkeel import functions as x


def values(spark, expression, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i INT, v STRING")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_bom_blank_and_null_literals(spark):
    rows = ["﻿a", "  b \t", "NULL", " null", "None", "none", "", "   ", None, "0"]
    assert values(spark, x.clean_null, rows) == ["a", "b", None, None, None, None, None, None, None, "0"]


def test_mojibake_is_repaired_and_leftovers_flagged(spark):
    rows = ["LentokentÃ¤nkatu", "Määrä", "â€œ", None]
    assert values(spark, x.repair_mojibake, rows)[:2] == ["Lentokentänkatu", "Määrä"]
    assert values(spark, lambda c: x.has_mojibake(x.repair_mojibake(c)), rows) == [False, False, True, None]
    with pytest.raises(Exception, match="unrecoverable"):
        values(spark, lambda c: x.repair_mojibake(c, strict=True), rows)


def test_booleans(spark):
    rows = ["TOSI", "EPÄTOSI", "EPATOSI", "1", "0", "yes", "NO", "NULL", "maybe"]
    assert values(spark, x.parse_bool, rows) == [True, False, False, True, False, True, False, None, None]
    with pytest.raises(Exception, match="maybe"):
        values(spark, lambda c: x.parse_bool(c, strict=True), rows)


def test_numbers(spark):
    assert values(spark, x.parse_int, ["5701.0", "5701", "NULL", "x", " 7 "]) == [5701, 5701, None, None, 7]
    assert values(spark, x.parse_float, ["1,5", "2.25", "", "n/a"]) == [1.5, 2.25, None, None]
    assert values(spark, x.parse_finished_days, ["2.16.00", "3.5", "7", "1,5", None]) == [2.16, 3.5, 7.0, 1.5, None]


def test_timestamps(spark):
    rows = ["2019-12-02 10:00:00.123", "2019-12-02 10:00:00", "2.12.2019 10:00", "02.12.2019 9:05:07", "junk", "2019-12-02"]
    got = values(spark, x.parse_local_timestamp, rows)
    assert got[0] == dt.datetime(2019, 12, 2, 10, 0, 0, 123000)
    assert got[1:4] == [dt.datetime(2019, 12, 2, 10), dt.datetime(2019, 12, 2, 10), dt.datetime(2019, 12, 2, 9, 5, 7)]
    assert got[4:] == [None, None]


def test_local_to_utc_has_daylight_saving(spark):
    rows = ["2024-01-15 12:00:00", "2024-07-15 12:00:00", "2024-10-27 03:30:00"]
    got = values(spark, lambda c: x.local_to_utc(x.parse_local_timestamp(c)), rows)
    # an hour that occurs twice is its first occurrence
    assert got == [dt.datetime(2024, 1, 15, 10), dt.datetime(2024, 7, 15, 9), dt.datetime(2024, 10, 27, 0, 30)]


def test_dates(spark):
    rows = ["2024-03-01", "1.3.2024", "2024-03-01 10:00:00", "1.3.2024 10:00", "x"]
    assert values(spark, x.parse_date, rows) == [dt.date(2024, 3, 1)] * 4 + [None]


def test_offset_timestamps(spark):
    rows = ["2021-02-10 12:00:00+00", "2021-02-10T12:05:00+00:00", "2021-02-10 14:00:00+02:00", "2021-02-10 12:00:00"]
    noon = dt.datetime(2021, 2, 10, 12)
    assert values(spark, x.parse_offset_timestamp, rows) == [noon, noon.replace(minute=5), noon, noon]


def test_surrogate_key_counts_nulls(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, "b")], "p STRING, q STRING, r STRING")
    expected = hashlib.sha256(b"a|None|b").hexdigest()[:16]
    assert df.select(x.surrogate_key("p", "q", "r")).first()[0] == expected


def test_file_names(spark):
    names = ["North_House_2026-05-27_123944-normalized.json", "South_Plaza_20260527.json", "other.json"]
    assert values(spark, lambda c: x.building_of_file(c, ["North House", "South Plaza"]), names) == ["North House", "South Plaza", None]
    assert values(spark, x.occupancy_kind_of_file, names) == ["normalized", "raw_count", "raw_count"]
    assert values(spark, x.range_end_of_file, ["Room_Utilization_010124-270524.csv", "x.csv"]) == [dt.date(2024, 5, 27), None]
    fallback = F.lit("2020-01-01").cast("date")
    assert values(spark, lambda c: x.file_export_date(c, fallback), names) == [dt.date(2026, 5, 27)] * 2 + [dt.date(2020, 1, 1)]


@pytest.mark.parametrize("start", [dt.date(2024, 5, d) for d in range(1, 15)])
def test_business_days_match_stepping(spark, start):
    def step(day, n):
        while n:
            day += dt.timedelta(days=1)
            n -= day.weekday() < 5
        return day

    rows = spark.range(13).select(x.nth_business_day(F.lit(start), F.col("id")).alias("d")).collect()
    assert [r.d for r in rows] == [step(start, n) for n in range(13)]


def test_first_weekday_of_month(spark):
    days = [(2025, 12, 1), (2026, 2, 7), (2026, 5, 5)]
    df = spark.createDataFrame(days, "y INT, m INT, w INT").select(x.first_weekday_of_month("y", "m", "w").alias("d"))
    assert [r.d for r in df.collect()] == [dt.date(2025, 12, 1), dt.date(2026, 2, 1), dt.date(2026, 5, 1)]


def test_bands_and_bins(spark):
    df = spark.createDataFrame([(0.66,), (0.45,), (0.1,), (None,), (float("nan"),)], "p DOUBLE")
    assert [r[0] for r in df.select(x.risk_band("p")).collect()][:3] == ["HIGH", "MEDIUM", "LOW"]
    assert [r[0] for r in df.select(x.probability_label("p")).collect()][3:] == ["no model", "no model"]
    edges = spark.createDataFrame([(0.3,), (0.7,), (1.0,), (0.0,)], "p DOUBLE")
    # 0.3 lies just below the grid's 0.30000000000000004
    assert [r[0] for r in edges.select(x.equal_bin("p")).collect()] == [2, 6, 9, 0]


def test_severity_table():
    table = x.work_type_severity("Brand")
    assert len(table) == 39
    assert table["Repairs and maintenance Brand"] == table["Brand building automation"] == "Medium"


def test_action_matrix(spark):
    cases = [("Critical", "HIGH", "Urgent"), ("Critical", "MEDIUM", "Urgent"), ("Critical", "LOW", "Monitor"),
             ("High", "HIGH", "Urgent"), ("High", "MEDIUM", "Monitor"), ("Medium", "HIGH", "Monitor"),
             ("Medium", "LOW", "Low priority"), ("Low", "HIGH", "Monitor"), ("Low", "MEDIUM", "Low priority"),
             ("own text", "LOW", "Monitor")]
    df = spark.createDataFrame(cases, "s STRING, r STRING, want STRING")
    assert df.where(x.dispatch_action("s", "r") != F.col("want")).count() == 0


def test_half_even_is_numpys(spark):
    import numpy as np

    numbers = [0.05, 0.15, 0.25, 2.5, 3.5, 54.949999999999996, -1.25]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i INT, n DOUBLE").orderBy("i")
    assert [r[0] for r in df.select(x.half_even("n", 1)).collect()] == [float(v) for v in np.round(numbers, 1)]
