"""Daily site signals, event timeline, rolling context and the severity fact.

``daily_signals`` is one union of long rows and one aggregation by site and day:
the shuffle carries partial sums, and no partial results are joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.functions import (
    ALARM_SEVERITY, INCIDENT_SEVERITY, code_lookup, first_weekday_of_month, matches_class, prefixed_id, severity_of,
)
from evenkeel.operators.intervals import open_by_expansion, open_by_sweep
from evenkeel.operators.rolling import rolling
from evenkeel.sources.contracts import TIMELINE_SCHEMA

# --- fixed values: alarm classes, metric roles, mart columns ---------------------
FIRE_TYPES = ("PALO", "PALOVIK")
HVAC_TYPES = ("LVIS", "LVIA", "Lvi-häly", "LINJAVIK")
FIRE_PRIORITY = 1
DESK_PATTERN = r"(?i)^K\d+$"
METRIC_MEANS = {"avg_co2_ppm": "interior_co2_ppm", "avg_indoor_temp_c": "interior_temperature_C"}
METRIC_SUMS = {"electricity_kwh": "electricity_kWh", "heating_mwh": "district_heating_MWh"}
COUNT_COLUMNS = (
    "alarm_count", "fire_alarm_count", "hvac_alarm_count", "open_work_orders", "sla_violations",
    "incident_count", "unresolved_incident_count",
)
MEAN_COLUMNS = (
    "avg_co2_ppm", "avg_indoor_temp_c", "avg_room_utilization_pct", "avg_desk_utilization_pct",
    "avg_elevator_occupancy",
)
SUM_COLUMNS = ("electricity_kwh", "heating_mwh")
ROLLING_MEANS = {
    "open_wo_7d_avg": "open_work_orders", "alarms_7d_avg": "alarm_count", "utilization_7d_avg": "avg_room_utilization_pct",
}
ROLLING_SUMS = {
    "sla_violations_7d": "sla_violations", "fire_alarms_7d": "fire_alarm_count", "incidents_7d": "incident_count",
}
# ---------------------------------------------------------------------------------
KEYS = ("site_id", "signal_date")


def _one(condition: Column | None = None) -> Column:
    """A row's contribution to a count; a null condition contributes nothing."""
    one = F.lit(1).cast("bigint")
    return one if condition is None else F.when(condition, one).otherwise(F.lit(0).cast("bigint"))


# each contributor maps source rows to (site, day, measures …) ----------------------
def alarm_rows(alarms: DataFrame, fire: Sequence[str] = FIRE_TYPES, hvac: Sequence[str] = HVAC_TYPES,
               fire_priority: int = FIRE_PRIORITY, time: str = "event_time_utc") -> DataFrame:
    kind = F.col("alert_type")
    return alarms.select(
        "site_id", F.to_date(time).alias("signal_date"), _one().alias("alarm_count"),
        _one(kind.isin(*fire) | (F.col("priority") == fire_priority)).alias("fire_alarm_count"),
        _one(kind.isin(*hvac)).alias("hvac_alarm_count"))


def violation_rows(orders: DataFrame, finished: str = "work_finished_at_utc") -> DataFrame:
    return orders.where("is_sla_violation").select(
        "site_id", F.to_date(finished).alias("signal_date"), _one().alias("sla_violations"))


def open_order_rows(orders: DataFrame, started: str = "work_started_at_utc", finished: str = "work_finished_at_utc",
                    expand: bool = False) -> DataFrame:
    dated = orders.where(F.col("site_id").isNotNull()).select(
        "site_id", F.to_date(started).alias("_from"), F.to_date(finished).alias("_to"))
    count = open_by_expansion if expand else open_by_sweep
    return count(dated, ["site_id"], "_from", "_to", "signal_date", "open_work_orders")


def work_order_rows(orders: DataFrame, started: str = "work_started_at_utc",
                    finished: str = "work_finished_at_utc") -> DataFrame:
    """Open orders and violations per site and day from one pass over the orders.

    An order is a step up on its start day, a step down the day after its finish,
    and a violation on its finish day. Steps are combined per site and day on the
    map side; the running sum sees at most one row a site and day. A run of days
    with open orders is spelt out, a violation stays on its own day.
    """
    first, last = F.to_date(started), F.to_date(finished)
    valid = first <= last
    step = lambda day, up, bad: F.struct(day.alias("_day"), F.lit(up).cast("bigint").alias("_step"),
                                         F.lit(bad).cast("bigint").alias("_bad"))
    # a step that does not happen has no day
    steps = F.array(step(F.when(valid, first), 1, 0), step(F.when(valid, F.date_add(last, 1)), -1, 0),
                    step(F.when(F.col("is_sla_violation"), last), 0, 1))
    changes = orders.where(F.col("site_id").isNotNull()).select("site_id", F.inline(steps)).where(
        F.col("_day").isNotNull()).groupBy("site_id", "_day").agg(F.sum("_step").alias("_step"), F.sum("_bad").alias("_bad"))
    along = W.partitionBy("site_id").orderBy("_day")
    runs = changes.select(
        "site_id", "_day", "_bad", F.sum("_step").over(along.rowsBetween(W.unboundedPreceding, 0)).alias("open_work_orders"),
        F.lead("_day").over(along).alias("_next"))
    days = F.when(F.col("open_work_orders") > 0, F.sequence("_day", F.date_sub("_next", 1))).otherwise(F.array("_day"))
    spelt = runs.where("open_work_orders > 0 OR _bad > 0").select(
        "site_id", F.explode(days).alias("signal_date"), "open_work_orders", "_day", "_bad")
    return spelt.select("site_id", "signal_date", "open_work_orders",
                        F.when(F.col("signal_date") == F.col("_day"), F.col("_bad")).otherwise(F.lit(0)).alias("sla_violations"))


def reading_rows(readings: DataFrame, means: Mapping[str, str] = METRIC_MEANS, sums: Mapping[str, str] = METRIC_SUMS,
                 time: str = "timestamp_utc") -> DataFrame:
    """All metrics in one pass; rows of other metrics are filtered at the scan."""
    wanted = {**means, **sums}
    picked = [F.when(F.col("metric") == metric, F.col("value")).alias(name) for name, metric in wanted.items()]
    return readings.where(F.col("metric").isin(*wanted.values())).select(
        "site_id", F.to_date(time).alias("signal_date"), *picked)


def utilization_rows(use: DataFrame, desk: str = DESK_PATTERN) -> DataFrame:
    is_desk = matches_class("asset_name", desk)
    return use.select(
        "site_id", F.col("utilization_date").alias("signal_date"),
        F.when(~is_desk, F.col("utilization_pct")).alias("avg_room_utilization_pct"),
        F.when(is_desk, F.col("utilization_pct")).alias("avg_desk_utilization_pct"))


def occupancy_rows(profiles: DataFrame, every_matching_date: bool = False) -> DataFrame:
    """Normalised profiles on the first matching weekday of their month, or on all."""
    used = profiles.where(F.col("value_type") == "normalized")
    first = first_weekday_of_month("year", "month", "weekday")
    if every_matching_date:
        day = F.explode(F.sequence(first, F.last_day(first), F.expr("INTERVAL 7 DAYS")))
    else:
        day = first
    return used.select("site_id", day.alias("signal_date"), F.col("occupancy_value").alias("avg_elevator_occupancy"))


def incident_rows(incidents: DataFrame, created: str = "created_at_utc") -> DataFrame:
    return incidents.select("site_id", F.to_date(created).alias("signal_date"), _one().alias("incident_count"),
                            _one(~F.col("is_resolved")).alias("unresolved_incident_count"))


def aggregate_rows(parts: Sequence[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """Sum counts and sums, average means; columns no part has are left out."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    how = {**{c: F.sum for c in (*COUNT_COLUMNS, *SUM_COLUMNS)}, **{c: F.avg for c in MEAN_COLUMNS}}
    return union.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(
        *[how.get(c, F.sum)(c).alias(c) for c in union.columns if c not in keys])


def daily_signals(alarms: DataFrame | None = None, orders: DataFrame | None = None, readings: DataFrame | None = None,
                  use: DataFrame | None = None, occupancy: DataFrame | None = None, incidents: DataFrame | None = None,
                  as_of: Column | None = None, **options) -> DataFrame:
    """One row a site and UTC day over whatever sources there are.

    Counts are zero where a source says nothing, metrics stay null; all columns
    are there even if a source is absent.
    """
    pick = lambda *names: {n: options[n] for n in names if n in options}
    parts = []
    if alarms is not None:
        parts.append(alarm_rows(alarms, **pick("fire", "hvac", "fire_priority")))
    if orders is not None:
        parts.append(work_order_rows(orders))
    if readings is not None:
        parts.append(reading_rows(readings, **pick("means", "sums")))
    if use is not None:
        parts.append(utilization_rows(use, **pick("desk")))
    if occupancy is not None:
        parts.append(occupancy_rows(occupancy, **pick("every_matching_date")))
    if incidents is not None:
        parts.append(incident_rows(incidents))
    daily = aggregate_rows(parts)
    have = set(daily.columns)
    counts = [F.coalesce(F.col(c) if c in have else F.lit(None).cast("bigint"), F.lit(0)).cast("bigint").alias(c)
              for c in COUNT_COLUMNS]
    values = [(F.col(c) if c in have else F.lit(None)).cast("double").alias(c) for c in (*MEAN_COLUMNS, *SUM_COLUMNS)]
    return daily.select(*KEYS, *counts, *values, (F.current_date() if as_of is None else as_of).alias("as_of_date"))


def rolling_context(daily: DataFrame, days: int = 7, calendar: bool = False) -> DataFrame:
    """Trailing means and sums per site: rows by default, calendar days on request."""
    rolled = rolling(daily, ["site_id"], "signal_date", days, ROLLING_MEANS, ROLLING_SUMS, calendar)
    return rolled.select("site_id", F.col("signal_date").alias("as_of_date"), *ROLLING_MEANS, *ROLLING_SUMS)


def with_severity(orders: DataFrame, table: Mapping[str, str] | None = None, unmatched: str = "keep",
                  work_type: str = "work_type_eng") -> DataFrame:
    return orders.withColumn("severity", severity_of(work_type, table, unmatched))


# ---------------------------------------------------------------- timeline
def _text(c: Column) -> Column:
    return c.cast("string")


def alarm_events(alarms: DataFrame, source: str = "erp_alarms", codes: Mapping = ALARM_SEVERITY) -> DataFrame:
    kind = F.col("alert_type")
    return alarms.select(
        prefixed_id("alarm:", "alert_event_id").alias("event_id"), "site_id", F.lit(None).cast("string").alias("asset_id"),
        F.when(kind.isNotNull(), F.concat(F.lit("alarm_"), kind)).otherwise("alarm").alias("event_type"),
        code_lookup("priority", codes, "standard").alias("severity"), F.col("event_time_utc").alias("timestamp_utc"),
        F.col("event_description").alias("description"), F.lit(source).alias("source_system"),
        _text(F.col("alert_event_id")).alias("source_record_id"))


def work_order_events(orders: DataFrame, source: str = "erp_work_orders") -> DataFrame:
    """A started and a finished event from one pass over the orders."""
    priority = F.col("priority_id")
    started = F.struct(
        prefixed_id("wo:", "wo_no", ":started").alias("event_id"), F.lit("work_order_started").alias("event_type"),
        F.when(priority.isNotNull(), prefixed_id("priority_", priority)).otherwise("standard").alias("severity"),
        F.col("work_started_at_utc").alias("timestamp_utc"), F.col("work_order_description").alias("description"))
    finished = F.struct(
        prefixed_id("wo:", "wo_no", ":finished").alias("event_id"), F.lit("work_order_finished").alias("event_type"),
        F.when(F.col("is_sla_violation"), "sla_violation").otherwise("completed").alias("severity"),
        F.col("work_finished_at_utc").alias("timestamp_utc"),
        F.coalesce("work_order_performed_action", "work_order_description").alias("description"))
    events = orders.select("site_id", _text(F.col("wo_no")).alias("source_record_id"), F.inline(F.array(started, finished)))
    return events.select(
        "event_id", "site_id", F.lit(None).cast("string").alias("asset_id"), "event_type", "severity", "timestamp_utc",
        "description", F.lit(source).alias("source_system"), "source_record_id")


def incident_events(incidents: DataFrame, source: str = "building_automation",
                    codes: Mapping = INCIDENT_SEVERITY) -> DataFrame:
    return incidents.select(
        prefixed_id("incident:", "incident_id").alias("event_id"), "site_id", F.col("node_id").alias("asset_id"),
        "event_type", code_lookup("priority", codes, "standard").alias("severity"),
        F.col("created_at_utc").alias("timestamp_utc"), "description", F.lit(source).alias("source_system"),
        _text(F.col("incident_id")).alias("source_record_id"))


def event_timeline(spark: SparkSession, alarms: DataFrame | None = None, orders: DataFrame | None = None,
                   incidents: DataFrame | None = None) -> DataFrame:
    """Union of all events in one schema, which an empty result has too.

    Unsorted: write it with ``sort_by=["site_id", "timestamp_utc"]``.
    """
    parts = []
    if alarms is not None:
        parts.append(alarm_events(alarms))
    if orders is not None:
        parts.append(work_order_events(orders))
    if incidents is not None:
        parts.append(incident_events(incidents))
    if not parts:
        return spark.createDataFrame([], TIMELINE_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), parts)
