"""Daily marts, timeline, rolling context and their parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.catalogue.registry import Tables, query, rounded, shared
from evenkeel.operators.intervals import open_by_expansion, open_by_sweep
from evenkeel.operators.joins import full_outer, fused_parts, key_spine, spine_with_parts
from evenkeel.plans import marts as m
from evenkeel.plans.reliability import breach_load, index_trend, reliability_index

KEYS = ["site_id", "signal_date"]


@query("daily_alarm_counts", "G1 C25", """
SELECT site_id, CAST(event_time_utc AS DATE) AS signal_date, count(*) AS alarm_count,
       count(*) FILTER (WHERE alert_type = 'error' OR priority = 1) AS fire_alarm_count,
       count(*) FILTER (WHERE alert_type IN ('click', 'view')) AS hvac_alarm_count
FROM alarms GROUP BY 1, 2""", ("alarms",))
def _(t: Tables):
    return m.aggregate_rows([m.alarm_rows(t.alarms(), ("error",), ("click", "view"))])


@query("open_orders_by_sweep", "G2 K10", """
SELECT site_id, signal_date, count(*) AS open_work_orders FROM open_daily GROUP BY 1, 2""", ("open_daily",))
def _(t: Tables):
    return m.open_order_rows(t.work_orders())


@query("open_orders_by_expansion", "G2", """
SELECT site_id, signal_date, count(*) AS open_work_orders FROM open_daily GROUP BY 1, 2""", ("open_daily",))
def _(t: Tables):
    return m.open_order_rows(t.work_orders(), expand=True)


@query("daily_sla_violations", "G3", """
SELECT site_id, CAST(work_finished_at_utc AS DATE) AS signal_date, count(*) AS sla_violations
FROM work_orders WHERE is_sla_violation GROUP BY 1, 2""", ("work_orders",))
def _(t: Tables):
    return m.aggregate_rows([m.violation_rows(t.work_orders())])


@query("daily_metrics", "G4", """
SELECT site_id, CAST(timestamp_utc AS DATE) AS signal_date,
       round(avg(value) FILTER (WHERE metric = 'interior_co2_ppm'), 8) AS avg_co2_ppm,
       round(avg(value) FILTER (WHERE metric = 'interior_temperature_C'), 8) AS avg_indoor_temp_c,
       round(sum(value) FILTER (WHERE metric = 'electricity_kWh'), 4) AS electricity_kwh,
       round(sum(value) FILTER (WHERE metric = 'district_heating_MWh'), 4) AS heating_mwh
FROM readings WHERE metric <> 'fault_count' GROUP BY 1, 2""", ("readings",))
def _(t: Tables):
    return rounded(m.aggregate_rows([m.reading_rows(t.readings())]), 8, electricity_kwh=4, heating_mwh=4)


@query("daily_utilization", "G5 C19", """
SELECT site_id, utilization_date AS signal_date,
       round(avg(utilization_pct) FILTER (WHERE NOT regexp_matches(trim(asset_name), '^[Kk][0-9]+$')), 8) AS avg_room_utilization_pct,
       round(avg(utilization_pct) FILTER (WHERE regexp_matches(trim(asset_name), '^[Kk][0-9]+$')), 8) AS avg_desk_utilization_pct
FROM room_use GROUP BY 1, 2""", ("room_use",))
def _(t: Tables):
    return rounded(m.aggregate_rows([m.utilization_rows(t.room_use())]), 8)


@query("monthly_occupancy_on_first_weekday", "G6 C15 T6", """
WITH profiles AS (
  SELECT 'site_' || CAST(c_nationkey % 7 AS VARCHAR) AS site_id, year(o_orderdate) AS y, month(o_orderdate) AS mo,
         isodow(o_orderdate) AS wd, o_totalprice AS occupancy_value, CASE WHEN o_orderkey % 2 = 0 THEN 'normalized' ELSE 'raw_count' END AS value_type
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT site_id, CAST(make_date(y, mo, 1) + to_days(CAST((wd - isodow(make_date(y, mo, 1)) + 7) % 7 AS INTEGER)) AS DATE) AS signal_date,
       round(avg(occupancy_value), 6) AS avg_elevator_occupancy
FROM profiles WHERE value_type = 'normalized' GROUP BY 1, 2""")
def _(t: Tables):
    o = t.read("orders").join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    day = F.col("o_orderdate")
    profiles = o.select(
        t.site("c_nationkey").alias("site_id"), F.year(day).alias("year"), F.month(day).alias("month"),
        (F.weekday(day) + 1).alias("weekday"), F.col("o_totalprice").alias("occupancy_value"),
        F.when(F.col("o_orderkey") % 2 == 0, "normalized").otherwise("raw_count").alias("value_type"))
    return rounded(m.aggregate_rows([m.occupancy_rows(profiles)]), 6)


@query("daily_incidents", "G7", """
SELECT site_id, CAST(created_at_utc AS DATE) AS signal_date, count(*) AS incident_count,
       count(*) FILTER (WHERE NOT is_resolved) AS unresolved_incident_count
FROM incidents GROUP BY 1, 2""", ("incidents",))
def _(t: Tables):
    return m.aggregate_rows([m.incident_rows(t.incidents())])


DAILY_SQL = """
SELECT site_id, signal_date, alarm_count, fire_alarm_count, hvac_alarm_count, open_work_orders, sla_violations,
       incident_count, unresolved_incident_count, round(avg_co2_ppm, 8) AS avg_co2_ppm, round(avg_indoor_temp_c, 8) AS avg_indoor_temp_c,
       round(avg_room_utilization_pct, 8) AS avg_room_utilization_pct, round(avg_desk_utilization_pct, 8) AS avg_desk_utilization_pct,
       round(electricity_kwh, 4) AS electricity_kwh, round(heating_mwh, 4) AS heating_mwh FROM daily"""


@query("site_daily_signals", "G8 J3 K21", DAILY_SQL, ("daily",))
def site_daily_signals(t: Tables):
    return rounded(t.daily(), 8, electricity_kwh=4, heating_mwh=4)


def _partials(t: Tables):
    alarms = m.aggregate_rows([m.alarm_rows(t.alarms(), ("error",), ("click", "view"))])
    incidents = m.aggregate_rows([m.incident_rows(t.incidents())])
    open_orders = m.open_order_rows(t.work_orders())
    return [alarms, incidents, open_orders]


PARTIALS_SQL = """
WITH a AS (SELECT site_id, CAST(event_time_utc AS DATE) AS signal_date, count(*) AS alarm_count,
           count(*) FILTER (WHERE alert_type = 'error' OR priority = 1) AS fire_alarm_count,
           count(*) FILTER (WHERE alert_type IN ('click', 'view')) AS hvac_alarm_count FROM alarms GROUP BY 1, 2),
     i AS (SELECT site_id, CAST(created_at_utc AS DATE) AS signal_date, count(*) AS incident_count,
           count(*) FILTER (WHERE NOT is_resolved) AS unresolved_incident_count FROM incidents GROUP BY 1, 2),
     o AS (SELECT site_id, signal_date, count(*) AS open_work_orders FROM open_daily GROUP BY 1, 2)
SELECT * FROM a FULL JOIN i USING (site_id, signal_date) FULL JOIN o USING (site_id, signal_date)"""


def _inline_with(body: str) -> str:
    """A body that has its own WITH, ready to stand behind shared tables."""
    return "SELECT * FROM (" + body + ")"


@query("partials_by_full_outer_join", "J2", _inline_with(PARTIALS_SQL), ("alarms", "incidents", "open_daily"))
def _(t: Tables):
    return full_outer(_partials(t), KEYS)


@query("partials_by_spine", "J3 U3", _inline_with(PARTIALS_SQL), ("alarms", "incidents", "open_daily"))
def _(t: Tables):
    return spine_with_parts(_partials(t), KEYS)


@query("partials_by_fused_union", "J2 J3", _inline_with(PARTIALS_SQL), ("alarms", "incidents", "open_daily"))
def _(t: Tables):
    return fused_parts(_partials(t), KEYS)


@query("key_spine", "U3", """
SELECT site_id, CAST(event_time_utc AS DATE) AS signal_date FROM alarms
UNION SELECT site_id, CAST(created_at_utc AS DATE) FROM incidents
UNION SELECT site_id, CAST(work_finished_at_utc AS DATE) FROM work_orders""", ("alarms", "incidents", "work_orders"))
def _(t: Tables):
    dated = lambda df, c: df.select("site_id", F.to_date(c).alias("signal_date"))
    return key_spine([dated(t.alarms(), "event_time_utc"), dated(t.incidents(), "created_at_utc"),
                      dated(t.work_orders(), "work_finished_at_utc")], KEYS)


TIMELINE_SQL = """
SELECT 'alarm:' || CAST(alert_event_id AS VARCHAR) AS event_id, site_id, CAST(NULL AS VARCHAR) AS asset_id,
       'alarm_' || alert_type AS event_type,
       CASE priority WHEN 1 THEN 'critical' WHEN 13 THEN 'high' WHEN 50 THEN 'medium' WHEN 60 THEN 'standard' WHEN 77 THEN 'high'
            WHEN 99 THEN 'informational' ELSE 'standard' END AS severity,
       event_time_utc AS timestamp_utc, event_description AS description, 'erp_alarms' AS source_system,
       CAST(alert_event_id AS VARCHAR) AS source_record_id FROM alarms
UNION ALL SELECT 'wo:' || CAST(wo_no AS VARCHAR) || ':started', site_id, NULL, 'work_order_started',
       CASE WHEN priority_id IS NULL THEN 'standard' ELSE 'priority_' || CAST(priority_id AS VARCHAR) END,
       work_started_at_utc, work_order_description, 'erp_work_orders', CAST(wo_no AS VARCHAR) FROM work_orders
UNION ALL SELECT 'wo:' || CAST(wo_no AS VARCHAR) || ':finished', site_id, NULL, 'work_order_finished',
       CASE WHEN is_sla_violation THEN 'sla_violation' ELSE 'completed' END, work_finished_at_utc,
       coalesce(work_order_performed_action, work_order_description), 'erp_work_orders', CAST(wo_no AS VARCHAR) FROM work_orders
UNION ALL SELECT 'incident:' || CAST(incident_id AS VARCHAR), site_id, node_id, event_type,
       CASE priority WHEN 'immediate' THEN 'critical' WHEN 'significant' THEN 'high' ELSE 'standard' END,
       created_at_utc, description, 'building_automation', CAST(incident_id AS VARCHAR) FROM incidents"""
shared("timeline", TIMELINE_SQL, "alarms", "work_orders", "incidents")


@query("event_timeline", "U2 C17 C33", "SELECT * FROM timeline", ("timeline",))
def event_timeline(t: Tables):
    return m.event_timeline(t.spark, t.alarms(), t.work_orders(), t.incidents())


@query("timeline_sorted", "L4", "SELECT event_id, site_id, timestamp_utc FROM timeline", ("timeline",))
def _(t: Tables):
    from evenkeel.operators.latest import sorted_by_key

    events = m.event_timeline(t.spark, t.alarms(), t.work_orders(), t.incidents())
    return sorted_by_key(events.select("event_id", "site_id", "timestamp_utc"), "site_id", "timestamp_utc")


@query("rolling_context", "W2 K1", """
SELECT site_id, as_of_date, round(open_wo_7d_avg, 6) AS open_wo_7d_avg, sla_violations_7d, round(alarms_7d_avg, 6) AS alarms_7d_avg,
       fire_alarms_7d, incidents_7d, round(utilization_7d_avg, 6) AS utilization_7d_avg FROM rolling_ctx""", ("rolling_ctx",))
def _(t: Tables):
    return rounded(m.rolling_context(t.daily()))


@query("rolling_context_calendar_days", "W2 K1", """
SELECT site_id, signal_date AS as_of_date, round(avg(open_work_orders) OVER w, 6) AS open_wo_7d_avg,
       CAST(sum(sla_violations) OVER w AS DOUBLE) AS sla_violations_7d, round(avg(alarm_count) OVER w, 6) AS alarms_7d_avg,
       CAST(sum(fire_alarm_count) OVER w AS DOUBLE) AS fire_alarms_7d, CAST(sum(incident_count) OVER w AS DOUBLE) AS incidents_7d,
       round(avg(avg_room_utilization_pct) OVER w, 6) AS utilization_7d_avg
FROM daily WINDOW w AS (PARTITION BY site_id ORDER BY signal_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""", ("daily",))
def _(t: Tables):
    return rounded(m.rolling_context(t.daily(), calendar=True))


@query("work_order_severity", "C18 K2", """
SELECT wo_no, site_id, work_type_eng, CASE work_type_eng WHEN 'Repairs and maintenance building automation' THEN 'High'
       WHEN 'Cleaning services' THEN 'Low' WHEN 'Periodic maintenance ventilation' THEN 'Medium'
       WHEN 'Security services' THEN 'Critical' ELSE work_type_eng END AS severity FROM work_orders""", ("work_orders",))
def _(t: Tables):
    return m.with_severity(t.work_orders()).select("wo_no", "site_id", "work_type_eng", "severity")


shared("breach_load", """
SELECT site_id, CAST(work_started_at_utc AS DATE) AS signal_date, avg(breach_probability) AS maintenance_risk_raw,
       sum(breach_probability) AS expected_breaches, count(*) AS n_work_orders FROM work_orders GROUP BY 1, 2""", "work_orders")
shared("index_raw", """
SELECT d.*, l.maintenance_risk_raw, l.n_work_orders,
       fire_alarm_count * 3 + hvac_alarm_count * 2 + greatest(alarm_count - fire_alarm_count - hvac_alarm_count, 0) AS alarm_raw,
       incident_count + 3 * unresolved_incident_count AS incident_raw,
       CASE WHEN count(electricity_kwh) OVER w >= 7 THEN quantile_cont(electricity_kwh, 0.5) OVER w END AS med
FROM daily d LEFT JOIN breach_load l USING (site_id, signal_date)
WINDOW w AS (PARTITION BY site_id ORDER BY signal_date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)""", "daily", "breach_load")
shared("index_dev", "SELECT *, abs(electricity_kwh - med) AS dev FROM index_raw", "index_raw")
shared("index_energy", """
SELECT *, dev / ((CASE WHEN count(dev) OVER w >= 7 THEN quantile_cont(dev, 0.5) OVER w END) + 1e-6) AS energy_raw
FROM index_dev WINDOW w AS (PARTITION BY site_id ORDER BY signal_date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)""", "index_dev")
shared("index_ends", """
SELECT site_id, quantile_cont(CAST(alarm_raw AS DOUBLE), 0.05) AS a_lo, quantile_cont(CAST(alarm_raw AS DOUBLE), 0.95) AS a_hi, count(alarm_raw) AS a_n,
       quantile_cont(energy_raw, 0.05) AS e_lo, quantile_cont(energy_raw, 0.95) AS e_hi, count(energy_raw) AS e_n,
       quantile_cont(CAST(incident_raw AS DOUBLE), 0.05) AS i_lo, quantile_cont(CAST(incident_raw AS DOUBLE), 0.95) AS i_hi, count(incident_raw) AS i_n
FROM index_energy GROUP BY site_id""", "index_energy")
shared("index_parts", """
SELECT site_id, signal_date, n_work_orders, alarm_count, electricity_kwh, incident_count,
       CASE WHEN maintenance_risk_raw IS NOT NULL THEN least(greatest(maintenance_risk_raw, 0.0), 1.0) END AS maintenance_risk,
       CASE WHEN a_n >= 5 AND a_hi - a_lo >= 1e-9 THEN least(greatest((alarm_raw - a_lo) / (a_hi - a_lo), 0.0), 1.0) END AS alarm_pressure,
       CASE WHEN e_n >= 5 AND e_hi - e_lo >= 1e-9 AND energy_raw IS NOT NULL THEN least(greatest((energy_raw - e_lo) / (e_hi - e_lo), 0.0), 1.0) END AS energy_anomaly,
       CASE WHEN i_n >= 5 AND i_hi - i_lo >= 1e-9 THEN least(greatest((incident_raw - i_lo) / (i_hi - i_lo), 0.0), 1.0) END AS incident_pressure
FROM index_energy JOIN index_ends USING (site_id)""", "index_energy", "index_ends")
shared("index_daily", """
SELECT *, 100.0 * (coalesce(maintenance_risk, 0.0) + coalesce(alarm_pressure, 0.0) + coalesce(energy_anomaly, 0.0) + coalesce(incident_pressure, 0.0))
       / nullif((maintenance_risk IS NOT NULL)::INT + (alarm_pressure IS NOT NULL)::INT + (energy_anomaly IS NOT NULL)::INT + (incident_pressure IS NOT NULL)::INT, 0) AS rri_daily
FROM index_parts""", "index_parts")
shared("idx", """
SELECT *, avg(rri_daily) OVER (PARTITION BY site_id ORDER BY signal_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS reliability_risk_index
FROM index_daily""", "index_daily")


def index_of(t: Tables):
    return reliability_index(t.daily(), breach_load(t.work_orders(), "breach_probability"))


@query("breach_load", "G9 K8", """
SELECT site_id, signal_date, round(maintenance_risk_raw, 8) AS maintenance_risk_raw, round(expected_breaches, 6) AS expected_breaches,
       n_work_orders FROM breach_load""", ("breach_load",))
def _(t: Tables):
    return rounded(breach_load(t.work_orders(), "breach_probability"), maintenance_risk_raw=8)


@query("reliability_index", "M26 W3 W4 W5 W6 J6", """
SELECT site_id, signal_date, round(reliability_risk_index, 7) AS reliability_risk_index, round(rri_daily, 7) AS rri_daily,
       round(maintenance_risk, 8) AS maintenance_risk, round(alarm_pressure, 7) AS alarm_pressure, round(energy_anomaly, 7) AS energy_anomaly,
       round(incident_pressure, 7) AS incident_pressure, n_work_orders, alarm_count, round(electricity_kwh, 4) AS electricity_kwh, incident_count
FROM idx""", ("idx",))
def _(t: Tables):
    return rounded(index_of(t), 7, maintenance_risk=8, electricity_kwh=4)


@query("rolling_energy_deviation", "W3 W4", """
SELECT site_id, signal_date, round(energy_raw, 4) AS energy_anomaly_raw FROM index_energy""", ("index_energy",))
def _(t: Tables):
    from evenkeel.operators.rolling import rolling_deviation

    out = rolling_deviation(t.daily(), ["site_id"], "signal_date", "electricity_kwh", "energy_anomaly_raw")
    return rounded(out.select("site_id", "signal_date", "energy_anomaly_raw"), 4)


@query("robust_alarm_pressure", "W5", """
SELECT site_id, signal_date, round(alarm_pressure, 6) AS alarm_pressure FROM index_parts""", ("index_parts",))
def _(t: Tables):
    from evenkeel.operators.rolling import robust_unit
    from evenkeel.plans.reliability import alarm_pressure_raw

    scaled = robust_unit(alarm_pressure_raw(), ["site_id"])
    return rounded(t.daily().select("site_id", "signal_date", scaled.alias("alarm_pressure")))


@query("index_trend", "W13", """
SELECT site_id, signal_date, round(CASE WHEN count(reliability_risk_index) OVER w >= 3 THEN avg(reliability_risk_index) OVER w END, 7) AS trend
FROM idx WINDOW w AS (PARTITION BY site_id ORDER BY signal_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""", ("idx",))
def _(t: Tables):
    return rounded(index_trend(index_of(t)).select("site_id", "signal_date", "trend"), 7)


@query("gold_sql", "S19 S16", """
SELECT site_id, CAST(sum(alarm_count) AS BIGINT) AS alarms, round(avg(open_work_orders), 6) AS mean_open,
       min(signal_date) AS first_day, max(signal_date) AS last_day FROM daily GROUP BY site_id""", ("daily",))
def _(t: Tables):
    from evenkeel.sources.readers import register_views

    register_views({"site_daily_signals_view": t.daily()})
    return rounded(t.spark.sql("""
        SELECT site_id, sum(alarm_count) AS alarms, avg(open_work_orders) AS mean_open,
               min(signal_date) AS first_day, max(signal_date) AS last_day
        FROM site_daily_signals_view GROUP BY site_id"""))
