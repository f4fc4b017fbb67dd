"""Dispatch, assignment, cleaning, briefing, calendar and serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.catalogue.expressions import ACTION_SQL, RISK_SQL, SEVERITY_SQL
from evenkeel.catalogue.marts import index_of
from evenkeel.catalogue.registry import Tables, query, rounded, shared
from evenkeel.plans import decisions as d
from evenkeel.plans import serving as s

shared("graded", f"""
SELECT *, round_even(breach_probability * 100, 1) AS breach_risk_pct, {RISK_SQL} AS risk_band, {SEVERITY_SQL} AS severity,
       coalesce(CAST(priority_id AS VARCHAR), 'unknown') AS priority_id_str
FROM work_orders""", "work_orders")
shared("acted", f"SELECT *, {ACTION_SQL} AS action FROM graded", "graded")
shared("queue", """
SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY CASE action WHEN 'Urgent' THEN 0 WHEN 'Monitor' THEN 1 ELSE 2 END,
  CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 ELSE 4 END,
  CASE risk_band WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END, breach_probability DESC, wo_no) AS queue_rank FROM acted""", "acted")
ROLE_SQL = """CASE WHEN lower(work_type_eng) LIKE '%clean%' THEN 'Cleaner' WHEN lower(work_type_eng) LIKE '%security%' THEN 'Security'
  WHEN lower(work_type_eng) LIKE '%outdoor%' THEN 'Groundskeeper' WHEN lower(work_type_eng) LIKE '%ventil%' THEN 'HVAC technician' ELSE 'Technician' END"""
MEMBER_SQL = """role || ' ' || CAST(CASE WHEN role IN ('Cleaner', 'Technician') THEN (turn - 1) % 2 + 1 ELSE 1 END AS VARCHAR)"""
shared("assigned", f"""
SELECT *, {MEMBER_SQL} AS assigned_to FROM (SELECT *, row_number() OVER (PARTITION BY site_id, role ORDER BY breach_risk_pct DESC, wo_no) AS turn
FROM (SELECT *, {ROLE_SQL} AS role FROM queue))""", "queue")
shared("portfolio", """
SELECT site_id, signal_date, reliability_risk_index, CASE WHEN reliability_risk_index >= 70 THEN 'ELEVATED' WHEN reliability_risk_index >= 40 THEN 'NORMAL' ELSE 'CALM' END AS band,
       round_even(reliability_risk_index, 0) AS rri
FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY signal_date DESC) AS rn FROM idx WHERE reliability_risk_index IS NOT NULL) WHERE rn = 1""", "idx")


def scored_of(t: Tables):
    return t.work_orders().withColumn("priority_id_str", F.coalesce(F.col("priority_id").cast("string"), F.lit("unknown")))


def queue_of(t: Tables):
    return d.dispatch_queue(scored_of(t))


def rank64(df):
    return df.withColumn("queue_rank", F.col("queue_rank").cast("bigint"))


@query("dispatch_queue", "M27 L1 C22 K17", """
SELECT wo_no, site_id, work_type_eng, priority_id_str, breach_risk_pct, risk_band, severity, action, queue_rank, is_sla_violation FROM queue""", ("queue",))
def _(t: Tables):
    return rank64(queue_of(t))


@query("recent_dispatch_queue", "L1 M27", f"""
SELECT wo_no, site_id, action, row_number() OVER (PARTITION BY site_id ORDER BY CASE action WHEN 'Urgent' THEN 0 WHEN 'Monitor' THEN 1 ELSE 2 END,
  CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 ELSE 4 END,
  CASE risk_band WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END, breach_probability DESC, wo_no) AS queue_rank
FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY work_started_at_utc DESC, wo_no) AS recency FROM acted) WHERE recency <= {d.BACKLOG_ROWS}""", ("acted",))
def _(t: Tables):
    """The view of the latest orders: here the cut is the feature."""
    return rank64(d.dispatch_queue(scored_of(t), rows=d.BACKLOG_ROWS).select("wo_no", "site_id", "action", "queue_rank"))


@query("task_assignments", "M28 W9 C20", """
SELECT wo_no, site_id, role, assigned_to, action, queue_rank FROM assigned""", ("assigned",))
def _(t: Tables):
    return rank64(d.assign_tasks(queue_of(t)).select("wo_no", "site_id", "role", "assigned_to", "action", "queue_rank"))


@query("whole_backlog_assignments", "W9", f"""
SELECT wo_no, role, {MEMBER_SQL} AS assigned_to FROM (SELECT wo_no, role, row_number() OVER (PARTITION BY role ORDER BY breach_risk_pct DESC, wo_no) AS turn
FROM (SELECT wo_no, round_even(breach_probability * 100, 1) AS breach_risk_pct, {ROLE_SQL} AS role FROM work_orders))""", ("work_orders",))
def _(t: Tables):
    backlog = t.work_orders().withColumn("breach_risk_pct", d.half_even(F.col("breach_probability") * 100, 1))
    return d.assign_tasks(backlog, by=()).select("wo_no", "role", "assigned_to")


@query("crew_workload", "G10", """
SELECT site_id, assigned_to, role, count(*) AS tasks, count(*) FILTER (WHERE action = 'Urgent') AS urgent,
       count(*) FILTER (WHERE action = 'Monitor') AS monitor, count(*) FILTER (WHERE action = 'Low priority') AS low_priority FROM assigned GROUP BY 1, 2, 3""", ("assigned",))
def _(t: Tables):
    return d.crew_workload(d.assign_tasks(queue_of(t)), ["site_id"])


@query("portfolio_today", "W10 V1 C21", """
SELECT site_id, signal_date AS last_seen, round(reliability_risk_index, 6) AS reliability_risk_index, band FROM portfolio""", ("portfolio",))
def _(t: Tables):
    return rounded(s.portfolio_sites(d.portfolio_today(index_of(t))))


@query("unified_sample", "W10 L3", """
SELECT site_id, signal_date, alarm_count, open_work_orders, incident_count, round(electricity_kwh, 4) AS electricity_kwh FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY CAST(open_work_orders > 0 OR alarm_count > 0 OR electricity_kwh IS NOT NULL OR incident_count > 0 AS INT) DESC, signal_date DESC) AS rn FROM daily) WHERE rn = 1""", ("daily",))
def _(t: Tables):
    return rounded(d.unified_sample(t.daily()).select("site_id", "signal_date", "alarm_count", "open_work_orders", "incident_count", "electricity_kwh"), 4)


@query("briefing", "M29 W12", """
SELECT p.site_id, rri, band, h.n AS high_orders, i.n AS incidents_30d FROM portfolio p
LEFT JOIN (SELECT site_id, count(*) FILTER (WHERE risk_band = 'HIGH') AS n FROM queue GROUP BY 1) h USING (site_id)
LEFT JOIN (SELECT site_id, CAST(sum(incident_count) AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY signal_date DESC) AS rn FROM daily) WHERE rn <= 30 GROUP BY 1) i USING (site_id)""",
       ("portfolio", "queue", "daily"))
def _(t: Tables):
    return d.briefing(d.portfolio_today(index_of(t)), queue_of(t), t.daily())


@query("do_first", "M29 C24 L2", """
SELECT site_id, queue_rank, wo_no, breach_risk_pct, work_type_eng || ': ' || CAST(CAST(round_even(breach_risk_pct, 0) AS BIGINT) AS VARCHAR) || '% breach risk — ' ||
       CASE WHEN breach_risk_pct >= 80 THEN 'long/complex job that has historically slipped; start now.' WHEN breach_risk_pct >= 55 THEN 'typical for this service line; don''t let it sit.'
            ELSE 'low; safe to schedule later.' END AS reason FROM queue WHERE queue_rank <= 3""", ("queue",))
def _(t: Tables):
    return rank64(d.do_first(queue_of(t)).drop("work_type_eng"))


@query("dispatch_payoff", "M30", """
SELECT site_id, count(*) AS orders, CAST(greatest(1, count(*) // 3) AS BIGINT) AS top_third,
       count(*) FILTER (WHERE is_sla_violation AND queue_rank <= greatest(1, n // 3)) AS breaches_in_top_third, count(*) FILTER (WHERE is_sla_violation) AS breaches
FROM (SELECT *, count(*) OVER (PARTITION BY site_id) AS n FROM queue) GROUP BY site_id, n""", ("queue",))
def _(t: Tables):
    return d.dispatch_payoff(queue_of(t))


@query("site_index_summary", "G22", """
SELECT site_id, round_even(avg(reliability_risk_index), 1) AS mean_rri, count(reliability_risk_index) AS days_scored FROM idx GROUP BY 1""", ("idx",))
def _(t: Tables):
    return d.site_index_summary(index_of(t))


CLEANING_SQL = """
SELECT * FROM (WITH p AS (SELECT utilization_date, row_number() OVER (ORDER BY utilization_date) - 1 AS pos FROM (SELECT DISTINCT utilization_date FROM room_use)),
aim AS (SELECT {aim} AS target FROM p),
rooms AS (SELECT DISTINCT asset_name FROM room_use),
grid AS (SELECT asset_name, pos, target, coalesce(utilization_pct, 0) AS v FROM rooms CROSS JOIN p CROSS JOIN aim LEFT JOIN room_use USING (asset_name, utilization_date)),
parts AS (SELECT asset_name, max(CASE WHEN pos = target THEN v END) AS today, round(sum(v) FILTER (WHERE pos BETWEEN target - 2 AND target), 9) / count(*) FILTER (WHERE pos BETWEEN target - 2 AND target) AS roll,
          target - 1 - coalesce(max(pos) FILTER (WHERE pos < target AND v <= 10), -1) AS streak FROM grid GROUP BY asset_name, target),
scored AS (SELECT asset_name AS room, round_even(today, 1) AS today_pct, round_even(roll, 1) AS rolling_3d_mean, CAST(streak AS BIGINT) AS accumulation_days,
           round_even(least(100.0, today * 0.5 + roll * 0.3 + least(streak / 5.0, 1.0) * 20.0), 1) AS urgency_score FROM parts)
SELECT *, CASE WHEN urgency_score >= 65 THEN 'CLEAN' WHEN urgency_score >= 35 THEN 'MONITOR' ELSE 'SKIP' END AS recommendation FROM scored)"""


@query("cleaning_priority", "M25 W7 W8 K24", CLEANING_SQL.format(aim="max(pos)"), ("room_use",))
def _(t: Tables):
    return d.cleaning_priority(t.room_use())


@query("cleaning_priority_on_a_date", "M25 W7", CLEANING_SQL.format(
    aim="coalesce(max(pos) FILTER (WHERE utilization_date = DATE '2024-01-10'), max(pos))"), ("room_use",))
def _(t: Tables):
    return d.cleaning_priority(t.room_use(), target=F.lit("2024-01-10").cast("date"))


TODAY = "2000-06-15"
shared("history", f"""
SELECT site_id, week(signal_date) AS iso_week, avg(reliability_risk_index) AS hist_mean_rri FROM idx WHERE isoyear(signal_date) < year(DATE '{TODAY}') GROUP BY 1, 2""", "idx")


@query("iso_week_history", "G21", """
SELECT site_id, CAST(iso_week AS BIGINT) AS iso_week, round(hist_mean_rri, 6) AS hist_mean_rri FROM history""", ("history",))
def _(t: Tables):
    out = d.iso_week_history(index_of(t), F.lit(2000))
    return rounded(out.withColumn("iso_week", F.col("iso_week").cast("bigint")))


@query("projected_risk_windows", "J12", f"""
SELECT site_id, CAST(h.iso_week AS BIGINT) AS iso_week, CAST(min(m.day) AS DATE) AS start_date, round(max(hist_mean_rri), 6) AS hist_mean_rri
FROM history h JOIN (SELECT CAST(day AS DATE) AS day, week(day) AS iso_week FROM (SELECT unnest(generate_series(DATE '{TODAY}' + 1, DATE '{TODAY}' + 60, INTERVAL 1 DAY)) AS day) WHERE isodow(day) = 1) m
ON m.iso_week = h.iso_week WHERE hist_mean_rri >= 40 GROUP BY 1, 2""", ("history",))
def _(t: Tables):
    out = d.risk_windows(index_of(t), F.lit(TODAY).cast("date"), 60, 40.0)
    return rounded(out.withColumn("iso_week", F.col("iso_week").cast("bigint")))


CALENDAR_SQL = f"""
SELECT * FROM (WITH first AS (SELECT DATE '{TODAY}' - CAST(isodow(DATE '{TODAY}') - 1 AS INTEGER) AS monday, least(isodow(DATE '{TODAY}'), 5) - 1 AS gone),
ranked AS (SELECT *, row_number() OVER (ORDER BY site_id, breach_risk_pct DESC, wo_no) AS slot FROM queue WHERE risk_band IN ('HIGH', 'MEDIUM')),
mondays AS (SELECT CAST(day AS DATE) AS day, week(day) AS iso_week FROM (SELECT unnest(generate_series(DATE '{TODAY}' + 1, DATE '{TODAY}' + 30, INTERVAL 1 DAY)) AS day) WHERE isodow(day) = 1)
SELECT 'elevated-' || site_id || '-{TODAY}' AS event_id, site_id, 'inspection' AS kind, DATE '{TODAY}' + 1 AS start_date, DATE '{TODAY}' + 2 AS end_date,
       1 AS priority, rri AS risk_value FROM portfolio WHERE band = 'ELEVATED'
UNION ALL SELECT 'wo-' || CAST(wo_no AS VARCHAR), site_id, 'work order', d, d + 1, CASE WHEN risk_band = 'HIGH' THEN 1 ELSE 5 END, breach_risk_pct FROM (SELECT *, CAST(monday + CAST(7 * ((gone + slot) // 5) + (gone + slot) % 5 AS INTEGER) AS DATE) AS d FROM ranked CROSS JOIN first)
UNION ALL SELECT 'window-' || site_id || '-w' || CAST(h.iso_week AS VARCHAR) || '-' || CAST(year(day) AS VARCHAR), site_id, 'risk window', day, day + 5, 7, round(hist_mean_rri, 6)
FROM history h JOIN mondays m ON m.iso_week = h.iso_week WHERE hist_mean_rri >= 70)"""


@query("maintenance_calendar", "M31 W11 C29 J12", CALENDAR_SQL, ("queue", "portfolio", "history"))
def _(t: Tables):
    index = index_of(t)
    out = d.maintenance_calendar(d.portfolio_today(index), queue_of(t), index, F.lit(TODAY).cast("date"))
    return rounded(out.drop("note"))


@query("site_reliability", "V2 K19", """
SELECT signal_date, round(reliability_risk_index, 6) AS reliability_risk_index, round(maintenance_risk, 8) AS maintenance_risk, round(alarm_pressure, 6) AS alarm_pressure,
       round(energy_anomaly, 6) AS energy_anomaly, round(incident_pressure, 6) AS incident_pressure
FROM idx WHERE site_id = 'site_3' AND signal_date >= (SELECT max(signal_date) FROM idx WHERE site_id = 'site_3') - 30""", ("idx",))
def _(t: Tables):
    return rounded(s.site_reliability(index_of(t), "site_3"), maintenance_risk=8)


@query("site_queue", "V3", """
SELECT wo_no, work_type_eng, priority_id_str, breach_risk_pct, risk_band FROM queue WHERE site_id = 'site_3'""", ("queue",))
def _(t: Tables):
    return s.site_queue(queue_of(t), "site_3")


@query("known_sites", "V4", "SELECT DISTINCT site_id FROM work_orders", ("work_orders",))
def _(t: Tables):
    return s.known_sites(t.work_orders())


@query("my_tasks", "V5 J13 K18", """
SELECT wo_no, site_id, 'Site ' || substr(site_id, 6) AS display_name, action FROM assigned WHERE assigned_to = 'Cleaner 1'""", ("assigned",))
def _(t: Tables):
    sites = t.work_orders().select("site_id", F.concat(F.lit("Site "), F.substring("site_id", 6, 9)).alias("display_name")).distinct()
    return s.my_tasks(d.assign_tasks(queue_of(t)), "Cleaner 1", sites).select("wo_no", "site_id", "display_name", "action")


@query("my_task_counts", "V5", """
SELECT action, count(*) AS tasks FROM assigned WHERE assigned_to = 'Cleaner 1' GROUP BY 1""", ("assigned",))
def _(t: Tables):
    return s.task_counts(d.assign_tasks(queue_of(t)), "Cleaner 1")


@query("last_730_days", "V6 W12", """
SELECT site_id, signal_date, round(rri, 6) AS reliability_risk_index FROM (SELECT site_id, signal_date, reliability_risk_index AS rri,
  row_number() OVER (PARTITION BY site_id ORDER BY signal_date DESC) AS rn FROM idx WHERE site_id IN ('site_1', 'site_2')) WHERE rn <= 730""", ("idx",))
def _(t: Tables):
    return rounded(s.last_rows(index_of(t), ["site_1", "site_2"]).select("site_id", "signal_date", "reliability_risk_index"))
