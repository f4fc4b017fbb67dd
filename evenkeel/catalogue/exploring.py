"""Profiles, rates, frequency tables, distributions and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.catalogue.registry import Tables, query, rounded
from evenkeel.functions import calendar_columns, elapsed_hours, interval_bin
from evenkeel.operators import explore as e

RATE = "round(sum(CAST(is_sla_violation AS INT)) / count(*) * 100.0, 6) AS rate_pct"
POS = "CAST(sum(CAST(is_sla_violation AS INT)) AS BIGINT) AS positives"


@query("violation_rate_by_site", "G11", f"SELECT site_id, {POS}, count(*) AS row_count, {RATE} FROM work_orders GROUP BY 1", ("work_orders",))
def _(t: Tables):
    return rounded(e.rate_by(t.work_orders(), ["site_id"], "is_sla_violation"))


@query("violation_rate_by_month", "G11 C25", f"""
SELECT site_id, CAST(date_trunc('month', work_started_at_utc) AS DATE) AS period, {POS}, count(*) AS row_count, {RATE} FROM work_orders GROUP BY 1, 2""", ("work_orders",))
def _(t: Tables):
    dated = t.work_orders().withColumn("period", calendar_columns("work_started_at_utc")["period"])
    return rounded(e.rate_by(dated, ["site_id", "period"], "is_sla_violation"))


@query("violation_rates_all_dimensions", "G11", "\nUNION ALL ".join(
    f"SELECT '{d}' AS dimension, CAST({c} AS VARCHAR) AS level, {POS}, count(*) AS row_count, {RATE} FROM work_orders GROUP BY 2"
    for d, c in (("contract_type", "contract_type"), ("assignment_type", "assignment_type"), ("priority_id", "priority_id"),
                 ("weekday", "isodow(work_started_at_utc)"), ("month", "month(work_started_at_utc)"),
                 ("year", "year(work_started_at_utc)"), ("is_invoicable", "is_invoicable"))), ("work_orders",))
def _(t: Tables):
    parts = calendar_columns("work_started_at_utc")
    wo = t.work_orders().withColumns({n: parts[n] for n in ("weekday", "month", "year")})
    dims = ["contract_type", "assignment_type", "priority_id", "weekday", "month", "year", "is_invoicable"]
    return rounded(e.rates_by_dimension(wo, dims, "is_sla_violation"))


@query("violation_rate_grouping_sets", "G11", f"""
SELECT site_id, contract_type, CAST(grouping(site_id, contract_type) AS BIGINT) AS grain, {POS}, count(*) AS row_count, {RATE}
FROM work_orders GROUP BY GROUPING SETS ((site_id), (contract_type), (site_id, contract_type), ())""", ("work_orders",))
def _(t: Tables):
    sets = [["site_id"], ["contract_type"], ["site_id", "contract_type"], []]
    return rounded(e.grouping_sets_rate(t.work_orders(), sets, "is_sla_violation"))


@query("violation_rate_by_window_width", "G11 C32", f"""
SELECT CASE WHEN h <= 24 THEN '<1d' WHEN h <= 72 THEN '1-3d' WHEN h <= 168 THEN '3-7d' WHEN h <= 720 THEN '7-30d' ELSE '>30d' END AS window_bin,
       {POS}, count(*) AS row_count, {RATE}
FROM (SELECT *, epoch(sla_required_end_at_utc - sla_required_start_at_utc) / 3600.0 AS h FROM work_orders) WHERE h > 0 AND h < 5000 GROUP BY 1""", ("work_orders",))
def _(t: Tables):
    hours = elapsed_hours("sla_required_start_at_utc", "sla_required_end_at_utc")
    wo = t.work_orders().withColumn("_h", hours).where("_h > 0 AND _h < 5000")
    binned = wo.withColumn("window_bin", interval_bin("_h", (0, 24, 72, 168, 720, 5000), ("<1d", "1-3d", "3-7d", "7-30d", ">30d")))
    return rounded(e.rate_by(binned, ["window_bin"], "is_sla_violation"))


@query("top_work_types_by_rate", "L6 G11", f"""
SELECT pm_no, {POS}, count(*) AS row_count, {RATE} FROM work_orders GROUP BY 1 HAVING count(*) >= 5
ORDER BY sum(CAST(is_sla_violation AS INT)) / count(*) DESC, pm_no NULLS FIRST LIMIT 15""", ("work_orders",))
def _(t: Tables):
    return rounded(e.top_rates(t.work_orders(), "pm_no", "is_sla_violation", 5))


@query("column_profile", "G12", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(DISTINCT {c}) AS distinct_count, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100.0, 6) AS null_pct FROM work_orders"
    for c in ("wo_no", "site_id", "priority_id", "pm_no", "assignment_type", "contract_type")), ("work_orders",))
def _(t: Tables):
    return rounded(e.column_profile(t.work_orders(), ["wo_no", "site_id", "priority_id", "pm_no", "assignment_type", "contract_type"]))


@query("null_and_hit_rates", "G13", """
SELECT contract_type, round(avg(CAST(pm_no IS NULL AS INT)), 6) AS pm_null_rate, round(avg(CAST(priority_id IS NOT NULL AS INT)), 6) AS priority_hit_rate
FROM work_orders GROUP BY 1""", ("work_orders",))
def _(t: Tables):
    return rounded(t.work_orders().groupBy("contract_type").agg(
        e.null_rate("pm_no").alias("pm_null_rate"), e.hit_rate("priority_id").alias("priority_hit_rate")))


@query("value_counts", "G14", "SELECT assignment_type, contract_type, count(*) AS row_count FROM work_orders GROUP BY 1, 2", ("work_orders",))
def _(t: Tables):
    return e.value_counts(t.work_orders(), ["assignment_type", "contract_type"])


@query("price_distribution_by_flag", "G15 H7", """
SELECT l_returnflag, count(*) AS value_count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
       min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(quantile_cont(l_extendedprice, 0.01), 4) AS q01,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.95), 4) AS q95
FROM lineitem GROUP BY 1""")
def _(t: Tables):
    out = e.distribution(t.read("lineitem"), "l_extendedprice", {"q01": 0.01, "median": 0.5, "q95": 0.95}, ["l_returnflag"], few_groups=True)
    return rounded(out, 4)


@query("capped_prices", "G15", """
WITH c AS (SELECT quantile_cont(o_totalprice, 0.95) AS cap FROM orders)
SELECT o_orderkey, o_totalprice FROM orders, c WHERE o_totalprice <= cap""")
def _(t: Tables):
    return e.cap_by_quantile(t.read("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 0.95)


@query("clipped_values", "G15", """
WITH c AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events)
SELECT event_id, round(least(greatest(value, lo), hi), 6) AS value FROM events, c""")
def _(t: Tables):
    return rounded(e.cap_by_quantile(t.read("events").select("event_id", "value"), "value", 0.99, 0.01, drop=False))


@query("month_by_type_pivot", "G16", """
SELECT CAST(month(ts) AS BIGINT) AS month, count(*) FILTER (WHERE event_type = 'click') AS n_click, count(*) FILTER (WHERE event_type = 'error') AS n_error,
       count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase, count(*) FILTER (WHERE event_type = 'signup') AS n_signup,
       count(*) FILTER (WHERE event_type = 'view') AS n_view FROM events GROUP BY 1""")
def _(t: Tables):
    dated = t.read("events").withColumn("month", F.month("ts").cast("bigint"))
    return e.pivot_counts(dated, ["month"], "event_type", ["click", "error", "purchase", "signup", "view"], "n_")


PRESENCE_SQL = "\nUNION ALL ".join(
    f"SELECT '{c}' AS signal, coalesce({c}, 0) > 0 AS present, {POS}, count(*) AS row_count, {RATE} FROM enriched GROUP BY 2"
    for c in ("incident_count", "unresolved_incident_count"))


@query("rate_with_and_without_incidents", "G17", f"""
SELECT * FROM (WITH d AS (SELECT site_id AS s, CAST(created_at_utc AS DATE) AS d, count(*) AS incident_count,
  count(*) FILTER (WHERE NOT is_resolved) AS unresolved_incident_count FROM incidents GROUP BY 1, 2),
enriched AS (SELECT w.*, d.incident_count, d.unresolved_incident_count FROM work_orders w LEFT JOIN d ON s = site_id AND d = CAST(work_started_at_utc AS DATE))
{PRESENCE_SQL})""", ("incidents", "work_orders"))
def _(t: Tables):
    from evenkeel.operators.joins import day_context
    from evenkeel.plans.marts import aggregate_rows, incident_rows

    daily = aggregate_rows([incident_rows(t.incidents())])
    names = ["incident_count", "unresolved_incident_count"]
    enriched = day_context(t.work_orders(), daily, "work_started_at_utc", dict(zip(names, names)))
    return rounded(e.presence_rates(enriched, names, "is_sla_violation"))


@query("correlation_to_label", "G18", "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr(CAST({c} AS DOUBLE), CAST(CAST(is_sla_violation AS INT) AS DOUBLE)), 6) AS correlation FROM work_orders"
    for c in ("priority_id", "worktime_hours", "o_totalprice", "breach_probability")), ("work_orders",))
def _(t: Tables):
    wo = t.work_orders().withColumn("y", F.col("is_sla_violation").cast("int"))
    return rounded(e.correlations(wo, ["priority_id", "worktime_hours", "o_totalprice", "breach_probability"], "y"))


@query("two_site_correlation", "G18", """
SELECT count(*) AS dates, round(corr(a, b), 6) AS correlation FROM (SELECT max(CASE WHEN site_id = 'site_0' THEN open_work_orders END) AS a,
  max(CASE WHEN site_id = 'site_1' THEN open_work_orders END) AS b FROM daily WHERE site_id IN ('site_0', 'site_1') GROUP BY signal_date)
WHERE a IS NOT NULL AND b IS NOT NULL""", ("daily",))
def _(t: Tables):
    return rounded(e.pair_correlation(t.daily(), "site_id", "site_0", "site_1", "signal_date", "open_work_orders"))


@query("weekly_means", "G19", """
SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS period, round(avg(value), 8) AS mean_value, count(value) AS points FROM events GROUP BY 1, 2""")
def _(t: Tables):
    return rounded(e.resample(t.read("events"), "ts", "week", "value", ["event_type"]), 8)


@query("room_profiles", "G20", """
SELECT asset_name, round(avg(utilization_pct), 8) AS mean_pct, round(stddev_samp(utilization_pct), 6) AS std_pct,
       round(avg(CASE WHEN utilization_pct = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_day_frac,
       round(avg(CASE WHEN utilization_pct >= 60 THEN 1.0 ELSE 0.0 END), 6) AS high_day_frac FROM room_use GROUP BY 1""", ("room_use",))
def _(t: Tables):
    return rounded(e.usage_profile(t.room_use(), "asset_name", "utilization_pct"), mean_pct=8)


@query("property_inventory", "G23", """
SELECT property_id, metric, count(*) AS points, min(timestamp_utc) AS earliest, max(timestamp_utc) AS latest FROM readings GROUP BY 1, 2""", ("readings",))
def _(t: Tables):
    return e.reading_inventory(t.readings(), ["property_id", "metric"], "timestamp_utc")


@query("equipment_task_statistics", "G24", """
SELECT CAST(month(l_shipdate) AS BIGINT) AS month, count(*) AS tasks, round(avg(l_quantity), 6) AS mean_completion, min(l_discount) AS min_wear,
       round(avg(l_discount), 6) AS mean_wear, max(l_discount) AS max_wear, count(*) FILTER (WHERE l_returnflag = 'A') AS "status_A",
       count(*) FILTER (WHERE l_returnflag = 'N') AS "status_N", count(*) FILTER (WHERE l_returnflag = 'R') AS "status_R" FROM lineitem GROUP BY 1""")
def _(t: Tables):
    dated = t.read("lineitem").withColumn("month", F.month("l_shipdate").cast("bigint"))
    return rounded(e.task_statistics(dated, ["month"], "l_quantity", "l_discount", "l_returnflag", ["A", "N", "R"]))


@query("busiest_rooms", "G25", """
SELECT asset_name, round(mean_value, 8) AS mean_value FROM (SELECT asset_name, avg(utilization_pct) AS mean_value FROM room_use GROUP BY 1)
ORDER BY round(mean_value, 10) DESC, asset_name LIMIT 15""", ("room_use",))
def _(t: Tables):
    return rounded(e.ranking_by_mean(t.room_use(), "asset_name", "utilization_pct"), 8)


@query("building_daily_mean", "G25", """
SELECT utilization_date, round(avg(utilization_pct), 9) AS mean_value, count(*) AS assets FROM room_use GROUP BY 1""", ("room_use",))
def _(t: Tables):
    return rounded(t.room_use().groupBy("utilization_date").agg(
        F.avg("utilization_pct").alias("mean_value"), F.count(F.lit(1)).alias("assets")), 9)
