"""Conformers, crosswalk, joins, dedupe and other table shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.catalogue.registry import Tables, query, rounded
from evenkeel.operators import conform as c
from evenkeel.operators import joins as j
from evenkeel.operators.latest import (
    duplicate_rows, first_per_key, keep_latest, latest_with_preference, top_n,
)
from evenkeel.sources.contracts import resolve
from evenkeel.sources.landing import file_ledger, partition_manifest
from evenkeel.sources.readers import read_table, row_counts


def sites_of(t: Tables):
    """A crosswalk in configuration shape: one site a nation, one region unmapped."""
    n, r = t.read("nation"), t.read("region")
    key = F.col("n_nationkey")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).where(F.col("r_name") != "ASIA").select(
        F.concat(F.lit("site_"), F.lower("n_name")).alias("site_id"), F.col("n_name").alias("display_name"),
        F.col("r_name").alias("customer_name"), F.lit(None).cast("string").alias("address"), F.col("r_name").alias("city"),
        F.when(key % 2 == 0, "FI").alias("country"), F.lit(None).cast("string").alias("timezone"),
        F.struct(F.col("n_regionkey").cast("bigint").alias("customer_no"), key.cast("bigint").alias("customer_site_no")).alias("erp"),
        F.struct(F.concat(F.lit("property_"), key.cast("string")).alias("property_id"), F.lit(None).cast("string").alias("file_slug"),
                 F.array(F.concat(F.lit("child_"), key.cast("string"))).alias("child_property_ids")).alias("property"),
        F.col("n_name").alias("building_name"), key.alias("position"))


def mapped_nations(t: Tables):
    return t.read("nation").join(t.read("region").where("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))


SITES_SQL = """SELECT 'site_' || lower(n_name) AS site_id, n_name, r_name, n_nationkey, n_regionkey
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'"""


@query("conformed_alarms", "T1 S1 K3", f"""
WITH sites AS ({SITES_SQL})
SELECT event_id AS alert_event_id, CAST(user_id % 5 AS BIGINT) AS customer_no, CAST(user_id % 25 AS BIGINT) AS customer_site_no,
       CAST(ts AT TIME ZONE 'Europe/Helsinki' AT TIME ZONE 'UTC' AS TIMESTAMP) AS event_time_utc, event_type AS alert_type,
       CASE event_type WHEN 'error' THEN 1 WHEN 'purchase' THEN 13 WHEN 'signup' THEN 50 WHEN 'click' THEN NULL ELSE 42 END AS priority,
       event_id % 3 = 0 AS is_log_only, CASE WHEN event_id % 10 = 0 THEN event_id END AS workorder_no, event_id % 10 = 0 AS has_work_order,
       event_type NOT IN ('error', 'purchase', 'signup', 'click') AS flagged, site_id,
       CASE WHEN site_id IS NULL THEN 'unmapped' ELSE 'mapped' END AS mapping_status
FROM events LEFT JOIN sites ON n_regionkey = user_id % 5 AND n_nationkey = user_id % 25""")
def _(t: Tables):
    kind, key, user = F.col("event_type"), F.col("event_id"), F.col("user_id")
    text = lambda col: col.cast("string")
    raw = t.read("events").select(
        text(key).alias("ALERT_EVENT_ID"), text(key).alias("ALERT_ID"), text(user % 5).alias("CUSTOMER_NO"),
        text(user % 25).alias("CUSTOMER_SITE_NO"), F.lit("1").alias("CONTRACT_NO"), F.lit("2").alias("LOCATION_ID"),
        F.lit("3").alias("LOCATION_TABLE_ID"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("EVENT_TIME"),
        F.lit("NULL").alias("EVENT_CLOSED_TIME"), kind.alias("EVENT_TYPE"), F.lit("h").alias("HWID"), F.lit("t").alias("HWID_TYPE"),
        F.col("props").alias("EVENT_DESCRIPTION"), F.lit("i").alias("IVA_NO"), F.lit("s").alias("STATUS"),
        F.lit("  loop ").alias("LOOP"), F.concat(F.lit(" "), kind).alias("ALERT_TYPE"),
        F.when(kind == "error", "1").when(kind == "purchase", "13").when(kind == "signup", "50").when(kind == "click", "NULL")
        .otherwise("42").alias("Priority"),
        F.when(key % 3 == 0, "L").alias("LOG_ONLY"), F.when(key % 10 == 0, text(key)).otherwise("NULL").alias("WORKORDER_NO"))
    out = c.conform_alarms(raw, sites_of(t))
    return out.select("alert_event_id", "customer_no", "customer_site_no", "event_time_utc", "alert_type", "priority", "is_log_only",
                      "workorder_no", "has_work_order", (F.size("issues") > 0).alias("flagged"), "site_id", "mapping_status")


@query("conformed_work_orders", "T2 K11", f"""
WITH sites AS ({SITES_SQL})
SELECT o_orderkey AS wo_no, CAST(o_orderdate AT TIME ZONE 'Europe/Helsinki' AT TIME ZONE 'UTC' AS TIMESTAMP) AS work_started_at_utc,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 14 AS DOUBLE) ELSE CAST(CAST(o_orderkey % 14 AS VARCHAR) || '.16' AS DOUBLE) END AS work_finished_days,
       o_orderkey % 3 = 1 AS is_sla_violation, o_orderkey % 2 = 0 AS is_invoicable, false AS is_subcontractor_work,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS priority_id,
       'Määrä ' || o_orderpriority AS work_order_description, false AS flagged, site_id,
       CASE WHEN site_id IS NULL THEN 'unmapped' ELSE 'mapped' END AS mapping_status
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN (SELECT site_id, n_nationkey AS k FROM sites) ON k = c_nationkey""")
def _(t: Tables):
    key, d = F.col("o_orderkey"), F.col("o_orderdate")
    days = (key % 14).cast("int")
    null = F.lit("NULL")
    o = t.read("orders").join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    raw = o.select(
        key.cast("string").alias("WO_NO"), F.col("n_regionkey").cast("string").alias("CUSTOMER_NO"),
        F.col("n_nationkey").cast("string").alias("CUSTOMER_SITE_NO"), F.lit("w").alias("CUSTOMER_WORKSITE_NO"),
        F.lit("KH").alias("CONTRACT"), null.alias("CONTRACT_NO"), F.lit("t").alias("WORK_ORDER_TYPE"), null.alias("WO_PARENT_ID"),
        null.alias("ASSIGNMENT_TYPE"),
        F.when(F.col("o_orderpriority") == "5-LOW", "NULL").otherwise(F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0"))).alias("PRIORITY_ID"),
        null.alias("WORK_DESCRIPTION"), F.concat(F.lit("MÃ¤Ã¤rÃ¤ "), "o_orderpriority").alias("WORK_ORDER_DESCRIPTION"),
        null.alias("WORK_ORDER_PERFORMED_ACTION"), F.lit("f").alias("WORK_TYPE_DESCRIPTION_FIN"), F.lit("e").alias("WORK_TYPE_DESCRIPTION_ENG"),
        null.alias("PM_NO"), null.alias("PM_ACTION_DESCR"), F.date_format(d, "d.M.yyyy H:mm").alias("WORK_STARTED_DATETIME"),
        F.date_format(d + F.make_dt_interval(days), "yyyy-MM-dd HH:mm:ss").alias("WORK_FINISHED_DATETIME"),
        F.when(key % 5 == 0, "NULL").otherwise(F.concat(days.cast("string"), F.lit(".16.00"))).alias("WORK_FINISHED_DAYS"),
        null.alias("SLA_REQUIRED_START_DATETIME"), null.alias("SLA_REQUIRED_END_DATETIME"),
        F.when(key % 3 == 0, "NULL").otherwise((key % 3 == 1).cast("int").cast("string")).alias("IS_SLA_VIOLATION"),
        F.lit("1,5").alias("WORKTIME_HOURS"), F.when(key % 2 == 0, "TOSI").otherwise("EPÄTOSI").alias("WORK_INVOICABLE"),
        null.alias("IS_SUBCONTRACTOR_WORK"))
    out = c.conform_work_orders(raw, sites_of(t))
    return out.select("wo_no", "work_started_at_utc", "work_finished_days", "is_sla_violation", "is_invoicable", "is_subcontractor_work",
                      "priority_id", "work_order_description", (F.size("issues") > 0).alias("flagged"), "site_id", "mapping_status")


@query("conformed_maintenance_plans", "T3 W1", f"""
WITH sites AS ({SITES_SQL}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS rn FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS pm_no, CAST(o_orderdate AT TIME ZONE 'Europe/Helsinki' AT TIME ZONE 'UTC' AS TIMESTAMP) AS last_updated_utc,
       lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS action_descr, CAST(o_orderdate AS DATE) AS start_date, site_id
FROM ranked LEFT JOIN (SELECT site_id, n_nationkey AS k FROM sites) ON k = o_custkey % 25 WHERE rn = 1""")
def _(t: Tables):
    d, cust = F.col("o_orderdate"), F.col("o_custkey")
    one, null = F.lit("1"), F.lit("NULL")
    raw = t.read("orders").join(t.read("nation"), cust % 25 == F.col("n_nationkey"), "left").select(
        F.date_format(d, "d.M.yyyy H:mm:ss").alias("LAST_UPDATED"), cust.cast("string").alias("PM_NO"), one.alias("MCH_CODE_CONTRACT"),
        one.alias("CUSTOMER_WORKSITE_NO"), F.col("n_regionkey").cast("string").alias("CUSTOMER_NO"),
        F.col("n_nationkey").cast("string").alias("CUSTOMER_SITE_NO"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("ACTION_DESCR"),
        null.alias("ACTION_DESCR_ENG"), one.alias("PRIORITY_ID"), one.alias("INTERVAL"), null.alias("PM_INTERVAL_UNIT"),
        null.alias("PLAN_HRS"), null.alias("DESCRIPTION"), null.alias("DESCRIPTION_ENG"), F.date_format(d, "d.M.yyyy").alias("START_DATE"),
        null.alias("VALID_FROM"), null.alias("OBJSTATE"))
    return c.conform_maintenance_plans(raw, sites_of(t)).select("pm_no", "last_updated_utc", "action_descr", "start_date", "site_id")


def _properties(t: Tables, *more: str):
    """Each order as a property document: its reading, and one of a child."""
    point = lambda v, key: F.array(F.struct(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+00")).alias("t"),
                                            v.alias("v"), F.lit(key).alias("key"), F.lit("auto").alias("src")))
    readings = lambda metric, v, key: F.create_map(F.lit(metric), F.struct(point(v, key).alias("data")))
    status = F.when(F.col("o_orderstatus") == "F", "resolved").otherwise("open")
    incident = lambda prefix: F.array(F.struct(
        F.concat(F.lit(prefix), F.col("o_orderkey").cast("string")).alias("id"), F.lit("n").alias("node_id"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("created_at"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+00")).alias("updated_at"), F.lit("fault").alias("event_type"),
        F.lit("immediate").alias("priority"), status.alias("status"), F.lit("c").alias("category"), F.lit(1.0).alias("points"),
        F.lit("d").alias("description"), F.lit(None).cast("boolean").alias("internal"), F.lit(None).cast("boolean").alias("include_in_report")))
    price = F.col("o_totalprice")
    key = (F.col("o_custkey") % 25).cast("string")
    pid, child = F.concat(F.lit("property_"), key), F.concat(F.lit("child_"), key)
    return t.read("orders").select(F.col("o_orderkey"), F.struct(
        pid.alias("id"), readings("electricity_kWh", price, "m1").alias("readings"), incident("i").alias("incidents"),
        F.array(F.struct(child.alias("id"), readings("odd_metric", price / 2, "m2").alias("readings"),
                         incident("c").alias("incidents"))).alias("children")).alias("property"), *more)


@query("exploded_readings", "T4 S5 C16 K23", f"""
WITH sites AS ({SITES_SQL}),
long AS (SELECT 'property_' || CAST(o_custkey % 25 AS VARCHAR) AS property_id, CAST(NULL AS VARCHAR) AS parent_property_id, 'electricity_kWh' AS metric,
           'm1' AS meter_key, o_orderdate AS timestamp_utc, o_totalprice AS value, 'kWh' AS unit, o_custkey % 25 AS k FROM orders
         UNION ALL SELECT 'child_' || CAST(o_custkey % 25 AS VARCHAR), 'property_' || CAST(o_custkey % 25 AS VARCHAR), 'odd_metric', 'm2',
           o_orderdate, o_totalprice / 2, 'unknown', o_custkey % 25 FROM orders)
SELECT substr(sha256(property_id || '|' || metric || '|' || meter_key || '|' || strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S+00')), 1, 16) AS reading_id,
       property_id, parent_property_id, metric, meter_key, timestamp_utc, value, unit, site_id
FROM long LEFT JOIN (SELECT site_id, n_nationkey FROM sites) ON n_nationkey = k""")
def _(t: Tables):
    out = c.conform_readings(_properties(t), sites_of(t))
    return out.select("reading_id", "property_id", "parent_property_id", "metric", "meter_key", "timestamp_utc", "value", "unit", "site_id")


@query("extracted_incidents", "T5", f"""
WITH sites AS ({SITES_SQL})
SELECT p || CAST(o_orderkey AS VARCHAR) AS incident_id, o_orderdate AS created_at_utc, o_orderdate AS updated_at_utc,
       o_orderstatus = 'F' AS is_resolved, false AS is_internal, true AS include_in_report, site_id
FROM orders JOIN (VALUES ('i'), ('c')) v(p) ON true LEFT JOIN sites ON n_nationkey = o_custkey % 25""")
def _(t: Tables):
    out = c.conform_incidents(_properties(t), sites_of(t))
    return out.select("incident_id", "created_at_utc", "updated_at_utc", "is_resolved", "is_internal", "include_in_report", "site_id")


@query("property_record_counts", "S12 G23", """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderkey % 4 ELSE 4 + o_orderkey % 3 END AS BIGINT) AS records FROM orders""")
def _(t: Tables):
    from evenkeel.sources.landing import property_records

    many = lambda n: F.array_repeat(F.col("o_orderkey").cast("string"), (F.col("o_orderkey") % n).cast("int"))
    nodes = F.transform(many(3), lambda i: F.struct(i.alias("id"), i.alias("name"), i.alias("type"), i.alias("tags")))
    lists = F.col("o_orderstatus") == "P"
    docs = _properties(t, "o_orderstatus").select(
        "o_orderkey", F.when(~lists, F.col("property").withField("nodes", nodes)).alias("property"),
        F.when(lists, many(4)).alias("properties"))
    return docs.select("o_orderkey", property_records().cast("bigint").alias("records"))


@query("exploded_vectors", "T6 S6", """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS hour, round(CAST(unnest(embedding) AS DOUBLE), 6) AS occupancy_value FROM embeddings""")
def _(t: Tables):
    out = c.explode_hourly(t.read("embeddings").select("vec_id", F.col("embedding").alias("occupancy")))
    return rounded(out.withColumn("hour", F.col("hour").cast("bigint")), 6)


@query("unpivoted_events", "T7 G16", """
SELECT site_id, kind, count(*) FILTER (WHERE alert_type = kind) AS n
FROM alarms JOIN (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) v(kind) ON true GROUP BY 1, 2""", ("alarms",))
def _(t: Tables):
    from evenkeel.operators.explore import pivot_counts, unpivot_counts

    kinds = ["click", "error", "purchase", "signup", "view"]
    wide = pivot_counts(t.alarms(), ["site_id"], "alert_type", kinds)
    return unpivot_counts(wide, ["site_id"], kinds, "kind", "n")


@query("unpivoted_dates", "T7", """
SELECT asset, d AS utilization_date, CASE WHEN n > 0 THEN n + 0.5 END AS utilization_pct
FROM (SELECT u.user_id AS asset, d, CAST(count(e.event_id) AS DOUBLE) AS n FROM (SELECT DISTINCT user_id FROM events) u
      CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) LEFT JOIN events e ON e.user_id = u.user_id AND CAST(e.ts AS DATE) = d GROUP BY 1, 2)""")
def _(t: Tables):
    dated = t.read("events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("d"))
    days = [r.d for r in dated.select("d").distinct().orderBy("d").collect()]  # the calendar: the wide table's header
    n = lambda d: F.count_if(F.col("d") == d)
    wide = dated.groupBy(F.col("user_id").alias("asset")).agg(*[
        F.when(n(d) > 0, F.concat(n(d).cast("string"), F.lit(".5"))).otherwise("n/a").alias(d) for d in days])
    return c.unpivot_wide_dates(wide, "asset", "utilization_date", "utilization_pct")


@query("conformed_utilization", "T8 U1 W1", """
WITH files AS (SELECT 'Room ' || CAST(user_id AS VARCHAR) AS asset_name, CAST(ts AS DATE) AS d, value,
               CASE WHEN event_id % 2 = 0 THEN DATE '2024-05-27' ELSE DATE '2024-06-30' END AS export_end, lpad(CAST(event_id AS VARCHAR), 12, '0') AS f FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY asset_name, d ORDER BY export_end DESC, f) AS rn FROM files)
SELECT substr(sha256(asset_name || '|' || CAST(d AS VARCHAR)), 1, 16) AS utilization_id, asset_name, d AS utilization_date, value AS utilization_pct,
       'site_main' AS site_id FROM ranked WHERE rn = 1""")
def _(t: Tables):
    even = F.col("event_id") % 2 == 0
    long = t.read("events").select(
        F.concat(F.lit("Room "), F.col("user_id").cast("string")).alias("asset"), F.date_format("ts", "yyyy-MM-dd").alias("header"),
        F.col("value").cast("string").alias("value"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("file_path"),
        F.when(even, "Room_Utilization_010124-270524.csv").otherwise("Room_Utilization_010124-300624.csv").alias("file_name"))
    return c.conform_utilization(long, "site_main").select(
        "utilization_id", "asset_name", "utilization_date", "utilization_pct", "site_id")


@query("dim_site", "T9", f"""
WITH sites AS ({SITES_SQL})
SELECT site_id, n_name AS display_name, 'cust_' || replace(lower(r_name), ' ', '_') AS customer_id, CASE WHEN n_nationkey % 2 = 0 THEN 'FI' ELSE 'FI' END AS country,
       'Europe/Helsinki' AS timezone, CAST(n_nationkey AS BIGINT) AS erp_customer_site_no, 'mapped' AS mapping_status FROM sites""")
def _(t: Tables):
    return c.dim_site(sites_of(t)).select("site_id", "display_name", "customer_id", "country", "timezone", "erp_customer_site_no", "mapping_status")


@query("dim_customer", "T9 K20", f"""
WITH sites AS ({SITES_SQL})
SELECT 'cust_' || replace(lower(r_name), ' ', '_') AS customer_id, r_name AS customer_name, CAST(n_regionkey AS BIGINT) AS erp_customer_no
FROM (SELECT *, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS rn FROM sites) WHERE rn = 1""")
def _(t: Tables):
    return c.dim_customer(sites_of(t)).select("customer_id", "customer_name", "erp_customer_no")


@query("crosswalk_lookups", "T10", f"""
WITH sites AS ({SITES_SQL})
SELECT 'property_' || CAST(n_nationkey AS VARCHAR) AS property_id, site_id FROM sites
UNION ALL SELECT 'child_' || CAST(n_nationkey AS VARCHAR), site_id FROM sites""")
def _(t: Tables):
    return c.property_sites(sites_of(t)).select("property_id", "site_id")


@query("orders_mapped_to_sites", "J1 Q5", f"""
WITH sites AS ({SITES_SQL})
SELECT o_orderkey, site_id, CASE WHEN site_id IS NULL THEN 'unmapped' ELSE 'mapped' END AS mapping_status
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN sites ON c_nationkey = n_nationkey""")
def _(t: Tables):
    o = t.read("orders").join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    named = o.select("o_orderkey", F.concat(F.lit("property_"), F.col("c_nationkey").cast("string")).alias("property_id"))
    return j.map_to_site(named, c.property_sites(sites_of(t)), ["property_id"]).drop("property_id")


@query("same_day_context", "J4 K15", """
SELECT wo_no, d.open_work_orders AS site_open_wo_at_start, d.alarm_count AS alarms_at_start
FROM work_orders w LEFT JOIN daily d ON d.site_id = w.site_id AND d.signal_date = CAST(work_started_at_utc AS DATE)""", ("work_orders", "daily"))
def _(t: Tables):
    out = j.day_context(t.work_orders(), t.daily(), "work_started_at_utc",
                        {"site_open_wo_at_start": "open_work_orders", "alarms_at_start": "alarm_count"})
    return out.select("wo_no", "site_open_wo_at_start", "alarms_at_start")


@query("previous_day_context", "J5", """
SELECT wo_no, round(r.open_wo_7d_avg, 6) AS site_open_wo_7d_avg, r.sla_violations_7d AS site_sla_violations_7d
FROM work_orders w LEFT JOIN rolling_ctx r ON r.site_id = w.site_id AND r.as_of_date = CAST(work_started_at_utc AS DATE) - 1""", ("work_orders", "rolling_ctx"))
def _(t: Tables):
    from evenkeel.plans.marts import rolling_context

    out = j.day_context(t.work_orders(), rolling_context(t.daily()), "work_started_at_utc",
                        {"site_open_wo_7d_avg": "open_wo_7d_avg", "site_sla_violations_7d": "sla_violations_7d"},
                        date="as_of_date", lag_days=1)
    return rounded(out.select("wo_no", "site_open_wo_7d_avg", "site_sla_violations_7d"))


@query("as_of_context", "J5", """
WITH d AS (SELECT site_id, CAST(created_at_utc AS DATE) AS signal_date, count(*) AS incident_count FROM incidents GROUP BY 1, 2)
SELECT wo_no, d.incident_count AS last_incidents FROM work_orders w ASOF LEFT JOIN d ON d.site_id = w.site_id
AND CAST(w.work_started_at_utc AS DATE) > d.signal_date""".replace("WITH d AS (", "SELECT * FROM (WITH d AS (") + ")", ("work_orders", "incidents"))
def _(t: Tables):
    from evenkeel.plans.marts import aggregate_rows, incident_rows

    daily = aggregate_rows([incident_rows(t.incidents())])
    out = j.as_of_context(t.work_orders(), daily, "work_started_at_utc", {"last_incidents": "incident_count"})
    return out.select("wo_no", "last_incidents")


@query("duplicate_items", "J7 Q2 K9", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def _(t: Tables):
    items = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return duplicate_rows(items, ["l_orderkey", "l_linenumber"])


@query("orphan_orders", "J8 Q6", f"""
WITH sites AS ({SITES_SQL})
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM sites)""")
def _(t: Tables):
    return j.orphans(t.read("customer").select("c_custkey", "c_nationkey"), "c_nationkey", mapped_nations(t), "n_nationkey")


@query("alarm_type_context", "J10 G16", """
SELECT wo_no, coalesce(n_error, 0) AS n_error, coalesce(n_view, 0) AS n_view
FROM work_orders w LEFT JOIN (SELECT site_id, CAST(created_at_utc AS DATE) AS d, count(*) FILTER (WHERE event_type = 'incident_f') AS n_error,
  count(*) FILTER (WHERE event_type = 'incident_o') AS n_view FROM incidents GROUP BY 1, 2) p ON p.site_id = w.site_id AND p.d = CAST(work_started_at_utc AS DATE)""", ("work_orders", "incidents"))
def _(t: Tables):
    from evenkeel.operators.explore import pivot_counts

    dated = t.incidents().withColumn("day", F.to_date("created_at_utc"))
    wide = pivot_counts(dated, ["site_id", "day"], "event_type", ["incident_f", "incident_o"])
    out = j.day_context(t.work_orders(), wide, "work_started_at_utc", {"n_error": "incident_f", "n_view": "incident_o"}, date="day")
    return out.select("wo_no", F.coalesce("n_error", F.lit(0)).alias("n_error"), F.coalesce("n_view", F.lit(0)).alias("n_view"))


@query("item_order_linkage", "J11", """
SELECT l_returnflag, count(*) AS row_count, count(CASE WHEN l_linenumber <> 2 THEN l_orderkey END) AS keyed, count(o_orderkey) AS matched,
       round(count(CASE WHEN l_linenumber <> 2 THEN l_orderkey END) / count(*), 6) AS keyed_rate, round(count(o_orderkey) / count(*), 6) AS matched_rate
FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey AND l_linenumber <> 2 GROUP BY 1""")
def _(t: Tables):
    items = t.read("lineitem").select("l_returnflag", F.when(F.col("l_linenumber") != 2, F.col("l_orderkey")).alias("wo"))
    closed = t.read("orders").where(F.col("o_orderstatus") == "F")
    return rounded(j.link_rate(items, "wo", closed, "o_orderkey", ["l_returnflag"]))


@query("labelled_orders", "J13", """
SELECT o_orderkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS display_name FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT nation.* FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA') ON c_nationkey = n_nationkey""")
def _(t: Tables):
    o = t.read("orders").join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    dim = mapped_nations(t).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("display_name"))
    return j.with_labels(o, dim, "c_nationkey", "display_name").select("o_orderkey", "display_name")


@query("latest_item_per_line", "W1", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def _(t: Tables):
    out = keep_latest(t.read("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@query("latest_order_with_preference", "W10", """
SELECT site_id, wo_no, work_started_at_utc, is_sla_violation FROM (SELECT *, row_number() OVER (PARTITION BY site_id
  ORDER BY CAST(is_sla_violation AS INTEGER) DESC, work_started_at_utc DESC, wo_no) AS rn FROM work_orders) WHERE rn = 1""", ("work_orders",))
def _(t: Tables):
    out = latest_with_preference(t.work_orders(), "site_id", "work_started_at_utc", F.col("is_sla_violation"), [F.col("wo_no")])
    return out.select("site_id", "wo_no", "work_started_at_utc", "is_sla_violation")


@query("last_thirty_days_per_site", "W12 L3", """
SELECT site_id, signal_date, incident_count FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY signal_date DESC) AS rn FROM daily)
WHERE rn <= 30""", ("daily",))
def _(t: Tables):
    return first_per_key(t.daily(), ["site_id"], [F.col("signal_date").desc()], 30).select("site_id", "signal_date", "incident_count")


@query("use_streaks", "W8 K24", """
WITH p AS (SELECT utilization_date, row_number() OVER (ORDER BY utilization_date) - 1 AS pos FROM (SELECT DISTINCT utilization_date FROM room_use)),
aim AS (SELECT max(pos) AS last_pos FROM p), rooms AS (SELECT DISTINCT asset_name FROM room_use),
grid AS (SELECT asset_name, pos, coalesce(utilization_pct, 0) AS v FROM rooms CROSS JOIN p LEFT JOIN room_use USING (asset_name, utilization_date)),
last_gap AS (SELECT asset_name, max(pos) AS gap FROM grid, aim WHERE pos < last_pos AND v <= 10 GROUP BY 1),
active AS (SELECT DISTINCT asset_name FROM grid, aim WHERE pos < last_pos AND v > 10)
SELECT asset_name, CAST((SELECT last_pos FROM aim) - 1 - coalesce(gap, -1) AS BIGINT) AS streak FROM active LEFT JOIN last_gap USING (asset_name)""".replace(
    "WITH p AS (", "SELECT * FROM (WITH p AS (") + ")", ("room_use",))
def _(t: Tables):
    from evenkeel.operators.rolling import use_streaks

    use = t.room_use()
    last = use.agg(F.max("utilization_date")).scalar()
    return use_streaks(use, "asset_name", "utilization_date", "utilization_pct", last, 10.0)


@query("top_orders", "L2 L5", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def _(t: Tables):
    return top_n(t.read("orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 25)


@query("relaxed_union", "U1", """
SELECT CAST(o_orderkey AS DOUBLE) AS id, o_orderstatus AS label, CAST(NULL AS INTEGER) AS size FROM orders
UNION ALL SELECT p_retailprice, p_type, p_size FROM part""")
def _(t: Tables):
    return j.relaxed_union([t.read("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label")),
                            t.read("part").select(F.col("p_retailprice").alias("id"), F.col("p_type").alias("label"), F.col("p_size").alias("size"))])


@query("first_file_wins", "U5", """
SELECT user_id, d, value FROM (SELECT user_id, CAST(ts AS DATE) AS d, value, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS rn FROM events) WHERE rn = 1""")
def _(t: Tables):
    long = t.read("events").select("user_id", F.to_date("ts").alias("d"), "value", "event_id")
    return c.first_file_wins(long, ["user_id", "d"], "event_id").drop("event_id")


@query("row_counts", "S8", """
SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents""")
def _(t: Tables):
    return row_counts({n: t.read(n) for n in ("orders", "lineitem", "events", "documents")})


@query("filtered_table", "S7", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'""")
def _(t: Tables):
    return read_table(t.spark, t.path("customer"), "BUILDING", "c_mktsegment").select("c_custkey", "c_acctbal")


@query("landing_manifest", "S9 S10 S13 S14", """
SELECT 'erp_work_orders' AS source_system, DATE '2026-06-05' AS ingest_date, CAST(1 AS BIGINT) AS file_count, count(*) AS total_row_count FROM orders
UNION ALL SELECT 'erp_alarms', DATE '2026-06-05', 1, count(*) FROM events""")
def _(t: Tables):
    ledgers = [file_ledger(t.read(n), resolve(s), "2026-06-05") for n, s in (("orders", "work_orders"), ("events", "alarms"))]
    return partition_manifest(ledgers[0].unionByName(ledgers[1])).drop("total_bytes")
