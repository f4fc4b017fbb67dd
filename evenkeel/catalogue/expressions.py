"""Scalar expressions over the given tables, checked value by value."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel import functions as x
from evenkeel.catalogue.registry import Tables, query, rounded
from evenkeel.functions.text import CP1252_EXTRA

BLANK_SQL = "' ' || chr(9) || chr(10) || chr(13)"


@query("clean_role_text", "C1 C2", f"""
WITH raw AS (SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN ' NULL ' WHEN 1 THEN chr(9) || 'none' WHEN 2 THEN chr(65279) || role || ' '
             WHEN 3 THEN '  ' ELSE ' ' || role END AS t FROM conversations),
     cut AS (SELECT conv_id, turn, ltrim(trim(t, {BLANK_SQL}), chr(65279)) AS t FROM raw)
SELECT conv_id, turn, CASE WHEN t NOT IN ('NULL', 'null', 'None', 'none', '') THEN t END AS role FROM cut""")
def _(t: Tables):
    turn = F.col("turn") % 5
    raw = (F.when(turn == 0, " NULL ").when(turn == 1, "\tnone").when(turn == 2, F.concat(F.lit("\ufeff"), "role", F.lit(" ")))
           .when(turn == 3, "  ").otherwise(F.concat(F.lit(" "), "role")))
    return t.read("conversations").select("conv_id", "turn", x.clean_null(raw).alias("role"))


@query("repaired_documents", "C3", r"""
WITH broken AS (SELECT doc_id, lang, replace(replace(replace(text, 'é', 'Ã©'), 'ä', 'Ã¤'), 'ö', 'Ã¶') AS b FROM documents),
     fixed AS (SELECT doc_id, lang, b, CASE WHEN regexp_matches(b, 'Ã[\x{80}-\x{BF}]|â€|ï¿½') THEN
       replace(replace(replace(replace(replace(replace(replace(replace(b, 'Ã¤', 'ä'), 'Ã„', 'Ä'), 'Ã¶', 'ö'), 'Ã–', 'Ö'),
       'Ã¥', 'å'), 'Ã…', 'Å'), 'Ã©', 'é'), 'Ã¼', 'ü') ELSE b END AS f FROM broken)
SELECT doc_id, lang, regexp_matches(b, 'Ã[\x{80}-\x{BF}]|â€|ï¿½') AS was_broken,
       regexp_matches(f, 'Ã[\x{80}-\x{BF}]|â€|ï¿½') AS still_broken, sha256(f) AS text_hash FROM fixed""")
def _(t: Tables):
    b = F.col("text")
    for good, bad in (("é", "Ã©"), ("ä", "Ã¤"), ("ö", "Ã¶")):
        b = F.replace(b, F.lit(good), F.lit(bad))
    docs = t.read("documents").select("doc_id", "lang", b.alias("_b")).withColumn("_f", x.repair_mojibake("_b"))
    return docs.select("doc_id", "lang", x.has_mojibake("_b").alias("was_broken"), x.has_mojibake("_f").alias("still_broken"),
                       F.sha2("_f", 256).alias("text_hash"))


@query("parsed_booleans", "C4 K11", """
WITH raw AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'TOSI' WHEN 1 THEN 'EPÄTOSI' WHEN 2 THEN ' yes ' WHEN 3 THEN 'NO'
             WHEN 4 THEN 'NULL' WHEN 5 THEN '1' ELSE 'maybe' END AS t FROM orders)
SELECT o_orderkey, CASE WHEN trim(t) IN ('TOSI', 'true', 'True', '1', 'yes', 'YES') THEN true
       WHEN trim(t) IN ('EPÄTOSI', 'EPATOSI', 'false', 'False', '0', 'no', 'NO') THEN false END AS parsed,
       t = 'maybe' AS failed FROM raw""")
def _(t: Tables):
    k = F.col("o_orderkey") % 7
    raw = (F.when(k == 0, "TOSI").when(k == 1, "EPÄTOSI").when(k == 2, " yes ").when(k == 3, "NO").when(k == 4, "NULL")
           .when(k == 5, "1").otherwise("maybe"))
    parsed = x.parse_bool(raw)
    return t.read("orders").select("o_orderkey", parsed.alias("parsed"), x.parse_failed(raw, parsed).alias("failed"))


@query("parsed_numbers", "C5 C6 C7", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_suppkey END AS whole,
       CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount END AS comma, CAST(CAST(l_linenumber AS VARCHAR) || '.' || CAST(l_suppkey % 90 + 10 AS VARCHAR) AS DOUBLE) AS days
FROM lineitem""")
def _(t: Tables):
    n = F.col("l_linenumber")
    whole = F.when(n == 3, "NULL").otherwise(F.concat(F.col("l_suppkey").cast("string"), F.lit(".0")))
    comma = F.when(n == 2, "null").otherwise(F.replace(F.col("l_discount").cast("string"), F.lit("."), F.lit(",")))
    days = F.concat(n.cast("string"), F.lit("."), (F.col("l_suppkey") % 90 + 10).cast("string"), F.lit(".00"))
    return t.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", x.parse_int(whole).alias("whole"), x.parse_float(comma).alias("comma"),
        x.parse_finished_days(days).alias("days"))


@query("local_times_to_utc", "C8 C10", """
WITH l AS (SELECT o_orderkey, o_orderdate + to_minutes(CAST(o_custkey % 1440 AS INTEGER)) AS wall FROM orders),
u AS (SELECT *, CAST(wall AT TIME ZONE 'Europe/Helsinki' AT TIME ZONE 'UTC' AS TIMESTAMP) AS utc FROM l)
SELECT o_orderkey, CASE WHEN CAST((utc - INTERVAL 1 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Helsinki' AS TIMESTAMP) = wall
  THEN utc - INTERVAL 1 HOUR ELSE utc END AS utc FROM u  -- an hour that occurs twice means its first occurrence""")
def _(t: Tables):
    at = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("o_custkey") % 1440).cast("int"))
    iso, european = F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS"), F.date_format(at, "d.M.yyyy H:mm")
    raw = F.when(F.col("o_orderkey") % 2 == 0, iso).otherwise(european)
    return t.read("orders").select("o_orderkey", x.local_to_utc(x.parse_local_timestamp(raw)).alias("utc"))


@query("local_times_by_site_zone", "C10 K22", """
SELECT o_orderkey, CAST(CASE WHEN o_custkey % 2 = 0 THEN o_orderdate AT TIME ZONE 'Europe/Helsinki' ELSE o_orderdate AT TIME ZONE 'America/New_York' END
       AT TIME ZONE 'UTC' AS TIMESTAMP) AS utc FROM orders""")
def _(t: Tables):
    zone = F.when(F.col("o_custkey") % 2 == 0, "Europe/Helsinki").otherwise("America/New_York")
    return t.read("orders").select("o_orderkey", x.local_to_utc(F.col("o_orderdate").cast("timestamp"), zone).alias("utc"))


@query("parsed_dates", "C9", """
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_shipdate AS DATE) AS ship FROM lineitem""")
def _(t: Tables):
    d = F.col("l_shipdate")
    raw = F.when(F.col("l_linenumber") % 3 == 0, F.date_format(d, "yyyy-MM-dd")).when(
        F.col("l_linenumber") % 3 == 1, F.date_format(d, "d.M.yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
    return t.read("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", x.parse_date(raw).alias("ship"))


@query("offset_timestamps", "C11", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def _(t: Tables):
    short = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))
    full = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    bare = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = F.when(F.col("event_id") % 3 == 0, short).when(F.col("event_id") % 3 == 1, full).otherwise(bare)
    return t.read("events").select("event_id", x.parse_offset_timestamp(raw).alias("at"))


@query("surrogate_keys", "C12 K23", """
SELECT l_orderkey, l_linenumber, l_partkey, substr(sha256(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' ||
       coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, 'None') || '|' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR)), 1, 16) AS id
FROM lineitem""")
def _(t: Tables):
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", x.surrogate_key(
        "l_orderkey", "l_linenumber", flag, F.to_date("l_shipdate")).alias("id"))


@query("file_name_parts", "C13 S11 K5", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'North House' ELSE 'South Plaza' END AS building,
       CASE WHEN o_orderkey % 3 = 0 THEN 'normalized' ELSE 'raw_count' END AS kind, CAST(o_orderdate AS DATE) AS range_end,
       CAST(o_orderdate AS DATE) AS export_date FROM orders""")
def _(t: Tables):
    even, d = F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")
    stem = F.when(even, "North_House_").otherwise("South_Plaza_")
    dated = F.when(even, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "yyyyMMdd"))
    name = F.concat(stem, dated, F.lit("_1"), F.when(F.col("o_orderkey") % 3 == 0, "-normalized").otherwise(""), F.lit(".json"))
    wide = F.concat(F.lit("Room_Utilization_010190-"), F.date_format(d, "ddMMyy"), F.lit(".csv"))
    # two-digit years are read as 20xx: shift the century back for the comparison
    end = x.range_end_of_file(wide)
    end = F.when(F.year(end) > F.year(d), F.add_months(end, -1200)).otherwise(end)
    return t.read("orders").select(
        "o_orderkey", x.building_of_file(name, ["North House", "South Plaza"]).alias("building"),
        x.occupancy_kind_of_file(name).alias("kind"), end.alias("range_end"),
        x.file_export_date(name, F.current_date()).alias("export_date"))


@query("export_years", "C14", """
SELECT o_orderkey, CAST(CASE WHEN month(o_orderdate) = 12 THEN 2025 ELSE 2026 END AS BIGINT) AS export_year FROM orders""")
def _(t: Tables):
    return t.read("orders").select("o_orderkey", x.export_year(F.month("o_orderdate")).cast("bigint").alias("export_year"))


@query("first_weekdays", "C15", """
SELECT o_orderkey, CAST(make_date(year(o_orderdate), month(o_orderdate), 1)
       + to_days(CAST((isodow(o_orderdate) - isodow(make_date(year(o_orderdate), month(o_orderdate), 1)) + 7) % 7 AS INTEGER)) AS DATE) AS first_day
FROM orders""")
def _(t: Tables):
    d = F.col("o_orderdate")
    return t.read("orders").select("o_orderkey", x.first_weekday_of_month(
        F.year(d), F.month(d), x.iso_weekday(d)).alias("first_day"))


@query("metric_units", "C16", """
SELECT event_id, metric, CASE metric WHEN 'electricity_kWh' THEN 'kWh' WHEN 'district_heating_MWh' THEN 'MWh'
       WHEN 'interior_temperature_C' THEN 'C' WHEN 'interior_co2_ppm' THEN 'ppm' ELSE 'unknown' END AS unit FROM readings""", ("readings",))
def _(t: Tables):
    return t.readings().select("event_id", "metric", x.code_lookup("metric", x.METRIC_UNITS, "unknown").alias("unit"))


@query("alarm_and_incident_severity", "C17", """
SELECT 'alarm' AS source, severity, count(*) AS n FROM (SELECT CASE priority WHEN 1 THEN 'critical' WHEN 13 THEN 'high' WHEN 50 THEN 'medium'
       WHEN 60 THEN 'standard' ELSE 'standard' END AS severity FROM alarms) GROUP BY 2
UNION ALL SELECT 'incident', severity, count(*) FROM (SELECT CASE priority WHEN 'immediate' THEN 'critical' WHEN 'significant' THEN 'high'
       ELSE 'standard' END AS severity FROM incidents) GROUP BY 2""", ("alarms", "incidents"))
def _(t: Tables):
    a = t.alarms().select(F.lit("alarm").alias("source"), x.code_lookup("priority", x.ALARM_SEVERITY, "standard").alias("severity"))
    i = t.incidents().select(F.lit("incident").alias("source"), x.code_lookup("priority", x.INCIDENT_SEVERITY, "standard").alias("severity"))
    return a.unionByName(i).groupBy("source", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("desk_assets", "C19", """
SELECT asset_name, regexp_matches(trim(asset_name), '^[Kk][0-9]+$') AS is_desk FROM room_use GROUP BY 1""", ("room_use",))
def _(t: Tables):
    from evenkeel.plans.marts import DESK_PATTERN

    return t.room_use().select("asset_name", x.matches_class("asset_name", DESK_PATTERN).alias("is_desk")).distinct()


@query("roles_by_keyword", "C20", """
SELECT wo_no, CASE WHEN lower(work_type_eng) LIKE '%clean%' THEN 'Cleaner' WHEN lower(work_type_eng) LIKE '%security%' THEN 'Security'
       WHEN lower(work_type_eng) LIKE '%outdoor%' THEN 'Groundskeeper' WHEN lower(work_type_eng) LIKE '%ventil%' THEN 'HVAC technician'
       ELSE 'Technician' END AS role FROM work_orders""", ("work_orders",))
def _(t: Tables):
    return t.work_orders().select("wo_no", x.role_of("work_type_eng").alias("role"))


@query("threshold_bands", "C21", """
SELECT wo_no, CASE WHEN breach_probability >= 0.66 THEN 'HIGH' WHEN breach_probability >= 0.45 THEN 'MEDIUM' ELSE 'LOW' END AS risk,
       CASE WHEN breach_probability * 100 >= 70 THEN 'ELEVATED' WHEN breach_probability * 100 >= 40 THEN 'NORMAL' ELSE 'CALM' END AS idx,
       CASE WHEN wo_no % 9 = 0 THEN 'no model' WHEN breach_probability >= 0.65 THEN 'HIGH' WHEN breach_probability >= 0.35 THEN 'MEDIUM' ELSE 'LOW' END AS label,
       CASE WHEN breach_probability * 100 >= 65 THEN 'CLEAN' WHEN breach_probability * 100 >= 35 THEN 'MONITOR' ELSE 'SKIP' END AS cleaning
FROM work_orders""", ("work_orders",))
def _(t: Tables):
    p = F.col("breach_probability")
    routed = F.when(F.col("wo_no") % 9 != 0, p)
    return t.work_orders().select(
        "wo_no", x.risk_band(p).alias("risk"), x.index_band(p * 100).alias("idx"),
        x.probability_label(routed).alias("label"), x.cleaning_band(p * 100).alias("cleaning"))


ACTION_SQL = """CASE WHEN (severity = 'Critical' AND risk_band <> 'LOW') OR (severity = 'High' AND risk_band = 'HIGH') THEN 'Urgent'
  WHEN (severity = 'Medium' AND risk_band = 'LOW') OR (severity = 'Low' AND risk_band <> 'HIGH') THEN 'Low priority' ELSE 'Monitor' END"""
SEVERITY_SQL = """CASE work_type_eng WHEN 'Repairs and maintenance building automation' THEN 'High' WHEN 'Cleaning services' THEN 'Low'
  WHEN 'Periodic maintenance ventilation' THEN 'Medium' WHEN 'Security services' THEN 'Critical' ELSE work_type_eng END"""
RISK_SQL = "CASE WHEN breach_probability >= 0.66 THEN 'HIGH' WHEN breach_probability >= 0.45 THEN 'MEDIUM' ELSE 'LOW' END"


@query("dispatch_actions", "C22 C23", f"""
WITH g AS (SELECT wo_no, {SEVERITY_SQL} AS severity, {RISK_SQL} AS risk_band FROM work_orders)
SELECT wo_no, severity, risk_band, {ACTION_SQL} AS action,
       CAST(CASE {ACTION_SQL} WHEN 'Urgent' THEN 0 WHEN 'Monitor' THEN 1 ELSE 2 END AS BIGINT) AS action_rank,
       CAST(CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 ELSE 4 END AS BIGINT) AS severity_rank,
       CAST(CASE risk_band WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END AS BIGINT) AS risk_rank FROM g""".replace(
    "WITH g AS (", "SELECT * FROM (WITH g AS (") + ")", ("work_orders",))
def _(t: Tables):
    graded = t.work_orders().select("wo_no", x.severity_of("work_type_eng").alias("severity"),
                                    x.risk_band("breach_probability").alias("risk_band"))
    graded = graded.withColumn("action", x.dispatch_action("severity", "risk_band"))
    ranks = [c.cast("bigint").alias(n) for c, n in zip(x.dispatch_order(), ("action_rank", "severity_rank", "risk_rank"))]
    return graded.select("*", *ranks)


@query("breach_reasons", "C24", """
SELECT wo_no, work_type_eng || ': ' || CAST(CAST(round_even(round_even(breach_probability * 100, 1), 0) AS BIGINT) AS VARCHAR) || '% breach risk — ' ||
       CASE WHEN round_even(breach_probability * 100, 1) >= 80 THEN 'long/complex job that has historically slipped; start now.'
            WHEN round_even(breach_probability * 100, 1) >= 55 THEN 'typical for this service line; don''t let it sit.'
            ELSE 'low; safe to schedule later.' END AS reason FROM work_orders""", ("work_orders",))
def _(t: Tables):
    pct = x.half_even(F.col("breach_probability") * 100, 1)
    return t.work_orders().select("wo_no", x.breach_reason("work_type_eng", pct).alias("reason"))


@query("calendar_parts", "C25 M20 K6", """
SELECT event_id, CAST(month(ts) AS BIGINT) AS month, CAST(isodow(ts) AS BIGINT) AS weekday, CAST(hour(ts) AS BIGINT) AS hour,
       CAST(year(ts) AS BIGINT) AS year, CAST(isoyear(ts) AS BIGINT) AS iso_year, CAST(week(ts) AS BIGINT) AS iso_week,
       isodow(ts) >= 6 AS is_weekend, CAST(date_trunc('month', ts) AS DATE) AS period FROM events""")
def _(t: Tables):
    parts = x.calendar_columns("ts")
    whole = ("month", "weekday", "hour", "year", "iso_year", "iso_week")
    return t.read("events").select("event_id", *[
        (c.cast("bigint") if n in whole else c).alias(n) for n, c in parts.items()])


@query("order_durations", "C26", """
SELECT wo_no, round(epoch(work_finished_at_utc - work_started_at_utc) / 3600.0, 6) AS duration_h,
       round(epoch(sla_required_end_at_utc - sla_required_start_at_utc) / 3600.0, 6) AS window_h,
       round(epoch(sla_required_end_at_utc - work_started_at_utc) / 86400.0, 6) AS window_days FROM work_orders""", ("work_orders",))
def _(t: Tables):
    return rounded(t.work_orders().select(
        "wo_no", x.elapsed_hours("work_started_at_utc", "work_finished_at_utc").alias("duration_h"),
        x.elapsed_hours("sla_required_start_at_utc", "sla_required_end_at_utc").alias("window_h"),
        x.elapsed_days("work_started_at_utc", "sla_required_end_at_utc").alias("window_days")))


@query("presence_and_unknown", "C27 C28", """
SELECT wo_no, CAST(pm_no IS NOT NULL AS BIGINT) AS has_pm_no, CAST(wo_parent_id IS NOT NULL AS BIGINT) AS has_parent_wo,
       CAST(sla_required_end_at_utc IS NOT NULL AS BIGINT) AS has_deadline, coalesce(CAST(priority_id AS VARCHAR), 'unknown') AS priority_id_str,
       coalesce(assignment_type, 'unknown') AS assignment_type FROM work_orders""", ("work_orders",))
def _(t: Tables):
    return t.work_orders().select(
        "wo_no", x.presence_flag("pm_no").cast("bigint").alias("has_pm_no"),
        x.presence_flag("wo_parent_id").cast("bigint").alias("has_parent_wo"),
        x.presence_flag("sla_required_end_at_utc").cast("bigint").alias("has_deadline"),
        x.known_or_unknown("priority_id").alias("priority_id_str"), x.known_or_unknown("assignment_type").alias("assignment_type"))


@query("business_days", "C29", """
WITH RECURSIVE calendar AS (SELECT DATE '1994-12-01' AS d UNION ALL SELECT CAST(d + INTERVAL 1 DAY AS DATE) FROM calendar WHERE d < DATE '2002-06-01'),
working AS (SELECT d, row_number() OVER (ORDER BY d) AS n FROM calendar WHERE isodow(d) < 6),
based AS (SELECT c.d, (SELECT max(n) FROM working w WHERE w.d <= c.d) AS n FROM calendar c)
SELECT o_orderkey, CASE WHEN o_orderkey % 12 = 0 THEN CAST(o_orderdate AS DATE) ELSE w.d END AS due
FROM orders JOIN based b ON b.d = CAST(o_orderdate AS DATE) JOIN working w ON w.n = b.n + o_orderkey % 12""")
def _(t: Tables):
    return t.read("orders").select("o_orderkey", x.nth_business_day(F.to_date("o_orderdate"), F.col("o_orderkey") % 12).alias("due"))


@query("clipped_and_rounded", "C30", """
SELECT l_orderkey, l_linenumber, l_partkey, least(greatest(l_quantity / 40.0, 0.25), 1.0) AS clipped,
       round_even(l_quantity / 8.0, 0) AS even, round(l_discount * 100, 1) AS pct FROM lineitem""")
def _(t: Tables):
    q = F.col("l_quantity")
    return t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", x.clip(q / 40.0, 0.25, 1.0).alias("clipped"),
                                     x.half_even(q / 8.0, 0).alias("even"), F.round(F.col("l_discount") * 100, 1).alias("pct"))


@query("normalised_names", "C31", """
SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%ring%' THEN 'Ring site' WHEN lower(p_name) LIKE '%widget%' THEN 'Widget site'
       WHEN lower(p_name) LIKE '%bolt%' THEN 'Bolt site' ELSE 'Other' END AS site FROM part""")
def _(t: Tables):
    rules = (("ring", "Ring site"), ("widget", "Widget site"), ("bolt", "Bolt site"))
    return t.read("part").select("p_partkey", x.first_keyword("p_name", rules, "Other").alias("site"))


@query("binned_windows", "C32", """
SELECT wo_no, CASE WHEN h > 0 AND h <= 24 THEN '<1d' WHEN h > 24 AND h <= 72 THEN '1-3d' WHEN h > 72 AND h <= 168 THEN '3-7d'
       WHEN h > 168 AND h <= 720 THEN '7-30d' WHEN h > 720 AND h <= 5000 THEN '>30d' END AS window_bin,
       CAST((p >= 0.1)::INT + (p >= 0.2)::INT + (p >= 0.30000000000000004)::INT + (p >= 0.4)::INT + (p >= 0.5)::INT + (p >= 0.6000000000000001)::INT
       + (p >= 0.7000000000000001)::INT + (p >= 0.8)::INT + (p >= 0.9)::INT AS BIGINT) AS score_bin
FROM (SELECT wo_no, epoch(sla_required_end_at_utc - sla_required_start_at_utc) / 3600.0 AS h, breach_probability AS p FROM work_orders)""", ("work_orders",))
def _(t: Tables):
    hours = x.elapsed_hours("sla_required_start_at_utc", "sla_required_end_at_utc")
    return t.work_orders().select(
        "wo_no", x.interval_bin(hours, (0, 24, 72, 168, 720, 5000), ("<1d", "1-3d", "3-7d", "7-30d", ">30d")).alias("window_bin"),
        x.equal_bin("breach_probability").cast("bigint").alias("score_bin"))


@query("prefixed_ids", "C33", """
SELECT wo_no, 'wo:' || CAST(wo_no AS VARCHAR) || ':started' AS event_id, coalesce(work_order_performed_action, work_order_description) AS description
FROM work_orders""", ("work_orders",))
def _(t: Tables):
    return t.work_orders().select("wo_no", x.prefixed_id("wo:", "wo_no", ":started").alias("event_id"),
                                  F.coalesce("work_order_performed_action", "work_order_description").alias("description"))


@query("header_delimiters", "S2", """
SELECT doc_id, CASE WHEN length(h) - length(replace(h, ';', '')) > length(h) - length(replace(h, ',', '')) THEN ';' ELSE ',' END AS delimiter
FROM (SELECT doc_id, split_part(text, chr(10), 1) AS h FROM documents)""")
def _(t: Tables):
    return t.read("documents").select("doc_id", x.delimiter_of("text").alias("delimiter"))


@query("cp1252_texts", "S3 H1", """
SELECT doc_id, lang, sha256(text) AS text_hash FROM documents""")
def _(t: Tables):
    # what the reader sees of a Windows-1252 file (Latin-1 characters) gives the text back
    extra = {character: code for code, character in CP1252_EXTRA.items()}
    as_read = F.translate("text", "".join(extra), "".join(map(chr, extra.values())))
    return t.read("documents").select("doc_id", "lang", F.sha2(x.cp1252_from_latin1(as_read), 256).alias("text_hash"))
