"""Conformers: raw string rows in, typed site-keyed facts out.

Each is one ``select`` of column expressions and one crosswalk join. Bad values
never vanish: they become null and are named in ``issues``; with ``strict`` a row
with issues stops the job instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import (
    METRIC_UNITS, building_of_file, clean_null, code_lookup, elapsed_days, export_year, has_mojibake,
    local_to_utc, occupancy_kind_of_file, parse_bool, parse_date, parse_finished_days,
    parse_float, parse_int, parse_local_timestamp, parse_offset_timestamp, range_end_of_file,
    repair_mojibake, strip_blank, surrogate_key,
)
from evenkeel.operators.joins import MAPPED, map_to_site
from evenkeel.operators.latest import keep_latest
from evenkeel.sources.contracts import CROSSWALK_SCHEMA

ALARM_PRIORITIES = (1, 13, 50, 60, 77, 99)
ERP_KEY = ("customer_no", "customer_site_no")


# ---------------------------------------------------------------- crosswalk
def crosswalk(spark: SparkSession, sites: Sequence[Mapping]) -> DataFrame:
    """The site configuration as a table, in listed order (``position``)."""
    rows = [{**site, "position": i} for i, site in enumerate(sites)]
    return spark.createDataFrame(rows, schema=CROSSWALK_SCHEMA + ", position INT")


def erp_sites(sites: DataFrame) -> DataFrame:
    return sites.where(F.col("erp.customer_no").isNotNull() & F.col("erp.customer_site_no").isNotNull()).select(
        F.col("erp.customer_no").alias("customer_no"), F.col("erp.customer_site_no").alias("customer_site_no"), "site_id")


def property_sites(sites: DataFrame) -> DataFrame:
    """Property ids, own and children's, to sites."""
    own = F.array(F.col("property.property_id"))
    ids = F.concat(own, F.coalesce(F.col("property.child_property_ids"), F.array().cast("array<string>")))
    return sites.select("site_id", F.explode(ids).alias("property_id")).where(F.col("property_id").isNotNull())


def building_sites(sites: DataFrame) -> DataFrame:
    return sites.where(F.col("building_name").isNotNull()).select("building_name", "site_id")


def customer_slug(name: Column | str, slugs: Mapping[str, str] | None = None) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    plain = F.concat(F.lit("cust_"), F.replace(F.lower(column), F.lit(" "), F.lit("_")))
    return F.coalesce(code_lookup(column, slugs), plain) if slugs else plain


def dim_site(sites: DataFrame, slugs: Mapping[str, str] | None = None, zone: str = "Europe/Helsinki") -> DataFrame:
    return sites.select(
        "site_id", "display_name", customer_slug("customer_name", slugs).alias("customer_id"), "address", "city",
        F.coalesce("country", F.lit("FI")).alias("country"), F.coalesce("timezone", F.lit(zone)).alias("timezone"),
        F.col("erp.customer_no").alias("erp_customer_no"), F.col("erp.customer_site_no").alias("erp_customer_site_no"),
        F.col("property.property_id").alias("property_id"), F.col("property.file_slug").alias("property_file_slug"),
        "building_name", F.lit(MAPPED).alias("mapping_status"), F.lit(None).cast("double").alias("gross_area_m2"))


def dim_customer(sites: DataFrame, slugs: Mapping[str, str] | None = None, source: str = "crosswalk",
                 zone: str = "Europe/Helsinki", region: str = "FI") -> DataFrame:
    """First-listed site of each customer gives the customer's row."""
    keyed = sites.withColumn("customer_id", customer_slug("customer_name", slugs))
    first = keep_latest(keyed, ["customer_id"], [], ["position"])
    return first.select(
        "customer_id", "customer_name", F.col("erp.customer_no").alias("erp_customer_no"),
        F.lit(region).alias("region_code"), F.lit(None).cast("string").alias("currency"),
        F.lit(zone).alias("timezone"), F.lit(source).alias("source_system"))


# ---------------------------------------------------------------- shared steps
def _cleaned(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null-normalise the listed columns once; everything later reads the result."""
    return raw.withColumns({c: clean_null(c) for c in columns})


def _finish(typed: DataFrame, issues: Mapping[str, Column], strict: bool, scratch: Sequence[str]) -> DataFrame:
    """Put the list of issues beside the typed columns and drop the raw ones."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in issues.items()]))
    out = typed.withColumn("issues", found).drop(*scratch)
    if strict:
        message = F.concat(F.lit("rows with issues: "), F.array_join("issues", ", "))
        out = out.withColumn("issues", F.when(F.size("issues") == 0, F.col("issues")).otherwise(
            F.raise_error(message).cast("array<string>")))
    return out


def flag_duplicates(df: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Name rows whose key occurs more than once among their ``issues``.

    Keys are counted first, and only repeated ones (few, as a rule) meet the rows;
    a null key is not a duplicate here, it is an issue of its own.
    """
    repeated = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_times")).where(F.col("_times") > 1)
    marked = df.join(repeated, df[key] == repeated["_key"], "left")
    twice, message = F.col("_times").isNotNull(), f"duplicate {key}"
    added = F.array_append("issues", F.lit(message))
    stopped = F.raise_error(F.lit(f"rows with issues: {message}")).cast("array<string>") if strict else added
    return marked.withColumn("issues", F.when(twice, stopped).otherwise(F.col("issues"))).drop("_key", "_times")


def split_clean(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows without the issue list, and the rest with it. Together: all rows."""
    return df.where(F.size("issues") == 0).drop("issues"), df.where(F.size("issues") > 0)


def _int(name: str) -> Column:
    return parse_int(name, cleaned=True)


def _utc(name: str, zone: str) -> Column:
    return local_to_utc(parse_local_timestamp(name, cleaned=True), zone)


def _unparsed(raw: str, typed: str) -> Column:
    return F.col(f"_raw_{raw}").isNotNull() & F.col(typed).isNull()


def _project(df: DataFrame, columns: Mapping[str, Column], keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Typed columns, with the cleaned text of ``keep`` beside them for the checks."""
    scratch = [f"_raw_{c}" for c in keep]
    raw = [F.col(c).alias(n) for c, n in zip(keep, scratch)]
    return df.select(*[c.alias(n) for n, c in columns.items()], *raw), scratch


def _source(df: DataFrame, source_system: str) -> dict[str, Column]:
    name = F.col("source_file") if "source_file" in df.columns else F.lit(None).cast("string")
    return {"source_system": F.lit(source_system), "source_file": name}


# ---------------------------------------------------------------- ERP facts
def conform_alarms(raw: DataFrame, sites: DataFrame, zone: str = "Europe/Helsinki", strict: bool = False,
                   source_system: str = "erp_alarms") -> DataFrame:
    keys = {"alert_event_id": "ALERT_EVENT_ID", "alert_id": "ALERT_ID", "customer_no": "CUSTOMER_NO",
            "customer_site_no": "CUSTOMER_SITE_NO", "contract_no": "CONTRACT_NO", "location_id": "LOCATION_ID",
            "location_table_id": "LOCATION_TABLE_ID"}
    checked = ["Priority", "EVENT_TIME", "EVENT_CLOSED_TIME", "WORKORDER_NO"]
    clean = _cleaned(raw, [*keys.values(), *checked, "LOOP", "ALERT_TYPE", "LOG_ONLY"])
    columns = {
        **{n: _int(c) for n, c in keys.items()},
        "event_time_utc": _utc("EVENT_TIME", zone), "event_type": F.col("EVENT_TYPE"), "hwid": F.col("HWID"),
        "hwid_type": F.col("HWID_TYPE"), "loop": F.col("LOOP"), "alert_type": F.col("ALERT_TYPE"),
        "priority": _int("Priority").cast("int"), "is_log_only": F.coalesce(F.col("LOG_ONLY") == "L", F.lit(False)),
        "event_description": F.col("EVENT_DESCRIPTION"), "workorder_no": _int("WORKORDER_NO"),
        "event_closed_at_utc": _utc("EVENT_CLOSED_TIME", zone), "iva_no": F.col("IVA_NO"), "status": F.col("STATUS"),
        **_source(raw, source_system),
    }
    typed, scratch = _project(clean, columns, checked)
    typed = typed.withColumn("has_work_order", F.col("workorder_no").isNotNull())
    issues = {
        "invalid priority": _unparsed("Priority", "priority") | ~F.col("priority").isin(*ALARM_PRIORITIES),
        "missing alert_event_id": F.col("alert_event_id").isNull(),
        "bad event_time": _unparsed("EVENT_TIME", "event_time_utc"),
        "bad event_closed_time": _unparsed("EVENT_CLOSED_TIME", "event_closed_at_utc"),
        "bad workorder_no": _unparsed("WORKORDER_NO", "workorder_no"),
    }
    checked_rows = flag_duplicates(_finish(typed, issues, strict, scratch), "alert_event_id", strict)
    return map_to_site(checked_rows, erp_sites(sites), ERP_KEY)


def conform_work_orders(raw: DataFrame, sites: DataFrame, zone: str = "Europe/Helsinki", strict: bool = False,
                        source_system: str = "erp_work_orders") -> DataFrame:
    checked = ["WORK_FINISHED_DAYS", "SLA_REQUIRED_START_DATETIME", "SLA_REQUIRED_END_DATETIME", "IS_SLA_VIOLATION",
               "WORKTIME_HOURS", "WORK_INVOICABLE", "IS_SUBCONTRACTOR_WORK"]
    keys = {"wo_no": "WO_NO", "customer_no": "CUSTOMER_NO", "customer_site_no": "CUSTOMER_SITE_NO",
            "contract_no": "CONTRACT_NO", "wo_parent_id": "WO_PARENT_ID"}
    texts = ["ASSIGNMENT_TYPE", "PM_NO", "PM_ACTION_DESCR", "WORK_DESCRIPTION", "WORK_ORDER_PERFORMED_ACTION"]
    clean = _cleaned(raw.withColumn("_description", F.col("WORK_ORDER_DESCRIPTION")), [
        *keys.values(), *checked, *texts, "PRIORITY_ID", "WORK_STARTED_DATETIME", "WORK_FINISHED_DATETIME",
        "WORK_ORDER_DESCRIPTION"])
    columns = {
        **{n: _int(c) for n, c in keys.items()},
        "customer_worksite_no": F.col("CUSTOMER_WORKSITE_NO"), "contract_type": F.col("CONTRACT"),
        "work_order_type": F.col("WORK_ORDER_TYPE"), "assignment_type": F.col("ASSIGNMENT_TYPE"),
        "priority_id": _int("PRIORITY_ID").cast("int"), "work_description": repair_mojibake("WORK_DESCRIPTION"),
        "work_order_description": F.coalesce(repair_mojibake("WORK_ORDER_DESCRIPTION"), F.col("_description")),
        "work_order_performed_action": repair_mojibake("WORK_ORDER_PERFORMED_ACTION"),
        "work_type_fin": F.col("WORK_TYPE_DESCRIPTION_FIN"), "work_type_eng": F.col("WORK_TYPE_DESCRIPTION_ENG"),
        "pm_no": F.col("PM_NO"), "pm_action_descr": F.col("PM_ACTION_DESCR"),
        "_started": parse_local_timestamp("WORK_STARTED_DATETIME", cleaned=True),
        "_finished": parse_local_timestamp("WORK_FINISHED_DATETIME", cleaned=True),
        "_days": parse_finished_days("WORK_FINISHED_DAYS", cleaned=True),
        "sla_required_start_at_utc": _utc("SLA_REQUIRED_START_DATETIME", zone),
        "sla_required_end_at_utc": _utc("SLA_REQUIRED_END_DATETIME", zone),
        "_violation": _int("IS_SLA_VIOLATION"), "worktime_hours": parse_float("WORKTIME_HOURS", cleaned=True),
        "_invoicable": parse_bool("WORK_INVOICABLE"), "_subcontractor": parse_bool("IS_SUBCONTRACTOR_WORK"),
        **_source(raw, source_system),
    }
    typed, scratch = _project(clean, columns, checked)
    typed = typed.withColumns({
        "work_started_at_utc": local_to_utc("_started", zone), "work_finished_at_utc": local_to_utc("_finished", zone),
        # elapsed wall time, as both ends are read in one zone
        "work_finished_days": F.coalesce("_days", elapsed_days("_started", "_finished")),
        "is_sla_violation": F.coalesce(F.col("_violation") != 0, F.lit(False)),
        "is_invoicable": F.coalesce("_invoicable", F.lit(False)),
        "is_subcontractor_work": F.coalesce("_subcontractor", F.lit(False)),
    })
    texts = ("work_description", "work_order_description", "work_order_performed_action")
    issues = {
        "missing wo_no": F.col("wo_no").isNull(),
        "missing start": F.col("_started").isNull(), "missing finish": F.col("_finished").isNull(),
        "bad finished_days": _unparsed("WORK_FINISHED_DAYS", "_days"),
        "bad sla_start": _unparsed("SLA_REQUIRED_START_DATETIME", "sla_required_start_at_utc"),
        "bad sla_end": _unparsed("SLA_REQUIRED_END_DATETIME", "sla_required_end_at_utc"),
        "bad sla_violation": _unparsed("IS_SLA_VIOLATION", "_violation"),
        "bad worktime_hours": _unparsed("WORKTIME_HOURS", "worktime_hours"),
        "bad invoicable": _unparsed("WORK_INVOICABLE", "_invoicable"),
        "bad subcontractor": _unparsed("IS_SUBCONTRACTOR_WORK", "_subcontractor"),
        "mojibake": has_mojibake(F.concat_ws(" ", *texts)),
    }
    scratch += ["_started", "_finished", "_days", "_violation", "_invoicable", "_subcontractor"]
    return map_to_site(flag_duplicates(_finish(typed, issues, strict, scratch), "wo_no", strict), erp_sites(sites), ERP_KEY)


def conform_maintenance_plans(raw: DataFrame, sites: DataFrame, zone: str = "Europe/Helsinki", strict: bool = False,
                              source_system: str = "erp_maintenance_plans") -> DataFrame:
    """Typed plans, the latest row of each plan number."""
    checked = ["START_DATE", "VALID_FROM"]
    clean = _cleaned(raw, [*checked, "CUSTOMER_NO", "CUSTOMER_SITE_NO", "DESCRIPTION", "DESCRIPTION_ENG", "PRIORITY_ID",
                           "INTERVAL", "PM_INTERVAL_UNIT", "PLAN_HRS", "LAST_UPDATED"])
    columns = {
        "pm_no": strip_blank("PM_NO"), "contract_type": F.col("MCH_CODE_CONTRACT"),
        "customer_no": _int("CUSTOMER_NO"), "customer_site_no": _int("CUSTOMER_SITE_NO"),
        "customer_worksite_no": F.col("CUSTOMER_WORKSITE_NO"), "action_descr": F.col("ACTION_DESCR"),
        "action_descr_eng": F.col("ACTION_DESCR_ENG"), "description": F.col("DESCRIPTION"),
        "description_eng": F.col("DESCRIPTION_ENG"), "priority_id": _int("PRIORITY_ID").cast("int"),
        "interval": _int("INTERVAL"), "interval_unit": F.col("PM_INTERVAL_UNIT"),
        "plan_hrs": parse_float("PLAN_HRS", cleaned=True), "start_date": parse_date("START_DATE", cleaned=True),
        "valid_from": parse_date("VALID_FROM", cleaned=True), "objstate": F.col("OBJSTATE"),
        "last_updated_utc": _utc("LAST_UPDATED", zone), **_source(raw, source_system),
    }
    typed, scratch = _project(clean, columns, checked)
    issues = {
        "missing last_updated": F.col("last_updated_utc").isNull(), "missing pm_no": F.col("pm_no").isNull(),
        "bad start_date": _unparsed("START_DATE", "start_date"), "bad valid_from": _unparsed("VALID_FROM", "valid_from"),
    }
    latest = keep_latest(_finish(typed, issues, strict, scratch), ["pm_no"], ["last_updated_utc"],
                         ["action_descr", "source_file"])
    return map_to_site(latest, erp_sites(sites), ERP_KEY)


# ---------------------------------------------------------------- building automation
def _members(properties: DataFrame, prop: str, fields: Sequence[str]) -> DataFrame:
    """The property and its children as rows, with the parent's id on the children."""
    p = F.col(prop)
    own = F.array(F.struct(p["id"].alias("property_id"), F.lit(None).cast("string").alias("parent_property_id"),
                           *[p[f].alias(f) for f in fields]))
    children = F.transform(p["children"], lambda c: F.struct(
        c["id"].alias("property_id"), p["id"].alias("parent_property_id"), *[c[f].alias(f) for f in fields]))
    source = [c for c in ("source_file",) if c in properties.columns]
    everyone = F.when(p["children"].isNull(), own).otherwise(F.concat(own, children))
    return properties.where(p.isNotNull()).select(*source, F.inline(everyone))


def _bad_times(fields: Mapping[str, str]) -> Column:
    """Issues of offset timestamps: text that is no timestamp."""
    return F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & parse_offset_timestamp(c).isNull(), F.lit(f"bad {n}")) for n, c in fields.items()]))


def _stopped(df: DataFrame, strict: bool) -> DataFrame:
    if not strict:
        return df
    message = F.concat(F.lit("rows with issues: "), F.array_join("issues", ", "))
    return df.withColumn("issues", F.when(F.size("issues") == 0, F.col("issues")).otherwise(
        F.raise_error(message).cast("array<string>")))


def explode_readings(properties: DataFrame, prop: str = "property", source_system: str = "building_automation",
                     units: Mapping[str, str] = METRIC_UNITS, spread: int | None = None) -> DataFrame:
    """Property → metric → point, children included, in long form.

    A large document is parsed by one task; ``spread`` deals its metrics to that
    many partitions before the points are unfolded.
    """
    members = _members(properties, prop, ["readings"])
    keep = [c for c in members.columns if c != "readings"]
    metrics = members.select(*keep, F.explode("readings").alias("metric", "_block"))
    metrics = metrics.repartition(spread, "property_id", "metric") if spread else metrics
    points = metrics.select(*keep, "metric", F.inline("_block.data"))
    return points.select(
        surrogate_key("property_id", "metric", "key", "t").alias("reading_id"), "property_id", "parent_property_id",
        "metric", F.col("key").alias("meter_key"), parse_offset_timestamp("t").alias("timestamp_utc"),
        F.col("v").cast("double").alias("value"), code_lookup("metric", units, "unknown").alias("unit"),
        F.col("src").alias("source"),
        *[c.alias(n) for n, c in _source(members, source_system).items()], _bad_times({"timestamp": "t"}).alias("issues"))


def extract_incidents(properties: DataFrame, prop: str = "property",
                      source_system: str = "building_automation") -> DataFrame:
    members = _members(properties, prop, ["incidents"])
    keep = [c for c in members.columns if c not in ("incidents", "parent_property_id")]
    found = members.select(*keep, F.inline("incidents"))
    return found.select(
        F.col("id").alias("incident_id"), "property_id", "node_id",
        parse_offset_timestamp("created_at").alias("created_at_utc"),
        parse_offset_timestamp("updated_at").alias("updated_at_utc"), "event_type", "priority", "status", "category",
        F.col("points").cast("double").alias("points"), "description",
        F.coalesce("internal", F.lit(False)).alias("is_internal"),
        F.coalesce("include_in_report", F.lit(True)).alias("include_in_report"),
        (F.col("status") == "resolved").alias("is_resolved"),
        *[c.alias(n) for n, c in _source(members, source_system).items()],
        _bad_times({"created_at": "created_at", "updated_at": "updated_at"}).alias("issues"))


def conform_readings(properties: DataFrame, sites: DataFrame, strict: bool = False, **kwargs) -> DataFrame:
    points = flag_duplicates(_stopped(explode_readings(properties, **kwargs), strict), "reading_id", strict)
    return map_to_site(points, property_sites(sites), ["property_id"])


def conform_incidents(properties: DataFrame, sites: DataFrame, strict: bool = False, **kwargs) -> DataFrame:
    found = flag_duplicates(_stopped(extract_incidents(properties, **kwargs), strict), "incident_id", strict)
    return map_to_site(found, property_sites(sites), ["property_id"])


# ---------------------------------------------------------------- occupancy, utilization
def explode_hourly(profiles: DataFrame, values: str = "occupancy", hour: str = "hour",
                   value: str = "occupancy_value") -> DataFrame:
    """Array of hourly values → one row an hour."""
    keep = [c for c in profiles.columns if c != values]
    return profiles.select(*keep, F.posexplode(values).alias(hour, value)).withColumn(value, F.col(value).cast("double"))


def conform_occupancy(profiles: DataFrame, sites: DataFrame, buildings: Sequence[str],
                      source_system: str = "occupancy", first_month: int = 12, first_year: int = 2025,
                      strict: bool = False) -> DataFrame:
    """Hourly values of all profiles; rows whose ``occupancy_id`` is not their own say so
    in ``issues`` (``strict``: the query fails)."""
    named = profiles.withColumns({
        "building_name": building_of_file("file_name", buildings), "value_type": occupancy_kind_of_file("file_name"),
        "year": export_year("month", first_month, first_year)})
    hours = explode_hourly(named)
    out = hours.select(
        surrogate_key("building_name", "year", "month", "weekday", "floor", "hour", "value_type").alias("occupancy_id"),
        "building_name", "year", "month", "weekday", "floor", "floor_id", "hour", "occupancy_value", "value_type",
        "site_connection_ok", *[c.alias(n) for n, c in _source(hours, source_system).items()],
        F.array().cast("array<string>").alias("issues"))
    return map_to_site(flag_duplicates(out, "occupancy_id", strict), building_sites(sites), ["building_name"])


def unpivot_wide_dates(wide: DataFrame, identifier: str, name: str, value: str) -> DataFrame:
    """Wide date columns → long; the header is the date, non-numbers are null."""
    dates = [c for c in wide.columns if c != identifier]
    long = wide.select(identifier, *[F.col(f"`{c}`").cast("string").alias(c) for c in dates]).unpivot(
        identifier, dates, name, value)
    return long.select(identifier, F.try_to_date(F.col(name)).alias(name), F.col(value).try_cast("double").alias(value))


def conform_utilization(long: DataFrame, site_id: str, identifier: str = "asset",
                        source_system: str = "cleaning_utilization") -> DataFrame:
    """Long rows of overlapping exports → one row an asset and date, latest export first.

    ``long`` is what ``readers.read_wide_csv`` gives: identifier, header, value and
    file name. All rows belong to one site.
    """
    typed = long.select(
        F.col(identifier).alias("asset_name"), F.try_to_date(F.col("header")).alias("utilization_date"),
        clean_null("value").try_cast("double").alias("utilization_pct"), F.col("file_path").alias("source_file"),
        range_end_of_file("file_name").alias("_export_end"))
    latest = keep_latest(typed, ["asset_name", "utilization_date"], ["_export_end"], ["source_file"])
    return latest.select(
        surrogate_key("asset_name", "utilization_date").alias("utilization_id"), "asset_name",
        F.lit(None).cast("string").alias("asset_id"), "utilization_date", "utilization_pct",
        F.lit(site_id).alias("site_id"), F.lit(MAPPED).alias("mapping_status"),
        F.lit(source_system).alias("source_system"), "source_file")


def first_file_wins(long: DataFrame, keys: Sequence[str], file: str) -> DataFrame:
    """Side-by-side files in long form: the first file's value for a repeated column."""
    return keep_latest(long, keys, [], [file])
