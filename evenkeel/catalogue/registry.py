"""Registration of queries and the tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
AREAS: dict[str, tuple[str, ...]] = {}

# name → (SQL, names of the tables it needs)
SHARED_SQL: dict[str, tuple[str, tuple[str, ...]]] = {}


def shared(name: str, sql: str, *needs: str) -> None:
    SHARED_SQL[name] = (sql, needs)


def with_shared(body: str, needs: tuple[str, ...]) -> str:
    """The body behind the common table expressions it needs, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dependency in SHARED_SQL[name][1]:
            add(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return body
    heads = ",\n".join(f"{n} AS (\n{SHARED_SQL[n][0].strip()}\n)" for n in ordered)
    return f"WITH {heads}\n{body.strip()}"


def query(name: str, areas: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register a query; ``areas`` is a space-separated list of inventory ids."""

    def register(fn: Callable[["Tables"], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return naive(fn(Tables(pin_utc(spark), folder)))

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        AREAS[name] = tuple(areas.split())
        if sql is not None:
            ORACLE[name] = with_shared(sql, needs)
        return fn

    return register


def naive(df: DataFrame) -> DataFrame:
    """UTC instants as timestamps without a zone, the kind the given tables have."""
    if "timestamp" not in dict(df.dtypes).values():
        return df
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round double columns: engines add up floating-point numbers in other orders."""
    return df.select(*[
        F.round(F.col(c), special.get(c, digits)).alias(c) if t == "double" else F.col(c)
        for c, t in df.dtypes])


# --- the given tables in the roles of this domain --------------------------------
WORK_TYPES = {
    "AUTOMOBILE": "Repairs and maintenance building automation",
    "BUILDING": "Cleaning services",
    "FURNITURE": "Periodic maintenance ventilation",
    "HOUSEHOLD": "Security services",
    "MACHINERY": "Outdoor works",
}

shared("alarms", """
SELECT event_id AS alert_event_id, 'site_' || CAST(user_id % 7 AS VARCHAR) AS site_id, event_type AS alert_type,
       CASE event_type WHEN 'error' THEN 1 WHEN 'purchase' THEN 13 WHEN 'signup' THEN 50 WHEN 'click' THEN 60 END AS priority,
       ts AS event_time_utc, props AS event_description, value, user_id
FROM events""")

shared("work_orders", """
SELECT o_orderkey AS wo_no, 'site_' || CAST(c_nationkey % 7 AS VARCHAR) AS site_id,
       o_orderdate AS work_started_at_utc,
       o_orderdate + to_days(CAST(o_orderkey % 14 AS INTEGER)) AS work_finished_at_utc,
       ((o_orderkey * 7919) % 1000) < o_totalprice / 500.0 AS is_sla_violation,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS priority_id,
       CASE o_orderstatus WHEN 'O' THEN 'KH' WHEN 'F' THEN 'KT' ELSE 'SP' END AS contract_type,
       c_mktsegment AS work_order_type,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Repairs and maintenance building automation'
            WHEN 'BUILDING' THEN 'Cleaning services' WHEN 'FURNITURE' THEN 'Periodic maintenance ventilation'
            WHEN 'HOUSEHOLD' THEN 'Security services' ELSE 'Outdoor works' END AS work_type_eng,
       CASE WHEN o_custkey % 3 = 0 THEN 'manual' WHEN o_custkey % 3 = 1 THEN 'automatic' END AS assignment_type,
       CASE WHEN o_orderkey % 5 = 0 THEN 'PM' || CAST(o_custkey % 50 AS VARCHAR) END AS pm_no,
       CASE WHEN o_orderkey % 6 = 0 THEN o_orderkey - 1 END AS wo_parent_id,
       o_orderkey % 2 = 0 AS is_invoicable, o_custkey % 3 = 0 AS is_subcontractor_work,
       o_orderdate AS sla_required_start_at_utc,
       CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate + to_days(CAST(1 + o_custkey % 40 AS INTEGER)) END AS sla_required_end_at_utc,
       round_even(o_totalprice / 100.0, 0) / 100.0 AS worktime_hours, o_orderpriority AS work_order_description,
       CASE WHEN o_orderkey % 3 = 0 THEN c_mktsegment END AS work_order_performed_action,
       round_even(o_totalprice / 50.0, 0) / 10000.0 AS breach_probability, o_totalprice, o_custkey
FROM orders JOIN customer ON o_custkey = c_custkey""")

shared("incidents", """
SELECT l_orderkey * 10 + l_linenumber AS incident_id, 'site_' || CAST(l_suppkey % 7 AS VARCHAR) AS site_id,
       'node_' || CAST(l_partkey AS VARCHAR) AS node_id, 'incident_' || lower(l_linestatus) AS event_type,
       CASE l_linenumber % 4 WHEN 0 THEN 'immediate' WHEN 1 THEN 'significant' WHEN 2 THEN 'according_to_agreement' ELSE 'other' END AS priority,
       l_shipdate AS created_at_utc, l_linestatus = 'F' AS is_resolved, 'incident ' || l_returnflag AS description
FROM lineitem""")

shared("readings", """
SELECT event_id, 'site_' || CAST(user_id % 7 AS VARCHAR) AS site_id, 'property_' || CAST(user_id % 7 AS VARCHAR) AS property_id,
       CASE event_type WHEN 'view' THEN 'interior_co2_ppm' WHEN 'click' THEN 'interior_temperature_C'
            WHEN 'purchase' THEN 'electricity_kWh' WHEN 'signup' THEN 'district_heating_MWh' ELSE 'fault_count' END AS metric,
       'meter_' || CAST(user_id % 10 AS VARCHAR) AS meter_key, ts AS timestamp_utc, value
FROM events""")

shared("room_use", """
SELECT CASE WHEN user_id % 2 = 0 THEN 'K' || CAST(user_id AS VARCHAR) ELSE 'Room ' || CAST(user_id AS VARCHAR) END AS asset_name,
       'site_' || CAST(user_id % 7 AS VARCHAR) AS site_id, CAST(ts AS DATE) AS utilization_date,
       least(100.0, round(sum(value), 2)) AS utilization_pct
FROM events GROUP BY 1, 2, 3""")

shared("open_daily", """
SELECT site_id, CAST(unnest(generate_series(CAST(work_started_at_utc AS DATE), CAST(work_finished_at_utc AS DATE), INTERVAL 1 DAY)) AS DATE) AS signal_date
FROM work_orders""", "work_orders")

shared("daily_rows", """
SELECT site_id, CAST(event_time_utc AS DATE) AS signal_date, 1 AS alarm_count,
       CASE WHEN alert_type = 'error' OR priority = 1 THEN 1 ELSE 0 END AS fire_alarm_count,
       CASE WHEN alert_type IN ('click', 'view') THEN 1 ELSE 0 END AS hvac_alarm_count,
       0 AS open_work_orders, 0 AS sla_violations, 0 AS incident_count, 0 AS unresolved_incident_count,
       CAST(NULL AS DOUBLE) AS avg_co2_ppm, CAST(NULL AS DOUBLE) AS avg_indoor_temp_c,
       CAST(NULL AS DOUBLE) AS avg_room_utilization_pct, CAST(NULL AS DOUBLE) AS avg_desk_utilization_pct,
       CAST(NULL AS DOUBLE) AS electricity_kwh, CAST(NULL AS DOUBLE) AS heating_mwh
FROM alarms
UNION ALL SELECT site_id, signal_date, 0, 0, 0, 1, 0, 0, 0, NULL, NULL, NULL, NULL, NULL, NULL FROM open_daily
UNION ALL SELECT site_id, CAST(work_finished_at_utc AS DATE), 0, 0, 0, 0, 1, 0, 0, NULL, NULL, NULL, NULL, NULL, NULL
  FROM work_orders WHERE is_sla_violation
UNION ALL SELECT site_id, CAST(created_at_utc AS DATE), 0, 0, 0, 0, 0, 1, CASE WHEN is_resolved THEN 0 ELSE 1 END,
  NULL, NULL, NULL, NULL, NULL, NULL FROM incidents
UNION ALL SELECT site_id, CAST(timestamp_utc AS DATE), 0, 0, 0, 0, 0, 0, 0,
  CASE WHEN metric = 'interior_co2_ppm' THEN value END, CASE WHEN metric = 'interior_temperature_C' THEN value END, NULL, NULL,
  CASE WHEN metric = 'electricity_kWh' THEN value END, CASE WHEN metric = 'district_heating_MWh' THEN value END
  FROM readings WHERE metric <> 'fault_count'
UNION ALL SELECT site_id, utilization_date, 0, 0, 0, 0, 0, 0, 0, NULL, NULL,
  CASE WHEN NOT regexp_matches(trim(asset_name), '^[Kk][0-9]+$') THEN utilization_pct END,
  CASE WHEN regexp_matches(trim(asset_name), '^[Kk][0-9]+$') THEN utilization_pct END, NULL, NULL FROM room_use""",
       "alarms", "open_daily", "work_orders", "incidents", "readings", "room_use")

shared("daily", """
SELECT site_id, signal_date, CAST(sum(alarm_count) AS BIGINT) AS alarm_count, CAST(sum(fire_alarm_count) AS BIGINT) AS fire_alarm_count,
       CAST(sum(hvac_alarm_count) AS BIGINT) AS hvac_alarm_count, CAST(sum(open_work_orders) AS BIGINT) AS open_work_orders,
       CAST(sum(sla_violations) AS BIGINT) AS sla_violations, CAST(sum(incident_count) AS BIGINT) AS incident_count,
       CAST(sum(unresolved_incident_count) AS BIGINT) AS unresolved_incident_count,
       avg(avg_co2_ppm) AS avg_co2_ppm, avg(avg_indoor_temp_c) AS avg_indoor_temp_c,
       avg(avg_room_utilization_pct) AS avg_room_utilization_pct, avg(avg_desk_utilization_pct) AS avg_desk_utilization_pct,
       sum(electricity_kwh) AS electricity_kwh, sum(heating_mwh) AS heating_mwh
FROM daily_rows GROUP BY site_id, signal_date""", "daily_rows")

shared("rolling_ctx", """
SELECT site_id, signal_date AS as_of_date, avg(open_work_orders) OVER w AS open_wo_7d_avg,
       CAST(sum(sla_violations) OVER w AS DOUBLE) AS sla_violations_7d, avg(alarm_count) OVER w AS alarms_7d_avg,
       CAST(sum(fire_alarm_count) OVER w AS DOUBLE) AS fire_alarms_7d, CAST(sum(incident_count) OVER w AS DOUBLE) AS incidents_7d,
       avg(avg_room_utilization_pct) OVER w AS utilization_7d_avg
FROM daily WINDOW w AS (PARTITION BY site_id ORDER BY signal_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", "daily")


class Tables:
    """The given tables of one folder, and the same in this domain's roles."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    @staticmethod
    def site(key: str):
        return F.concat(F.lit("site_"), (F.col(key) % 7).cast("string"))

    def alarms(self) -> DataFrame:
        kind = F.col("event_type")
        return self.read("events").select(
            F.col("event_id").alias("alert_event_id"), self.site("user_id").alias("site_id"), kind.alias("alert_type"),
            F.when(kind == "error", 1).when(kind == "purchase", 13).when(kind == "signup", 50).when(kind == "click", 60)
            .alias("priority"),
            F.col("ts").alias("event_time_utc"), F.col("props").alias("event_description"), "value", "user_id")

    def work_orders(self) -> DataFrame:
        o = self.read("orders").join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
        days = lambda n: F.make_dt_interval(n.cast("int"))
        kind = F
        for segment, name in list(WORK_TYPES.items())[:-1]:
            kind = kind.when(F.col("c_mktsegment") == segment, name)
        status = F.col("o_orderstatus")
        return o.select(
            key.alias("wo_no"), self.site("c_nationkey").alias("site_id"), F.col("o_orderdate").alias("work_started_at_utc"),
            (F.col("o_orderdate") + days(key % 14)).alias("work_finished_at_utc"),
            ((key * 7919) % 1000 < price / 500.0).alias("is_sla_violation"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.substring("o_orderpriority", 1, 1).cast("int")).alias("priority_id"),
            F.when(status == "O", "KH").when(status == "F", "KT").otherwise("SP").alias("contract_type"),
            F.col("c_mktsegment").alias("work_order_type"), kind.otherwise("Outdoor works").alias("work_type_eng"),
            F.when(cust % 3 == 0, "manual").when(cust % 3 == 1, "automatic").alias("assignment_type"),
            F.when(key % 5 == 0, F.concat(F.lit("PM"), (cust % 50).cast("string"))).alias("pm_no"),
            F.when(key % 6 == 0, key - 1).alias("wo_parent_id"),
            (key % 2 == 0).alias("is_invoicable"), (cust % 3 == 0).alias("is_subcontractor_work"),
            F.col("o_orderdate").alias("sla_required_start_at_utc"),
            F.when(key % 4 != 0, F.col("o_orderdate") + days(cust % 40 + 1)).alias("sla_required_end_at_utc"),
            (F.rint(price / 100.0) / 100.0).alias("worktime_hours"), F.col("o_orderpriority").alias("work_order_description"),
            F.when(key % 3 == 0, F.col("c_mktsegment")).alias("work_order_performed_action"),
            (F.rint(price / 50.0) / 10000.0).alias("breach_probability"), "o_totalprice", "o_custkey")

    def incidents(self) -> DataFrame:
        turn = F.col("l_linenumber") % 4
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("incident_id"), self.site("l_suppkey").alias("site_id"),
            F.concat(F.lit("node_"), F.col("l_partkey").cast("string")).alias("node_id"),
            F.concat(F.lit("incident_"), F.lower("l_linestatus")).alias("event_type"),
            F.when(turn == 0, "immediate").when(turn == 1, "significant").when(turn == 2, "according_to_agreement")
            .otherwise("other").alias("priority"),
            F.col("l_shipdate").alias("created_at_utc"), (F.col("l_linestatus") == "F").alias("is_resolved"),
            F.concat(F.lit("incident "), F.col("l_returnflag")).alias("description"))

    def readings(self) -> DataFrame:
        kind = F.col("event_type")
        return self.read("events").select(
            "event_id", self.site("user_id").alias("site_id"),
            F.concat(F.lit("property_"), (F.col("user_id") % 7).cast("string")).alias("property_id"),
            F.when(kind == "view", "interior_co2_ppm").when(kind == "click", "interior_temperature_C")
            .when(kind == "purchase", "electricity_kWh").when(kind == "signup", "district_heating_MWh")
            .otherwise("fault_count").alias("metric"),
            F.concat(F.lit("meter_"), (F.col("user_id") % 10).cast("string")).alias("meter_key"),
            F.col("ts").alias("timestamp_utc"), "value")

    def room_use(self) -> DataFrame:
        user = F.col("user_id")
        name = F.when(user % 2 == 0, F.concat(F.lit("K"), user.cast("string"))).otherwise(
            F.concat(F.lit("Room "), user.cast("string")))
        return self.read("events").groupBy(
            name.alias("asset_name"), self.site("user_id").alias("site_id"), F.to_date("ts").alias("utilization_date"),
        ).agg(F.least(F.lit(100.0), F.round(F.sum("value"), 2)).alias("utilization_pct"))

    def daily(self) -> DataFrame:
        from evenkeel.plans.marts import daily_signals

        return daily_signals(self.alarms(), self.work_orders(), self.readings(), self.room_use(),
                             incidents=self.incidents(), fire=("error",), hvac=("click", "view"),
                             as_of=F.lit("2024-02-01").cast("date")).drop("as_of_date", "avg_elevator_occupancy")
