"""Source contracts: families, raw columns, canonical table schemas.

Raw files are always read as strings against these columns; nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: the raw columns of each export and the canonical schemas ------
ALARM_COLUMNS = (
    "ALERT_EVENT_ID", "ALERT_ID", "CUSTOMER_NO", "CUSTOMER_SITE_NO", "CONTRACT_NO", "LOCATION_ID",
    "LOCATION_TABLE_ID", "EVENT_TIME", "EVENT_CLOSED_TIME", "EVENT_TYPE", "HWID", "HWID_TYPE",
    "EVENT_DESCRIPTION", "IVA_NO", "STATUS", "LOOP", "ALERT_TYPE", "Priority", "LOG_ONLY", "WORKORDER_NO",
)
WORK_ORDER_COLUMNS = (
    "WO_NO", "CUSTOMER_NO", "CUSTOMER_SITE_NO", "CUSTOMER_WORKSITE_NO", "CONTRACT", "CONTRACT_NO",
    "WORK_ORDER_TYPE", "WO_PARENT_ID", "ASSIGNMENT_TYPE", "PRIORITY_ID", "WORK_DESCRIPTION",
    "WORK_ORDER_DESCRIPTION", "WORK_ORDER_PERFORMED_ACTION", "WORK_TYPE_DESCRIPTION_FIN",
    "WORK_TYPE_DESCRIPTION_ENG", "PM_NO", "PM_ACTION_DESCR", "WORK_STARTED_DATETIME",
    "WORK_FINISHED_DATETIME", "WORK_FINISHED_DAYS", "SLA_REQUIRED_START_DATETIME",
    "SLA_REQUIRED_END_DATETIME", "IS_SLA_VIOLATION", "WORKTIME_HOURS", "WORK_INVOICABLE",
    "IS_SUBCONTRACTOR_WORK",
)
PLAN_COLUMNS = (
    "LAST_UPDATED", "PM_NO", "MCH_CODE_CONTRACT", "CUSTOMER_WORKSITE_NO", "CUSTOMER_NO", "customer_name",
    "CUSTOMER_SITE_NO", "customer_site_name", "site_address", "ACTION_DESCR", "ACTION_DESCR_ENG",
    "PRIORITY_ID", "INTERVAL", "PM_INTERVAL_UNIT", "LAST_CHANGED", "PLAN_HRS", "DESCRIPTION",
    "DESCRIPTION_ENG", "START_DATE", "REV_CRE_DATE", "VALID_FROM", "OBJSTATE",
)
_POINT = "STRUCT<t: STRING, v: DOUBLE, key: STRING, src: STRING>"
_READINGS = f"MAP<STRING, STRUCT<data: ARRAY<{_POINT}>>>"
_INCIDENTS = (
    "ARRAY<STRUCT<id: STRING, node_id: STRING, created_at: STRING, updated_at: STRING, event_type: STRING, "
    "priority: STRING, status: STRING, category: STRING, points: DOUBLE, description: STRING, "
    "internal: BOOLEAN, include_in_report: BOOLEAN>>"
)
_NODES = "ARRAY<STRUCT<id: STRING, name: STRING, type: STRING, tags: STRING>>"
PROPERTY_SCHEMA = (
    f"property STRUCT<id: STRING, readings: {_READINGS}, incidents: {_INCIDENTS}, nodes: {_NODES}, "
    f"children: ARRAY<STRUCT<id: STRING, readings: {_READINGS}, incidents: {_INCIDENTS}>>>, "
    "properties ARRAY<STRING>"
)
OCCUPANCY_SCHEMA = (
    "month INT, weekday INT, site_connection_ok BOOLEAN, floor STRING, floor_id INT, occupancy ARRAY<DOUBLE>"
)
CROSSWALK_SCHEMA = (
    "site_id STRING, display_name STRING, customer_name STRING, address STRING, city STRING, country STRING, "
    "timezone STRING, erp STRUCT<customer_no: BIGINT, customer_site_no: BIGINT>, "
    "property STRUCT<property_id: STRING, file_slug: STRING, child_property_ids: ARRAY<STRING>>, "
    "building_name STRING"
)
TIMELINE_SCHEMA = (
    "event_id STRING, site_id STRING, asset_id STRING, event_type STRING, severity STRING, "
    "timestamp_utc TIMESTAMP, description STRING, source_system STRING, source_record_id STRING"
)
# ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Contract:
    """What one source family delivers."""

    name: str
    source_system: str
    format: str
    table: str
    key: tuple[str, ...]
    columns: tuple[str, ...] = ()
    schema: str | None = None
    expected_rows: int | None = None
    enums: dict[str, tuple] = field(default_factory=dict)
    file_pattern: str = "*"

    def raw_schema(self) -> T.StructType:
        if self.schema:
            return T.StructType.fromDDL(self.schema)
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


CONTRACTS = {
    c.name: c
    for c in (
        Contract("alarms", "erp_alarms", "csv", "fact_alarm", ("alert_event_id",), ALARM_COLUMNS,
                 expected_rows=18702, enums={"priority": (1, 13, 50, 60, 77, 99)}, file_pattern="*.csv"),
        Contract("work_orders", "erp_work_orders", "csv", "fact_work_order", ("wo_no",), WORK_ORDER_COLUMNS,
                 expected_rows=44265, enums={"contract_type": ("SP", "KIPA", "KH", "KT")}, file_pattern="*.csv"),
        Contract("maintenance_plans", "erp_maintenance_plans", "csv", "fact_maintenance_plan", ("pm_no",),
                 PLAN_COLUMNS, expected_rows=106, file_pattern="*.csv"),
        Contract("building_automation", "building_automation", "json_object", "fact_sensor_reading",
                 ("reading_id",), schema=PROPERTY_SCHEMA, file_pattern="*.json"),
        Contract("occupancy", "occupancy", "json_array", "fact_occupancy", ("occupancy_id",),
                 schema=OCCUPANCY_SCHEMA, file_pattern="*.json"),
        Contract("utilization", "cleaning_utilization", "wide_csv", "fact_utilization", ("utilization_id",),
                 file_pattern="Room_Utilization_*.csv"),
    )
}
ALIASES = {"maintenance": "maintenance_plans", "bms": "building_automation", "elevators": "occupancy"}


def resolve(name: str) -> Contract:
    """Contract of a family by name or alias, any case."""
    key = name.strip().lower()
    key = ALIASES.get(key, key)
    if key not in CONTRACTS:
        raise KeyError(f"unknown source {name!r}; known: {sorted(set(CONTRACTS) | set(ALIASES))}")
    return CONTRACTS[key]
