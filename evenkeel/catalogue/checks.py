"""Data-quality checks over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.catalogue.registry import Tables, query, rounded
from evenkeel.catalogue.shaping import mapped_nations
from evenkeel.functions import EMAIL_PATTERN
from evenkeel.operators import quality as q
from evenkeel.operators.quality import Check
from evenkeel.sources.contracts import resolve

EMAIL_SQL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
COLUMNS = ("check_id", "passed", "actual", "expected", "failed_count", "total_count")


def _plain(results):
    return rounded(results.select(*COLUMNS), 6)


def _row(check: str, table: str, failed: str, actual: str | None = None, expected: str = "0.0", passed: str | None = None, total: str = "count(*)") -> str:
    """One expected result row over a table."""
    passed = passed or f"({failed}) = 0"
    return (f"SELECT '{check}' AS check_id, {passed} AS passed, round(CAST({actual or failed} AS DOUBLE), 6) AS actual, "
            f"CAST({expected} AS DOUBLE) AS expected, CAST(CASE WHEN {passed} THEN 0 ELSE {failed} END AS BIGINT) AS failed_count, "
            f"CAST({total} AS BIGINT) AS total_count FROM {table}")


count_if = lambda c: f"count(*) FILTER (WHERE {c})"

ORDER_CHECKS = [
    Check("required", "required", ("wo_no", "site_id", "priority_id")),
    Check("enum_contract", "enum", ("contract_type",), options={"allowed": ("KH", "KT")}),
    Check("enum_priority", "enum", ("priority_id",), options={"allowed": (1, 2, 3, 4)}),
    Check("range_price", "range", ("o_totalprice",), options={"low": 1000.0, "high": 450000.0}),
    Check("kind_range", "kind_range", ("worktime_hours",), options={"kind": "contract_type", "limits": {"KH": (0.0, 10.0), "KT": (1.0, None)}}),
    Check("mapping_pm", "mapping", ("pm_no",), options={"min_rate": 0.15}),
    Check("row_count", "row_count", options={"rows": 15000, "tolerance": 0.005}),
    Check("min_rows", "min_rows", options={"rows": 100}),
    Check("site_sum", "min_sum", ("priority_id",), options={"where": {"site_id": "site_1"}, "least": 100}),
    Check("site_present", "min_present_pct", ("pm_no",), options={"where": {"site_id": "site_1"}, "limit": 50.0}),
    Check("site_nonzero", "max_nonzero_pct", ("priority_id",), options={"where": {"site_id": "site_1"}, "limit": 5.0}),
]
SITE = "site_id = 'site_1'"
PRESENT = f"100.0 * count(*) FILTER (WHERE {SITE} AND pm_no IS NOT NULL) / count(*) FILTER (WHERE {SITE})"
NONZERO = f"100.0 * count(*) FILTER (WHERE {SITE} AND coalesce(priority_id, 0) > 0) / count(*) FILTER (WHERE {SITE})"
SUM = f"coalesce(sum(priority_id) FILTER (WHERE {SITE}), 0)"
KIND = "(contract_type = 'KH' AND (worktime_hours < 0 OR worktime_hours > 10)) OR (contract_type = 'KT' AND worktime_hours < 1)"
ORDER_ROWS = [
    _row("required", "work_orders", count_if("wo_no IS NULL OR site_id IS NULL OR priority_id IS NULL")),
    _row("enum_contract", "work_orders", count_if("contract_type NOT IN ('KH', 'KT')")),
    _row("enum_priority", "work_orders", count_if("priority_id NOT IN (1, 2, 3, 4)")),
    _row("range_price", "work_orders", count_if("o_totalprice < 1000 OR o_totalprice > 450000")),
    _row("kind_range", "work_orders", count_if(KIND)),
    _row("mapping_pm", "work_orders", count_if("pm_no IS NULL"), "100.0 * count(pm_no) / count(*)", "15.0", "count(pm_no) / count(*) >= 0.15"),
    _row("row_count", "work_orders", "abs(count(*) - 15000)", "count(*)", "15000.0", "abs(count(*) - 15000) / 15000.0 <= 0.005"),
    _row("min_rows", "work_orders", "0", "count(*)", "100.0", "count(*) >= 100"),
    _row("site_sum", "work_orders", "0", SUM, "100.0", f"{SUM} >= 100", count_if(SITE)),
    _row("site_present", "work_orders", "0", PRESENT, "50.0", f"{PRESENT} >= 50", count_if(SITE)),
    _row("site_nonzero", "work_orders", "0", NONZERO, "5.0", f"{NONZERO} <= 5", count_if(SITE)),
]


@query("fused_order_checks", "Q1 Q3 Q4 Q5 Q7 Q9 Q14 Q15 Q18 Q20", "\nUNION ALL ".join(ORDER_ROWS), ("work_orders",))
def _(t: Tables):
    return _plain(q.run_checks(t.work_orders(), "silver", "fact_work_order", ORDER_CHECKS))


@query("contract_checks", "S14 Q2 Q3 Q9 Q20", "\nUNION ALL ".join([
    """SELECT 'work_orders_key' AS check_id, count(DISTINCT wo_no) = count(*) AS passed, CAST(count(DISTINCT wo_no) AS DOUBLE) AS actual,
       CAST(count(*) AS DOUBLE) AS expected, CAST(count(*) - count(DISTINCT wo_no) AS BIGINT) AS failed_count, count(*) AS total_count FROM work_orders""",
    _row("work_orders_contract_type", "work_orders", count_if("contract_type NOT IN ('SP', 'KIPA', 'KH', 'KT')")),
    _row("work_orders_rows", "work_orders", "abs(count(*) - 44265)", "count(*)", "44265.0", "abs(count(*) - 44265) / 44265.0 <= 0.005")]),
       ("work_orders",))
def _(t: Tables):
    return _plain(q.run_checks(t.work_orders(), "silver", "fact_work_order", q.contract_checks(resolve("work_orders"))))


@query("key_checks", "Q2 Q10 Q13", """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2), o AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1)
SELECT 'items_unique' AS check_id, count(*) FILTER (WHERE n > 1) = 0 AS passed, CAST(count(*) AS DOUBLE) AS actual, CAST(sum(n) AS DOUBLE) AS expected,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS failed_count, CAST(sum(n) AS BIGINT) AS total_count FROM k
UNION ALL SELECT 'items_grain', count(*) FILTER (WHERE n > 1) = 0, CAST(sum(n) AS DOUBLE), CAST(count(*) AS DOUBLE),
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT), CAST(sum(n) AS BIGINT) FROM k
UNION ALL SELECT 'orders_primary_key', count(*) FILTER (WHERE n > 1) = 0, CAST(count(*) AS DOUBLE), CAST(sum(n) AS DOUBLE),
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT), CAST(sum(n) AS BIGINT) FROM o""")
def _(t: Tables):
    keys = ("l_orderkey", "line")
    items = t.read("lineitem").withColumnRenamed("l_linenumber", "linenumber")
    parts = q.run_checks(items, "silver", "items", [
        Check("items_unique", "unique", keys, options={"aliases": {"line": "linenumber"}}),
        Check("items_grain", "grain", keys, options={"aliases": {"line": "linenumber"}})])
    own = q.run_checks(t.read("orders"), "silver", "orders", [Check("orders_primary_key", "primary_key", ("o_orderkey",))])
    return _plain(parts.unionByName(own))


@query("reference_checks", "Q6", """
SELECT 'customer_to_nation' AS check_id, count(n_nationkey) / count(*) >= 0.99 AS passed, round(100.0 * count(n_nationkey) / count(*), 6) AS actual,
       CAST(99.0 AS DOUBLE) AS expected, CAST(CASE WHEN count(n_nationkey) / count(*) >= 0.99 THEN 0 ELSE count(*) - count(n_nationkey) END AS BIGINT) AS failed_count,
       count(*) AS total_count FROM customer LEFT JOIN (SELECT nation.* FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA') ON c_nationkey = n_nationkey
UNION ALL SELECT 'order_to_customer', count(c_custkey) / count(*) >= 0.99, round(100.0 * count(c_custkey) / count(*), 6), 99.0,
       CAST(CASE WHEN count(c_custkey) / count(*) >= 0.99 THEN 0 ELSE count(*) - count(c_custkey) END AS BIGINT), count(*)
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def _(t: Tables):
    ref = lambda table, column: {"table": table, "column": column}
    a = q.run_checks(t.read("customer"), "silver", "customer", [
        Check("customer_to_nation", "reference", ("c_nationkey",), options=ref("nation", "n_nationkey"))],
        {"nation": mapped_nations(t)})
    b = q.run_checks(t.read("orders"), "silver", "orders", [
        Check("order_to_customer", "reference", ("o_custkey",), options=ref("customer", "c_custkey"))], {"customer": t.read("customer")})
    return _plain(a.unionByName(b))


@query("email_and_null_scan", "Q8 Q12 Q19", f"""
SELECT 'emails' AS check_id, count(*) FILTER (WHERE regexp_matches(text, '{EMAIL_SQL}') OR regexp_matches(source, '{EMAIL_SQL}') OR regexp_matches(lang, '{EMAIL_SQL}')) = 0 AS passed,
       CAST(count(*) FILTER (WHERE regexp_matches(text, '{EMAIL_SQL}') OR regexp_matches(source, '{EMAIL_SQL}') OR regexp_matches(lang, '{EMAIL_SQL}')) AS DOUBLE) AS actual,
       CAST(0 AS DOUBLE) AS expected, count(*) FILTER (WHERE regexp_matches(text, '{EMAIL_SQL}') OR regexp_matches(source, '{EMAIL_SQL}') OR regexp_matches(lang, '{EMAIL_SQL}')) AS failed_count,
       count(*) AS total_count FROM documents
UNION ALL SELECT 'literal_nulls', count(*) FILTER (WHERE text IN ('NULL', 'null', 'None', 'none', '') OR source IN ('NULL', 'null', 'None', 'none', '')) = 0,
       CAST(count(*) FILTER (WHERE text IN ('NULL', 'null', 'None', 'none', '') OR source IN ('NULL', 'null', 'None', 'none', '')) AS DOUBLE), 0,
       count(*) FILTER (WHERE text IN ('NULL', 'null', 'None', 'none', '') OR source IN ('NULL', 'null', 'None', 'none', '')), count(*) FROM documents""")
def _(t: Tables):
    return _plain(q.run_checks(t.read("documents"), "gold", "documents", [Check("emails", "pii"), Check("literal_nulls", "literal_null", ("text", "source"))]))


@query("quarantined_documents", "Q8 S17", f"""
SELECT doc_id, source FROM documents WHERE regexp_matches(text, '{EMAIL_SQL}')""")
def _(t: Tables):
    bad = q.failing_rows(t.read("documents"), Check("emails", "pii", ("text",), options={"pattern": EMAIL_PATTERN}))
    return bad.select("doc_id", "source")


@query("bad_rows_either_way", "U4 Q7", f"""
SELECT wo_no, contract_type, worktime_hours FROM work_orders WHERE {KIND}""", ("work_orders",))
def _(t: Tables):
    check = Check("k", "kind_range", ("worktime_hours",), options={"kind": "contract_type", "limits": {"KH": (0.0, 10.0), "KT": (1.0, None)}})
    return q.failing_rows(t.work_orders(), check).select("wo_no", "contract_type", "worktime_hours")


@query("rows_with_issues", "Q22 S17", """
SELECT wo_no, concat_ws(', ', CASE WHEN pm_no IS NULL THEN 'no plan' END, CASE WHEN o_totalprice > 450000 THEN 'too dear' END,
       CASE WHEN priority_id IS NULL THEN 'no priority' END) AS issues FROM work_orders""", ("work_orders",))
def _(t: Tables):
    tagged = q.split_rows(t.work_orders(), {"no plan": F.col("pm_no").isNull(), "too dear": F.col("o_totalprice") > 450000,
                                            "no priority": F.col("priority_id").isNull()})
    return tagged.select("wo_no", F.array_join("issues", ", ").alias("issues"))


@query("mapping_by_source", "Q11", """
SELECT 'mapped_' || o_orderstatus AS check_id, count(p) / count(*) >= 0.7 AS passed, round(100.0 * count(p) / count(*), 6) AS actual, CAST(70.0 AS DOUBLE) AS expected,
       CAST(CASE WHEN count(p) / count(*) >= 0.7 THEN 0 ELSE count(*) - count(p) END AS BIGINT) AS failed_count, count(*) AS total_count
FROM (SELECT o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' AND NOT (o_orderstatus = 'F' AND o_orderkey % 5 = 0) THEN 'x' END AS p FROM orders) GROUP BY o_orderstatus""")
def _(t: Tables):
    mapped = F.when((F.col("o_orderpriority") != "5-LOW") & ~((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 5 == 0)), "x")
    rows = t.read("orders").select(F.col("o_orderstatus").alias("source_system"), mapped.alias("site_id"))
    return _plain(q.run_checks(rows, "silver", "orders", [
        Check(f"mapped_{s}", "mapping", ("site_id",), options={"min_rate": 0.7, "source": s}) for s in ("F", "O", "P")]))


@query("content_snapshots", "Q16 H6", """
SELECT 'orders' AS table_name, count(*) AS row_count, true AS same FROM orders UNION ALL SELECT 'events', count(*), true FROM events""")
def _(t: Tables):
    tables = {n: t.read(n) for n in ("orders", "events")}
    before = q.content_snapshot(tables)
    again = q.content_snapshot({n: d.repartition(3) for n, d in tables.items()})
    drift = q.idempotency(before, again, ("row_count", "content_hash")).select(F.col("table_name").alias("_drifted"))
    joined = before.join(drift, F.col("table_name") == F.col("_drifted"), "left")
    return joined.select("table_name", "row_count", F.col("_drifted").isNull().alias("same"))


@query("missing_sources", "Q17", """
SELECT r_name AS source_system FROM region WHERE r_name NOT IN (SELECT r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')""")
def _(t: Tables):
    expected = t.read("region").select(F.col("r_name").alias("source_system"))
    landed = t.read("supplier").join(mapped_nations(t), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("r_name").alias("source_system"))
    return q.missing_sources(expected, landed)


CRITERIA = {"silver": [
    {"id": "rows", "table": "orders", "expected_rows": 1, "tolerance_pct": 0.5, "severity": "warn"},
    {"id": "pk", "table": "orders", "column": "wo_no"},
    {"id": "no_null_text", "table": "orders", "columns": ["assignment_type", "contract_type"], "forbidden_values": ["NULL", "SP"]},
    {"id": "mapped", "table": "orders", "column": "pm_no", "min_mapped_pct": 10.0},
    {"id": "enough", "table": "orders", "min_rows": 50},
    {"id": "grain", "table": "orders", "unique_keys": ["site_id", "contract_type"], "severity": "warn"},
    {"id": "gone", "table": "absent", "min_rows": 1, "severity": "warn"},
], "gold": [
    {"id": "alarms_there", "table": "daily", "site_id": "site_1", "min_alarm_count_total": 10},
    {"id": "utilization_there", "table": "daily", "site_id": "site_1", "column": "avg_room_utilization_pct", "min_non_null_pct": 10.0, "severity": "warn"},
    {"id": "few_alarms", "table": "daily", "site_id": "site_1", "column": "alarm_count", "max_non_zero_pct": 50.0},
    {"id": "no_email", "tables": ["daily"], "pattern": "unused"},
]}


@query("acceptance_criteria", "Q20 Q21 S18", """
SELECT 'rows' AS check_id, false AS passed FROM region WHERE r_regionkey = 0 UNION ALL SELECT 'pk', count(*) = count(DISTINCT wo_no) FROM work_orders
UNION ALL SELECT 'no_null_text', count(*) FILTER (WHERE contract_type = 'SP') + count(*) FILTER (WHERE assignment_type IN ('NULL', 'SP')) = 0 FROM work_orders
UNION ALL SELECT 'mapped', count(pm_no) / count(*) >= 0.1 FROM work_orders UNION ALL SELECT 'enough', count(*) >= 50 FROM work_orders
UNION ALL SELECT 'grain', count(*) = count(DISTINCT site_id || contract_type) FROM work_orders UNION ALL SELECT 'table_exists', false FROM region WHERE r_regionkey = 0
UNION ALL SELECT 'alarms_there', sum(alarm_count) FILTER (WHERE site_id = 'site_1') >= 10 FROM daily
UNION ALL SELECT 'utilization_there', 100.0 * count(*) FILTER (WHERE site_id = 'site_1' AND avg_room_utilization_pct IS NOT NULL) / count(*) FILTER (WHERE site_id = 'site_1') >= 10 FROM daily
UNION ALL SELECT 'few_alarms', 100.0 * count(*) FILTER (WHERE site_id = 'site_1' AND alarm_count > 0) / count(*) FILTER (WHERE site_id = 'site_1') <= 50 FROM daily
UNION ALL SELECT 'no_email', true FROM region WHERE r_regionkey = 0""", ("work_orders", "daily"))
def _(t: Tables):
    layers = {"silver": {"orders": t.work_orders()}, "gold": {"daily": t.daily()}}
    return q.run_criteria(t.spark, layers, CRITERIA).select("check_id", "passed")


@query("overall_verdict", "S18 Q21", """
SELECT CAST(count(*) FILTER (WHERE NOT passed) AS BIGINT) AS errors, CAST(0 AS BIGINT) AS warnings, count(*) FILTER (WHERE passed) AS checks_passed,
       count(*) AS checks, CASE WHEN count(*) FILTER (WHERE NOT passed) = 0 THEN 'PASS' ELSE 'FAIL' END AS overall FROM (""" + "\nUNION ALL ".join(ORDER_ROWS) + ")", ("work_orders",))
def _(t: Tables):
    return q.overall(q.run_checks(t.work_orders(), "silver", "fact_work_order", ORDER_CHECKS))


@query("site_samples", "Q23", """
SELECT site_id, count(*) AS days, CAST(sum(alarm_count) AS BIGINT) AS alarm_count_sum, count(*) FILTER (WHERE alarm_count > 0) AS alarm_count_nonzero_days,
       count(avg_room_utilization_pct) AS avg_room_utilization_pct_days, count(electricity_kwh) AS electricity_kwh_days FROM daily GROUP BY 1""", ("daily",))
def _(t: Tables):
    return q.site_samples(t.daily(), ["alarm_count"], ["avg_room_utilization_pct", "electricity_kwh"])


@query("split_is_disjoint", "U6 M4", "SELECT o_orderkey AS wo_no FROM orders WHERE false")
def _(t: Tables):
    from evenkeel.plans.features import shared_ids, time_split

    orders = t.read("orders").select(F.col("o_orderkey").alias("wo_no"), F.col("o_orderdate").alias("work_started_at_utc"))
    return shared_ids(*time_split(orders))
