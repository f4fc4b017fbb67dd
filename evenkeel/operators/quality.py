"""Data-quality checks as aggregates, with quarantine of the failing rows.

Every check is a spec (plain data). All count-type checks of one table share a
single aggregate over it, however many there are; key checks add one aggregate by
key, reference checks one join. Results are rows of ``RESULT_COLUMNS``; failing
rows come from ``failing_rows`` as another DataFrame and are only read when used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import EMAIL_PATTERN, NULL_LITERALS
from evenkeel.operators.joins import orphans
from evenkeel.operators.latest import duplicate_rows
from evenkeel.sources.contracts import Contract

RESULT_COLUMNS = (
    "check_id", "layer", "table_name", "passed", "severity", "message",
    "actual", "expected", "failed_count", "total_count",
)

# --- fixed values: kinds whose empty input passes, and report severities ---------
WARNING_SEVERITIES = ("warn", "warning")
OCCUPANCY_LIMITS = {"normalized": (0.0, 10.0), "raw_count": (0.0, None)}
# ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One check. ``kind`` selects the rule, ``options`` its parameters."""

    check_id: str
    kind: str
    columns: tuple[str, ...] = ()
    severity: str = "error"
    options: Mapping = field(default_factory=dict)


def contract_checks(contract: Contract, tolerance: float = 0.005) -> list[Check]:
    """What a source contract says of its conformed table, as checks: a key of its own a
    row, the values that listed columns may have, and about how many rows there are."""
    checks = [Check(f"{contract.name}_key", "unique", contract.key)]
    checks += [Check(f"{contract.name}_{c}", "enum", (c,), options={"allowed": allowed}) for c, allowed in contract.enums.items()]
    if contract.expected_rows is not None:
        checks.append(Check(f"{contract.name}_rows", "row_count", options={"rows": contract.expected_rows, "tolerance": tolerance}))
    return checks


# ------------------------------------------------------------------ row conditions
def null_in(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def not_in(column: str, allowed: Sequence) -> Column:
    """Non-null value outside the set."""
    return F.coalesce(~F.col(column).isin(*allowed), F.lit(False))


def outside(column: str, low: float | None, high: float | None) -> Column:
    tests = []
    if low is not None:
        tests.append(F.col(column) < F.lit(low))
    if high is not None:
        tests.append(F.col(column) > F.lit(high))
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def outside_for_kind(column: str, kind: str, limits: Mapping[str, tuple]) -> Column:
    """Range that depends on another column; other kinds are not judged."""
    tests = [(F.col(kind) == k) & outside(column, low, high) for k, (low, high) in limits.items()]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def any_match(columns: Sequence[str], pattern: str = EMAIL_PATTERN) -> Column:
    if not columns:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c).rlike(pattern), F.lit(False)) for c in columns])


def any_literal_null(columns: Sequence[str], literals: Sequence[str] = NULL_LITERALS) -> Column:
    if not columns:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c).isin(*literals), F.lit(False)) for c in columns])


def failing_condition(check: Check, df: DataFrame) -> Column | None:
    """The condition of a failing row, for kinds that judge rows one by one."""
    o, cols = check.options, list(check.columns)
    present = [c for c in cols if c in df.columns]
    match check.kind:
        case "required":
            return null_in(present) if present else F.lit(False)
        case "enum":
            return not_in(cols[0], o["allowed"]) if present else F.lit(False)
        case "range":
            return outside(cols[0], o.get("low"), o.get("high")) if present else F.lit(False)
        case "kind_range":
            return outside_for_kind(cols[0], o["kind"], o.get("limits", OCCUPANCY_LIMITS))
        case "mapping":
            condition = F.col(cols[0]).isNull() if present else F.lit(False)
            if "source" in o and "source_system" in df.columns:
                condition = condition & (F.col("source_system") == o["source"])
            return condition
        case "pii":
            return any_match(present or string_columns(df), o.get("pattern", EMAIL_PATTERN))
        case "literal_null":
            texts = string_columns(df)
            return any_literal_null([c for c in (cols or texts) if c in texts], o.get("literals", NULL_LITERALS))
    return None


# ------------------------------------------------------------------ fused aggregate
def _measures(check: Check, df: DataFrame) -> dict[str, Column]:
    """Aggregates a check needs from the shared pass over its table."""
    o, cols = check.options, list(check.columns)
    scope = F.lit(True)
    if "where" in o:
        scope = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in o["where"].items()])
    if "source" in o and "source_system" in df.columns:
        scope = F.col("source_system") == F.lit(o["source"])
    out = {"total": F.count_if(scope)}
    condition = failing_condition(check, df)
    if condition is not None:
        out["failed"] = F.count_if(scope & condition)
        if check.kind == "pii" and o.get("count") == "matches":
            texts = cols or string_columns(df)
            out["failed"] = reduce(lambda a, b: a + b, [
                F.count_if(F.coalesce(F.col(c).rlike(o.get("pattern", EMAIL_PATTERN)), F.lit(False))) for c in texts])
        if check.kind == "literal_null" and o.get("count") == "matches":
            texts = [c for c in (cols or string_columns(df)) if c in string_columns(df)]
            out["failed"] = reduce(lambda a, b: a + b, [
                F.count_if(F.col(c).isin(*o.get("literals", NULL_LITERALS))) for c in texts], F.lit(0).cast("bigint"))
    if check.kind == "min_sum":
        out["value"] = F.coalesce(F.sum(F.when(scope, F.col(cols[0]))), F.lit(0)).cast("double")
    if check.kind == "min_present_pct":
        out["value"] = F.count_if(scope & F.col(cols[0]).isNotNull()).cast("double")
    if check.kind == "max_nonzero_pct":
        out["value"] = F.count_if(scope & (F.coalesce(F.col(cols[0]), F.lit(0)) > 0)).cast("double")
    return out


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100.0)


def _verdict(check: Check, df: DataFrame, total: Column, failed: Column, value: Column) -> dict[str, Column]:
    """passed / actual / expected / message / severity of a fused check."""
    o, cols = check.options, list(check.columns)
    missing = [c for c in cols if c not in df.columns]
    text = lambda *parts: F.concat_ws("", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    num = lambda c: c.cast("string")
    name = ", ".join(cols)
    none_failed = failed == 0
    severity = F.lit(check.severity)
    actual, expected = failed.cast("double"), F.lit(0.0)
    passed, message = none_failed, text(num(failed), f" failing row(s) on {name}")
    if check.kind == "required":
        if missing:
            passed, message = F.lit(False), F.lit(f"missing columns: {', '.join(missing)}")
            actual = F.lit(float(len(missing)))
        else:
            message = text(num(failed), f" row(s) with a null in {name}")
    elif missing and check.kind in ("enum", "range"):
        passed, message = F.lit(True), F.lit(f"{name} missing (skipped)")
    elif check.kind == "mapping":
        rate = _percent(total - failed, total)
        least = 100.0 * o["min_rate"]
        actual, expected = rate, F.lit(least)
        if missing:
            ok_missing = not o.get("strict", False)
            passed, message = F.lit(ok_missing), F.lit(f"{name} missing")
        else:
            empty_passes = F.lit(not o.get("strict", False))
            passed = F.when(total == 0, empty_passes).otherwise((total - failed) / total >= F.lit(o["min_rate"]))
            severity = F.when(total == 0, F.lit("warning")).otherwise(severity) if "source" in o else severity
            message = text(F.coalesce(num(F.bround(rate, 1)), F.lit("no")), f"% mapped (min {least:g}%)")
    elif check.kind == "row_count":
        want, tolerance = o["rows"], o["tolerance"]
        actual, expected = total.cast("double"), F.lit(float(want))
        passed = total == 0 if want == 0 else F.abs(total - want) / F.lit(float(want)) <= tolerance
        message = text(num(total), f" rows (expected {want} ±{tolerance:.1%})")
    elif check.kind == "min_rows":
        actual, expected = total.cast("double"), F.lit(float(o["rows"]))
        passed, message = total >= o["rows"], text(num(total), f" rows (min {o['rows']})")
    elif check.kind == "min_sum":
        actual, expected, passed = value, F.lit(float(o["least"])), value >= o["least"]
        message = text(f"sum of {name} ", num(value), f" (min {o['least']})")
    elif check.kind in ("min_present_pct", "max_nonzero_pct"):
        pct = _percent(value, total)
        limit = float(o["limit"])
        actual, expected = pct, F.lit(limit)
        within = pct >= limit if check.kind == "min_present_pct" else pct <= limit
        passed = F.coalesce(within, F.lit(False))
        message = text(F.coalesce(num(F.bround(pct, 1)), F.lit("no rows:")), f"% of {name} (limit {limit:g}%)")
    return {"passed": passed, "actual": actual, "expected": expected, "message": message, "severity": severity}


def _result(check: Check, layer: str, table: str, total: Column, failed: Column, verdict: dict[str, Column]) -> Column:
    passed = verdict["passed"]
    values = {
        "check_id": F.lit(check.check_id), "layer": F.lit(layer), "table_name": F.lit(table),
        "passed": passed, "severity": verdict["severity"], "message": verdict["message"],
        "actual": verdict["actual"].cast("double"), "expected": verdict["expected"].cast("double"),
        "failed_count": F.when(passed, F.lit(0)).otherwise(failed).cast("bigint"),
        "total_count": total.cast("bigint"),
    }
    return F.struct(*[values[c].alias(c) for c in RESULT_COLUMNS])


KEY_KINDS = ("unique", "primary_key", "grain")


def run_checks(df: DataFrame, layer: str, table: str, checks: Sequence[Check],
               references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Result rows of all checks of one table."""
    row_checks = [c for c in checks if c.kind not in KEY_KINDS and c.kind != "reference"]
    results = []
    if row_checks:
        fused = df.agg(*[m.alias(f"_{i}_{n}") for i, c in enumerate(row_checks) for n, m in _measures(c, df).items()])
        rows = []
        for i, check in enumerate(row_checks):
            pick = lambda n: F.col(f"_{i}_{n}") if f"_{i}_{n}" in fused.columns else F.lit(0).cast("bigint")
            total, failed, value = pick("total"), pick("failed"), pick("value")
            if check.kind == "row_count":
                failed = F.abs(total - check.options["rows"])
            rows.append(_result(check, layer, table, total, failed, _verdict(check, df, total, failed, value)))
        results.append(fused.select(F.inline(F.array(*rows))))
    results += [key_check(df, layer, table, c) for c in checks if c.kind in KEY_KINDS]
    for c in (c for c in checks if c.kind == "reference"):
        target = (references or {}).get(c.options["table"])
        results.append(missing_reference(df, layer, table, c) if target is None
                       else reference_check(df, layer, table, c, target))
    return reduce(lambda a, b: a.unionByName(b), results)


def key_check(df: DataFrame, layer: str, table: str, check: Check) -> DataFrame:
    """Uniqueness of one or more columns; a null key counts as a value.

    ``unique`` reports the rows in duplicate groups, ``primary_key`` and ``grain``
    the distinct keys against the rows.
    """
    aliases = check.options.get("aliases", {})
    keys = [aliases.get(c, c) for c in check.columns]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    sums = counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct"),
        F.count_if(F.col("_n") > 1).alias("dup_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("dup_rows"))
    total, distinct = F.col("total"), F.col("distinct")
    passed = F.col("dup_keys") == 0
    name = ", ".join(keys)
    message = F.when(passed, F.concat_ws("", F.lit(f"unique on {name}: "), total, F.lit(" rows"))).otherwise(
        F.concat_ws("", F.col("dup_keys"), F.lit(f" duplicate key(s) on {name} ("), F.col("dup_rows"), F.lit(" rows)")))
    actual, expected = (total, distinct) if check.kind == "grain" else (distinct, total)
    verdict = {"passed": passed, "actual": actual, "expected": expected, "message": message,
               "severity": F.lit(check.severity)}
    return sums.select(F.inline(F.array(_result(check, layer, table, total, F.col("dup_rows"), verdict))))


def reference_check(df: DataFrame, layer: str, table: str, check: Check, reference: DataFrame) -> DataFrame:
    """Share of non-null foreign keys with a match; all-null passes as a warning."""
    key = check.columns[0]
    target, least = check.options.get("column", "site_id"), check.options.get("min_rate", 0.99)
    # keys are counted first: one row a key meets the reference, not one a record
    keys = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    known = reference.select(F.col(target).alias("_known")).where(F.col("_known").isNotNull()).distinct()
    sums = keys.join(known, keys["_fk"] == known["_known"], "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias("orphans"))
    total, orphan = F.col("total"), F.col("orphans")
    empty = total == 0
    rate = F.when(~empty, (total - orphan) / total)
    verdict = {
        "passed": F.coalesce(rate >= least, F.lit(True)),
        "actual": rate * 100.0, "expected": F.lit(least * 100.0),
        "message": F.concat_ws("", orphan, F.lit(f" orphan {key} value(s)")),
        "severity": F.when(empty, "warning").otherwise(check.severity),
    }
    return sums.select(F.inline(F.array(_result(check, layer, table, total, orphan, verdict))))


def missing_reference(df: DataFrame, layer: str, table: str, check: Check) -> DataFrame:
    """The failing result of a reference whose target table is not there."""
    keyed = df.agg(F.count(check.columns[0]).alias("total"))
    total = F.col("total")
    verdict = {"passed": F.lit(False), "actual": F.lit(0.0), "expected": F.lit(check.options.get("min_rate", 0.99) * 100.0),
               "message": F.lit(f"missing reference table: {check.options['table']}"), "severity": F.lit("error")}
    return keyed.select(F.inline(F.array(_result(check, layer, table, total, total, verdict))))


def failing_rows(df: DataFrame, check: Check, references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All rows a check fails; ``limit`` the result where a sample is enough."""
    if check.kind in KEY_KINDS:
        aliases = check.options.get("aliases", {})
        return duplicate_rows(df, [aliases.get(c, c) for c in check.columns])
    if check.kind == "reference":
        reference = (references or {})[check.options["table"]]
        return orphans(df, check.columns[0], reference, check.options.get("column", "site_id"))
    condition = failing_condition(check, df)
    return df.where(F.lit(False) if condition is None else condition)


def split_rows(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Tag every row with the list of issues it has; none means clean."""
    issues = [F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in conditions.items()]
    return df.withColumn("issues", F.array_compact(F.array(*issues)))


def missing_table(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """The failing result of a table that is not there."""
    check = Check("table_exists", "table_exists")
    verdict = {"passed": F.lit(False), "actual": F.lit(0.0), "expected": F.lit(1.0),
               "message": F.lit(f"missing {layer} table: {table}"), "severity": F.lit("error")}
    zero = F.lit(0)
    return spark.range(1).select(F.inline(F.array(_result(check, layer, table, zero, zero, verdict))))


def run_layer(spark: SparkSession, layer: str, tables: Mapping[str, DataFrame | None],
              specs: Mapping[str, Sequence[Check]], references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Results of every table of a layer that has a spec; absent tables fail."""
    known = {**{n: t for n, t in tables.items() if t is not None}, **(references or {})}
    parts = [
        missing_table(spark, layer, name) if tables.get(name) is None
        else run_checks(tables[name], layer, name, checks, known)
        for name, checks in specs.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------------------------------ whole-run checks
def content_snapshot(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and an order-insensitive content hash per table."""
    parts = [
        t.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
              F.coalesce(F.sum(F.xxhash64(*[F.col(c) for c in t.columns]).cast("decimal(38,0)")), F.lit(0))
              .cast("string").alias("content_hash"))
        for name, t in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def idempotency(before: DataFrame, after: DataFrame, compare: Sequence[str] = ("row_count",)) -> DataFrame:
    """Tables whose snapshot changed between two runs (empty when idempotent)."""
    a = before.select("table_name", F.struct(*compare).alias("_before"))
    b = after.select("table_name", F.struct(*compare).alias("_after"))
    joined = a.join(b, "table_name", "full").where(~F.col("_before").eqNullSafe(F.col("_after")))
    return joined.select(
        "table_name",
        *[F.col(f"_before.{c}").alias(f"{c}_before") for c in compare],
        *[F.col(f"_after.{c}").alias(f"{c}_after") for c in compare])


def missing_sources(expected: DataFrame, ledger: DataFrame, source: str = "source_system") -> DataFrame:
    """Expected sources with no file in the ledger."""
    return expected.join(ledger.select(source).distinct(), source, "left_anti")


def overall(results: DataFrame) -> DataFrame:
    """PASS/FAIL with error and warning counts; a failed warning does not fail."""
    failed = ~F.col("passed")
    warns = F.col("severity").isin(*WARNING_SEVERITIES)
    out = results.agg(
        F.count_if(failed & ~warns).alias("errors"), F.count_if(failed & warns).alias("warnings"),
        F.count_if(F.col("passed")).alias("checks_passed"), F.count(F.lit(1)).alias("checks"))
    return out.withColumn("overall", F.when(F.col("errors") == 0, "PASS").otherwise("FAIL"))


def site_samples(daily: DataFrame, counts: Sequence[str], metrics: Sequence[str], site: str = "site_id") -> DataFrame:
    """Per site: days, sums of counts, days with a non-zero count, non-null metric days."""
    return daily.groupBy(site).agg(
        F.count(F.lit(1)).alias("days"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"{c}_sum") for c in counts],
        *[F.count_if(F.col(c) > 0).alias(f"{c}_nonzero_days") for c in counts],
        *[F.count(m).alias(f"{m}_days") for m in metrics])


# ------------------------------------------------------------------ specs
def table_spec(required=(), unique=(), enum=None, ranges=None, mapping_min=None, references=None,
               pii=False, kind_range=None) -> list[Check]:
    """Compact spec of a table, in the order the checks are reported."""
    checks = [Check("required", "required", tuple(required))] if required else []
    for key in unique:
        columns = (key,) if isinstance(key, str) else tuple(key)
        checks.append(Check("unique_" + "_".join(columns), "unique", columns))
    for column, allowed in (enum or {}).items():
        checks.append(Check(f"enum_{column}", "enum", (column,), options={"allowed": tuple(allowed)}))
    for column, (low, high) in (ranges or {}).items():
        checks.append(Check(f"range_{column}", "range", (column,), options={"low": low, "high": high}))
    if mapping_min is not None:
        checks.append(Check("site_mapping", "mapping", ("site_id",), options={"min_rate": mapping_min}))
    for column, table in (references or {}).items():
        checks.append(Check(f"reference_{column}_to_{table}", "reference", (column,), options={"table": table}))
    if pii:
        checks.append(Check("email_scan", "pii"))
    if kind_range:
        column, kind = kind_range
        checks.append(Check(f"range_{column}", "kind_range", (column,), options={"kind": kind}))
    return checks


ALARM_PRIORITIES = (1, 13, 50, 60, 77, 99)

SILVER_SPECS = {
    "fact_alarm": table_spec(["alert_event_id", "site_id", "priority", "event_time_utc"], ["alert_event_id"],
                             enum={"priority": ALARM_PRIORITIES}, mapping_min=0.99),
    "fact_work_order": table_spec(["wo_no", "site_id", "work_order_description"], ["wo_no"], mapping_min=0.99),
    "fact_maintenance_plan": table_spec(["pm_no", "site_id"], ["pm_no"], mapping_min=0.99),
    "fact_sensor_reading": table_spec(["reading_id", "site_id", "metric", "timestamp_utc"], ["reading_id"],
                                      mapping_min=0.95),
    "fact_incident": table_spec(["incident_id", "site_id", "created_at_utc"], ["incident_id"], mapping_min=0.95),
    "fact_occupancy": table_spec(["occupancy_id", "site_id", "occupancy_value", "value_type"], ["occupancy_id"],
                                 mapping_min=0.95, kind_range=("occupancy_value", "value_type")),
    "fact_utilization": table_spec(["utilization_id", "site_id", "utilization_pct", "utilization_date"],
                                   ["utilization_id"], ranges={"utilization_pct": (0.0, 100.0)}, mapping_min=0.99),
    "dim_site": table_spec(["site_id", "display_name", "customer_id"], ["site_id"]),
    "dim_customer": table_spec(["customer_id", "customer_name"], ["customer_id"]),
}
GOLD_SPECS = {
    "site_daily_signals": table_spec(["site_id", "signal_date"], [("site_id", "signal_date")],
                                     references={"site_id": "dim_site"}),
    "event_timeline": table_spec(["event_id", "event_type", "timestamp_utc"], ["event_id"],
                                 references={"site_id": "dim_site"}, pii=True),
    "fact_work_order": table_spec(["wo_no"], ["wo_no"], references={"site_id": "dim_site"}),
    "site_rolling_context": table_spec(["site_id", "as_of_date"], [("site_id", "as_of_date")],
                                       references={"site_id": "dim_site"}),
}


def criterion(spec: Mapping) -> Check:
    """Turn one line of an acceptance list into a check, by the keys it has."""
    get = spec.get
    column = (spec["column"],) if "column" in spec else ()
    options: dict = {}
    if "site_id" in spec:
        options["where"] = {"site_id": spec["site_id"]}
    if "expected_rows" in spec:
        kind, options = "row_count", {"rows": spec["expected_rows"], "tolerance": get("tolerance_pct", 0) / 100.0}
    elif "forbidden_values" in spec:
        kind, column = "literal_null", tuple(spec["columns"])
        options = {"literals": tuple(spec["forbidden_values"]), "count": "matches"}
    elif "min_mapped_pct" in spec:
        kind, options = "mapping", {"min_rate": spec["min_mapped_pct"] / 100.0, "strict": True}
    elif "min_non_null_pct" in spec:
        kind, options["limit"] = "min_present_pct", spec["min_non_null_pct"]
    elif "max_non_zero_pct" in spec:
        kind, options["limit"] = "max_nonzero_pct", spec["max_non_zero_pct"]
    elif "min_alarm_count_total" in spec:
        kind, column, options["least"] = "min_sum", ("alarm_count",), spec["min_alarm_count_total"]
    elif "unique_keys" in spec:
        kind, column, options = "grain", tuple(spec["unique_keys"]), {"aliases": {"date": "signal_date"}}
    elif "min_rows" in spec:
        kind, options = "min_rows", {"rows": spec["min_rows"]}
    elif "tables" in spec or "pattern" in spec:
        kind, options = "pii", {"count": "matches"}
    elif column:
        kind = "primary_key"
    else:
        raise ValueError(f"no rule for criterion {spec['id']!r}")
    return Check(spec["id"], kind, column, get("severity", "error"), options)


def run_criteria(spark: SparkSession, layers: Mapping[str, Mapping[str, DataFrame]],
                 criteria: Mapping[str, Sequence[Mapping]]) -> DataFrame:
    """Results of an acceptance list ``{layer: [spec, …]}``; specs of one table share its pass.

    Bronze completeness and the rerun comparison are separate
    (``missing_sources``, ``idempotency``): they are not about one table.
    """
    parts = []
    for layer, specs in criteria.items():
        by_table: dict[str, list[Check]] = {}
        for spec in specs:
            for table in spec.get("tables") or [spec["table"]]:
                by_table.setdefault(table, []).append(criterion(spec))
        for table, checks in by_table.items():
            frames = layers.get(layer, {}) or {}
            frame = frames.get(table)
            parts.append(missing_table(spark, layer, table) if frame is None
                         else run_checks(frame, layer, table, checks))
    return reduce(lambda a, b: a.unionByName(b), parts)
