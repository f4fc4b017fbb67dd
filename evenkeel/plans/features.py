"""Leakage-safe features and chronological splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.functions import (
    elapsed_days, elapsed_hours, is_weekend, iso_weekday, known_or_unknown, presence_flag,
)
from evenkeel.operators.joins import day_context
from evenkeel.operators.ordered import cut_at_rank

# --- fixed values: feature lists -------------------------------------------------
TARGET = "is_sla_violation"
TIMESTAMP = "work_started_at_utc"
CREATION_CATEGORIES = (
    "work_type_eng", "work_order_type", "contract_type", "assignment_type", "priority_id_str", "site_id",
)
CREATION_NUMBERS = (
    "is_subcontractor_work", "is_invoicable", "start_month", "start_weekday", "start_is_weekend", "start_year",
    "sla_window_hours", "site_open_wo_at_start",
)
LEAKAGE_COLUMNS = (
    "work_finished_at_utc", "work_finished_days", "worktime_hours", "work_order_performed_action", TARGET,
)
INTAKE_CATEGORIES = ("site_id", "contract_type", "work_order_type", "work_type_eng")
INTAKE_CONTEXT = {
    "site_open_wo_7d_avg": "open_wo_7d_avg", "site_sla_violations_7d": "sla_violations_7d",
    "site_alarms_7d_avg": "alarms_7d_avg", "site_fire_alarms_7d": "fire_alarms_7d",
    "site_incidents_7d": "incidents_7d", "site_utilization_7d_avg": "utilization_7d_avg",
}
INTAKE_NUMBERS = (
    "priority_id", "month", "day_of_week", "hour", "year", "sla_window_days", "has_pm_no", "has_parent_wo",
    "has_sla_deadline", "is_invoicable", "is_subcontractor_work", *INTAKE_CONTEXT,
)
# ---------------------------------------------------------------------------------


class LeakageError(AssertionError):
    """A column only known after completion is among the features."""


def assert_no_leakage(df: DataFrame, features: Sequence[str], forbidden: Sequence[str] = LEAKAGE_COLUMNS,
                      target: str = TARGET) -> DataFrame:
    listed = [c for c in forbidden if c in features]
    present = [c for c in forbidden if c in df.columns and c != target]
    if listed or present:
        raise LeakageError(f"leakage columns: listed {listed}, present {present}")
    return df


def creation_features(orders: DataFrame, daily: DataFrame | None = None, lag_days: int = 0) -> DataFrame:
    """What is known when an order is created, plus target, time and id.

    ``lag_days=1`` takes the backlog of the day before; on the day itself the
    order counts towards its own backlog.
    """
    started = F.col(TIMESTAMP)
    df = orders.where(started.isNotNull())
    backlog = {"site_open_wo_at_start": "open_work_orders"}
    if daily is not None:
        df = day_context(df, daily, TIMESTAMP, backlog, lag_days=lag_days)
    else:
        df = df.withColumn("site_open_wo_at_start", F.lit(None).cast("double"))
    columns = {
        **{c: known_or_unknown(c) for c in CREATION_CATEGORIES if c != "priority_id_str"},
        "priority_id_str": known_or_unknown("priority_id"),
        "is_subcontractor_work": F.col("is_subcontractor_work").cast("int"),
        "is_invoicable": F.col("is_invoicable").cast("int"),
        "start_month": F.month(started), "start_weekday": iso_weekday(started),
        "start_is_weekend": is_weekend(started).cast("int"), "start_year": F.year(started),
        "sla_window_hours": elapsed_hours("sla_required_start_at_utc", "sla_required_end_at_utc"),
        "site_open_wo_at_start": F.col("site_open_wo_at_start").cast("double"),
    }
    out = df.select(*[c.alias(n) for n, c in columns.items()], TARGET, TIMESTAMP, "wo_no")
    return assert_no_leakage(out, (*CREATION_CATEGORIES, *CREATION_NUMBERS))


def intake_features(orders: DataFrame, rolling: DataFrame | None = None) -> DataFrame:
    """The wider set of the segment models, with the rolling context of the day before."""
    started, deadline = F.col(TIMESTAMP), F.col("sla_required_end_at_utc")
    df = orders
    if rolling is not None:
        df = day_context(df, rolling, TIMESTAMP, INTAKE_CONTEXT, date="as_of_date", lag_days=1)
    else:
        df = df.withColumns({c: F.lit(None).cast("double") for c in INTAKE_CONTEXT})
    return df.select(
        "wo_no", TIMESTAMP, *INTAKE_CATEGORIES, F.col("priority_id").cast("double").alias("priority_id"),
        F.month(started).alias("month"), F.weekday(started).alias("day_of_week"), F.hour(started).alias("hour"),
        F.year(started).alias("year"), elapsed_days(TIMESTAMP, "sla_required_end_at_utc").alias("sla_window_days"),
        presence_flag("pm_no").alias("has_pm_no"), presence_flag("wo_parent_id").alias("has_parent_wo"),
        presence_flag(deadline).alias("has_sla_deadline"), F.col("is_invoicable").cast("int").alias("is_invoicable"),
        F.col("is_subcontractor_work").cast("int").alias("is_subcontractor_work"), *INTAKE_CONTEXT,
        F.col(TARGET).cast("int").alias(TARGET))


def train_rows(df: DataFrame, timestamp: str, identifier: str, test_fraction: float = 0.2) -> Column:
    """Condition: among the earliest ``round(n · (1 − f))`` rows by (time, id)."""
    rank = F.rint(F.col("total_rows") * F.lit(1.0 - test_fraction)).cast("bigint")
    return cut_at_rank(df, timestamp, identifier, rank)


def time_split(df: DataFrame, timestamp: str = TIMESTAMP, identifier: str = "wo_no",
               test_fraction: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Earliest rows train, the most recent fraction tests; together all rows."""
    early = train_rows(df, timestamp, identifier, test_fraction)
    return df.where(early), df.where(~early)


def cutoff_split(df: DataFrame, cutoff: Column, timestamp: str = TIMESTAMP) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(timestamp) < cutoff), df.where(F.col(timestamp) >= cutoff)


def trailing_months_split(df: DataFrame, months: int = 12, timestamp: str = TIMESTAMP,
                          now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Test on the last ``months`` before ``now`` (default: the moment it runs)."""
    end = F.current_timestamp() if now is None else now
    return cutoff_split(df, F.add_months(end, -months) if now is not None else F.add_months(F.to_date(end), -months), timestamp)


def shared_ids(train: DataFrame, test: DataFrame, identifier: str = "wo_no") -> DataFrame:
    """Ids on both sides of a split; empty when disjoint."""
    return train.select(identifier).intersect(test.select(identifier))


def site_feature_matrix(daily: DataFrame, features: Sequence[str], site: str = "site_id", date: str = "signal_date",
                        keep_above: float = 0.3) -> DataFrame:
    """Per site: features with enough values, gaps filled with the site's median.

    A feature a site lacks is null in all of its rows; ``usable`` lists the rest.
    Groups are a site's days, so the median's buffer is bounded by the calendar.
    """
    own = W.partitionBy(site)
    value = {f: F.col(f).cast("double") for f in features}
    stats = daily.select(
        site, date, *features,
        *[F.avg(F.col(f).isNotNull().cast("double")).over(own).alias(f"_share_{f}") for f in features],
        *[F.percentile(value[f], F.lit(0.5)).over(own).alias(f"_med_{f}") for f in features])
    kept = {f: (F.col(f"_share_{f}") >= keep_above) & F.col(f"_med_{f}").isNotNull() for f in features}
    return stats.select(
        site, date, *[F.when(kept[f], F.coalesce(value[f], F.col(f"_med_{f}"))).alias(f) for f in features],
        F.array_compact(F.array(*[F.when(kept[f], F.lit(f)) for f in features])).alias("usable"))
