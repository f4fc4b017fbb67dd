"""Read queries over published marts; filters reach the scan or prune partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.joins import with_labels
from evenkeel.operators.latest import first_per_key

INDEX_COLUMNS = (
    "signal_date", "reliability_risk_index", "maintenance_risk", "alarm_pressure", "energy_anomaly", "incident_pressure",
)


def portfolio_sites(portfolio: DataFrame) -> DataFrame:
    return portfolio.select("site_id", F.col("signal_date").alias("last_seen"), "reliability_risk_index", "band")


def site_reliability(index: DataFrame, site: str, days: int = 30) -> DataFrame:
    """A site's index from ``days`` before its last date, that day included."""
    mine = index.where(F.col("site_id") == site)
    last = mine.agg(F.max("signal_date")).scalar()
    return mine.where(F.col("signal_date") >= F.date_sub(last, days)).select(*INDEX_COLUMNS).orderBy("signal_date")


def site_queue(queue: DataFrame, site: str) -> DataFrame:
    return queue.where(F.col("site_id") == site).select(
        "wo_no", "work_type_eng", "priority_id_str", "breach_risk_pct", "risk_band").orderBy(F.desc("breach_risk_pct"), "wo_no")


def known_sites(table: DataFrame) -> DataFrame:
    return table.select("site_id").distinct()


def my_tasks(assigned: DataFrame, worker: str, sites: DataFrame | None = None) -> DataFrame:
    mine = assigned.where(F.col("assigned_to") == worker)
    return with_labels(mine, sites, "site_id", "display_name") if sites is not None else mine


def task_counts(assigned: DataFrame, worker: str) -> DataFrame:
    return assigned.where(F.col("assigned_to") == worker).groupBy("action").agg(F.count(F.lit(1)).alias("tasks"))


def last_rows(index: DataFrame, sites: Sequence[str], rows: int = 730) -> DataFrame:
    """The last daily rows of selected sites."""
    return first_per_key(index.where(F.col("site_id").isin(*sites)), ["site_id"], [F.col("signal_date").desc()], rows)


def model_comparison(metrics: DataFrame, digits: int = 3) -> DataFrame:
    """Evaluation rows rounded for display."""
    numbers = [f.name for f in metrics.schema.fields if f.dataType.typeName() == "double"]
    return metrics.select(*[F.round(c, digits).alias(c) if c in numbers else F.col(c) for c in metrics.columns])
