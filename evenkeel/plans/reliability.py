"""Reliability risk index: one 0–100 number per site and day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import clip, weighted_blend
from evenkeel.operators.rolling import robust_unit, rolling_deviation, rolling_mean, trailing

# --- fixed values: components and weights ----------------------------------------
COMPONENTS = ("maintenance_risk", "alarm_pressure", "energy_anomaly", "incident_pressure")
FIRE_WEIGHT, HVAC_WEIGHT, UNRESOLVED_WEIGHT = 3, 2, 3
# ---------------------------------------------------------------------------------
KEYS = ["site_id", "signal_date"]


def breach_load(scored: DataFrame, probability: str = "p", timestamp: str = "work_started_at_utc") -> DataFrame:
    """Mean and summed breach probability of the orders created per site and day."""
    return scored.groupBy("site_id", F.to_date(timestamp).alias("signal_date")).agg(
        F.avg(probability).alias("maintenance_risk_raw"), F.sum(probability).alias("expected_breaches"),
        F.count(F.lit(1)).alias("n_work_orders"))


def alarm_pressure_raw() -> Column:
    fire, hvac, every = (F.coalesce(c, F.lit(0)) for c in ("fire_alarm_count", "hvac_alarm_count", "alarm_count"))
    return fire * FIRE_WEIGHT + hvac * HVAC_WEIGHT + F.greatest(every - fire - hvac, F.lit(0))


def incident_pressure_raw() -> Column:
    return F.coalesce("incident_count", F.lit(0)) + F.coalesce("unresolved_incident_count", F.lit(0)) * UNRESOLVED_WEIGHT


def reliability_index(daily: DataFrame, load: DataFrame | None = None,
                      weights: Mapping[str, float] | None = None) -> DataFrame:
    """Component scores and the blended, smoothed index.

    All windows are over a site's days, so they share one shuffle by site of the
    daily table; nothing here depends on event volume.
    """
    df = daily.withColumns({"_alarm": alarm_pressure_raw(), "_incident": incident_pressure_raw()})
    if load is not None:
        df = df.join(load, KEYS, "left")
    else:
        df = df.withColumns({"maintenance_risk_raw": F.lit(None).cast("double"), "n_work_orders": F.lit(None).cast("bigint")})
    df = rolling_deviation(df, ["site_id"], "signal_date", "electricity_kwh", "_energy")
    df = df.withColumns({
        "maintenance_risk": clip("maintenance_risk_raw", 0.0, 1.0),
        "alarm_pressure": robust_unit("_alarm", ["site_id"]),
        "energy_anomaly": robust_unit("_energy", ["site_id"]),
        "incident_pressure": robust_unit("_incident", ["site_id"]),
    })
    weight = {**dict.fromkeys(COMPONENTS, 1.0), **(weights or {})}
    df = df.withColumn("rri_daily", weighted_blend([(c, weight[c]) for c in COMPONENTS]) * 100.0)
    week = trailing(["site_id"], "signal_date", 7)
    df = df.withColumn("reliability_risk_index", rolling_mean("rri_daily", week))
    return df.select(*KEYS, "reliability_risk_index", "rri_daily", *COMPONENTS, "n_work_orders", "alarm_count",
                     "electricity_kwh", "incident_count")


def index_trend(index: DataFrame, rows: int = 14, at_least: int = 3) -> DataFrame:
    spec = trailing(["site_id"], "signal_date", rows)
    return index.withColumn("trend", rolling_mean("reliability_risk_index", spec, at_least))
