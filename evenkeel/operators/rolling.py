"""Trailing windows over daily tables.

The partition is a site's days, bounded by the calendar and not by event volume:
these operators run on tables already aggregated to one row a site and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.window import WindowSpec

from evenkeel.functions import as_column, clip


def trailing(keys: Sequence[str], date: str, days: int, calendar: bool = False) -> WindowSpec:
    """The last ``days`` rows of a key, or calendar days when ``calendar``."""
    spec = W.partitionBy(*keys)
    if calendar:
        return spec.orderBy(F.datediff(F.col(date), F.lit("1970-01-01"))).rangeBetween(-(days - 1), 0)
    return spec.orderBy(date).rowsBetween(-(days - 1), 0)


def rolling(df: DataFrame, keys: Sequence[str], date: str, days: int,
            means: dict[str, str] | None = None, sums: dict[str, str] | None = None,
            calendar: bool = False) -> DataFrame:
    """Add rolling means and sums: ``{new column: source column}``."""
    spec = trailing(keys, date, days, calendar)
    new = {n: F.avg(F.col(c).cast("double")).over(spec) for n, c in (means or {}).items()}
    new |= {n: F.sum(F.col(c).cast("double")).over(spec) for n, c in (sums or {}).items()}
    return df.withColumns(new)


def rolling_mean(value: Column | str, spec: WindowSpec, at_least: int = 1) -> Column:
    """Mean over the frame, null below ``at_least`` non-null values."""
    column = as_column(value)
    return F.when(F.count(column).over(spec) >= at_least, F.avg(column).over(spec))


def rolling_median(value: Column | str, spec: WindowSpec, at_least: int) -> Column:
    """``median`` takes no frame; ``percentile`` does."""
    column = as_column(value)
    return F.when(F.count(column).over(spec) >= at_least, F.percentile(column, F.lit(0.5)).over(spec))


def rolling_deviation(df: DataFrame, keys: Sequence[str], date: str, value: str, name: str,
                      rows: int = 28, at_least: int = 7) -> DataFrame:
    """Distance from the rolling median, in units of the rolling median distance."""
    spec = trailing(keys, date, rows)
    out = df.withColumn("_med", rolling_median(value, spec, at_least))
    out = out.withColumn("_dev", F.abs(F.col(value) - F.col("_med")))
    out = out.withColumn("_mad", rolling_median("_dev", spec, at_least))
    return out.withColumn(name, F.col("_dev") / (F.col("_mad") + F.lit(1e-6))).drop("_med", "_dev", "_mad")


def robust_unit(value: Column | str, keys: Sequence[str], at_least: int = 5, spread: float = 1e-9) -> Column:
    """Winsorised min–max between a key's 5th and 95th percentile, in [0, 1].

    Null for the whole key when it has under ``at_least`` values or no spread.
    """
    column = as_column(value).cast("double")
    spec = W.partitionBy(*keys)
    ends = F.percentile(column, F.array(F.lit(0.05), F.lit(0.95))).over(spec)
    low, high = F.element_at(ends, 1), F.element_at(ends, 2)
    usable = (F.count(column).over(spec) >= at_least) & (high - low >= spread)
    return F.when(usable, clip((column - low) / (high - low), 0.0, 1.0))


def dated_positions(df: DataFrame, date: str, name: str = "date_position") -> DataFrame:
    """The distinct dates with their position (from 0): one row a calendar date."""
    days = df.select(date).where(F.col(date).isNotNull()).distinct()
    return days.withColumn(name, F.row_number().over(W.orderBy(date)) - 1)


def use_streaks(df: DataFrame, key: str, date: str, value: str, target: Column, threshold: float,
                name: str = "streak") -> DataFrame:
    """Per key, how many dates in a row right before ``target`` exceed ``threshold``.

    Dates are those of the whole table; a key without a row on one of them counts
    as zero there and the streak ends. No dense key × date grid is built: the r-th
    latest active date belongs to the streak when it lies r positions back.
    """
    positions = F.broadcast(dated_positions(df, date))  # one row a calendar date
    placed = df.join(positions, date)
    here = F.max(F.when(F.col(date) == target, F.col("date_position")))
    aim = placed.agg(here.alias("at")).scalar()
    active = placed.where((F.col(value) > threshold) & (F.col("date_position") < aim)).select(key, "date_position")
    ranked = active.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(F.desc("date_position"))))
    return ranked.groupBy(key).agg(F.count_if(F.col("date_position") == aim - F.col("_r")).alias(name))
