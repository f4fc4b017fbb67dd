"""Profiles, rates, frequency tables, distributions, pivots and correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import as_column, share
from evenkeel.operators.ordered import exact_quantiles


def rate_by(df: DataFrame, keys: Sequence[str], label: str, min_count: int = 0) -> DataFrame:
    """Positives, rows and positive rate in percent per key."""
    y = F.col(label).cast("int")
    out = df.groupBy(*keys).agg(F.sum(y).alias("positives"), F.count(y).alias("row_count"))
    out = out.withColumn("rate_pct", F.col("positives") / F.col("row_count") * 100.0)
    return out.where(F.col("row_count") >= min_count) if min_count else out


def rates_by_dimension(df: DataFrame, dimensions: Sequence[str], label: str) -> DataFrame:
    """``rate_by`` for many dimensions in one scan and one small shuffle.

    A row becomes one (dimension, level) pair a dimension; the map side combines
    them, so what is shuffled is one row a level and task.
    """
    y = F.col(label).cast("int")
    cells = df.select(*[F.col(d).cast("string").alias(d) for d in dimensions], y.alias("_y"))
    long = cells.select("_y", F.inline(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).alias("level")) for d in dimensions])))
    out = long.groupBy("dimension", "level").agg(F.sum("_y").alias("positives"), F.count("_y").alias("row_count"))
    return out.withColumn("rate_pct", F.col("positives") / F.col("row_count") * 100.0)


def grouping_sets_rate(df: DataFrame, sets: Sequence[Sequence[str]], label: str) -> DataFrame:
    """Rates at several grains at once, with the grouping id."""
    columns = sorted({c for s in sets for c in s}, key=[c for s in sets for c in s].index)
    y = F.col(label).cast("int")
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("grain"), F.sum(y).alias("positives"), F.count(y).alias("row_count"))
    return out.withColumn("rate_pct", F.col("positives") / F.col("row_count") * 100.0)


def top_rates(df: DataFrame, key: str, label: str, min_count: int = 50, n: int = 15) -> DataFrame:
    return rate_by(df, [key], label, min_count).orderBy(F.desc("rate_pct"), key).limit(n)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Row count, nulls, null percent and distinct values per column.

    Nulls come from one fused aggregate; exact distinct counts from distinct
    (column, value) pairs, so no column's values meet in one task.
    """
    columns = list(columns or df.columns)
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])))
    if approximate:
        distinct = F.approx_count_distinct("value").alias("distinct_count")
        out = pairs.groupBy("column_name").agg(
            F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("value").isNull()).alias("null_count"), distinct)
    else:
        counted = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_n"))
        out = counted.groupBy("column_name").agg(
            F.sum("_n").alias("row_count"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_n"))), F.lit(0)).alias("null_count"),
            F.count("value").alias("distinct_count"))
    return out.withColumn("null_pct", F.col("null_count") / F.col("row_count") * 100.0)


def null_rate(column: Column | str) -> Column:
    """Aggregate: share of nulls, 0.0 for an empty table."""
    return F.coalesce(F.avg(as_column(column).isNull().cast("double")), F.lit(0.0))


def hit_rate(column: Column | str) -> Column:
    """Aggregate: share of non-nulls, 0.0 for an empty table."""
    return F.coalesce(F.avg(as_column(column).isNotNull().cast("double")), F.lit(0.0))


def value_counts(df: DataFrame, keys: Sequence[str], with_null: bool = True) -> DataFrame:
    kept = df if with_null else df.dropna(subset=list(keys))
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def distribution(df: DataFrame, value: str, fractions: Mapping[str, float], groups: Sequence[str] = (),
                 few_groups: bool = False) -> DataFrame:
    """Count, mean, sample deviation, ends and exact quantiles per group."""
    column = F.col(value).cast("double")
    moments = df.groupBy(*groups).agg(
        F.count(column).alias("value_count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"), F.max(column).alias("max"))
    quantiles = exact_quantiles(df, value, fractions, groups, few_groups)
    if not groups:
        found = quantiles.first()
        return moments.withColumns({f: F.lit(found[f]).cast("double") for f in fractions})
    return moments.join(quantiles, list(groups), "left")


def cap_by_quantile(df: DataFrame, value: str, fraction: float = 0.95, low: float | None = None,
                    drop: bool = True) -> DataFrame:
    """Rows up to the value's own quantile (``drop``), or values clipped to it."""
    wanted = {"high": fraction} | ({"low": low} if low is not None else {})
    # one row to the driver: as literals the cuts reach the scan
    cuts = exact_quantiles(df, value, wanted).first()
    column, high = F.col(value), F.lit(cuts["high"])
    if drop:
        kept = df.where(column <= high)
        return kept if low is None else kept.where(column >= F.lit(cuts["low"]))
    bounded = F.least(column, high)
    bounded = bounded if low is None else F.greatest(bounded, F.lit(cuts["low"]))
    return df.withColumn(value, F.when(column.isNotNull(), bounded))


def pivot_counts(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    """Counts per key with one column a listed value, zero when absent.

    Listing the values saves the extra job that finds them and bounds the width.
    """
    return df.groupBy(*keys).agg(*[
        F.count_if(F.col(column) == F.lit(v)).alias(f"{prefix}{v}") for v in values])


def unpivot_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(keys), list(columns), name, value)


def presence_rates(df: DataFrame, count_columns: Sequence[str], label: str) -> DataFrame:
    """Rate when a counted thing occurred at least once against when it did not."""
    y = F.col(label).cast("int")
    long = df.select(y.alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("signal"), (F.coalesce(F.col(c), F.lit(0)) > 0).alias("present"))
        for c in count_columns])))
    out = long.groupBy("signal", "present").agg(F.sum("_y").alias("positives"), F.count("_y").alias("row_count"))
    return out.withColumn("rate_pct", F.col("positives") / F.col("row_count") * 100.0)


def correlations(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Pearson correlation of each feature to the label over rows that have both."""
    y = F.col(label).cast("double")
    row = df.agg(*[F.corr(F.col(f).cast("double"), y).alias(f) for f in features])
    return row.unpivot([], list(features), "feature", "correlation")


def pair_correlation(df: DataFrame, key: str, left: str, right: str, date: str, value: str) -> DataFrame:
    """Correlation of one value between two keys, over the dates both have."""
    sides = df.where(F.col(key).isin(left, right)).groupBy(date).agg(
        F.max(F.when(F.col(key) == left, F.col(value))).alias("_a"),
        F.max(F.when(F.col(key) == right, F.col(value))).alias("_b")).dropna(subset=["_a", "_b"])
    return sides.agg(F.count(F.lit(1)).alias("dates"), F.corr("_a", "_b").alias("correlation"))


def resample(df: DataFrame, timestamp: str, unit: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and count of a series per day, week (Monday) or month."""
    period = F.to_date(F.date_trunc(unit, F.col(timestamp))).alias("period")
    return df.groupBy(*keys, period).agg(F.avg(value).alias("mean_value"), F.count(value).alias("points"))


def usage_profile(df: DataFrame, key: str, value: str, high: float = 60.0) -> DataFrame:
    """Mean, sample deviation, share of zero days and of busy days per room."""
    return df.groupBy(key).agg(
        F.avg(value).alias("mean_pct"), F.stddev_samp(value).alias("std_pct"),
        share(F.col(value) == 0).alias("zero_day_frac"), share(F.col(value) >= high).alias("high_day_frac"))


def ranking_by_mean(df: DataFrame, key: str, value: str, n: int = 15, ascending: bool = False) -> DataFrame:
    means = df.groupBy(key).agg(F.avg(value).alias("mean_value"))
    order = F.asc("mean_value") if ascending else F.desc("mean_value")
    return means.orderBy(order, key).limit(n)


def reading_inventory(readings: DataFrame, group: Sequence[str], timestamp: str) -> DataFrame:
    return readings.groupBy(*group).agg(
        F.count(F.lit(1)).alias("points"), F.min(timestamp).alias("earliest"), F.max(timestamp).alias("latest"))


def task_statistics(df: DataFrame, keys: Sequence[str], completion: str, wear: str, status: str,
                    statuses: Sequence[str]) -> DataFrame:
    """Equipment task table: mean completion, wear spread and status counts."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tasks"), F.avg(completion).alias("mean_completion"),
        F.min(wear).alias("min_wear"), F.avg(wear).alias("mean_wear"), F.max(wear).alias("max_wear"),
        *[F.count_if(F.col(status) == s).alias(f"status_{s}") for s in statuses])
