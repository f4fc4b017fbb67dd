"""Open intervals per day: by expansion and by sweep line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def open_by_expansion(df: DataFrame, keys: Sequence[str], start: str, end: str, day: str, name: str) -> DataFrame:
    """Each interval counts on every day ``start``..``end`` inclusive.

    Equal intervals are counted before they are expanded. Reversed or half-null
    intervals are dropped (``reversed_intervals`` lists them).
    """
    counted = (
        df.where(F.col(start) <= F.col(end))
        .groupBy(*keys, F.col(start).alias("_from"), F.col(end).alias("_to"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    days = counted.select(*keys, "_n", F.explode(F.sequence("_from", "_to")).alias(day))
    return days.groupBy(*keys, day).agg(F.sum("_n").alias(name))


def open_by_sweep(df: DataFrame, keys: Sequence[str], start: str, end: str, day: str, name: str) -> DataFrame:
    """The same counts from +1 at the start and −1 after the end.

    Two rows an interval instead of one a day, combined per key and day before the
    shuffle; the running sum is over at most one row a key and calendar day, and
    only runs with something open are spelt out into days.
    """
    steps = (
        df.where(F.col(start) <= F.col(end))
        .select(*keys, F.inline(F.array(
            F.struct(F.col(start).alias("_day"), F.lit(1).cast("bigint").alias("_step")),
            F.struct(F.date_add(F.col(end), 1).alias("_day"), F.lit(-1).cast("bigint").alias("_step")),
        )))
        .groupBy(*keys, "_day").agg(F.sum("_step").alias("_step"))
    )
    along = W.partitionBy(*keys).orderBy("_day")
    runs = steps.select(
        *keys, "_day",
        F.sum("_step").over(along.rowsBetween(W.unboundedPreceding, 0)).alias(name),
        F.lead("_day").over(along).alias("_next"),
    ).where(F.col(name) > 0)
    return runs.select(*keys, F.explode(F.sequence("_day", F.date_sub("_next", 1))).alias(day), name)


def reversed_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col(start) > F.col(end))
