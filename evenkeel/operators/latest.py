"""Dedupe, top-k and latest-row operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
                  rank_name: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key in ``order`` (end it with a unique column).

    ``row_number() <= n`` is planned with a group limit before the shuffle: each
    task sends on at most ``n`` rows a key, so a hot key does not pile up. Spark
    does so up to a threshold (1000), which is raised where ``n`` is larger.
    """
    threshold = "spark.sql.optimizer.windowGroupLimitThreshold"
    if n >= int(df.sparkSession.conf.get(threshold, "1000")):
        df.sparkSession.conf.set(threshold, str(n + 1))
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col("_rank") <= n)
    return kept.withColumnRenamed("_rank", rank_name) if rank_name else kept.drop("_rank")


def keep_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row a key: the greatest by ``latest``, ties by the smallest ``tiebreak``."""
    order = [F.col(c).desc_nulls_last() for c in latest] + [F.col(c).asc() for c in tiebreak]
    return first_per_key(df, keys, order)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall: a bounded heap a task, then one merge."""
    return df.orderBy(*order).limit(n)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once, null keys included.

    Keys are counted with a map-side combine and joined back; a window count would
    bring every row of a hot key into one task.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    names = {k: f"_d_{k}" for k in keys}
    repeated = repeated.withColumnsRenamed(names)
    match = None
    for key, name in names.items():
        test = df[key].eqNullSafe(repeated[name])
        match = test if match is None else match & test
    return df.join(repeated, match, "left_semi")


def latest_with_preference(df: DataFrame, key: str, date: str, preferred: Column,
                           tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Latest row a key, rows meeting ``preferred`` first."""
    wanted = F.coalesce(preferred, F.lit(False)).cast("int")
    return first_per_key(df, [key], [wanted.desc(), F.col(date).desc(), *tiebreak])


def sorted_by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows in order of key and ``order`` across and inside partitions.

    Ranges are cut on all sort columns, so a key with a third of the rows is
    spread over several partitions.
    """
    return df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
