"""Rooms in three usage tiers by k-means on their usage profile."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.session import durable

# --- fixed values ----------------------------------------------------------------
PROFILE_COLUMNS = ("mean_pct", "std_pct", "zero_day_frac", "high_day_frac")
TIERS = ("light", "medium", "heavy")
# ---------------------------------------------------------------------------------
#: Rooms that one task reads in each of the many passes of the restarts.
ROWS_PER_TASK = 50_000


def usage_tiers(profiles: DataFrame, columns: Sequence[str] = PROFILE_COLUMNS, restarts: int = 20, seed: int = 42) -> DataFrame:
    """Best of ``restarts`` k-means runs; clusters are named by their mean use.

    The profiles, one row a room, are worked out once; the restarts read them side by
    side, in as many tasks as there are rows for, not as their shuffle had.
    """
    filled = durable(profiles.fillna(0.0, subset=list(columns)))
    tasks = max(1, math.ceil(filled.count() / ROWS_PER_TASK))
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_vector").transform(filled.coalesce(tasks))
    scaler = StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True).fit(assembled)
    spark = profiles.sparkSession
    data = scaler.transform(assembled).select("_scaled").persist()

    def fit(i: int):
        return KMeans(k=len(TIERS), featuresCol="_scaled", predictionCol="_cluster", seed=seed + i).fit(data)

    try:
        data.count()
        with ThreadPoolExecutor(max_workers=spark.sparkContext.defaultParallelism) as pool:
            fits = list(pool.map(inheritable_thread_target(spark)(fit), range(restarts)))
    finally:
        data.unpersist()
    best = min(fits, key=lambda m: m.summary.trainingCost)
    labelled = best.transform(scaler.transform(assembled))
    # one row a cluster
    means = labelled.groupBy("_cluster").agg(F.avg("mean_pct").alias("_mean"))
    ranked = means.withColumn("_rank", F.row_number().over(W.orderBy("_mean")))
    tier = F.get(F.array(*[F.lit(t) for t in TIERS]), F.col("_rank") - 1)
    named = ranked.select("_cluster", tier.alias("usage_tier"))
    return labelled.join(F.broadcast(named), "_cluster").drop("_cluster", "_vector", "_scaled")
