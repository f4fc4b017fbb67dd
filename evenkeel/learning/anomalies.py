"""Anomalies per site: isolation forest (Liu, Ting and Zhou 2008) and robust z-scores.

Trees see at most 256 sampled rows each, grown in small tasks by site and tree. A
site's rows are then dealt to blocks, and its forest (0.7 MB of 200 trees) travels once
to each block, never beside a row.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.operators.ordered import exact_quantiles
from evenkeel.session import durable

# --- fixed values: forest parameters ---------------------------------------------
TREES, SAMPLE, CONTAMINATION, SEED, LEAST_ROWS = 200, 256, 0.05, 42, 30
MAD_TO_SIGMA = 1.4826
EULER_GAMMA = 0.5772156649015329
# ---------------------------------------------------------------------------------
TREES_PER_TASK = 20
#: Rows that walk down a block of trees at once.
SCORED_TOGETHER = 4096
#: Rows of a site that one task scores, on average.
ROWS_PER_BLOCK = 50_000
# executors need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])
BLOCK_SCHEMA = "trees INT, sample_rows INT, split_on ARRAY<INT>, split_at ARRAY<DOUBLE>, child ARRAY<INT>, depth_at ARRAY<DOUBLE>"


def mean_path(n: int | np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + EULER_GAMMA) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, tree: np.ndarray, trees: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """Isolation trees over rows labelled with their tree, all grown level by level.

    Nodes sit in one table whose first ``trees`` entries are the roots; a leaf has
    split −1 and its expected depth, an inner node the index of its lower child.
    """
    limit = math.ceil(math.log2(max(np.bincount(tree, minlength=trees).max(), 2)))
    on, at, child = np.full(trees, -1), np.zeros(trees), np.zeros(trees, dtype=int)
    depth_at = np.zeros(trees)
    node = tree.copy()
    for depth in range(limit + 1):
        order = np.argsort(node, kind="stable")
        x, node = x[order], node[order]
        here, starts, counts = np.unique(node, return_index=True, return_counts=True)
        low, high = np.minimum.reduceat(x, starts, axis=0), np.maximum.reduceat(x, starts, axis=0)
        varies = high > low
        inner = (counts > 1) & varies.any(axis=1) & (depth < limit)
        depth_at[here[~inner]] = depth + mean_path(counts[~inner])
        if not inner.any():
            break
        lottery = rng.random(varies.shape)
        feature = np.where(varies, lottery, -1.0).argmax(axis=1)
        lines = np.arange(len(here))
        cut = low[lines, feature] + rng.random(len(here)) * (high[lines, feature] - low[lines, feature])
        first = len(on) + 2 * (np.cumsum(inner) - 1)
        on[here[inner]], at[here[inner]], child[here[inner]] = feature[inner], cut[inner], first[inner]
        fresh = 2 * int(inner.sum())
        on, at = np.append(on, np.full(fresh, -1)), np.append(at, np.zeros(fresh))
        child, depth_at = np.append(child, np.zeros(fresh, dtype=int)), np.append(depth_at, np.full(fresh, depth + 1.0))
        place = np.repeat(lines, counts)
        goes_on = inner[place]
        x, place = x[goes_on], place[goes_on]
        node = first[place] + (x[np.arange(len(x)), feature[place]] >= cut[place])
    return on, at, child, depth_at


def _depths(x: np.ndarray, trees: int, on: np.ndarray, at: np.ndarray, child: np.ndarray, depth_at: np.ndarray) -> np.ndarray:
    """Summed expected depth of each row over a block of trees."""
    node = np.tile(np.arange(trees), (len(x), 1))
    lines = np.broadcast_to(np.arange(len(x))[:, None], node.shape)
    inner = on[node] >= 0
    while inner.any():
        here = node[inner]
        node[inner] = child[here] + (x[lines[inner], on[here]] >= at[here])
        inner = on[node] >= 0
    return depth_at[node].sum(axis=1)


def isolation_forest(df: DataFrame, site: str, identifier: str, features: Sequence[str], trees: int = TREES,
                     sample: int = SAMPLE, contamination: float = CONTAMINATION, seed: int = SEED,
                     least_rows: int = LEAST_ROWS) -> DataFrame:
    """Score (−1 to 0, lower is stranger), flag and reason per row; no row is left out.

    A gap takes the site's median of that feature; a feature that is null throughout
    a site is not used there. Sites below ``least_rows`` are too small for a forest:
    their rows have a null score, are not flagged, and say so in ``reason``. So do
    rows without a site, which are no site of their own.
    """
    features = list(features)
    sizes = df.groupBy(site).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.percentile(F.col(f).cast("double"), F.lit(0.5)).alias(f"_mid_{f}") for f in features])
    whole = df.select(site, identifier, *[F.col(f).cast("double").alias(f) for f in features]).join(sizes, site)
    filled = [F.coalesce(f, f"_mid_{f}", F.lit(0.0)).alias(f) for f in features]
    every = whole.select(site, identifier, "_rows", *filled)
    rows, small = every.where(F.col("_rows") >= least_rows), every.where(F.col("_rows") < least_rows)

    # a row draws each tree by hash; expected draws a tree are about 1.5 times the sample
    chance = F.least(F.lit(1.0), F.lit(1.5 * sample + 32) / F.col("_rows"))
    coin = lambda t: F.pmod(F.xxhash64(F.col(identifier), t, F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    drawn = rows.withColumn("tree", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: coin(t) < chance)))
    order = W.partitionBy(site, "tree").orderBy(F.xxhash64(identifier, "tree", F.lit(seed)), identifier)
    drawn = drawn.withColumn("_pick", F.row_number().over(order)).where(F.col("_pick") <= sample)

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tree", "_pick"])
        names, local = np.unique(pdf["tree"], return_inverse=True)
        rng = np.random.default_rng([seed, int(key[1])])
        table = _grow(pdf[features].to_numpy(float), local, len(names), rng)
        rows = int(np.bincount(local).max())
        return pd.DataFrame([(key[0], int(key[1]), len(names), rows, *(c.tolist() for c in table))], columns=[
            site, "_task", "trees", "sample_rows", "split_on", "split_at", "child", "depth_at"])

    kind = dict(df.dtypes)[site]
    grown = drawn.withColumn("_task", F.floor(F.col("tree") / TREES_PER_TASK)).groupBy(site, "_task").applyInPandas(
        grow, f"`{site}` {kind}, _task BIGINT, {BLOCK_SCHEMA}")

    forests = durable(grown)
    blocks = F.ceil(F.col("_rows") / ROWS_PER_BLOCK).cast("int")
    places = sizes.where(F.col("_rows") >= least_rows).select(site, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block"))
    travelling = forests.join(places, site).groupBy(site, "_block")
    ready = rows.select(site, identifier, F.pmod(F.xxhash64(F.col(identifier), F.lit(seed)), blocks).cast("int").alias("_place"), *features)

    def score(pdf: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        x, depth = pdf[features].to_numpy(float), np.zeros(len(pdf))
        forest = forest.sort_values("_task")
        for trees_, *table in zip(*(forest[c] for c in ("trees", "split_on", "split_at", "child", "depth_at"))):
            table = [np.asarray(c) for c in table]
            for start in range(0, len(x), SCORED_TOGETHER):
                depth[start:start + SCORED_TOGETHER] += _depths(x[start:start + SCORED_TOGETHER], trees_, *table)
        grown_trees = max(int(forest["trees"].sum()), 1)
        typical = max(float(mean_path(int(forest["sample_rows"].max()))) if len(forest) else 0.0, 1e-12)
        return pd.DataFrame({site: pdf[site], identifier: pdf[identifier], "anomaly_score": -np.power(2.0, -(depth / grown_trees) / typical)})

    kinds = dict(df.dtypes)
    scored = durable(ready.groupBy(site, "_place").cogroup(travelling).applyInPandas(
        score, f"`{site}` {kind}, `{identifier}` {kinds[identifier]}, anomaly_score DOUBLE"))
    cut = exact_quantiles(scored, "anomaly_score", {"_cut": contamination}, [site])
    judged = scored.join(cut, site).select(
        site, identifier, "anomaly_score", (F.col("anomaly_score") < F.col("_cut")).alias("is_anomaly"),
        F.lit(None).cast("string").alias("reason"))
    nowhere = df.where(F.col(site).isNull()).select(
        site, identifier, F.lit(None).cast("double").alias("anomaly_score"), F.lit(False).alias("is_anomaly"),
        F.lit("no site").alias("reason"))
    return judged.unionByName(nowhere).unionByName(small.select(
        site, identifier, F.lit(None).cast("double").alias("anomaly_score"), F.lit(False).alias("is_anomaly"),
        F.lit(f"fewer than {least_rows} rows").alias("reason")))


def robust_z(df: DataFrame, site: str, features: Sequence[str], name: str = "baseline_zscore") -> DataFrame:
    """Largest distance from the site's median over the features, in robust sigmas.

    Groups are a site's days, so the two medians' buffers are bounded.
    """
    own = W.partitionBy(site)
    middle = {f"_m_{f}": F.percentile(f, F.lit(0.5)).over(own) for f in features}
    away = df.withColumns(middle).withColumns({f"_d_{f}": F.abs(F.col(f) - F.col(f"_m_{f}")) for f in features})
    out = away.withColumns({f"_s_{f}": F.percentile(f"_d_{f}", F.lit(0.5)).over(own) for f in features})
    z = [F.col(f"_d_{f}") / (F.when(F.col(f"_s_{f}") == 0, F.lit(1e-6)).otherwise(F.col(f"_s_{f}")) * MAD_TO_SIGMA)
         for f in features]
    largest = z[0] if len(z) == 1 else F.greatest(*z)
    scratch = [f"{p}{f}" for p in ("_m_", "_d_", "_s_") for f in features]
    return out.withColumn(name, largest).drop(*scratch)


def anomaly_metrics(scored: DataFrame, site: str, score: str = "anomaly_score", flag: str = "is_anomaly",
                    baseline: str = "baseline_zscore") -> DataFrame:
    return scored.groupBy(site).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(flag)).alias("n_anomalies"),
        F.round(F.avg(F.col(flag).cast("double")), 4).alias("anomaly_rate"), F.min(score).alias("score_min"),
        F.max(score).alias("score_max"), F.avg(score).alias("score_mean"),
        F.percentile(baseline, F.lit(0.95)).alias("baseline_p95"))


def strangest(scored: DataFrame, n: int = 10, score: str = "anomaly_score", tiebreak: Sequence[str] = ()) -> DataFrame:
    return scored.orderBy(F.asc_nulls_last(score), *tiebreak).limit(n)
