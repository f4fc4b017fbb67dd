"""Evaluation of scored rows: rank metrics, precision at k, calibration, importance.

Scores are first counted per distinct value, so ties cost nothing, and totals in
score order come from ``ordered.running_totals``: no global sort in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.functions import equal_bin
from evenkeel.learning import ranks
from evenkeel.operators import ordered
from evenkeel.operators.ordered import hashed_numbers, row_numbers, running_totals
from evenkeel.session import durable

# --- fixed values: shares of the backlog a crew can act on -----------------------
CAPACITY_FRACTIONS = (0.05, 0.10, 0.20, 0.30)
# ---------------------------------------------------------------------------------


def _by_score(scored: DataFrame, score: str, label: str, groups: Sequence[str]) -> DataFrame:
    y = F.col(label).cast("bigint")
    return scored.groupBy(*groups, F.col(score).cast("double").alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(y).alias("_pos"))


def classification_metrics(scored: DataFrame, score: str, label: str, groups: Sequence[str] = (),
                           few_groups: bool = False) -> DataFrame:
    """ROC AUC, average precision, F1/precision/recall at 0.5, Brier, base rate and
    the confusion matrix, one row a group."""
    counts = _by_score(scored, score, label, groups)
    r = running_totals(counts, [F.col("_s")], {"n": F.col("_n"), "pos": F.col("_pos")}, groups, few_groups)
    s, n, pos = F.col("_s"), F.col("_n"), F.col("_pos")
    neg = n - pos
    positives, negatives = F.col("total_pos"), F.col("total_n") - F.col("total_pos")
    neg_below = (F.col("cum_n") - n) - (F.col("cum_pos") - pos)
    # flagged when everything from this score upwards is
    flagged, caught = F.col("total_n") - F.col("cum_n") + n, F.col("total_pos") - F.col("cum_pos") + pos
    yes = s >= 0.5
    sums = r.groupBy(*groups).agg(
        F.sum(n).alias("row_count"), F.sum(pos).alias("_p"), F.sum(neg).alias("_q"),
        F.sum(pos * (neg_below + neg / 2.0)).alias("_wins"),
        F.sum(F.when(positives > 0, pos / positives * (caught / flagged))).alias("pr_auc"),
        F.sum(F.when(yes, pos).otherwise(0)).alias("tp"), F.sum(F.when(yes, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(~yes, pos).otherwise(0)).alias("fn"), F.sum(F.when(~yes, neg).otherwise(0)).alias("tn"),
        F.sum(pos * F.pow(1.0 - s, 2) + neg * F.pow(s, 2)).alias("_brier"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(
        *groups, "row_count",
        F.when((F.col("_p") > 0) & (F.col("_q") > 0), F.col("_wins") / (F.col("_p") * F.col("_q"))).alias("roc_auc"),
        "pr_auc", ratio(tp * 2.0, tp * 2 + fp + fn).alias("f1"), ratio(tp * 1.0, tp + fp).alias("precision"),
        ratio(tp * 1.0, tp + fn).alias("recall"), (F.col("_brier") / F.col("row_count")).alias("brier"),
        (F.col("_p") / F.col("row_count")).alias("base_rate"), "tp", "fp", "fn", "tn")


def precision_at_k(scored: DataFrame, score: str, label: str, identifier: str,
                   fractions: Sequence[float] = CAPACITY_FRACTIONS, groups: Sequence[str] = (),
                   few_groups: bool = False) -> DataFrame:
    """Share of positives among the top ``k = max(1, round(n·f))`` rows by score.

    Ties at the cut are taken in id order. Only rows that tie there are looked at
    one by one; all else comes from the counts per distinct score.
    """
    groups = list(groups)
    counts = _by_score(scored, score, label, groups)
    r = running_totals(counts, [-F.col("_s")], {"n": F.col("_n"), "pos": F.col("_pos")}, groups, few_groups)
    names = ("k", "edge", "above", "need", "edge_n", "edge_pos", "all_pos")

    def at(fraction: float) -> list[Column]:
        k = F.greatest(F.lit(1), F.bround(F.col("total_n") * F.lit(fraction), 0)).cast("bigint")
        before = F.col("cum_n") - F.col("_n")
        here = (F.col("cum_n") >= k) & (before < k)
        values = (k, F.col("_s"), F.col("cum_pos") - F.col("_pos"), k - before, F.col("_n"), F.col("_pos"), F.col("total_pos"))
        return [F.max(F.when(here, v)).alias(f"{n}_{fraction}") for n, v in zip(names, values)]

    wide = r.groupBy(*groups).agg(*[c for f in fractions for c in at(f)])
    edges = wide.select(*groups, F.inline(F.array(*[
        F.struct(F.lit(float(f)).alias("k_frac"), *[F.col(f"`{n}_{f}`").alias(n) for n in names]) for f in fractions])))
    if few_groups or not groups:
        # len(fractions) rows a group: found now, so the totals are not worked out twice
        edges = scored.sparkSession.createDataFrame(edges.collect(), edges.schema)
    else:
        edges = durable(edges)
    split = edges.where("need < edge_n").select(*groups, "k_frac", "edge", "need")
    rows = scored.select(*groups, F.col(score).cast("double").alias("_s"), F.col(identifier).alias("_id"),
                         F.col(label).cast("bigint").alias("_y"))
    renamed = split.withColumnsRenamed({g: f"_g_{g}" for g in groups})
    match = F.col("_s") == F.col("edge")
    for g in groups:
        match = match & rows[g].eqNullSafe(renamed[f"_g_{g}"])
    ties = rows.join(renamed, match).select(*groups, "k_frac", "need", "_id", "_y")
    taken = row_numbers(ties, [F.col("_id")], [*groups, "k_frac"], few_groups=few_groups or not groups)
    partial = taken.where(F.col("row_number") <= F.col("need")).groupBy(*groups, "k_frac").agg(
        F.sum("_y").alias("_part"))
    keys = [*groups, "k_frac"]
    out = edges.join(partial.withColumnsRenamed({c: f"_p_{c}" for c in keys}),
                     _all_equal(keys, "_p_"), "left")
    caught = F.col("above") + F.when(F.col("need") == F.col("edge_n"), F.col("edge_pos")).otherwise(
        F.coalesce("_part", F.lit(0)))
    return out.select(*keys, "k", (caught / F.col("k")).alias("precision"),
                      F.when(F.col("all_pos") > 0, caught / F.col("all_pos")).otherwise(0.0).alias("recall"),
                      caught.cast("bigint").alias("breaches_caught"))


def _all_equal(columns: Sequence[str], prefix: str) -> Column:
    match = None
    for c in columns:
        test = F.col(c).eqNullSafe(F.col(prefix + c))
        match = test if match is None else match & test
    return match


def calibration_table(scored: DataFrame, score: str, label: str, bins: int = 10, groups: Sequence[str] = ()) -> DataFrame:
    """Mean prediction, observed rate and rows per score bin; empty bins are absent."""
    step = 1.0 / bins
    out = scored.groupBy(*groups, equal_bin(score, bins).alias("bin")).agg(
        F.avg(score).alias("mean_pred"), F.avg(F.col(label).cast("double")).alias("observed"),
        F.count(F.lit(1)).alias("row_count"))
    return out.withColumn("bin_mid", (F.col("bin") + 0.5) * step)


def _with_givers(df: DataFrame, taken: Sequence[str], identifier: str, repeats: int, seed: int) -> DataFrame:
    """Per ``repeat`` all rows, each with ``_other``: the ``taken`` columns of the row whose
    second random number is its first."""
    rows = df.count()
    copies = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    hashed = lambda salt: F.xxhash64(identifier, "repeat", F.lit(seed + salt))
    placed = hashed_numbers(copies, hashed(0), identifier, rows, ["repeat"], "_at")
    givers = hashed_numbers(copies.select("repeat", identifier, F.struct(*taken).alias("_other")), hashed(1), identifier, rows,
                            ["repeat"], "_at").select("repeat", "_at", "_other")
    return placed.join(givers, ["repeat", "_at"])


def shuffled_features(df: DataFrame, features: Sequence[str], identifier: str, repeats: int,
                      seed: int = 42) -> DataFrame:
    """Copies of the rows with one feature shuffled: per ``feature`` and ``repeat``.

    In each repeat all rows are numbered in two random orders, and a row takes the
    feature of the row whose second number is its first: one permutation of the whole
    table at any size, so every column keeps exactly its values and loses its link to
    the label. Numbers come from ranges of the orders, not from one sort.
    """
    moved = _with_givers(df, features, identifier, repeats, seed)
    versions = [
        F.struct(F.lit(f).alias("feature"), *[(F.col(f"_other.{g}") if g == f else F.col(g)).alias(g) for g in features])
        for f in features]
    rest = [c for c in df.columns if c not in features]
    return moved.select(*rest, "repeat", F.inline(F.array(*versions)))


def permutation_importance(df: DataFrame, predict: Callable[[DataFrame], DataFrame], features: Sequence[str],
                           score: str, label: str, identifier: str, repeats: int = 8, seed: int = 42,
                           parts: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None) -> DataFrame:
    """Mean and deviation of the AUC lost when a feature is shuffled.

    ``parts`` (``BreachModel.parts``) gives what each feature adds to a logistic score;
    rows then exchange these, and a copy's score is a sum, not a run of the pipeline.
    """
    y = F.col(label).cast("int").alias("y")
    base = durable(predict(df).select(F.col(score).cast("double").alias("score"), y))
    ranges = math.ceil(base.count() / ordered.ROWS_PER_RANGE)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(base.approxQuantile("score", shares, 0.1 / ranges))) if shares else []
    if parts is None:
        names = F.create_map(*[F.lit(x) for i, f in enumerate(features) for x in (f, i)])
        scored = predict(shuffled_features(df, features, identifier, repeats, seed)).select(
            F.element_at(names, F.col("feature")).alias("feature"), F.col("repeat"), F.col(score).cast("double").alias("score"), y)
        untouched = base.select(F.lit(ranks.UNTOUCHED).alias("feature"), F.lit(ranks.UNTOUCHED).alias("repeat"), "score", "y")
        counted = scored.unionByName(untouched).mapInArrow(ranks.count_scored(cuts), ranks.COUNTED)
    else:
        own = durable(parts(df, features).select(identifier, y, F.col("_parts").alias("own")))
        pairs = _with_givers(own, ["own"], identifier, repeats, seed).select("repeat", "y", "own", F.col("_other.own").alias("other"))
        untouched = own.select(F.lit(ranks.UNTOUCHED).alias("repeat"), "y", "own", F.col("own").alias("other"))
        counted = pairs.unionByName(untouched).mapInArrow(ranks.count_pairs(cuts), ranks.COUNTED)
    merged = counted.groupBy("feature", "repeat", "range").applyInArrow(ranks.merge_range, ranks.MERGED)
    below = W.partitionBy("feature", "repeat").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    lower = F.coalesce(F.sum(F.col("n") - F.col("pos")).over(below), F.lit(0))
    wins = merged.withColumn("_wins", F.col("twice_wins") + 2 * F.col("pos") * lower).groupBy("feature", "repeat").agg(
        F.sum("_wins").alias("_wins"), F.sum("pos").alias("_p"), F.sum(F.col("n") - F.col("pos")).alias("_q"))
    per_copy = durable(wins.select("feature", "repeat", F.when(
        (F.col("_p") > 0) & (F.col("_q") > 0), F.col("_wins") / 2.0 / (F.col("_p") * F.col("_q"))).alias("roc_auc")))
    whole = per_copy.where(F.col("feature") == ranks.UNTOUCHED).first()
    loss = F.lit(whole["roc_auc"] if whole else None).cast("double") - F.col("roc_auc")
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("feature")).alias("feature")
    return per_copy.where(F.col("feature") != ranks.UNTOUCHED).groupBy(name).agg(
        F.avg(loss).alias("importance"), F.stddev_pop(loss).alias("std"))
