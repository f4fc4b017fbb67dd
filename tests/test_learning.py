"""Metrics against brute force; models learn; anomalies and tiers are found."""

import math
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from evenkeel.learning import anomalies as a
from evenkeel.learning import evaluation as v
from evenkeel.learning import forests
from evenkeel.learning import models as m
from evenkeel.learning.clusters import usage_tiers
from evenkeel.operators import ordered


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(7)
    p = np.round(rng.random(2000), 2)
    y = (rng.random(2000) < p).astype(int)
    rows = [(i, float(p[i]), int(y[i]), "a" if i % 5 else "b") for i in range(2000)]
    return spark.createDataFrame(rows, "id BIGINT, p DOUBLE, y INT, g STRING"), p, y


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return float(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))


def brute_ap(y, p):
    total, seen, hit, out = y.sum(), 0, 0, 0.0
    for s in sorted(set(p), reverse=True):
        here = p == s
        seen, hit = seen + here.sum(), hit + y[here].sum()
        out += y[here].sum() / total * hit / seen
    return float(out)


@pytest.mark.parametrize("rows_per_range", [5, 1_000_000])
def test_rank_metrics(scored, monkeypatch, rows_per_range):
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", rows_per_range)
    df, p, y = scored
    r = v.classification_metrics(df, "p", "y").first()
    assert r.roc_auc == pytest.approx(brute_auc(y, p)) and r.pr_auc == pytest.approx(brute_ap(y, p))
    assert r.brier == pytest.approx(float(((p - y) ** 2).mean())) and r.base_rate == pytest.approx(float(y.mean()))
    yes = p >= 0.5
    assert (r.tp, r.fp, r.fn, r.tn) == (int((yes & (y == 1)).sum()), int((yes & (y == 0)).sum()), int((~yes & (y == 1)).sum()), int((~yes & (y == 0)).sum()))
    groups = {x.g: x.roc_auc for x in v.classification_metrics(df, "p", "y", ["g"], few_groups=True).collect()}
    third = np.arange(2000) % 5 != 0
    assert groups["a"] == pytest.approx(brute_auc(y[third], p[third]))


@pytest.mark.parametrize("few", [True, False])
def test_precision_at_k(scored, few):
    df, p, y = scored
    coarse = np.round(p, 1)
    rows = v.precision_at_k(df.withColumn("p", F.rint(F.col("p") * 10) / 10), "p", "y", "id", groups=["g"], few_groups=few).collect()
    assert len(rows) == 8
    for r in rows:
        mine = np.flatnonzero((np.arange(2000) % 5 != 0) == (r.g == "a"))
        order = sorted(mine, key=lambda i: (-coarse[i], i))
        k = max(1, round(len(mine) * r.k_frac))
        assert r.k == k and r.breaches_caught == int(y[order[:k]].sum())


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 0)], "p DOUBLE, y INT")
    assert v.classification_metrics(df, "p", "y").first().roc_auc is None


def test_calibration_omits_empty_bins(spark):
    df = spark.createDataFrame([(0.05, 0), (0.95, 1), (1.0, 1)], "p DOUBLE, y INT")
    rows = {r.bin: (r.row_count, r.observed) for r in v.calibration_table(df, "p", "y").collect()}
    assert rows == {0: (1, 0.0), 9: (2, 1.0)}


@pytest.mark.parametrize("rows_per_range", [100_000, 50])
def test_shuffling_keeps_each_column_and_the_rest(scored, rows_per_range, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", rows_per_range)
    df = scored[0].withColumn("q", F.when(F.col("id") % 3 != 0, F.col("id")))
    out = v.shuffled_features(df, ["p", "q"], "id", repeats=2)
    assert out.count() == 2000 * 2 * 2
    for feature in ("p", "q"):
        got = out.where((F.col("feature") == feature) & (F.col("repeat") == 1))
        same = got.join(df.select("id", F.col("p").alias("p0"), F.col("q").alias("q0")), "id")
        other = "q" if feature == "p" else "p"
        assert same.where(~F.col(other).eqNullSafe(F.col(f"{other}0"))).count() == 0
        counts = lambda d, c: {r[0]: r[1] for r in d.groupBy(c).count().collect()}
        assert counts(got, feature) == counts(df, feature)
        assert same.where(~F.col(feature).eqNullSafe(F.col(f"{feature}0"))).count() > 1000


@pytest.fixture(scope="module")
def learnable(spark):
    n = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    kind = F.when(n % 4 == 0, "bad").when(n % 50 == 1, "rare").otherwise("good")
    return spark.range(4000).select(
        n.alias("wo_no"), kind.alias("kind"), F.when(n % 7 != 0, noise).alias("x"), (n % 10).cast("double").alias("z"),
        ((F.when(kind == "bad", 0.8).otherwise(0.1) + F.when(noise > 0.7, 0.3).otherwise(0.0)) > F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1000)) / 1000.0)
        .cast("int").alias("y"), F.when(n % 2 == 0, "KH").when(n % 3 == 0, "KT").otherwise("SP").alias("contract"),
        F.timestamp_seconds(n * 86400).alias("at"))


@pytest.mark.parametrize("kind", ["boosted", "forest", "logistic"])
def test_models_beat_the_base_rate(learnable, kind):
    train, test = learnable.where("wo_no < 3000"), learnable.where("wo_no >= 3000")
    model = m.fit_breach_model(train, kind, ["kind"], ["x", "z"], "y", trees=15, depth=4, identifier="wo_no")
    out = model.transform(test, "p")
    assert out.count() == 1000 and out.where("p < 0 OR p > 1 OR p IS NULL").count() == 0
    assert v.classification_metrics(out, "p", "y").first().roc_auc > 0.75
    unseen = model.transform(test.withColumn("kind", F.lit("never seen")), "p")
    assert unseen.where("p IS NULL").count() == 0
    if kind != "logistic":
        assert model.impurity_importance().first()["feature"].startswith("kind=")


@pytest.mark.parametrize("kind", ["forest", "logistic"])
def test_models_score_in_a_session_that_has_observed(spark, learnable, kind):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    model = m.fit_breach_model(learnable, kind, ["kind"], ["x", "z"], "y", trees=3, depth=2)
    assert seen.get["n"] == 3 and model.transform(learnable, "p").where("p IS NULL").count() == 0


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_trees_are_fitted_in_as_many_tasks_as_cores(spark, learnable, kind, monkeypatch):
    tasks, cut = [], m.durable
    monkeypatch.setattr(m, "durable", lambda df: tasks.append(df.rdd.getNumPartitions()) or cut(df))
    model = m.fit_breach_model(learnable.repartition(40), kind, ["kind"], ["x", "z"], "y", trees=2, depth=2)
    assert tasks == [spark.sparkContext.defaultParallelism]
    assert kind == "boosted" or model.pipeline.stages[-1].getCacheNodeIds()


def test_forest_takes_no_pass_a_level(spark, learnable):
    context = spark.sparkContext

    def jobs(depth):
        context.setJobGroup(f"depth {depth}", "fit")
        m.fit_breach_model(learnable, "forest", ["kind"], ["x", "z"], "y", trees=3, depth=depth)
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(f"depth {depth}"))

    assert jobs(10) == jobs(1)


def test_forest_is_the_same_by_passes_and_like_sparks(spark, learnable, monkeypatch):
    seen, fit = [], m.fit_forest
    monkeypatch.setattr(m, "fit_forest", lambda values, estimator, *rest: seen.append((values, estimator)) or fit(values, estimator, *rest))
    grow = lambda: m.fit_breach_model(learnable, "forest", ["kind"], ["x", "z"], "y", trees=40, depth=6).pipeline.stages[-1]
    local = grow()
    # nodes of over 100 draws are split by passes, two rows of counts at a time; counts are weighed a few nodes at once
    for name, value in (("LOCAL_ROWS", 100), ("NODES_PER_GROUP", 2), ("COUNTS_AT_ONCE", 150)):
        monkeypatch.setattr(forests, name, value)
    nodes = lambda forest: forest.toDebugString.split("\n", 1)[1]
    assert nodes(grow()) == nodes(local) and local.totalNumNodes > 400
    values, estimator = seen[0]
    known = sorted(r[0] for r in values.select(F.col("_values")[0]).distinct().collect())
    slots = F.array(*[(F.col("_values")[0] == k).cast("double") for k in known], F.lit(0.0), F.col("_values")[1], F.col("_values")[2])
    theirs = estimator.fit(values.select("_label", "_weight", forests.array_to_vector(slots).alias("_features")))
    # which of two levels that say the same is drawn is chance: levels count together
    weights = lambda forest: np.add.reduceat(forest.featureImportances.toArray(), [0, len(known) + 1, len(known) + 2])
    assert np.allclose(weights(local), weights(theirs), atol=0.03)
    assert 0.8 < local.totalNumNodes / theirs.totalNumNodes < 1.25


def test_forest_scores_in_batches_what_its_pipeline_scores(learnable):
    model = m.fit_breach_model(learnable.where("wo_no < 3000"), "forest", ["kind"], ["x", "z"], "y", trees=20, depth=8)
    rows = learnable.withColumn("kind", F.when(F.col("wo_no") % 11 == 0, "never seen").otherwise(F.col("kind"))).repartition(3)
    scores = lambda one: {r.wo_no: r.p for r in one.transform(rows, "p").collect()}
    mine = scores(model)
    model.scorer, batched = None, model.scorer
    assert batched is not None and scores(model) == mine and len(set(mine.values())) > 50


def test_wide_categories_and_one_class(spark):
    df = spark.range(12000).select((F.col("id") % 400).cast("string").alias("k"), F.lit(None).cast("string").alias("none"),
                                  (F.col("id") % 3).cast("double").alias("x"), (F.col("id") % 400 == 7).cast("int").alias("y"), F.lit(1).alias("one"))
    model = m.fit_breach_model(df, "forest", ["k", "none"], ["x"], "y", min_frequency=2, trees=30, depth=5)
    assert model.impurity_importance(1).first()["feature"] == "k=7"
    alone = m.fit_breach_model(df, "forest", ["none"], ["x"], "one", trees=2, depth=3)
    assert {r.breach_probability for r in alone.transform(df).select("breach_probability").distinct().collect()} == {1.0}


def test_boosted_features_take_three_passes_and_none_is_constant(spark, learnable, monkeypatch):
    """Counts, medians, features; labels and constant slots follow from the counts."""
    read, seen, cut = spark.sparkContext.accumulator(0), [], m.durable

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def counted_cut(df):
        out = cut(df)
        seen.append((read.value, df))
        return out

    df = cut(learnable.withColumns({"same": F.lit("s"), "one": F.lit(1.0), "none": F.lit(None).cast("double")}))
    monkeypatch.setattr(m, "durable", counted_cut)
    model = m.fit_breach_model(df.mapInArrow(counting, df.schema), "boosted", ["kind", "same"], ["x", "z", "one", "none"], "y",
                               min_frequency=100, trees=2, depth=2, identifier="wo_no")
    [(rows, features)] = seen
    assert rows == 3 * 4000
    assert model.options["names"] == ["kind=_rare_", "kind=bad", "kind=good", "x", "z", "x missing"]
    found = np.array([r._features.toArray() for r in features.collect()])
    assert found.shape == (4000, 6) and (found.var(axis=0) > 0).all()
    unseen = model.transform(df.limit(5).withColumns({"same": F.lit("other"), "x": F.lit(math.nan)}), "p")
    assert unseen.where("p BETWEEN 0 AND 1").count() == 5


def test_permutation_importance_finds_the_signal(learnable):
    train, test = learnable.where("wo_no < 3000"), learnable.where("wo_no >= 3000")
    model = m.fit_breach_model(train, "logistic", ["kind"], ["x", "z"], "y", trees=30)
    rows = {r.feature: r.importance for r in v.permutation_importance(
        test, lambda d: model.transform(d, "p"), ["kind", "x", "z"], "p", "y", "wo_no", repeats=3).collect()}
    assert rows["kind"] > 0.1 > abs(rows["z"])


def test_importance_by_parts_equals_brute_force(learnable, monkeypatch):
    """Every copy's AUC from its rows; ranges of 50 rows; what a feature adds, or the whole pipeline."""
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", 50)
    train, test = learnable.where("wo_no < 3000"), learnable.where("wo_no >= 3700")
    model = m.fit_breach_model(train, "logistic", ["kind"], ["x", "z"], "y", trees=30)
    features, predict = ["kind", "x", "z"], lambda d: model.transform(d, "p")
    scores = {r.wo_no: (r.p, r.s) for r in predict(model.parts(test, features)).select(
        "wo_no", "p", F.expr("1 / (1 + exp(-aggregate(_parts, 0D, (a, b) -> a + b)))").alias("s")).collect()}
    assert all(math.isclose(p, s, rel_tol=1e-9) for p, s in scores.values())
    auc = lambda rows: brute_auc(np.array([r.y for r in rows]), np.array([r.p for r in rows]))
    base, lost = auc(predict(test).collect()), {}
    copies = predict(v.shuffled_features(test, features, "wo_no", 2)).collect()
    for f in features:
        lost[f] = [base - auc([r for r in copies if (r.feature, r.repeat) == (f, i)]) for i in range(2)]
    for parts in (model.parts, None):
        got = v.permutation_importance(test, predict, features, "p", "y", "wo_no", repeats=2, parts=parts).collect()
        assert {r.feature: r.importance for r in got} == pytest.approx({f: np.mean(x) for f, x in lost.items()}, abs=1e-9)
        assert {r.feature: r.std for r in got} == pytest.approx({f: np.std(x) for f, x in lost.items()}, abs=1e-9)


def test_rare_levels_fold(learnable):
    kept = m.kept_levels(learnable, ["kind"], 100)
    assert kept == {"kind": ["bad", "good"]}


def test_segments_and_routing(learnable):
    models, table = m.fit_segments(learnable, "contract", {"KH": "1978-01-01", "KT": "1978-01-01"}, ["kind"], ["x", "z"], "y", "at",
                                   trees=5, depth=3, min_frequency=10)
    assert set(models) == {"KH", "KT"} and table.count() == 4
    out = m.score_routed(learnable, "contract", models)
    assert out.count() == 4000
    assert {r.risk_label for r in out.where("contract = 'SP'").select("risk_label").distinct().collect()} == {"no model"}
    assert out.where("contract <> 'SP' AND risk_prob IS NULL").count() == 0


def test_isolation_forest_finds_planted_days(spark):
    rng = np.random.default_rng(1)
    rows = [(site, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(v1), float(v2), None)
            for site in ("a", "b") for i, (v1, v2) in enumerate(rng.normal(size=(400, 2)))]
    rows += [("b", dt.date(2022, 1, 1), None, 0.1, None), ("a", dt.date(2022, 1, 1), 9.0, -9.0, None), ("tiny", dt.date(2022, 1, 1), 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "site STRING, day DATE, x DOUBLE, y DOUBLE, z DOUBLE")
    out = a.isolation_forest(df, "site", "day", ["x", "y", "z"], trees=60)
    tiny = out.where("site = 'tiny'").first()
    assert tiny.anomaly_score is None and not tiny.is_anomaly and "30 rows" in tiny.reason
    assert out.where("site = 'b' AND anomaly_score IS NULL").count() == 0  # its gaps are filled
    rows = out.where("site <> 'tiny'").collect()
    assert len(rows) == 802 and all(-1 <= r.anomaly_score <= 0 for r in rows)
    worst = min(rows, key=lambda r: r.anomaly_score)
    assert (worst.site, worst.day) == ("a", dt.date(2022, 1, 1)) and worst.is_anomaly
    assert 0.03 < sum(r.is_anomaly for r in rows) / len(rows) < 0.07


def test_rows_without_a_site_are_named(spark):
    df = spark.range(100).select(F.when(F.col("id") < 96, F.lit("s")).alias("site"), "id", F.sin("id").alias("x"))
    out = a.isolation_forest(df, "site", "id", ["x"], trees=10)
    nowhere = out.where("site IS NULL").collect()
    assert out.count() == 100 and sorted(r.id for r in nowhere) == [96, 97, 98, 99]
    assert all(r.anomaly_score is None and r.is_anomaly is False and r.reason == "no site" for r in nowhere)
    assert all(r.site == "s" for r in a.strangest(out, 5, tiebreak=["id"]).collect())


def test_isolation_forest_is_repeatable(spark):
    df = spark.range(200).select(F.lit("s").alias("site"), "id", F.sin("id").alias("x"))
    run = lambda d: sorted((r.id, r.anomaly_score) for r in a.isolation_forest(d, "site", "id", ["x"], trees=20).collect())
    assert run(df) == run(df.repartition(5))


def test_robust_z(spark):
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "site STRING, d INT, x DOUBLE")
    z = {r.d: r.baseline_zscore for r in a.robust_z(df, "site", ["x"]).collect()}
    assert z[4] == pytest.approx(97 / 1.4826) and z[2] == 0.0


def test_usage_tiers(spark):
    rows = [(f"{tier}{i}", base + i, 3.0 + i / 10, zero, high) for tier, base, zero, high in
            (("low", 2.0, 0.8, 0.0), ("mid", 40.0, 0.1, 0.2), ("top", 85.0, 0.0, 0.9)) for i in range(6)]
    df = spark.createDataFrame(rows, "room STRING, mean_pct DOUBLE, std_pct DOUBLE, zero_day_frac DOUBLE, high_day_frac DOUBLE")
    got = {r.room[:3]: r.usage_tier for r in usage_tiers(df, restarts=3).collect()}
    assert got == {"low": "light", "mid": "medium", "top": "heavy"}


def test_usage_tiers_work_out_profiles_once_in_few_tasks(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        reads.add(1)
        return x

    rows = spark.range(300).repartition(40).select("id", (F.col("id") % 3 * 40.0 + F.rand(1)).alias("x"))
    profiles = rows.select("id", counted("x").alias("mean_pct"), *[F.lit(0.5).alias(c) for c in ("std_pct", "zero_day_frac", "high_day_frac")])
    out = usage_tiers(profiles, restarts=2)
    assert out.rdd.getNumPartitions() == 1
    got = {(r.id % 3, r.usage_tier) for r in out.collect()}
    assert got == {(0, "light"), (1, "medium"), (2, "heavy")} and reads.value == 300


def test_depths_equal_walking_each_tree():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 3)), 1)
    trees = np.repeat(np.arange(6), 50)
    on, at, child, depth_at = a._grow(x, trees, 6, np.random.default_rng(1))

    def walk(row, node):
        while on[node] >= 0:
            node = child[node] + (row[on[node]] >= at[node])
        return depth_at[node]

    assert np.allclose(a._depths(x, 6, on, at, child, depth_at), [sum(walk(row, t) for t in range(6)) for row in x])
    for t in range(6):  # a leaf's rows: as many as its depth says, by the mean path of what is left
        leaves = {}
        for row in x[trees == t]:
            node, depth = t, 0
            while on[node] >= 0:
                node, depth = child[node] + (row[on[node]] >= at[node]), depth + 1
            leaves.setdefault(node, []).append(depth)
        assert sum(map(len, leaves.values())) == 50
        for node, depths in leaves.items():
            assert math.isclose(depth_at[node], depths[0] + float(a.mean_path(len(depths))))


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(s, i, float(i % 17) + (50 if i == 5 else 0)) for s in "ab" for i in range(150)], "site string, id bigint, x double")
    run = lambda: sorted((r.site, r.id, r.anomaly_score) for r in a.isolation_forest(df, "site", "id", ["x"], trees=25).collect())
    whole = run()
    monkeypatch.setattr(a, "ROWS_PER_BLOCK", 20)
    assert run() == whole and len(whole) == 300


def test_saved_model_scores_the_same(spark, tmp_path):
    df = spark.range(600).select(
        F.col("id"), F.concat(F.lit("k"), (F.col("id") % 4).cast("string")).alias("kind"), (F.col("id") % 37).cast("double").alias("x"),
        ((F.col("id") % 37) > 18).cast("int").alias("y"))
    for kind in ("logistic", "forest"):
        model = m.fit_breach_model(df, kind, ["kind"], ["x"], "y", trees=8)
        again = m.load_model(m.save_model(model, str(tmp_path / kind)))
        scores = lambda one: {r.id: r.breach_probability for r in one.transform(df).collect()}
        assert scores(model) == scores(again) and again.kept == model.kept


def test_robust_scaling_is_exact(spark):
    values = [(i, float((i * 37) % 101), 5.0, None if i == 3 else 1.0 * i) for i in range(200)]
    df = spark.createDataFrame(values, "id bigint, a double, flat double, c double")
    got = {r.id: r["s"] for r in m.robust_scaled(df, ["a", "flat", "c"], "s").collect()}
    kept = np.array([v[1:] for v in values if v[3] is not None], float)
    q1, q2, q3 = np.percentile(kept, [25, 50, 75], axis=0)
    want = (kept - q2) / np.where(q3 > q1, q3 - q1, 1.0)
    assert 3 not in got and np.allclose([got[v[0]] for v in values if v[3] is not None], want)
