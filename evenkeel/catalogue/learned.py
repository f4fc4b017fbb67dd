"""Features, splits, evaluation and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.catalogue.registry import Tables, query, rounded, shared
from evenkeel.learning import anomalies as a
from evenkeel.learning import evaluation as v
from evenkeel.learning import models as m
from evenkeel.learning.clusters import usage_tiers
from evenkeel.operators.explore import usage_profile
from evenkeel.operators.joins import rate_lookup
from evenkeel.plans import features as f
from evenkeel.plans.marts import rolling_context
from evenkeel.plans.serving import model_comparison
from evenkeel.session import durable, shared_path

CATEGORIES = ["work_type_eng", "work_order_type", "contract_type", "assignment_type", "priority_id_str", "site_id"]
NUMBERS = ["is_subcontractor_work", "is_invoicable", "start_month", "start_weekday", "start_is_weekend", "start_year", "sla_window_hours", "site_open_wo_at_start"]
LABEL = "is_sla_violation"


@query("creation_features", "M1 J4 M3 C28", """
SELECT wo_no, work_started_at_utc, is_sla_violation, work_type_eng, work_order_type, contract_type, coalesce(assignment_type, 'unknown') AS assignment_type,
       coalesce(CAST(priority_id AS VARCHAR), 'unknown') AS priority_id_str, w.site_id, CAST(is_subcontractor_work AS INT) AS is_subcontractor_work,
       CAST(is_invoicable AS INT) AS is_invoicable, CAST(month(work_started_at_utc) AS INTEGER) AS start_month, CAST(isodow(work_started_at_utc) AS INTEGER) AS start_weekday,
       CAST(isodow(work_started_at_utc) >= 6 AS INT) AS start_is_weekend, CAST(year(work_started_at_utc) AS INTEGER) AS start_year,
       round(epoch(sla_required_end_at_utc - sla_required_start_at_utc) / 3600.0, 6) AS sla_window_hours, CAST(d.open_work_orders AS DOUBLE) AS site_open_wo_at_start
FROM work_orders w LEFT JOIN daily d ON d.site_id = w.site_id AND d.signal_date = CAST(work_started_at_utc AS DATE)""", ("work_orders", "daily"))
def _(t: Tables):
    return rounded(f.creation_features(t.work_orders(), t.daily()))


@query("intake_features", "M2 J5", """
SELECT wo_no, work_started_at_utc, w.site_id, contract_type, work_order_type, work_type_eng, CAST(priority_id AS DOUBLE) AS priority_id,
       CAST(month(work_started_at_utc) AS INTEGER) AS month, CAST(isodow(work_started_at_utc) - 1 AS INTEGER) AS day_of_week, CAST(hour(work_started_at_utc) AS INTEGER) AS hour,
       CAST(year(work_started_at_utc) AS INTEGER) AS year, round(epoch(sla_required_end_at_utc - work_started_at_utc) / 86400.0, 6) AS sla_window_days,
       CAST(pm_no IS NOT NULL AS INT) AS has_pm_no, CAST(wo_parent_id IS NOT NULL AS INT) AS has_parent_wo, CAST(sla_required_end_at_utc IS NOT NULL AS INT) AS has_sla_deadline,
       CAST(is_invoicable AS INT) AS is_invoicable, CAST(is_subcontractor_work AS INT) AS is_subcontractor_work, round(r.open_wo_7d_avg, 6) AS site_open_wo_7d_avg,
       r.sla_violations_7d AS site_sla_violations_7d, round(r.alarms_7d_avg, 6) AS site_alarms_7d_avg, r.fire_alarms_7d AS site_fire_alarms_7d, r.incidents_7d AS site_incidents_7d,
       round(r.utilization_7d_avg, 6) AS site_utilization_7d_avg, CAST(is_sla_violation AS INT) AS is_sla_violation
FROM work_orders w LEFT JOIN rolling_ctx r ON r.site_id = w.site_id AND r.as_of_date = CAST(work_started_at_utc AS DATE) - 1""", ("work_orders", "rolling_ctx"))
def _(t: Tables):
    return rounded(f.intake_features(t.work_orders(), rolling_context(t.daily())))


shared("split", """
SELECT *, row_number() OVER (ORDER BY work_started_at_utc, wo_no) <= round_even(0.8 * (SELECT count(*) FROM work_orders), 0) AS is_train FROM work_orders""", "work_orders")


@query("chronological_split", "M4 H8", "SELECT wo_no, is_train FROM split", ("split",))
def _(t: Tables):
    orders = t.read("orders").join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("wo_no"), F.col("o_orderdate").alias("work_started_at_utc"))
    return orders.select("wo_no", f.train_rows(orders, "work_started_at_utc", "wo_no").alias("is_train"))


@query("cutoff_split", "M5", """
SELECT contract_type, count(*) FILTER (WHERE work_started_at_utc < TIMESTAMP '2000-01-01') AS train_rows, count(*) FILTER (WHERE work_started_at_utc >= TIMESTAMP '2000-01-01') AS test_rows
FROM work_orders GROUP BY 1""", ("work_orders",))
def _(t: Tables):
    train, test = f.cutoff_split(t.work_orders(), F.lit("2000-01-01").cast("timestamp_ntz"))
    count = lambda df, n: df.groupBy("contract_type").agg(F.count(F.lit(1)).alias(n))
    return count(train, "train_rows").join(count(test, "test_rows"), "contract_type", "full")


@query("trailing_months_split", "M5", """
SELECT count(*) FILTER (WHERE work_started_at_utc < TIMESTAMP '2000-08-01') AS train_rows, count(*) FILTER (WHERE work_started_at_utc >= TIMESTAMP '2000-08-01') AS test_rows FROM work_orders""", ("work_orders",))
def _(t: Tables):
    train, test = f.trailing_months_split(t.work_orders(), 12, now=F.lit("2001-08-01").cast("date"))
    return train.agg(F.count(F.lit(1)).alias("train_rows")).withColumn("test_rows", test.agg(F.count(F.lit(1))).scalar())


shared("rates", """
SELECT wo_no, is_sla_violation AS y, priority_id AS priority, coalesce(r.rate, (SELECT avg(CAST(is_sla_violation AS INT)) FROM split WHERE is_train)) AS p
FROM split s LEFT JOIN (SELECT priority_id AS k, avg(CAST(is_sla_violation AS INT)) AS rate FROM split WHERE is_train GROUP BY 1) r ON k IS NOT DISTINCT FROM priority_id
WHERE NOT is_train""", "split")


def _split(t: Tables):
    orders = t.work_orders()
    return f.time_split(orders)


@query("priority_rate_baseline", "M10 J9", "SELECT wo_no, round(p, 8) AS p FROM rates", ("rates",))
def _(t: Tables):
    train, test = _split(t)
    labelled = train.withColumn("y", F.col(LABEL).cast("int"))
    return rounded(rate_lookup(labelled, test, "priority_id", "y", "p").select("wo_no", "p"), 8)


@query("majority_baseline", "M10", """
SELECT wo_no, round((SELECT avg(CAST(is_sla_violation AS INT)) FROM split WHERE is_train), 8) AS p FROM split WHERE NOT is_train""", ("split",))
def _(t: Tables):
    train, test = _split(t)
    return rounded(m.majority_rate(train.withColumn("y", F.col(LABEL).cast("int")), test, "y").select("wo_no", "p"), 8)


shared("by_score", """
SELECT breach_probability AS s, count(*) AS n, sum(CAST(is_sla_violation AS INT)) AS pos FROM work_orders GROUP BY 1""", "work_orders")
shared("ranked_scores", """
SELECT *, sum(n) OVER (ORDER BY s) AS cum_n, sum(pos) OVER (ORDER BY s) AS cum_pos, sum(n) OVER () AS all_n, sum(pos) OVER () AS all_pos FROM by_score""", "by_score")
METRIC_SQL = """
SELECT CAST(max(all_n) AS BIGINT) AS row_count, round(sum(pos * ((cum_n - n) - (cum_pos - pos) + (n - pos) / 2.0)) / max(all_pos * (all_n - all_pos)), 6) AS roc_auc,
       round(sum(pos * 1.0 / all_pos * (all_pos - cum_pos + pos) / (all_n - cum_n + n)), 6) AS pr_auc,
       round(2.0 * sum(pos) FILTER (WHERE s >= 0.5) / (2 * sum(pos) FILTER (WHERE s >= 0.5) + sum(n - pos) FILTER (WHERE s >= 0.5) + sum(pos) FILTER (WHERE s < 0.5)), 6) AS f1,
       round(1.0 * sum(pos) FILTER (WHERE s >= 0.5) / sum(n) FILTER (WHERE s >= 0.5), 6) AS precision, round(1.0 * sum(pos) FILTER (WHERE s >= 0.5) / sum(pos), 6) AS recall,
       round(sum(pos * (1 - s) ** 2 + (n - pos) * s ** 2) / max(all_n), 6) AS brier, round(1.0 * sum(pos) / sum(n), 6) AS base_rate,
       CAST(sum(pos) FILTER (WHERE s >= 0.5) AS BIGINT) AS tp, CAST(sum(n - pos) FILTER (WHERE s >= 0.5) AS BIGINT) AS fp,
       CAST(sum(pos) FILTER (WHERE s < 0.5) AS BIGINT) AS fn, CAST(sum(n - pos) FILTER (WHERE s < 0.5) AS BIGINT) AS tn FROM ranked_scores"""


def _labelled(t: Tables):
    return t.work_orders().select("wo_no", "contract_type", "breach_probability", F.col(LABEL).cast("int").alias("y"))


@query("classification_metrics", "M13", METRIC_SQL, ("ranked_scores",))
def _(t: Tables):
    return rounded(v.classification_metrics(_labelled(t), "breach_probability", "y"))


@query("auc_by_contract", "M13", """
SELECT contract_type, round((sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
       / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)), 6) AS roc_auc
FROM (SELECT contract_type, CAST(is_sla_violation AS INT) AS y, rank() OVER (PARTITION BY contract_type ORDER BY breach_probability)
      + (count(*) OVER (PARTITION BY contract_type, breach_probability) - 1) / 2.0 AS r FROM work_orders) GROUP BY 1""", ("work_orders",))
def _(t: Tables):
    out = v.classification_metrics(_labelled(t), "breach_probability", "y", ["contract_type"], few_groups=True)
    return rounded(out.select("contract_type", "roc_auc"))


@query("precision_at_k", "M14 L2", """
SELECT k_frac, k, round(1.0 * caught / k, 6) AS precision, round(1.0 * caught / all_pos, 6) AS recall, caught AS breaches_caught FROM (
  SELECT k_frac, k, count(*) FILTER (WHERE is_sla_violation AND rn <= k) AS caught, count(*) FILTER (WHERE is_sla_violation) AS all_pos FROM (
    SELECT is_sla_violation, row_number() OVER (ORDER BY breach_probability DESC, wo_no) AS rn, count(*) OVER () AS n FROM work_orders)
  JOIN (SELECT CAST(k AS DOUBLE) AS k_frac FROM (VALUES (0.05), (0.1), (0.2), (0.3)) v(k)) ON true, LATERAL (SELECT CAST(greatest(1, round_even(n * k_frac, 0)) AS BIGINT) AS k) GROUP BY 1, 2)""", ("work_orders",))
def _(t: Tables):
    return rounded(v.precision_at_k(_labelled(t), "breach_probability", "y", "wo_no"))


@query("precision_at_k_with_ties", "M14", """
SELECT k_frac, k, round(1.0 * caught / k, 6) AS precision, round(1.0 * caught / all_pos, 6) AS recall, caught AS breaches_caught FROM (
  SELECT k_frac, k, count(*) FILTER (WHERE is_sla_violation AND rn <= k) AS caught, count(*) FILTER (WHERE is_sla_violation) AS all_pos FROM (
    SELECT is_sla_violation, row_number() OVER (ORDER BY round_even(breach_probability, 1) DESC, wo_no) AS rn, count(*) OVER () AS n FROM work_orders)
  JOIN (SELECT CAST(k AS DOUBLE) AS k_frac FROM (VALUES (0.05), (0.1), (0.2), (0.3)) v(k)) ON true, LATERAL (SELECT CAST(greatest(1, round_even(n * k_frac, 0)) AS BIGINT) AS k) GROUP BY 1, 2)""", ("work_orders",))
def _(t: Tables):
    from evenkeel.functions import half_even

    coarse = _labelled(t).withColumn("breach_probability", half_even("breach_probability", 1))
    return rounded(v.precision_at_k(coarse, "breach_probability", "y", "wo_no"))


@query("calibration_table", "M15 C32", """
SELECT CAST(bin AS BIGINT) AS bin, round(CAST((bin + 0.5) * 0.1 AS DOUBLE), 6) AS bin_mid, round(avg(p), 8) AS mean_pred, round(avg(y), 8) AS observed, count(*) AS row_count FROM (
  SELECT breach_probability AS p, CAST(is_sla_violation AS INT) AS y, (p >= 0.1)::INT + (p >= 0.2)::INT + (p >= 0.30000000000000004)::INT + (p >= 0.4)::INT + (p >= 0.5)::INT
       + (p >= 0.6000000000000001)::INT + (p >= 0.7000000000000001)::INT + (p >= 0.8)::INT + (p >= 0.9)::INT AS bin FROM work_orders) GROUP BY bin""", ("work_orders",))
def _(t: Tables):
    out = v.calibration_table(_labelled(t), "breach_probability", "y")
    return rounded(out.withColumn("bin", F.col("bin").cast("bigint")), 8, bin_mid=6)


@query("class_weights", "M8", """
SELECT is_sla_violation, count(*) AS row_count, round((SELECT count(*) FROM work_orders) / (2.0 * count(*)), 8) AS weight FROM work_orders GROUP BY 1""", ("work_orders",))
def _(t: Tables):
    weighted = m.with_class_weights(_labelled(t), "y", "weight")
    out = weighted.groupBy((F.col("y") == 1).alias(LABEL)).agg(F.count(F.lit(1)).alias("row_count"), F.max("weight").alias("weight"))
    return rounded(out, 8)


@query("median_imputed_windows", "M18 M9", """
SELECT wo_no, round(coalesce(epoch(sla_required_end_at_utc - sla_required_start_at_utc) / 3600.0,
  (SELECT quantile_cont(epoch(sla_required_end_at_utc - sla_required_start_at_utc) / 3600.0, 0.5) FROM work_orders)), 6) AS window_h FROM work_orders""", ("work_orders",))
def _(t: Tables):
    from evenkeel.functions import elapsed_hours

    hours = t.work_orders().select("wo_no", elapsed_hours("sla_required_start_at_utc", "sla_required_end_at_utc").alias("window_h"))
    return rounded(m.impute_median(hours, ["window_h"]))


@query("column_variances", "M18", """
SELECT 'l_quantity' AS column_name, round(var_pop(l_quantity), 6) AS variance, true AS kept FROM lineitem
UNION ALL SELECT 'l_discount', round(var_pop(l_discount), 6), true FROM lineitem UNION ALL SELECT 'constant', 0.0, false FROM region WHERE r_regionkey = 0""")
def _(t: Tables):
    items = t.read("lineitem").withColumn("constant", F.lit(1.0))
    return rounded(m.varying_columns(items, ["l_quantity", "l_discount", "constant"]))


@query("site_feature_matrix", "M19 K7", """
SELECT site_id, signal_date, CASE WHEN a_share >= 0.3 THEN CAST(coalesce(open_work_orders, a_med) AS DOUBLE) END AS open_work_orders,
       CASE WHEN e_share >= 0.3 AND e_med IS NOT NULL THEN round(coalesce(electricity_kwh, e_med), 4) END AS electricity_kwh, CAST(incident_count AS DOUBLE) AS incident_count
FROM daily JOIN (SELECT site_id, avg(CAST(open_work_orders IS NOT NULL AS INT)) AS a_share, quantile_cont(open_work_orders, 0.5) AS a_med,
  avg(CAST(electricity_kwh IS NOT NULL AS INT)) AS e_share, quantile_cont(electricity_kwh, 0.5) AS e_med FROM daily GROUP BY 1) USING (site_id)""", ("daily",))
def _(t: Tables):
    return rounded(f.site_feature_matrix(t.daily(), ["open_work_orders", "electricity_kwh", "incident_count"]).drop("usable"), 4)


@query("robust_z_baseline", "M22", """
SELECT site_id, signal_date, round(greatest(abs(open_work_orders - m1) / (1.4826 * CASE WHEN s1 = 0 THEN 1e-6 ELSE s1 END),
       abs(incident_count - m2) / (1.4826 * CASE WHEN s2 = 0 THEN 1e-6 ELSE s2 END)), 4) AS baseline_zscore
FROM (SELECT d.*, m1, m2 FROM daily d JOIN (SELECT site_id, quantile_cont(open_work_orders, 0.5) AS m1, quantile_cont(incident_count, 0.5) AS m2 FROM daily GROUP BY 1) USING (site_id))
JOIN (SELECT site_id, quantile_cont(abs(open_work_orders - m1), 0.5) AS s1, quantile_cont(abs(incident_count - m2), 0.5) AS s2
      FROM daily JOIN (SELECT site_id, quantile_cont(open_work_orders, 0.5) AS m1, quantile_cont(incident_count, 0.5) AS m2 FROM daily GROUP BY 1) USING (site_id) GROUP BY 1) USING (site_id)""", ("daily",))
def _(t: Tables):
    return rounded(a.robust_z(t.daily(), "site_id", ["open_work_orders", "incident_count"]).select("site_id", "signal_date", "baseline_zscore"), 4)


def _anomalies(t: Tables):
    features = ["alarm_count", "open_work_orders", "sla_violations", "incident_count"]
    daily = durable(t.daily().select("site_id", "signal_date", *features))
    scored = a.isolation_forest(daily, "site_id", "signal_date", features)
    baseline = a.robust_z(daily, "site_id", features).select(
        F.col("site_id").alias("_site"), F.col("signal_date").alias("_date"), "baseline_zscore")
    return scored.join(baseline, F.col("site_id").eqNullSafe(F.col("_site")) & F.col("signal_date").eqNullSafe(F.col("_date")),
                       "left").drop("_site", "_date")


@query("isolation_forest", "M21")
def _(t: Tables):
    return _anomalies(t).select("site_id", "signal_date", "anomaly_score", "is_anomaly", "baseline_zscore")


@query("anomaly_metrics", "M23")
def _(t: Tables):
    return a.anomaly_metrics(_anomalies(t), "site_id")


@query("strangest_days", "L5 M21")
def _(t: Tables):
    return a.strangest(_anomalies(t), 10, tiebreak=["site_id", "signal_date"]).select("site_id", "signal_date", "anomaly_score")


@query("usage_tiers", "M24 G20")
def _(t: Tables):
    return usage_tiers(usage_profile(t.room_use(), "asset_name", "utilization_pct"))


def _features(t: Tables):
    data = f.creation_features(t.work_orders(), t.daily()).withColumn(LABEL, F.col(LABEL).cast("int"))
    return f.time_split(durable(data))


@query("boosted_model_metrics", "M7 M6 M13 V7")
def _(t: Tables):
    train, test = _features(t)
    model = m.fit_breach_model(train, "boosted", CATEGORIES, NUMBERS, LABEL, identifier="wo_no")
    scored = m.scored_once(model, test, "p")
    rows = v.classification_metrics(scored, "p", LABEL).withColumn("model", F.lit("boosted"))
    base = v.classification_metrics(m.priority_rate(train, test, LABEL), "p", LABEL).withColumn("model", F.lit("priority rate"))
    return model_comparison(rows.unionByName(base))


@query("forest_importance", "M8 M17 M6")
def _(t: Tables):
    train, _test = _features(t)
    return m.fit_breach_model(train, "forest", CATEGORIES, NUMBERS, LABEL).impurity_importance()


@query("logistic_predictions", "M9 M18")
def _(t: Tables):
    train, test = _features(t)
    model = m.fit_breach_model(train, "logistic", CATEGORIES, NUMBERS, LABEL)
    return model.transform(test).select("wo_no", "site_id", "breach_probability", LABEL)


@query("permutation_importance", "M16")
def _(t: Tables):
    train, test = _features(t)
    model = m.fit_breach_model(train, "logistic", CATEGORIES, NUMBERS, LABEL)
    return v.permutation_importance(test, lambda df: model.transform(df, "p"), [*CATEGORIES, *NUMBERS], "p", LABEL, "wo_no",
                                    parts=model.parts)


@query("segment_models", "M11 M12")
def _(t: Tables):
    data = durable(f.intake_features(t.work_orders(), rolling_context(t.daily())).withColumn(
        "work_started_at_utc", F.col("work_started_at_utc").cast("timestamp")))
    models, _table = m.fit_segments(data, "contract_type", {"KH": "2000-01-01", "KT": "1999-01-01"}, list(f.INTAKE_CATEGORIES),
                                    list(f.INTAKE_NUMBERS), LABEL, "work_started_at_utc", min_frequency=10)
    scored = m.score_routed(data, "contract_type", models)
    return scored.select("wo_no", "contract_type", "risk_prob", "risk_label", "model_used")


SCALED_SQL = """
SELECT l_orderkey, l_linenumber, {columns}
FROM lineitem, (SELECT {facts} FROM lineitem)"""
SCALED = ["l_quantity", "l_discount"]


@query("scaled_features", "M18", SCALED_SQL.format(
    columns=", ".join(f"round(({c} - m_{c}) / CASE WHEN q3_{c} = q1_{c} THEN NULL ELSE q3_{c} - q1_{c} END, 6) AS robust_{c}, "
                      f"round(({c} - a_{c}) / s_{c}, 6) AS standard_{c}" for c in SCALED),
    facts=", ".join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}, "
                    f"avg({c}) AS a_{c}, stddev_samp({c}) AS s_{c}" for c in SCALED)))
def _(t: Tables):
    items = t.read("lineitem").select("l_orderkey", "l_linenumber", *SCALED)
    both = m.standard_scaled(m.robust_scaled(items, SCALED, "robust"), SCALED, "standard")
    return both.select("l_orderkey", "l_linenumber", *[
        F.round(F.col(kind)[i], 6).alias(f"{kind}_{c}") for i, c in enumerate(SCALED) for kind in ("robust", "standard")])


@query("reloaded_model", "S20 M9", """
SELECT count(*) AS orders, CAST(0 AS BIGINT) AS unlike FROM work_orders""", ("work_orders",))
def _(t: Tables):
    """A model that was written and read again gives each order the score it gave before."""
    train, test = _features(t)
    path = shared_path(t.spark, "breach-model")
    fitted = m.fit_breach_model(train, "logistic", CATEGORIES, NUMBERS, LABEL)
    again = m.load_model(m.save_model(fitted, path))
    both = again.transform(fitted.transform(train.unionByName(test), "before"), "after")
    return both.agg(F.count(F.lit(1)).alias("orders"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("unlike"))
