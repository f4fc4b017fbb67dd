"""Order statistics against brute force, with ranges forced to be many and a hot group."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.operators import ordered as o


@pytest.fixture(params=[(3, 4), (50, 64), (1_000_000, 64)], ids=["tiny ranges", "some ranges", "one range"])
def ranges(request, monkeypatch):
    monkeypatch.setattr(o, "ROWS_PER_RANGE", request.param[0])


@pytest.fixture(scope="module")
def skewed(spark):
    """Three groups, one with 80 % of the rows; values repeat; some are null."""
    n = F.col("id")
    group = F.when(n % 10 < 8, "hot").when(n % 10 == 8, "warm")
    value = F.when(n % 97 != 0, F.pmod(F.xxhash64("id"), F.lit(211)) / 7.0)
    return spark.range(3000).select("id", group.alias("g"), value.alias("v"))


@pytest.mark.parametrize("groups,few", [([], False), (["g"], True), (["g"], False)])
def test_row_numbers(skewed, ranges, groups, few):
    rows = skewed.where("v IS NOT NULL")
    got = o.row_numbers(rows, [-F.col("v"), F.col("id")], groups, few_groups=few)
    want = F.row_number().over(W.partitionBy(*groups).orderBy(F.desc("v"), "id"))
    both = got.withColumn("want", want)
    assert both.count() == rows.count() and both.where("want <> row_number").count() == 0


@pytest.mark.parametrize("groups,few", [([], False), (["g"], True), (["g"], False)])
def test_running_totals(skewed, ranges, groups, few):
    got = o.running_totals(skewed, [F.col("id")], {"n": F.lit(1), "s": F.col("id")}, groups, few)
    spec = W.partitionBy(*groups).orderBy("id")
    both = got.withColumns({"a": F.sum("id").over(spec), "b": F.sum("id").over(W.partitionBy(*groups))})
    assert both.where("a <> cum_s OR b <> total_s").count() == 0


@pytest.mark.parametrize("groups,few", [([], False), (["g"], True), (["g"], False)])
def test_exact_quantiles(skewed, ranges, groups, few):
    fractions = {"q0": 0.0, "q05": 0.05, "q50": 0.5, "q95": 0.95, "q1": 1.0}
    got = o.exact_quantiles(skewed, "v", fractions, groups, few)
    want = skewed.groupBy(*groups).agg(*[F.percentile("v", F.lit(f)).alias(n) for n, f in fractions.items()])
    rounded = lambda df: sorted(tuple(str(r[g]) for g in groups) + tuple(round(r[n], 9) for n in fractions) for r in df.collect())
    assert rounded(got) == rounded(want)


@pytest.mark.parametrize("keep", [1, 7, 1500, 2969])
def test_cut_at_rank(skewed, ranges, keep):
    rows = skewed.where("v IS NOT NULL")
    want = {r.id for r in rows.orderBy("v", "id").limit(keep).collect()}
    first = o.cut_at_rank(rows, "v", "id", F.lit(keep))
    assert {r.id for r in rows.where(first).collect()} == want


def test_a_large_group_is_sorted_in_ranges(spark, skewed, monkeypatch):
    """Rows are sorted inside ranges; only range totals meet in one place."""
    monkeypatch.setattr(o, "ROWS_PER_RANGE", 100)
    plan = o.row_numbers(skewed, [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_range" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
