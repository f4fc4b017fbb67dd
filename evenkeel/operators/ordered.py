"""Exact order statistics without putting a large group into one task.

A window ordered over a whole table, or over a group that holds a third of it,
runs in one task. The order is therefore cut into ranges: a deterministic sample
of the keys gives the cut points, every row gets the number of its range, range
totals become offsets, and the running sum is taken inside each range. A range
holds about ``ROWS_PER_RANGE`` rows at every size, so their number grows with the
group and a small group is one range. The answer does not depend on which cut
points were drawn, only the balance does.

Keys must come out the same whenever a task is re-run. A key computed from a
floating-point sum over a shuffle is not; pass such input through
``session.durable`` first.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ROWS_PER_RANGE = 200_000  # one task sorts this many rows at ease


def _beside(left: DataFrame, right: DataFrame, on: list[str], small: bool) -> DataFrame:
    """Put the columns ``right`` holds per key next to ``left``; nulls match nulls."""
    if not on:
        # a single row: a scalar subquery, no join
        return left.withColumns({c: right.select(c).scalar() for c in right.columns})
    right = F.broadcast(right) if small else right
    names = [f"_r_{c}" for c in on]
    renamed = right.select(*[F.col(c).alias(n) for c, n in zip(on, names)],
                           *[c for c in right.columns if c not in on])
    match = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[n]) for c, n in zip(on, names)])
    return left.join(renamed, match, "left").drop(*names)


def _with_group_value(left: DataFrame, right: DataFrame, keys: list[str], name: str, few: bool) -> DataFrame:
    """One value per group beside the rows. For few groups it is a lookup in one
    constant map, so that an array is not copied into every row by a join."""
    if keys and few:
        entries = F.collect_list(F.struct(F.struct(*keys).alias("key"), F.col(name).alias("value")))
        table = right.agg(F.map_from_entries(entries).alias("_map")).scalar()
        return left.withColumn(name, F.element_at(table, F.struct(*keys)))
    return _beside(left, right.select(*keys, name), keys, False)


def _cuts_below(cuts: str, key: str) -> Column:
    """How many of the sorted cut points lie below the key, by bisection."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        below = F.get(cuts, middle) < F.col(key)
        return F.when(at["lo"] >= at["hi"], at).when(below, F.struct((middle + 1).alias("lo"), at["hi"].alias("hi"))).otherwise(
            F.struct(at["lo"].alias("lo"), middle.alias("hi")))

    whole = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    return F.when(F.coalesce(F.size(cuts), F.lit(0)) > 0, F.aggregate(steps, whole, halve)["lo"]).otherwise(F.lit(0))


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    measures: Mapping[str, Column],
    groups: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """Add ``cum_<m>`` (sum up to and including the row) and ``total_<m>``.

    ``order`` is ascending (negate a number to sort it downwards) and must be
    unique within a group. Set ``few_groups`` when the number of groups is bounded
    by the caller (a fixed list of labels), which lets what is known per group
    travel as a constant; otherwise the joins are left to adaptive execution,
    which splits a skewed side.
    """
    keys = list(groups)
    small = few_groups or not groups
    key = order[0] if len(order) == 1 else F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    base = df.withColumns({"_key": key, **{f"_m_{m}": c for m, c in measures.items()}})
    scratch = ["_key", *[f"_m_{m}" for m in measures]]

    group = W.partitionBy(*keys)
    # one key in so many becomes a cut point; a small group has none, so one range
    cuts = base.where(F.pmod(F.xxhash64("_key"), F.lit(ROWS_PER_RANGE)) == 0).groupBy(*keys).agg(
        F.sort_array(F.collect_list("_key")).alias("_cuts"))
    ranged = _with_group_value(base, cuts, keys, "_cuts", small)
    ranged = ranged.withColumn("_range", _cuts_below("_cuts", "_key")).drop("_cuts")

    sums = ranged.groupBy(*keys, "_range").agg(*[F.sum(f"_m_{m}").alias(f"_s_{m}") for m in measures])
    before = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        *keys, "_range",
        *[F.coalesce(F.sum(f"_s_{m}").over(before), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(group).alias(f"total_{m}") for m in measures],
    )
    local = W.partitionBy(*keys, "_range").orderBy("_key").rowsBetween(W.unboundedPreceding, 0)
    out = _beside(ranged, offsets, [*keys, "_range"], small)
    out = out.withColumns({f"cum_{m}": F.col(f"_o_{m}") + F.sum(f"_m_{m}").over(local) for m in measures})
    return out.drop("_range", *scratch, *[f"_o_{m}" for m in measures])


def row_numbers(df: DataFrame, order: Sequence[Column], groups: Sequence[str] = (),
                name: str = "row_number", few_groups: bool = False) -> DataFrame:
    """Position of each row (from 1) in a unique order, globally or per group."""
    numbered = running_totals(df, order, {"rows": F.lit(1).cast("bigint")}, groups, few_groups)
    return numbered.withColumnRenamed("cum_rows", name).drop("total_rows")


def hashed_numbers(df: DataFrame, hashed: Column, identifier: str, rows: int, groups: Sequence[str],
                   name: str = "row_number") -> DataFrame:
    """``row_numbers`` in the order of (``hashed``, ``identifier``), a 64-bit hash first.

    Hashes are even over their whole reach, so their upper bits are the ranges: no cut
    points. ``rows`` is about how many rows a group has.
    """
    keys, bits = list(groups), max(0, math.ceil(math.log2(max(rows, 1) / ROWS_PER_RANGE)))
    # an arithmetic shift: ranges keep the order of signed hashes
    placed = df.withColumn("_hash", hashed).withColumn("_range", F.shiftright("_hash", 64 - bits) if bits else F.lit(0).cast("bigint"))
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = W.partitionBy(*keys, "_range").orderBy("_hash", identifier)
    numbered = placed.withColumn(name, F.row_number().over(local).cast("bigint"))
    out = numbered.join(F.broadcast(offsets), [*keys, "_range"])
    return out.withColumn(name, F.col(name) + F.col("_before")).drop("_hash", "_range", "_before")


def exact_quantiles(df: DataFrame, value: str, fractions: Mapping[str, float],
                    groups: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """Linearly interpolated quantiles, one named column each, one row a group.

    Equal to ``percentile`` but its buffer is not one group's distinct values: the
    values are counted first, and only counts travel on.
    """
    keys = list(groups)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    ranked = running_totals(counts, [F.col("_value")], {"rows": F.col("_rows")}, keys, few_groups)
    picks = []
    for name, fraction in fractions.items():
        position = (F.col("total_rows") - 1) * F.lit(float(fraction))
        low, high = F.floor(position), F.ceil(position)
        holds = lambda rank: (F.col("cum_rows") > rank) & (F.col("cum_rows") - F.col("_rows") <= rank)
        picks += [
            F.max(F.when(holds(low), F.col("_value"))).alias(f"_lo_{name}"),
            F.max(F.when(holds(high), F.col("_value"))).alias(f"_hi_{name}"),
            F.max(position - low).alias(f"_w_{name}"),
        ]
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(*keys, *[
        (F.col(f"_lo_{n}") + F.col(f"_w_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
        for n in fractions
    ])


def cut_at_rank(df: DataFrame, order: str, identifier: str, rank: Column) -> Column:
    """Condition true for the first ``rank`` rows by (``order``, ``identifier``).

    ``rank`` may use ``total_rows``. Order values are counted first, so a value
    shared by a third of the rows is one row, and only rows that tie at the cut are
    numbered by identifier. Two values come to the driver; the condition is made of
    literals, so the table is neither joined nor shuffled and scans push it down.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    counts = df.groupBy(order).agg(F.count(F.lit(1)).alias("_rows"))
    ranked = running_totals(counts, [F.col(order)], {"rows": F.col("_rows")})
    before = F.col("cum_rows") - F.col("_rows")
    edge = ranked.where((F.col("cum_rows") >= rank) & (before < rank)).select(
        order, (rank - before).cast("bigint").alias("_need")).first()
    if edge is None:
        return F.lit(False)
    at = F.lit(edge[order]).cast(types[order])
    ties = row_numbers(df.where(F.col(order) == at).select(identifier), [F.col(identifier)])
    last = F.lit(ties.where(F.col("row_number") == edge["_need"]).first()[identifier]).cast(types[identifier])
    return (F.col(order) < at) | ((F.col(order) == at) & (F.col(identifier) <= last))
