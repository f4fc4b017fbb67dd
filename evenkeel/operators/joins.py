"""Crosswalk, context, link and lookup joins.

No side is broadcast by hint unless it is one row per item of a fixed list:
Spark broadcasts a side it knows to be small, adaptive execution does so at run
time from measured sizes, and beyond that splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAPPED, UNMAPPED = "mapped", "unmapped"


def map_to_site(df: DataFrame, crosswalk: DataFrame, on: Sequence[str] | Mapping[str, str],
                site: str = "site_id") -> DataFrame:
    """Left join to a crosswalk; rows without a match stay, with a null site.

    ``on`` is the shared key columns, or ``{left column: crosswalk column}``.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    renamed = {right: f"_x_{right}" for right in pairs.values()}
    keys = crosswalk.select(*[F.col(r).alias(n) for r, n in renamed.items()], F.col(site).alias("_site"))
    match = reduce(lambda a, b: a & b, [df[left] == keys[renamed[right]] for left, right in pairs.items()])
    joined = df.drop(site).join(keys, match, "left").drop(*renamed.values())
    return joined.withColumnRenamed("_site", site).withColumn("mapping_status", mapping_status(site))


def mapping_status(site: str = "site_id") -> Column:
    return F.when(F.col(site).isNotNull(), MAPPED).otherwise(UNMAPPED)


def full_outer(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of partial aggregates, keys coalesced."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), parts)


def key_spine(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys of several tables; each is made distinct before the union."""
    return reduce(lambda a, b: a.unionByName(b), [p.select(*keys).distinct() for p in parts]).distinct()


def spine_with_parts(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    spine = key_spine(parts, keys)
    return reduce(lambda a, b: a.join(b, list(keys), "left"), parts, spine)


def fused_parts(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """What ``spine_with_parts`` gives, from one union and one aggregation.

    Holds when each part has one row a key: every column then has at most one
    value a key, and ``max`` picks it.
    """
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.groupBy(*keys).agg(*[F.max(c).alias(c) for c in union.columns if c not in keys])


def day_context(df: DataFrame, daily: DataFrame, timestamp: str, columns: Mapping[str, str],
                site: str = "site_id", date: str = "signal_date", lag_days: int = 0) -> DataFrame:
    """Add a site's daily values of the start day, or of ``lag_days`` before it.

    ``columns`` is ``{new name: daily column}``. A lag of one keeps what happens on
    the day itself, the order included, out of the features.
    """
    side = daily.select(F.col(site).alias("_site"), F.col(date).alias("_day"),
                        *[F.col(c).alias(n) for n, c in columns.items()])
    day = F.date_sub(F.to_date(timestamp), lag_days)
    return df.join(side, (df[site] == side["_site"]) & (day == side["_day"]), "left").drop("_site", "_day")


def as_of_context(df: DataFrame, daily: DataFrame, timestamp: str, columns: Mapping[str, str],
                  site: str = "site_id", date: str = "signal_date") -> DataFrame:
    """Like ``day_context`` with a lag of one, but reaching back to the last day on record.

    The days that ``df`` asks about are counted down to one row a site and day first and
    stand among the daily rows; each takes the last daily row at or before it. The
    window thus runs over days, never over the rows of ``df``, however many one site has.
    ``daily`` has one row a site and day. A null site or start finds nothing.
    """
    from pyspark.sql import Window as W

    day = F.date_sub(F.to_date(timestamp), 1)
    known = daily.select(F.col(site).alias("_site"), F.col(date).alias("_day"),
                         F.struct(*[F.col(c).alias(n) for n, c in columns.items()]).alias("_values"))
    asked = df.select(F.col(site).alias("_site"), day.alias("_day")).dropna().distinct()
    so_far = W.partitionBy("_site").orderBy("_day").rangeBetween(W.unboundedPreceding, W.currentRow)
    both = known.withColumn("_asked", F.lit(False)).unionByName(
        asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    found = both.withColumn("_last", F.last("_values", ignorenulls=True).over(so_far)).where("_asked").select(
        "_site", "_day", "_last")
    return df.join(found, (df[site] == found["_site"]) & (day == found["_day"]), "left").select(
        *[df[c] for c in df.columns], *[F.col(f"_last.{n}").alias(n) for n in columns])


def orphans(df: DataFrame, key: str, reference: DataFrame, reference_key: str) -> DataFrame:
    """Rows whose non-null foreign key has no match."""
    known = reference.select(F.col(reference_key).alias("_known"))
    return df.where(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_known"), "left_anti")


def rate_lookup(train: DataFrame, test: DataFrame, level: str, label: str, name: str) -> DataFrame:
    """Score test rows by the training rate of their level, else the overall rate."""
    y = F.col(label).cast("double")
    rates = train.groupBy(F.col(level).alias("_level")).agg(F.avg(y).alias("_rate"))
    overall = train.agg(F.avg(y)).scalar()
    joined = test.join(rates, test[level].eqNullSafe(rates["_level"]), "left")
    return joined.withColumn(name, F.coalesce("_rate", overall)).drop("_level", "_rate")


def link_rate(df: DataFrame, key: str, target: DataFrame, target_key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, rows with a link key, rows whose key matches, and the two rates."""
    known = target.select(F.col(target_key).alias("_target")).distinct()
    # null keys match nothing: kept out of the join, they do not all go to one task
    keyed = df.where(F.col(key).isNotNull())
    linked = keyed.join(known, keyed[key] == known["_target"], "left").unionByName(
        df.where(F.col(key).isNull()), allowMissingColumns=True)
    return linked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(key).alias("keyed"),
        F.count("_target").alias("matched"),
        F.avg(F.col(key).isNotNull().cast("double")).alias("keyed_rate"),
        F.avg(F.col("_target").isNotNull().cast("double")).alias("matched_rate"),
    )


def with_labels(df: DataFrame, dimension: DataFrame, key: str, label: str) -> DataFrame:
    """Display names from a dimension table; a key without one labels itself."""
    side = dimension.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    return df.join(side, df[key] == side["_key"], "left").withColumn(
        label, F.coalesce("_label", F.col(key).cast("string"))).drop("_key", "_label")


def relaxed_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns of unlike type meet in double, else in string."""
    types: dict[str, list[T.DataType]] = {}
    for part in parts:
        for field in part.schema.fields:
            types.setdefault(field.name, []).append(field.dataType)

    def common(kinds: list[T.DataType]) -> T.DataType:
        if all(k == kinds[0] for k in kinds):
            return kinds[0]
        if all(isinstance(k, T.NumericType) for k in kinds):
            whole = all(isinstance(k, T.IntegralType) for k in kinds)
            return T.LongType() if whole else T.DoubleType()
        return T.StringType()

    target = {name: common(kinds) for name, kinds in types.items()}
    cast = [p.select(*[F.col(c).cast(target[c]).alias(c) for c in p.columns]) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)
