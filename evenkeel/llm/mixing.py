"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.llm.common import WORD, carried, cut, given_back, let, text_of, words_of

WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MOST_EPOCHS = 3
#: Documents in a slice of a source's order, on average: one slice is sorted a source.
SLICE_DOCUMENTS = 5_000
MIX = ("size", "source_size", "target", "taken")


def quality_weight(text: Column, size: Column) -> Column:
    """Share of plain words: symbols count against a text. In (0, 1]."""
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))
    return F.when(size > 0, size / (size + symbols)).otherwise(F.lit(1.0))


def exponential_key(identifier: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight; u in (0, 1) follows from the id, so reruns agree. Ascending
    order is a weighted sample without replacement."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit("")))),
                              1, 13), 16, 10).cast("bigint")
    return -F.log((bits + 0.5) / float(1 << 52)) / weight


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) → also ``target``. One row a source.

    A source's share of the total grows with its weight until it is ``most`` times its
    size; what is over goes to the others by weight. So target = min(cap, level ×
    weight), where the level is the largest of (total − caps of the sources that fill
    up first) / (weights of the rest).
    """
    cap, ratio = F.col("source_size") * most, F.col("source_size") * most / F.col("_weight")
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    filled = W.orderBy(ratio, F.col("source").asc_nulls_last())
    every = W.partitionBy()
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_source) - 1) % len(weights))
    weighed = sizes.withColumn("_weight", weight)
    levels = weighed.withColumns({
        "_total": F.sum("source_size").over(every),
        "_before": F.coalesce(F.sum(cap).over(filled.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "_rest": F.sum("_weight").over(filled.rowsBetween(0, W.unboundedFollowing))})
    level = F.max((F.col("_total") - F.col("_before")) / F.col("_rest")).over(every)
    return levels.withColumn("target", F.least(cap.cast("double"), level * F.col("_weight"))).drop(
        "_weight", "_total", "_before", "_rest")


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = "mix",
                identifier: str = "doc_id", source: str = "source", text: str = "text",
                keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``mix``, a struct of ``size`` (words),
    ``source_size``, ``target`` and ``taken`` (words the mix takes, repeats counted); a
    column of that name is replaced.

    Every document is taken once per complete epoch of its source; the words left to
    the target are then taken in the order of exponential keys divided by document
    quality, the last document as far as the target reaches. The order of a source is
    cut into slices by the keys' distribution function; slices are summed first, so
    only the slice where the target ends is sorted, however large the source is. Texts
    are read once: sizes and keys are written, with the kept columns, to the shared folder.

    Null text has size 0 and is never taken. Null sources are one source, the last.
    Rows that tie in key are ordered by id and text; equal rows are interchangeable.
    An empty table gives no rows.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != "mix"]
    slices = max(1, math.ceil(docs.count() / SLICE_DOCUMENTS))
    value = text_of(text)
    sized = docs.select(*carried(kept), F.col(source).alias("_source"), F.col(identifier).alias("_id"), value.alias("_text")
                        ).withColumn("_size", F.size(words_of(F.col("_text"))).cast("bigint"))
    keyed = sized.withColumn("_key", exponential_key(F.col("_id"), quality_weight(F.col("_text"), F.col("_size")), seed))
    placed = cut(keyed.withColumns({
        "_slice": F.floor((1 - F.exp(-F.col("_key"))) * slices), "_tie": F.xxhash64("_text")}).drop("_text"), "mix")

    sums = cut(placed.groupBy(F.col("_source").alias("source"), F.col("_slice").alias("slice")).agg(
        F.sum("_size").alias("words")), "slices")
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    planned = targets.withColumn("epochs", epochs).withColumn(
        "open", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint"))
    upto = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, 0)
    reached = sums.withColumn("upto", F.sum("words").over(upto))
    joined = reached.alias("r").join(planned.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    ends = (F.col("upto") >= F.col("open")) & (F.col("open") > 0)
    # one row a source, written: Spark knows its size before it chooses the join
    plan = cut(joined.groupBy(F.col("p.source").alias("of")).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.first("epochs").alias("epochs"), F.coalesce(F.min(F.when(ends, F.col("slice"))), F.lit(-1)).alias("last"),
        F.min(F.when(ends, F.struct("slice", (F.col("open") - F.col("upto") + F.col("words")).alias("open"))))["open"
                                                                                                        ].alias("open")), "plan")
    ready = placed.join(plan, F.col("_source").eqNullSafe(F.col("of")), "left")
    whole = ready.where(F.col("_slice") != F.col("last")).withColumn(
        "_part", F.when(F.col("_slice") < F.col("last"), F.col("_size")).otherwise(F.lit(0)))
    order = W.partitionBy("_source").orderBy("_key", "_id", "_tie").rowsBetween(W.unboundedPreceding, 0)
    edge = ready.where(F.col("_slice") == F.col("last")).withColumn("_upto", F.sum("_size").over(order)).withColumn(
        "_part", F.greatest(F.lit(0), F.least(F.col("_size"), F.col("open") - F.col("_upto") + F.col("_size")))
    ).drop("_upto")
    taken = F.col("epochs") * F.col("_size") + F.col("_part")
    return whole.unionByName(edge).select(*given_back(kept), F.struct(
        F.col("_size").alias("size"), "source_size", "target", taken.cast("bigint").alias("taken")).alias("mix"))


def mixed_documents(mixed: DataFrame, text: str = "text") -> DataFrame:
    """Documents as often as the mix takes them: whole copies, then the words left, with
    all white space before and between them."""
    runs = F.regexp_extract_all(text_of(text), F.lit(rf"{WORD}|[\x20\x09-\x0D]+"), F.lit(0))
    copies = F.floor(F.col("mix.taken") / F.col("mix.size"))
    left = F.col("mix.taken") - copies * F.col("mix.size")
    parts = F.array_append(F.array_repeat(F.lit(-1).cast("bigint"), copies.cast("int")), left)
    taken = mixed.where(F.col("mix.taken") > 0).withColumn("_part", F.explode(F.filter(parts, lambda n: n != 0)))
    # words and white space take turns
    upto = lambda runs: F.array_join(F.slice(runs, 1, 2 * F.col("_part").cast("int") - F.when(
        F.get(runs, F.lit(0)).rlike(WORD), 1).otherwise(0)), "")
    cut = let(runs, upto)
    return taken.withColumn(text, F.when(F.col("_part") < 0, F.col(text)).otherwise(cut)).drop("_part", "mix")
