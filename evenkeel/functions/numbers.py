"""Number parsing, clipping, binning and conditional averages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions.text import as_column, clean_null

__all__ = [
    "parse_int", "parse_float", "parse_finished_days", "parse_failed", "nan_to_null",
    "clip", "half_even", "presence_flag", "interval_bin", "equal_bin", "share", "weighted_blend",
]


# ``cleaned`` says that the text has been through ``clean_null`` already


def parse_int(c: Column | str, cleaned: bool = False) -> Column:
    """``"5701.0"`` and ``"5701"`` are 5701; null literals and junk are null."""
    text = as_column(c) if cleaned else clean_null(c)
    return text.try_cast("double").try_cast("bigint")


def parse_float(c: Column | str, cleaned: bool = False) -> Column:
    text = as_column(c) if cleaned else clean_null(c)
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def parse_finished_days(c: Column | str, cleaned: bool = False) -> Column:
    """``2.16.00`` is 2.16 days: the first two dotted parts when the first is digits."""
    text = as_column(c) if cleaned else clean_null(c)
    head = F.regexp_extract(text, r"^(\d+\.[^.]*)", 1)
    return F.when(head != "", head.try_cast("double")).otherwise(parse_float(text, cleaned=True))


def parse_failed(raw: Column | str, parsed: Column, cleaned: bool = False) -> Column:
    """True where a value was given but could not be parsed."""
    text = as_column(raw) if cleaned else clean_null(raw)
    return text.isNotNull() & parsed.isNull()


def nan_to_null(c: Column | str) -> Column:
    column = as_column(c)
    return F.when(~F.isnan(column), column)


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Null stays null (``least``/``greatest`` alone would skip it)."""
    column = as_column(c)
    bounded = column
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(column.isNotNull(), bounded)


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Banker's rounding of the scaled double, the rule of numpy and pandas."""
    if digits == 0:
        return F.rint(as_column(c))
    scale = float(10**digits)
    return F.rint(as_column(c) * F.lit(scale)) / F.lit(scale)


def presence_flag(c: Column | str) -> Column:
    return as_column(c).isNotNull().cast("int")


def interval_bin(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edges[i], edges[i+1]]``; outside all of them is null."""
    column = as_column(c)
    chain = F
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        chain = chain.when((column > F.lit(float(low))) & (column <= F.lit(float(high))), F.lit(label))
    return chain


def equal_bin(c: Column | str, bins: int = 10) -> Column:
    """Index of the left-closed equal-width bin of [0, 1]; both ends are clamped.

    Compared against the same literal edges ``i * (1 / bins)`` a linear grid has:
    ``floor(p * bins)`` puts some values that sit on an edge one bin off.
    """
    column = as_column(c)
    step = 1.0 / bins
    above = [F.when(column >= F.lit(i * step), 1).otherwise(0) for i in range(1, bins)]
    return F.when(column.isNotNull(), reduce(lambda a, b: a + b, above))


def share(condition: Column) -> Column:
    """Aggregate: fraction of rows where the condition holds, null counting as not."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def weighted_blend(parts: Sequence[tuple[Column | str, float]]) -> Column:
    """Weighted mean over the non-null parts; null when none is present."""
    zero = F.lit(0.0)
    columns = [(as_column(c), F.lit(float(w))) for c, w in parts]
    weight = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), w).otherwise(zero) for c, w in columns])
    total = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), c * w).otherwise(zero) for c, w in columns])
    return F.when(weight > 0, total / weight)
