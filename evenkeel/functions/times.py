"""Timestamps, dates, durations and the business calendar.

Spark's ``dayofweek`` starts on Sunday; everything here is ISO (Monday = 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions.text import as_column, clean_null

__all__ = [
    "LOCAL_ZONE", "parse_local_timestamp", "parse_date", "local_to_utc", "parse_offset_timestamp",
    "iso_weekday", "is_weekend", "iso_year", "month_start", "elapsed_seconds",
    "elapsed_hours", "elapsed_days", "first_weekday_of_month", "export_year",
    "nth_business_day", "file_export_date", "calendar_columns",
]

LOCAL_ZONE = "Europe/Helsinki"

# ISO with or without a fraction, and European day-first with optional seconds
ISO_TIMESTAMP, EUROPEAN_TIMESTAMP = "yyyy-M-d H:m:s[.SSSSSS]", "d.M.yyyy H:m[:s[.SSSSSS]]"
WEEKDAY_NAMES = ("MO", "TU", "WE", "TH", "FR", "SA", "SU")


def _is_iso(text: Column) -> Column:
    # picking the format by a look is cheaper than letting the wrong one fail
    return F.substring(text, 5, 1) == "-"


def parse_local_timestamp(c: Column | str, cleaned: bool = False) -> Column:
    """Wall-clock time as written; junk is null (see ``parse_failed``)."""
    text = as_column(c) if cleaned else clean_null(c)
    return F.when(_is_iso(text), F.try_to_timestamp(text, F.lit(ISO_TIMESTAMP))).otherwise(
        F.try_to_timestamp(text, F.lit(EUROPEAN_TIMESTAMP)))


def local_to_utc(c: Column | str, zone: Column | str = LOCAL_ZONE) -> Column:
    """Wall time in ``zone`` to UTC with daylight saving; the zone may be a column."""
    return F.to_utc_timestamp(as_column(c), F.lit(zone) if isinstance(zone, str) else zone)


def parse_date(c: Column | str, cleaned: bool = False) -> Column:
    """Date of the first ten characters, else of the whole text as a timestamp."""
    text = as_column(c) if cleaned else clean_null(c)
    head = F.substring(text, 1, 10)
    day_first = F.coalesce(F.try_to_timestamp(head, F.lit("d.M.yyyy")), F.try_to_timestamp(text, F.lit(EUROPEAN_TIMESTAMP)))
    iso = F.coalesce(F.try_to_timestamp(head, F.lit("yyyy-M-d")), F.try_to_timestamp(text, F.lit(ISO_TIMESTAMP)))
    return F.to_date(F.when(_is_iso(text), iso).otherwise(day_first))


def parse_offset_timestamp(c: Column | str) -> Column:
    """ISO with a space or ``T`` and an offset as short as ``+00``; none means UTC."""
    return as_column(c).try_cast("timestamp")


def iso_weekday(c: Column | str) -> Column:
    return F.weekday(as_column(c)) + 1


def is_weekend(c: Column | str) -> Column:
    return iso_weekday(c) >= 6


def iso_year(c: Column | str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), as_column(c))


def month_start(c: Column | str) -> Column:
    return F.to_date(F.date_trunc("month", as_column(c)))


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds between two instants, keeping fractions; null if either is null."""
    micros = F.unix_micros(as_column(end).cast("timestamp")) - F.unix_micros(as_column(start).cast("timestamp"))
    return micros / F.lit(1_000_000.0)


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    return elapsed_seconds(start, end) / F.lit(3600.0)


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    return elapsed_seconds(start, end) / F.lit(86400.0)


def first_weekday_of_month(year: Column | str, month: Column | str, weekday: Column | str) -> Column:
    """First date of the month falling on an ISO weekday given as a column."""
    before = F.date_sub(F.make_date(as_column(year), as_column(month), F.lit(1)), 1)
    day = as_column(weekday)
    tries = [F.when(day == i + 1, F.next_day(before, name)) for i, name in enumerate(WEEKDAY_NAMES)]
    return F.coalesce(*tries)


def export_year(month: Column | str, first_month: int = 12, first_year: int = 2025) -> Column:
    """Year of a month number inside an export window of under twelve months
    that starts with ``first_month`` of ``first_year``."""
    return F.when(as_column(month) >= first_month, F.lit(first_year)).otherwise(F.lit(first_year + 1))


def nth_business_day(start: Column | str, n: Column | int) -> Column:
    """The n-th Monday-to-Friday day after ``start``, in closed form.

    A weekend start counts from the Friday before; then five steps are a week.
    """
    day = as_column(start)
    steps = F.lit(n) if isinstance(n, int) else n
    weekday = F.least(F.weekday(day), F.lit(4))
    monday = F.date_sub(day, F.weekday(day))
    total = (weekday + steps).cast("int")
    moved = F.date_add(monday, (F.floor(total / 5) * 7 + total % 5).cast("int"))
    return F.when(steps == 0, day).otherwise(moved)


def file_export_date(name: Column | str, modified: Column | str) -> Column:
    """``YYYY-MM-DD`` token of a file name, else ``YYYYMMDD``, else the file's date."""
    stem = F.regexp_replace(as_column(name), r"\.[^.]*$", "")
    dashed = F.regexp_extract(stem, r"(?:^|_)(\d{4}-\d{2}-\d{2})(?:_|$)", 1)
    packed = F.regexp_extract(stem, r"(?:^|_)(\d{8})(?:_|$)", 1)
    return F.coalesce(
        F.to_date(F.try_to_timestamp(F.when(dashed != "", dashed), F.lit("yyyy-MM-dd"))),
        F.to_date(F.try_to_timestamp(F.when(packed != "", packed), F.lit("yyyyMMdd"))),
        F.to_date(as_column(modified)),
    )


def calendar_columns(c: Column | str) -> dict[str, Column]:
    """Date parts by name, for ``df.withColumns``."""
    day = as_column(c)
    return {
        "month": F.month(day), "weekday": iso_weekday(day), "hour": F.hour(day), "year": F.year(day),
        "iso_year": iso_year(day), "iso_week": F.weekofyear(day),
        "is_weekend": is_weekend(day), "period": month_start(day),
    }
