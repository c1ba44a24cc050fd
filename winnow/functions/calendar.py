"""Date parsing and the columns derived from a date."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"
# Weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def parse_date(text: Column, pattern: str = ISO_DATE, strict: bool = True) -> Column:
    """Date in one imposed format.

    Strict parsing fails the job on the first malformed text, so day and month
    can never be swapped unnoticed; tolerant parsing gives NULL instead.
    """
    if strict:
        return F.to_date(text, pattern)
    return F.try_to_date(text, pattern)


def weekday_name(date: Column) -> Column:
    """Full English weekday name."""
    return F.get(F.array(*[F.lit(name) for name in WEEKDAYS]), F.weekday(date))


def season_label(date: Column, first_month: int = 10) -> Column:
    """``'2022-2023'`` for a season that starts in ``first_month``."""
    start = F.when(F.month(date) >= first_month, F.year(date)).otherwise(F.year(date) - 1)
    return F.concat(start.cast("string"), F.lit("-"), (start + 1).cast("string"))


def season_kind(date: Column, months: Collection[int], inside: str, outside: str) -> Column:
    """``inside`` for the given months, ``outside`` for all others and for a missing date."""
    return F.when(F.month(date).isin(*sorted(months)), inside).otherwise(outside)
