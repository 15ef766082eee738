"""Dates kept as ISO text, periods and storage partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

END_OF_DAY = "T23:59:59"

#: Leading characters of an ISO date that make a storage partition: days for a table
#: of many terabytes, years for a small one.
GRAIN = {"day": 10, "month": 7, "year": 4}


def iso_day(compact: str) -> str:
    """``20260131`` -> ``2026-01-31``; text of another length is passed through."""
    if len(compact) != 8:
        return compact
    return "-".join((compact[:4], compact[4:6], compact[6:]))


def iso_day_of(compact: Column) -> Column:
    """P16 as a column."""
    dashed = F.concat_ws(
        "-", F.substring(compact, 1, 4), F.substring(compact, 5, 2), F.substring(compact, 7, 2)
    )
    return F.when(F.length(compact) == 8, dashed).otherwise(compact)


def compact_day_of(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def split_period(period: str) -> tuple[str, str]:
    """``A_B`` -> ``(A, B)``."""
    parts = period.split("_")
    if len(parts) != 2:
        raise ValueError(f"period must look like YYYYMMDD_YYYYMMDD, got {period!r}")
    return parts[0], parts[1]


def bounds(start: str, end: str) -> tuple[str, str]:
    """Inclusive ISO text bounds of the days ``start`` to ``end``."""
    return iso_day(start), iso_day(end) + END_OF_DAY


def published_between(text: Column, start: str, end: str) -> Column:
    """both days whole, compared as text; null never matches."""
    low, high = bounds(start, end)
    return (text >= F.lit(low)) & (text <= F.lit(high))


def publication_date(text: Column) -> Column:
    return F.try_to_date(text)


def month_of(text: Column) -> Column:
    """Month of an ISO text date, null where it is no date."""
    return F.month(publication_date(text))


def publication_part(text: Column, grain: str = "day") -> Column:
    """Storage partition: the leading characters of an ISO date, else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, GRAIN[grain]))


def part_between(part: Column, start: str, end: str) -> Column:
    """Partition filter implied by ``published_between``, whatever the table's grain.

    Cutting two texts to the same length keeps their order, so no partition that
    could hold a matching row is pruned. Text that is no ISO date lives in the
    null partition, which is always read.
    """
    low, high = (F.left(F.lit(bound), F.length(part)) for bound in bounds(start, end))
    return part.isNull() | part.between(low, high)
