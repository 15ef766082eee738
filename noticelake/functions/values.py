"""Numbers and money."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake import vocabulary as v

#: Fixed-point type money is summed in: its sum does not depend on the order of rows.
MONEY = "decimal(28,4)"


def to_double(raw: Column) -> Column:
    """Number or null; text that is no number and NaN both become null (defect D1)."""
    number = raw.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_whole(raw: Column) -> Column:
    """Int or null, also from "2026.0"."""
    return raw.try_cast("double").try_cast("int")


def band(
    value: Column,
    bounds: Sequence[tuple[float, str]] = v.VALUE_BANDS,
    above: str = v.VALUE_BAND_ABOVE,
    missing: str = v.VALUE_BAND_MISSING,
) -> Column:
    """Label of the first inclusive upper bound that holds the value."""
    label = F.lit(above)
    for limit, name in reversed(list(bounds)):
        label = F.when(value <= F.lit(limit), F.lit(name)).otherwise(label)
    return F.when(value.isNull() | F.isnan(value), F.lit(missing)).otherwise(label)


def fixed_part(value: Column) -> Column:
    """The value as fixed-point money; null where it does not fit."""
    return value.try_cast(MONEY)


def outlier_part(value: Column) -> Column:
    """The values ``fixed_part`` cannot hold (10^24 and more, infinities), as doubles."""
    return F.when(value.try_cast(MONEY).isNull(), value)


def join_parts(fixed_sum: Column, outlier_sum: Column) -> Column:
    """P10: one double out of the two partial sums; 0.0 when nothing was summed."""
    return F.coalesce(fixed_sum.cast("double"), F.lit(0.0)) + F.coalesce(outlier_sum, F.lit(0.0))


def money_sum(value: Column) -> Column:
    return join_parts(F.sum(fixed_part(value)), F.sum(outlier_part(value)))


def money_sum_rounded(value: Column, places: int = 2) -> Column:
    """Sum rounded while still fixed-point."""
    return join_parts(F.round(F.sum(fixed_part(value)), places), F.sum(outlier_part(value)))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))
