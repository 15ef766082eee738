"""Deterministic orders and limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_keys(order: Sequence[str]) -> list[Column]:
    """``"uf"`` ascending, ``"-valor_total"`` descending with nulls last."""
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc() for c in order]


def ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*sort_keys(order))


def top(df: DataFrame, order: Sequence[str], limit: int | None = None) -> DataFrame:
    """Order and limit in one TakeOrderedAndProject; ``order`` names a total order. No limit: all rows."""
    if limit is None:
        return ordered(df, order)
    if int(limit) < 1:
        raise ValueError(f"limit must be at least 1, got {limit}")
    return ordered(df, order).limit(int(limit))
