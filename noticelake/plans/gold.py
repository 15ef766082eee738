"""Gold tables as views over Silver, for queries that need no stored copy."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame

from noticelake import vocabulary as v
from noticelake.operators import periods, rollup
from noticelake.sources.tables import Tables, silver_slice


def of_all_periods(bronze: DataFrame, silver: DataFrame, as_of: datetime | Column | None = None) -> Tables:
    """All seven tables as if every daily run had been made."""
    gold = {
        name: rollup.stamp(periods.sliding(silver, spec), None, as_of) for name, spec in rollup.ROLLUPS.items()
    }

    def of_days(spec: rollup.Rollup) -> Callable[[str, str], DataFrame]:
        return lambda start, end: rollup.stamp(periods.sliding(silver_slice(silver, start, end), spec), None, as_of)

    by_period = {name: of_days(spec) for name, spec in rollup.ROLLUPS.items() if spec.by_period}
    return Tables(silver.sparkSession, {v.BRONZE: bronze, v.SILVER: silver, **gold}, by_period)
