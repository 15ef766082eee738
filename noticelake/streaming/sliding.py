"""Overlapping two-day periods on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sliding_periods(
    rows: DataFrame,
    event_time: str,
    keys: Sequence[str],
    measures: Sequence[Column],
    delay: str | None = None,
    days: int = 2,
) -> DataFrame:
    """Measures per key and run period; the same expression on a table or a stream.

    Give ``delay`` for append or update output, so that state of closed periods
    is dropped. Complete output needs none and emits the last, open periods too.
    Distinct counts on a stream: ``approx_count_distinct``.
    """
    timed = rows.withColumn(event_time, F.col(event_time).cast("timestamp"))
    if delay:
        timed = timed.withWatermark(event_time, delay)
    period = F.window(event_time, f"{days} days", "1 day")
    return (
        timed.groupBy(period, *keys)
        .agg(*measures)
        .select(
            F.date_format("window.start", "yyyyMMdd").alias("periodo_inicio"),
            F.date_format(F.col("window.end") - F.expr("interval 1 day"), "yyyyMMdd").alias("periodo_fim"),
            "*",
        )
        .drop("window")
    )
