"""Deduplication on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str, spread: int = 8
) -> DataFrame:
    """The first row of each key; repeats within ``delay`` of it are dropped.

    ``delay`` must cover the gap between repeats. Rows of a key are first
    deduplicated in ``spread`` shares, so the task that owns a hot key sees at
    most ``spread`` of its rows per interval, not all of them. ``spread=1`` leaves
    that stage out, which halves the state where no key is hot.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    if spread > 1:
        # Which share a row falls in does not matter to the result, but a task that runs
        # again must choose the same one: hence no random number.
        share = F.pmod(F.xxhash64(*stream.columns) + F.spark_partition_id(), F.lit(spread))
        timed = timed.withColumn("_share", share).dropDuplicatesWithinWatermark([*keys, "_share"]).drop("_share")
    return timed.dropDuplicatesWithinWatermark(list(keys))
