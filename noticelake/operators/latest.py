"""One row per key.

Every form reduces a key's rows inside the map tasks before anything is
shuffled, so a key that holds a third of all rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``; null keys are one key.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the
    shuffle (WindowGroupLimit Partial and Final in the plan).
    """
    latest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_place", F.row_number().over(latest_first)).filter("_place = 1").drop("_place")


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A15 in its plain form: an arbitrary row of each key."""
    return df.dropDuplicates(list(keys))


def merge_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], nulls: str | None = None) -> DataFrame:
    """W1 for merging writes: per field the last non-null value of each key.

    ``nulls``: a column that names the row's fields that were given as null. Such a null is a value like
    any other; where it is the last one, the field is null and named in ``nulls`` of the result.

    Aggregates, not a window over the whole group: partial results are one row
    per key and task.
    """
    place = F.struct(*order)
    fields = [c for c in df.columns if c not in (*keys, nulls)]

    def given(field: str) -> Column:
        there = F.col(field).isNotNull()
        return F.when(there | F.array_contains(nulls, field) if nulls else there, place)

    last = [F.max_by(F.col(c), given(c)).alias(c) for c in fields]
    if not nulls:
        return df.groupBy(*keys).agg(*last).select(*df.columns)
    ever = [F.max(given(c).isNotNull()).alias(f"_given_{c}") for c in fields]
    emptied = F.array_compact(F.array(*[F.when(F.col(f"_given_{c}") & F.col(c).isNull(), c) for c in fields]))
    return df.groupBy(*keys).agg(*last, *ever).withColumn(nulls, emptied).select(*df.columns)
