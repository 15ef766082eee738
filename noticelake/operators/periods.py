"""Overlapping run periods.

A daily run covers its day and the next one, both whole, so a notice counts in
two periods. All periods of a table are computed in one query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions import dates
from noticelake.operators import rollup as rollups
from noticelake.operators.rollup import Rollup, rollup
from noticelake.schemas import PARTITION

PERIOD = ("periodo_inicio", "periodo_fim")
#: What decides in which periods a date lies: its first ten characters, and whether it comes after the last moment
#: that a period which ends on that day takes in.
DAY, LATE = "_dia", "_tarde"


def in_periods(silver: DataFrame, days: int = 2, source: str = "data_publicacao_pncp") -> DataFrame:
    """Each row once per period that covers it.

    Membership is the text comparison of a run's own filter, so a stamp with a
    fraction after 23:59:59 falls outside the period that ends on its day.
    """
    day = dates.publication_date(F.col(source))
    start = F.col("_inicio")
    end = F.date_add(start, days - 1)
    starts = F.explode(F.array(*[F.date_sub(day, back) for back in range(days)]))
    last_moment = F.concat(F.date_format(end, "yyyy-MM-dd"), F.lit(dates.END_OF_DAY))
    return (
        silver.withColumn("_inicio", starts)
        .filter(F.col(source) <= last_moment)
        .withColumns(
            {"periodo_inicio": dates.compact_day_of(start), "periodo_fim": dates.compact_day_of(end)}
        )
        .drop("_inicio")
    )


def day_cells(silver: DataFrame, source: str = "data_publicacao_pncp", lg_k: int | None = None) -> DataFrame:
    """Pre-aggregate by storage partition and day, from which the Gold rows of any period are made; with ``lg_k``
    buyers are sketched."""
    day = F.substring(source, 1, 10)
    rows = silver.withColumns({DAY: day, LATE: F.col(source) > F.concat(day, F.lit(dates.END_OF_DAY))})
    keys = [PARTITION, DAY, LATE]
    return rollups.cells(rows, keys) if lg_k is None else rollups.sketch_cells(rows, keys, lg_k)


def cells_in(day_rows: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """Day cells once per wanted period (``YYYYMMDD`` each) that covers them.

    A real day finds its periods by an equality join with the days of the periods. Any other text
    is compared with the bounds, as a run's own filter does; there is little of it.
    """
    spark = day_rows.sparkSession
    periods = spark.createDataFrame([(a, b, dates.iso_day(a), dates.iso_day(b)) for a, b in wanted], f"{PERIOD[0]} string, {PERIOD[1]} string, _de string, _ate string")
    inside = dates.part_between(F.col(PARTITION), min(a for a, _ in wanted), max(b for _, b in wanted))
    day = F.col(DAY)
    real = F.coalesce(F.date_format(dates.publication_date(day), "yyyy-MM-dd") == day, F.lit(False))
    days = periods.withColumn(DAY, F.explode(F.sequence(F.to_date("_de"), F.to_date("_ate")))).withColumn(DAY, F.date_format(DAY, "yyyy-MM-dd"))
    rows = day_rows.filter(inside)
    # a day of the periods is a real one
    dated = rows.join(days, DAY).filter((day < F.col("_ate")) | ~F.col(LATE))
    bounds = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip((a, b, dates.iso_day(a), dates.iso_day(b)), (*PERIOD, "_de", "_ate"), strict=True)]) for a, b in wanted])
    covers = F.filter(bounds, lambda p: (day >= p["_de"]) & ((day < p["_ate"]) | ((day == p["_ate"]) & ~F.col(LATE))))
    other = rows.filter(~real).withColumn("_p", F.explode(covers)).select("*", "_p.*").drop("_p")
    return dated.unionByName(other).drop("_de", "_ate")


def sliding(silver: DataFrame, spec: Rollup, days: int = 2) -> DataFrame:
    """One Gold table for every period at once."""
    if not spec.by_period:
        return rollup(silver, spec)
    return rollup(in_periods(silver, days), spec, extra_keys=PERIOD)
