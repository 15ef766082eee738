"""The daily run: pages to Bronze, Bronze to Silver, Silver to Gold.

A run is named by its interval; stages hand over by stored tables, so each one
can be run again by itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake import schemas
from noticelake import vocabulary as v
from noticelake.functions import dates
from noticelake.operators import latest, periods, rollup, silver, trigrams
from noticelake.sinks.keyed import KeyedTable, Parts, in_parts, no_changes
from noticelake.sinks.partitions import clear_partitions, replace_partitions, spread
from noticelake.sinks.versioned import VersionedTable
from noticelake.sources import pages
from noticelake.sources.tables import Tables, bronze_slice, silver_slice
from noticelake.workspace import drop_path, path_exists, scratch

PERIOD = ("periodo_inicio", "periodo_fim")


@dataclass(frozen=True)
class Lake:
    """The seven stored tables below one folder."""

    spark: SparkSession
    root: str
    #: Storage partitions of Bronze and Silver, see functions.dates.GRAIN.
    grain: str = "day"
    #: Count distinct buyers by sketches of this size (rollup.sketch_cells) instead of exactly.
    sketch_lg_k: int | None = None
    #: Bronze and Silver as tables whose readers switch to a new version at once (sinks.versioned).
    versions: bool = False
    #: Keep filters of the object texts by storage partition, for text searches (operators.trigrams).
    text_index: bool = False

    @property
    def _table(self) -> type[KeyedTable]:
        return VersionedTable if self.versions else KeyedTable

    @property
    def bronze(self) -> KeyedTable:
        return self._table(
            self.spark, f"{self.root}/{v.BRONZE}", schemas.BRONZE, (v.BRONZE_KEY,), merge_fields=True,
            ignore=schemas.ORIGIN.names,
            partition_of=lambda: dates.publication_part(F.col("dataPublicacaoPncp"), self.grain),
        )

    @property
    def silver(self) -> KeyedTable:
        return self._table(
            self.spark, f"{self.root}/{v.SILVER}", schemas.SILVER, (v.SILVER_KEY,), ignore=("data_coleta",),
            date="data_publicacao_pncp", log_parts=True,
        )

    @property
    def cells_path(self) -> str:
        """Pre-aggregate of Silver by storage partition and day, from which all Gold tables are made. It can be
        removed: the next run builds it anew, and every stored period from it."""
        return f"{self.root}/_celulas_dia" + (f"_hll{self.sketch_lg_k}" if self.sketch_lg_k else "")

    def day_cells(self, silver_rows: DataFrame) -> DataFrame:
        return periods.day_cells(silver_rows, lg_k=self.sketch_lg_k)

    @property
    def filters_path(self) -> str:
        return f"{self.root}/_trigramas"

    def text_parts(self, pattern: str) -> set[str | None] | None:
        """Silver's partitions that can hold a text which matches; None if that cannot be told. Partitions that have
        been touched since the filters were made are among them."""
        if not self.text_index or not path_exists(self.spark, self.filters_path):
            return None
        wanted = trigrams.fixed_places(self.spark, pattern)
        if wanted is None:
            return None
        touched, _ = self.silver.logged_parts()
        return trigrams.partitions_with(self.spark.read.schema(trigrams.SCHEMA).parquet(self.filters_path), wanted) | touched

    @property
    def rejected_path(self) -> str:
        return f"{self.root}/{v.BRONZE}.rejeitados"

    def rejected(self) -> DataFrame:
        """Rejected content of all runs; the files are opened only if there is any."""
        if not path_exists(self.spark, self.rejected_path):
            return self.spark.createDataFrame([], schemas.REJECTED)
        return self.spark.read.schema(schemas.REJECTED).parquet(self.rejected_path).select(*schemas.REJECTED.names)

    def gold_path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def gold(self, name: str) -> DataFrame:
        schema = schemas.GOLD[name]
        if not path_exists(self.spark, self.gold_path(name)):
            return self.spark.createDataFrame([], schema)
        # partition columns come last from the files
        return self.spark.read.schema(schema).parquet(self.gold_path(name)).select(*schema.names)

    def stored_periods(self) -> list[tuple[str, str]]:
        """Periods with a partition in the tables by period: bounded by folders."""
        found = self.gold(v.GOLD_STATE).select(*PERIOD).distinct().collect()
        return sorted((r[0], r[1]) for r in found)

    def tables(self) -> Tables:
        stored = {v.BRONZE: self.bronze.read, v.SILVER: self.silver.read}
        stored.update({name: (lambda name=name: self.gold(name)) for name in v.GOLD_TABLES})
        return Tables(self.spark, stored, parts={v.SILVER: self.silver.parts}, text_parts=self.text_parts)


def bronze_batch(notices: DataFrame, grain: str = "day") -> DataFrame:
    """A landed batch with one row per key: per field the last value in page order; an explicit null is one where
    the pages were read so."""
    nulls = schemas.NULLS if schemas.NULLS in notices.columns else None
    collapsed = latest.merge_last(notices.drop(schemas.PARTITION), [v.BRONZE_KEY], schemas.ORIGIN.names, nulls)
    return silver.add_partition(collapsed, "dataPublicacaoPncp", grain)


def upsert_bronze(table: KeyedTable, notices: DataFrame, grain: str = "day", hold: bool = True) -> tuple[dict[str, int], Parts]:
    """A landed batch into Bronze. Nearly every notice lands once: those are rows as they are, and only
    repeated ones are merged (`bronze_batch`)."""
    if schemas.NULLS in notices.columns:
        return table.upsert(bronze_batch(notices, grain))
    rows = silver.add_partition(notices, "dataPublicacaoPncp", grain)
    return table.upsert(rows, merge=lambda repeated: bronze_batch(repeated, grain), hold=hold)


def silver_batch(bronze: DataFrame, as_of: datetime | Column | None, grain: str = "day") -> DataFrame:
    """Bronze rows as Silver rows; Bronze keys are unique, so nothing is left to deduplicate."""
    rows = silver.stamp_load(silver.classify(silver.flatten(bronze)), as_of)
    return silver.add_partition(rows, "data_publicacao_pncp", grain)


def ingest(lake: Lake, landed: DataFrame) -> dict[str, int]:
    """Landed pages into Bronze (K1). No record, no write (K7)."""
    notices = pages.records(landed)
    if notices.isEmpty():
        return no_changes()
    counts, _ = upsert_bronze(lake.bronze, notices, lake.grain)
    return counts


def keep_rejected(lake: Lake, rejected: DataFrame) -> dict[str | None, int]:
    """What a landing held that is no page or no record (`pages.rejected`), beside Bronze by run; how many of each
    run. A run that is landed again replaces its own."""
    with scratch(lake.spark, "rejected") as path:
        rejected.write.parquet(path)
        rows = lake.spark.read.schema(rejected.schema).parquet(path)
        # one row a run
        counts = {r["lote"]: r["n"] for r in rows.groupBy("lote").agg(F.count("*").alias("n")).collect()}
        if counts:
            replace_partitions(spread(rows, ["lote"]), lake.rejected_path, ["lote"])
    return counts


def refine(lake: Lake, start: str, end: str, as_of: datetime | Column | None = None) -> dict[str, object]:
    """A range of Bronze into Silver (K2, K8); also names the partitions it changed."""
    bronze = bronze_slice(lake.bronze.read(), start, end)
    if bronze.isEmpty():
        return {**no_changes(), "total": lake.silver.read().count(), "partes": Parts()}
    counts, touched = lake.silver.upsert(silver_batch(bronze, as_of, lake.grain), hold=False)
    return {**counts, "total": lake.silver.read().count(), "partes": touched}


def aggregate(
    lake: Lake, start: str, end: str, as_of: datetime | Column | None = None, changed_parts: list | None = None
) -> bool:
    """A range of Silver into the five Gold tables (K3, A6); whether the range has a row.

    The state between runs is a pre-aggregate of Silver by day. Of Silver only the partitions that upserts have
    touched since the last run (and ``changed_parts``) are read, into new day cells. Days whose cells differ from the
    stored ones have changed: every stored period that covers one is made again from its days' cells, with the
    range itself, so each stored period agrees with Silver after every run. Partitions are replaced whole, so no
    stale group stays (D5); a period without rows loses its partition. Months with a changed cell are made again
    whole (D4).

    The new cells move in last: if a run dies before, the next one finds the same differences.
    """
    logged, entries = lake.silver.logged_parts()
    parts = logged | set(changed_parts or ())
    first = not path_exists(lake.spark, lake.cells_path)
    everything = lake.silver.read()
    with _staged_cells(lake) as fresh_path:
        made = lake.day_cells(everything if first else everything.filter(in_parts(parts)))
        spread(made, [schemas.PARTITION]).write.partitionBy(schemas.PARTITION).parquet(fresh_path)
        fresh = _cells_at(lake, fresh_path)
        stored = _cells_at(lake, lake.cells_path)
        other = [p for p in lake.stored_periods() if p != (start, end)]
        if first:
            cells, changed = fresh, fresh
        else:
            touched = F.coalesce(in_parts(parts), F.lit(False))
            cells, replaced = stored.filter(~touched).unionByName(fresh), stored.filter(touched)
            changed = _differing(fresh, replaced).persist()
        try:
            wanted = [(start, end), *(other if first else _covering(changed, other))]
            # at most twelve values, and null
            months = {r[0] for r in changed.select("mes").distinct().collect()}
            filled = _replace_periods(lake, cells, everything, wanted, as_of, months)
        finally:
            changed.unpersist()
        if months:
            _replace_months(lake, cells, months, as_of)
        present = {r[0] for r in fresh.select(schemas.PARTITION).distinct().collect()}
        replace_partitions(fresh, lake.cells_path, [schemas.PARTITION], fresh_path)
        if not first:
            clear_partitions(lake.spark, lake.cells_path, [{schemas.PARTITION: part} for part in parts - present])
    if lake.text_index:
        _refresh_filters(lake, everything, parts)
    for entry in entries:
        drop_path(lake.spark, entry)
    return (start, end) in filled


@contextmanager
def _staged_cells(lake: Lake) -> Iterator[str]:
    """A folder beside the day cells for new ones, until they are moved in."""
    path = f"{lake.cells_path}.{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        drop_path(lake.spark, path)


def _differing(fresh: DataFrame, replaced: DataFrame) -> DataFrame:
    """Partitions, days and months of the cells that one side has and the other has not, or not as often."""
    sides = fresh.withColumn("_lado", F.lit(1)).unionByName(replaced.withColumn("_lado", F.lit(-1)))
    differing = sides.groupBy(*fresh.columns).agg(F.sum("_lado").alias("_lado")).filter("_lado <> 0")
    return differing.select(schemas.PARTITION, periods.DAY, periods.LATE, "mes").distinct()


def _refresh_filters(lake: Lake, everything: DataFrame, parts: set[str | None]) -> None:
    """The text filters of these partitions; of all where there are none yet."""
    rows = everything.filter(in_parts(parts)) if path_exists(lake.spark, lake.filters_path) else everything
    replace_partitions(spread(trigrams.filters(rows), [schemas.PARTITION]), lake.filters_path, [schemas.PARTITION])


def _cells_at(lake: Lake, path: str) -> DataFrame:
    schema = lake.day_cells(lake.silver.read()).schema
    if not path_exists(lake.spark, path):
        return lake.spark.createDataFrame([], schema)
    return lake.spark.read.schema(schema).parquet(path).select(*schema.names)


def _by_days(period: tuple[str, str]) -> bool:
    """Whether a period's bounds are days; others, taken as text, are answered from Silver's rows."""
    try:
        return all(len(bound) == 8 and datetime.strptime(bound, "%Y%m%d") for bound in period)
    except ValueError:
        return False


def _covering(changed: DataFrame, stored: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The stored periods that hold a changed day."""
    regular = [p for p in stored if _by_days(p)]
    if not stored or changed.isEmpty():
        return []
    found = periods.cells_in(changed, regular).select(*PERIOD).distinct().collect() if regular else []
    return sorted({(r[0], r[1]) for r in found} | {p for p in stored if not _by_days(p)})


def _replace_periods(lake: Lake, cells: DataFrame, everything: DataFrame, wanted: list[tuple[str, str]], as_of, months: set[int | None]) -> set[tuple[str, str]]:
    """The four tables' partitions of some periods; adds the months of their rows, returns the periods that have any."""
    rows = [periods.cells_in(cells, regular)] if (regular := [p for p in wanted if _by_days(p)]) else []
    for start, end in wanted:
        if not _by_days((start, end)):
            rows.append(lake.day_cells(silver_slice(everything, start, end)).withColumns({"periodo_inicio": F.lit(start), "periodo_fim": F.lit(end)}))
    cells_of = reduce(DataFrame.unionByName, rows)
    # without the buyers there are few rows, whatever the number of notices; cells with sketches are that already
    table = rollup.without_buyers(cells_of, (*PERIOD, "mes")).persist()
    try:
        found = table.select(*PERIOD, "mes").distinct().collect()
        filled = {(r[0], r[1]) for r in found}
        months |= {r["mes"] for r in found if (r[0], r[1]) == wanted[0]}
        for spec in rollup.ROLLUPS.values():
            if spec.by_period:
                counts_buyers = "orgaos_distintos" in spec.measures
                made = rollup.stamp(rollup.from_cells(cells_of if counts_buyers else table, spec, PERIOD), None, as_of)
                replace_partitions(spread(made, PERIOD), lake.gold_path(spec.table), PERIOD)
                empty = [dict(zip(PERIOD, period, strict=True)) for period in wanted if period not in filled]
                clear_partitions(lake.spark, lake.gold_path(spec.table), empty)
    finally:
        table.unpersist()
    return filled


def _replace_months(lake: Lake, cells: DataFrame, months: set[int | None], as_of) -> None:
    wanted = [m for m in months if m is not None]
    in_month = F.col("mes").isin(wanted)
    if None in months:
        in_month = in_month | F.col("mes").isNull()
    elif lake.grain != "year":
        # the partition name holds the month: other months are not read; a date that is not written in full
        # lies in the null partition, whatever its month
        named = F.substring(schemas.PARTITION, 6, 2).isin([f"{m:02d}" for m in wanted])
        in_month = in_month & (F.col(schemas.PARTITION).isNull() | named)
    table = rollup.stamp(rollup.from_cells(cells.filter(in_month), rollup.MONTH), None, as_of)
    table = spread(table, ["mes"]).persist()
    try:
        path = lake.gold_path(rollup.MONTH.table)
        replace_partitions(table, path, ["mes"])
        filled = {r[0] for r in table.select("mes").distinct().collect()}
        clear_partitions(lake.spark, path, [{"mes": m} for m in months - filled])
    finally:
        table.unpersist()


def run(
    lake: Lake, landed: DataFrame, start: str, end: str, as_of: datetime | Column | None = None, rejected: DataFrame | None = None
) -> dict:
    """All three stages of one interval; what was ``rejected`` is kept as well."""
    refused = {} if rejected is None else {"rejeitados": keep_rejected(lake, rejected)}
    ingested = ingest(lake, landed)
    refined = refine(lake, start, end, as_of)
    gold = aggregate(lake, start, end, as_of, refined["partes"])
    return {"bronze": ingested, "silver": refined, "gold": gold, **refused}
