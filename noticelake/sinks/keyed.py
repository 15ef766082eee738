"""Keyed Parquet tables with upsert (K1, K2, K4, K5).

Spark's own Parquet tables have no MERGE and cannot be overwritten while they
are read. An upsert here

1. finds the partitions the batch touches: those it writes to, and those that an index
   from keys to partitions names for its keys,
2. joins only those with the batch and writes the outcome beside the table by partition, counting
   outcomes and changed days as it writes,
3. adds new and moved keys to the index, and moves the written partitions into the place of the old ones.

It costs what the touched partitions, and the batch's buckets of the index, hold; the rest of the
table is not read. If a run dies between 2 and 3, the next one first finishes step 3 from what lies
beside the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from noticelake.operators.reconcile import (
    COUNTS,
    INSERTED,
    STATUS,
    UNCHANGED,
    UPDATED,
    outcome_counts,
    reconcile,
    same_keys,
)
from noticelake.schemas import NULLS, PARTITION
from noticelake.sinks.key_index import KeyIndex
from noticelake.sinks.partitions import NULL_PARTITION, clear_partitions, replace_partitions, spread
from noticelake.sources.tables import in_parts
from noticelake.workspace import child_names, drop_path, path_exists

_PART_SCHEMA = StructType([StructField(PARTITION, StringType())])


#: Beside a staged row: where its key was stored, and its date there.
_PART_WAS, _DATE_WAS = "_part_was", "_date_was"

#: A batch of at most this many rows sends its keys to every task: stored rows that it does not name go to the
#: write as they were read, and only the others are joined with it and shuffled.
SMALL_BATCH = 1_000_000


class Parts(list):
    """Touched storage partitions; ``days`` are the days of new, changed and moved keys, those they have
    moved away from (``left``) included."""

    def __init__(self, touched: Iterable[str | None] = (), left: Iterable[str] = (), days: Iterable[str] = ()):
        super().__init__(touched)
        self.left = list(left)
        self.days = list(days)


@dataclass(frozen=True)
class Batch:
    """A batch with one row per key, how many rows it has, and the index buckets of its keys, of which there are at
    most as many as the index has."""

    rows: DataFrame
    count: int
    buckets: list[int]


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    #: A batch row's non-null fields replace the stored ones (K1), or the row as a whole (K2).
    merge_fields: bool = False
    #: Columns that do not make a row "updated".
    ignore: tuple[str, ...] = ()
    #: False where the source never moves a key to another partition: saves the index.
    keys_may_move: bool = True
    #: Storage partition of a merged row, made from the row itself: a field merge may take the date
    #: that it follows from either side.
    partition_of: Callable[[], Column] | None = None
    #: Text date whose days of changed rows are reported.
    date: str | None = None
    #: Keep a list of the touched partitions for whoever derives tables from this one (`logged_parts`).
    log_parts: bool = False
    #: Folders of the index from keys to partitions; a batch of few keys opens few of them.
    index_buckets: int = 64

    def __post_init__(self) -> None:
        if self.merge_fields and not self.keys_may_move:
            raise ValueError("a sparse row does not say where its key is stored: merge_fields needs keys_may_move")

    @property
    def _stage(self) -> str:
        return f"{self.path}.staged"

    @property
    def _staged_rows_path(self) -> str:
        return f"{self._stage}/rows"

    @property
    def _vacated_path(self) -> str:
        return f"{self._stage}/vacated"

    @property
    def _emptied_path(self) -> str:
        return f"{self._stage}/emptied"

    @property
    def index(self) -> KeyIndex:
        return KeyIndex(self.spark, f"{self.path}.index", tuple(self.schema[k] for k in self.keys), self.index_buckets)

    @property
    def _log_path(self) -> str:
        return f"{self.path}.touched"

    def logged_parts(self) -> tuple[set[str | None], list[str]]:
        """Partitions that upserts have touched since the entries of their list were last dropped, and these
        entries. An entry is written before the rows move in, so it may name too much, never too little."""
        entries = [f"{self._log_path}/{name}" for name in child_names(self.spark, self._log_path)]
        whole = [e for e in entries if path_exists(self.spark, f"{e}/_SUCCESS")]
        rows = self.spark.read.schema(_PART_SCHEMA).parquet(*whole).distinct().collect() if whole else []
        return {r[0] for r in rows}, whole

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def parts(self) -> list[str | None]:
        """Stored partitions by name, the null partition first: a list of folders, no file is opened."""
        names = [n.removeprefix(f"{PARTITION}=") for n in child_names(self.spark, self.path) if n.startswith(f"{PARTITION}=")]
        return sorted((None if n == NULL_PARTITION else n for n in names), key=lambda part: part or "")

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def touched_parts(self, batch: DataFrame, buckets: Iterable[int], index: KeyIndex | None = None) -> DataFrame:
        """Partitions the batch writes to, or takes a key away from (``left``)."""
        parts = batch.select(PARTITION, F.lit(False).alias("left"))
        index = index or self.index
        if self.keys_may_move and self.exists():
            if not index.exists():
                index.add(self.read().select(*self.keys, PARTITION))
            stored = index.stored_parts(batch.select(*self.keys, PARTITION), buckets)
            moved = stored.filter(~F.col(PARTITION).eqNullSafe(F.col("_part")))
            parts = parts.union(moved.select("_part", F.lit(True)))
        return parts.groupBy(PARTITION).agg(F.max("left").alias("left"))

    def _touched(self, batch: Batch, index: KeyIndex, stored: Iterable[str | None]) -> dict[str | None, bool]:
        """`touched_parts` by name, and whether a key leaves them. A batch that writes to every ``stored`` partition
        touches them all wherever its keys were, so they are not looked up; any may be left."""
        # one row per storage partition: bounded by the table's folders, not by its rows
        if not self.keys_may_move or index.exists():
            own = {r[PARTITION] for r in batch.rows.select(PARTITION).distinct().collect()}
            if own >= set(stored):
                return dict.fromkeys(own, self.keys_may_move)
        return {r[PARTITION]: r["left"] for r in self.touched_parts(batch.rows, batch.buckets, index).collect()}

    def upsert(
        self, batch: DataFrame, merge: Callable[[DataFrame], DataFrame] | None = None, hold: bool = True
    ) -> tuple[dict[str, int], Parts]:
        """Apply ``batch`` (one row per key); counts by outcome, and touched partitions.

        In a merge the batch may name fields that were given as null (``schemas.NULLS``). ``merge`` makes one row per
        key of the rows of repeated keys; without it these are refused. ``hold=False`` for a batch that costs less to
        read again than to keep, as one that is read from a stored table does."""
        self.recover()
        with self._checked(batch, merge, hold) as given:
            touched = self._touched(given, self.index, self.parts())
            if any(touched.values()):
                _as_rows(self.spark, touched).write.parquet(self._vacated_path)
            if self.log_parts:
                log_parts(self.spark, touched, self._log_path)
            current = self.read().filter(in_parts(touched)) if self.parts() else None
            outcome = self._outcome(current, given.rows, given.count)
            # Counted where the rows are written, after the shuffle: a stage that runs again counts once.
            seen = Observation()
            outcome.observe(seen, *outcome_counts(), *self._changes()).write.partitionBy(PARTITION).parquet(self._staged_rows_path)
        found = seen.get
        self._apply(new_places=bool(found.get("_places")))
        left, days = (set(found.get(c) or ()) for c in ("_left", "_days"))
        return {c: found.get(c, 0) for c in COUNTS.values()}, Parts(touched, sorted(left), sorted(left | days))

    def _outcome(self, current: DataFrame | None, batch: DataFrame, count: int | None = None) -> DataFrame:
        """The touched partitions (``current``; None where the table has no row) after ``batch`` (of ``count`` rows),
        with each row's outcome; a partition's rows together. A small batch leaves the stored rows it does not
        name where they are (SMALL_BATCH)."""
        def placed(outcome: DataFrame) -> DataFrame:
            return outcome.withColumn(PARTITION, self.partition_of()) if self.partition_of is not None else outcome

        def applied(stored: DataFrame, given: DataFrame) -> DataFrame:
            return placed(reconcile(stored, given, self.keys, self.merge_fields, self.ignore, self._before(), NULLS))

        large = (batch.count() if count is None else count) > SMALL_BATCH
        if current is None:
            # every row is new: there is nothing to be shuffled for
            were = [F.lit(None).cast("string").alias(c) for c in self._before().values()]
            new = placed(batch.select(*self.schema.fieldNames(), F.lit(INSERTED).alias(STATUS), *were))
            return new.sortWithinPartitions(PARTITION) if large else spread(new, [PARTITION])
        if large:
            # the join has shuffled every row once already: sorted where it lies, a task writes one partition at a
            # time, and no second shuffle moves the whole outcome again
            return applied(current, batch).sortWithinPartitions(PARTITION)
        keys = F.broadcast(batch.select(*self.keys))
        named = current.join(keys, same_keys(current, keys, self.keys), "left_semi")
        kept = current.join(keys, same_keys(current, keys, self.keys), "left_anti")
        # the empty batch makes no join: kept rows are written from the files they were read from
        return spread(applied(named, batch), [PARTITION]).unionByName(applied(kept, batch.limit(0)))

    def _before(self) -> dict[str, str]:
        return {PARTITION: _PART_WAS} | ({self.date: _DATE_WAS} if self.date else {})

    def _changes(self) -> list[Column]:
        """How many keys are new or have moved; days of ``date`` of changed rows, and those that keys have left."""
        changed = F.col(STATUS).isin(INSERTED, UPDATED)
        day, was = (F.substring(F.col(c) if self.date else F.lit(None).cast("string"), 1, 10) for c in (self.date or "", _DATE_WAS))
        return [
            F.count_if(new_place()).alias("_places"),
            F.collect_set(F.when(changed, day)).alias("_days"),
            F.collect_set(F.when((F.col(STATUS) == UPDATED) & ~day.eqNullSafe(was), was)).alias("_left"),
        ]

    @contextmanager
    def _checked(self, batch: DataFrame, merge: Callable[[DataFrame], DataFrame] | None, hold: bool) -> Iterator[Batch]:
        """The batch, held while it is applied, after K5 on it alone, as stored keys are unique. Only the rows of
        repeated keys go through ``merge``; all others are one row per key as they are."""
        nulls = [NULLS] if self.merge_fields and NULLS in batch.columns else []
        columns = [*self.schema.fieldNames(), *nulls]
        with ExitStack() as held:
            def keep(rows: DataFrame) -> DataFrame:
                held.callback(rows.unpersist)
                return rows.persist()

            rows = keep(batch.select(*columns)) if hold else batch.select(*columns)
            each = rows.groupBy(*self.keys).agg(F.count("*").alias("_rows")).withColumn("_bucket", self.index.bucket())
            repeated, count, buckets = each.agg(F.count_if(F.col("_rows") > 1), F.count("*"), F.collect_set("_bucket")).first()
            if repeated and merge is None:
                raise ValueError(f"key {self.keys} is not unique in the batch for {self.path}")
            if repeated > SMALL_BATCH:
                rows = keep(merge(rows).select(*columns))
            elif repeated:
                keys = F.broadcast(keep(each.filter(F.col("_rows") > 1).select(*[F.col(k).alias(f"_again_{k}") for k in self.keys])))
                same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_again_{k}")) for k in self.keys])
                again = keep(merge(rows.join(keys, same, "left_semi")).select(*columns))
                rows = rows.join(keys, same, "left_anti").unionByName(again)
            yield Batch(rows, count, buckets)

    def recover(self) -> bool:
        """Finish an upsert that was written beside the table but not moved in."""
        complete = path_exists(self.spark, f"{self._staged_rows_path}/_SUCCESS")
        if complete:
            self._apply()
        else:
            drop_path(self.spark, self._stage)
        return complete

    def _apply(self, new_places: bool = True) -> None:
        """May run again after it was broken off: what is made from all staged rows is made, and kept beside the table,
        before the first of them moves in."""
        staged = self._staged_rows()
        rows = staged.select(*self.schema.fieldNames())
        if self.keys_may_move and new_places:
            self.index.add(staged.filter(new_place()).select(*self.keys, PARTITION))
        if path_exists(self.spark, self._vacated_path):
            left = {r[0] for r in self.spark.read.schema(_PART_SCHEMA).parquet(self._vacated_path).collect()}
            filled = {r[0] for r in rows.select(PARTITION).filter(in_parts(left)).distinct().collect()}
            if left - filled:
                _as_rows(self.spark, left - filled).write.mode("overwrite").parquet(self._emptied_path)
            drop_path(self.spark, self._vacated_path)
        replace_partitions(rows, self.path, [PARTITION], self._staged_rows_path)
        if path_exists(self.spark, self._emptied_path):
            emptied = self.spark.read.schema(_PART_SCHEMA).parquet(self._emptied_path).collect()
            clear_partitions(self.spark, self.path, [{PARTITION: r[0]} for r in emptied])
        drop_path(self.spark, self._stage)

    def _staged_rows(self) -> DataFrame:
        return self.spark.read.schema(self._staged_schema()).parquet(self._staged_rows_path)

    def _staged_schema(self) -> StructType:
        return StructType(self.schema.fields + [StructField(c, StringType()) for c in (STATUS, *self._before().values())])


def _as_rows(spark: SparkSession, parts: Iterable[str | None]) -> DataFrame:
    return spark.createDataFrame([(part,) for part in parts], _PART_SCHEMA).coalesce(1)


def log_parts(spark: SparkSession, parts: Iterable[str | None], path: str) -> None:
    _as_rows(spark, parts).write.parquet(f"{path}/{uuid.uuid4().hex}")


def new_place() -> Column:
    """Whether the index does not have a staged row's key in this partition."""
    moved = F.col(STATUS).isin(UPDATED, UNCHANGED) & ~F.col(PARTITION).eqNullSafe(F.col(_PART_WAS))
    return (F.col(STATUS) == INSERTED) | moved


def no_changes() -> dict[str, int]:
    return dict.fromkeys(COUNTS.values(), 0)
