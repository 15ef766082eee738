"""Where a key is stored: an index from key to storage partition (K1, K2).

A Parquet table beside the keyed one, with a row per key and change, split by hash of the key into
``buckets`` folders. An upsert opens the buckets of its batch alone, and appends a row for each key that is new or
has moved: it costs what the batch holds, not what the table holds. Rows are appended in numbered rounds
and the last one of a key counts, so a round that is written twice does no harm. After ``ROUNDS`` rounds the index is
written anew with one row per key. It can be removed as a whole: the next upsert builds it from the table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from noticelake.operators import latest
from noticelake.operators.reconcile import same_keys
from noticelake.schemas import PARTITION
from noticelake.workspace import child_names, drop_path

ROUND, BUCKET = "_round", "_bucket"
ROUNDS = 64


@dataclass(frozen=True)
class KeyIndex:
    spark: SparkSession
    path: str
    keys: tuple[StructField, ...]
    buckets: int = 64
    #: The rounds that count, in order, where another than the index itself keeps them.
    folders: tuple[str, ...] | None = None

    @property
    def names(self) -> list[str]:
        return [k.name for k in self.keys]

    @property
    def _schema(self) -> StructType:
        return StructType([*self.keys, StructField(PARTITION, StringType()), StructField(ROUND, IntegerType()), StructField(BUCKET, IntegerType())])

    def rounds(self) -> list[int]:
        """Rounds that were written whole."""
        found = [m for m in (re.fullmatch(rf"{ROUND}=(\d+)", name) for name in child_names(self.spark, self.path)) if m]
        return sorted(int(m[1]) for m in found if "_SUCCESS" in child_names(self.spark, f"{self.path}/{m[0]}"))

    def exists(self) -> bool:
        return bool(self.rounds() if self.folders is None else self.folders)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.names), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """Keys with the partition that each is stored in, of some buckets or all."""
        if not self.exists():
            return self.spark.createDataFrame([], StructType([*self.keys, StructField(PARTITION, StringType())]))
        if self.folders is None:
            folders = [f"{self.path}/{ROUND}={n}" for n in self.rounds()]
            last_only = len(folders) == 1
            rows = self.spark.read.schema(self._schema).option("basePath", self.path).parquet(*folders)
        else:
            schema = StructType([f for f in self._schema.fields if f.name != ROUND])
            each = [self.spark.read.schema(schema).parquet(f).withColumn(ROUND, F.lit(n)) for n, f in enumerate(self.folders)]
            rows = reduce(DataFrame.unionByName, each)
            last_only = len(each) == 1
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
        # a round has one row per key
        return (rows if last_only else latest.keep_last(rows, self.names, [ROUND])).select(*self.names, PARTITION)

    def stored_parts(self, batch: DataFrame, buckets: Iterable[int]) -> DataFrame:
        """Rows of ``batch`` whose key is stored, with the partition it is stored in as ``_part``."""
        there = self.read(buckets).withColumnRenamed(PARTITION, "_part")
        return batch.join(there, same_keys(batch, there, self.names)).select(*[batch[c] for c in batch.columns], "_part")

    def add(self, rows: DataFrame) -> None:
        """Rows (keys, partition) that are new or have moved."""
        rounds = self.rounds()
        number = max(rounds, default=-1) + 1
        self.write_round(rows, f"{self.path}/{ROUND}={number}")
        if len(rounds) >= ROUNDS:
            self.write_round(self.read(), f"{self.path}/{ROUND}={number + 1}")
            for old in [*rounds, number]:
                drop_path(self.spark, f"{self.path}/{ROUND}={old}")

    def write_round(self, rows: DataFrame, folder: str) -> None:
        table = rows.select(*self.names, PARTITION, self.bucket()).hint("rebalance", BUCKET)
        # what a lost run left of a round is no round
        table.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
