"""Keyed tables whose readers switch to a new version at once (K1, K2, K3).

An upsert writes the partitions it touches once, into a folder of its own, and then publishes the version: one small
file that says in which folder each partition lies. It is created exclusively, so of two upserts that
began from the same version one is published and the other fails without a trace. Folders are not changed once they are
published: whoever has opened a version goes on reading it until `expire` drops what no kept version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation

from noticelake.operators.reconcile import COUNTS, outcome_counts
from noticelake.schemas import PARTITION
from noticelake.sinks import key_index
from noticelake.sinks.key_index import KeyIndex
from noticelake.sinks.keyed import KeyedTable, Parts, log_parts, new_place
from noticelake.sinks.partitions import NULL_PARTITION
from noticelake.sources.tables import in_parts
from noticelake.workspace import child_names, create_exclusively, drop_path, read_text


class ConcurrentUpsert(RuntimeError):
    """Another upsert was published meanwhile; nothing was changed, the batch can be applied again."""


@dataclass(frozen=True)
class Version:
    """Where each partition lies, and the rounds of the key index: as many entries as there are partitions."""

    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    rounds: tuple[str, ...] = ()


@dataclass(frozen=True)
class VersionedTable(KeyedTable):
    @property
    def _versions_path(self) -> str:
        return f"{self.path}/_versions"

    def versions(self) -> list[int]:
        return sorted(int(name) for name in child_names(self.spark, self._versions_path) if name.isdigit())

    def version(self, number: int | None = None) -> Version:
        """A published version, the last one if none is named."""
        numbers = self.versions()
        if not numbers:
            return Version()
        number = numbers[-1] if number is None else number
        told = json.loads(read_text(self.spark, f"{self._versions_path}/{number:08d}"))
        return Version(number, told["folders"], tuple(told["rounds"]))

    @property
    def index(self) -> KeyIndex:
        return self._index_of(self.version())

    def _index_of(self, version: Version) -> KeyIndex:
        rounds = tuple(f"{self.path}/{r}" for r in version.rounds)
        return KeyIndex(self.spark, self.path, tuple(self.schema[k] for k in self.keys), self.index_buckets, rounds)

    def exists(self) -> bool:
        return bool(self.versions())

    def parts(self) -> list[str | None]:
        return sorted((None if n == NULL_PARTITION else n for n in self.version().folders), key=lambda part: part or "")

    def read(self, number: int | None = None) -> DataFrame:
        """A version's rows; publishing another one does not change them."""
        return self._rows(self.version(number))

    def _rows(self, version: Version, parts: set[str | None] | None = None) -> DataFrame:
        wanted = None if parts is None else {NULL_PARTITION if p is None else p for p in parts}
        folders = [f"{self.path}/{folder}/{PARTITION}={name}" for name, folder in version.folders.items() if wanted is None or name in wanted]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders).select(*self.schema.names)

    def recover(self) -> bool:
        """Nothing to finish: an upsert that was not published is no version."""
        return False

    def upsert(
        self, batch: DataFrame, merge: Callable[[DataFrame], DataFrame] | None = None, hold: bool = True
    ) -> tuple[dict[str, int], Parts]:
        """Apply ``batch`` (see `KeyedTable.upsert`) and publish the outcome; counts by outcome, and touched partitions."""
        now = self.version()
        own = f"_versao={now.number + 1}-{uuid.uuid4().hex[:12]}"
        with self._checked(batch, merge, hold) as given:
            touched = set(self._touched(given, self._index_of(now), (None if n == NULL_PARTITION else n for n in now.folders)))
            current = self._rows(now, touched).filter(in_parts(touched)) if now.folders else None
            outcome = self._outcome(current, given.rows, given.count)
            if self.log_parts:
                log_parts(self.spark, touched, self._log_path)
            seen = Observation()
            outcome.observe(seen, *outcome_counts(), *self._changes()).write.partitionBy(PARTITION).parquet(f"{self.path}/{own}")
        found = seen.get
        names = [n.removeprefix(f"{PARTITION}=") for n in child_names(self.spark, f"{self.path}/{own}") if n.startswith(f"{PARTITION}=")]
        gone = {NULL_PARTITION if part is None else part for part in touched}
        folders = {n: f for n, f in now.folders.items() if n not in gone} | dict.fromkeys(names, own)
        rounds = self._add_places(now, own, names) if self.keys_may_move and found.get("_places") else now.rounds
        told = json.dumps({"folders": folders, "rounds": rounds})
        if not create_exclusively(self.spark, f"{self._versions_path}/{now.number + 1:08d}", told):
            drop_path(self.spark, f"{self.path}/{own}")
            drop_path(self.spark, f"{self.path}/_index-{own}")
            raise ConcurrentUpsert(f"version {now.number + 1} of {self.path} was published by another upsert")
        left, days = (set(found.get(c) or ()) for c in ("_left", "_days"))
        return {c: found.get(c, 0) for c in COUNTS.values()}, Parts(touched, sorted(left), sorted(left | days))

    def _add_places(self, now: Version, own: str, names: list[str]) -> tuple[str, ...]:
        """Index rounds with one for the new and moved keys among the rows just written; after many rounds, a single one."""
        written = self.spark.read.schema(self._staged_schema()).option("basePath", f"{self.path}/{own}").parquet(*[f"{self.path}/{own}/{PARTITION}={n}" for n in names])
        index, round_ = self._index_of(now), f"_index-{own}"
        index.write_round(written.filter(new_place()), f"{self.path}/{round_}/new")
        rounds = (*now.rounds, f"{round_}/new")
        if len(rounds) <= key_index.ROUNDS:
            return rounds
        index.write_round(self._index_of(Version(now.number, rounds=rounds)).read(), f"{self.path}/{round_}/all")
        return (f"{round_}/all",)

    def expire(self, keep: int = 2) -> None:
        """Drop all but the last ``keep`` versions, and folders that no kept one names. Only when no upsert is running
        and nobody reads an older version."""
        kept = [self.version(n) for n in self.versions()[-keep:]]
        used = {f for x in kept for f in x.folders.values()} | {r.split("/")[0] for x in kept for r in x.rounds}
        for number in self.versions()[:-keep]:
            drop_path(self.spark, f"{self._versions_path}/{number:08d}")
        for name in child_names(self.spark, self.path):
            if name != "_versions" and name not in used:
                drop_path(self.spark, f"{self.path}/{name}")
