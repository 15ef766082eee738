"""Missing pages as a stream (S3): what is late is reported, and taken back when it lands."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

LATE, LANDED = "ausente", "chegou"
EVENTS = "lote string, pagina int, estado string"
#: Pages whose marks are one entry of a run's state, a bit each.
BLOCK = 8192

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Marks:
    """One bit a page in a map state, a block at a time."""

    def __init__(self, state):
        self._state, self._blocks, self._changed = state, {}, set()

    def _block(self, number: int) -> bytearray:
        if number not in self._blocks:
            stored = self._state.getValue((number,)) if self._state.containsKey((number,)) else None
            self._blocks[number] = bytearray(stored[0]) if stored else bytearray(BLOCK // 8)
        return self._blocks[number]

    def has(self, page: int) -> bool:
        number, place = divmod(page - 1, BLOCK)
        return bool(self._block(number)[place // 8] >> place % 8 & 1)

    def put(self, page: int, on: bool) -> None:
        number, place = divmod(page - 1, BLOCK)
        bits, mask = self._block(number), 1 << place % 8
        bits[place // 8] = bits[place // 8] | mask if on else bits[place // 8] & ~mask
        self._changed.add(number)

    def store(self) -> None:
        for number in self._changed:
            self._state.updateValue((number,), (bytes(self._blocks[number]),))


class LatePages(StatefulProcessor):
    """A run's state: how many pages it announced, which have landed, which were reported. A timer is set anew with
    every landing; when it fires, announced pages that have not landed are reported once."""

    def __init__(self, patience_ms: int):
        self._patience = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._total = handle.getValueState("total", "total int")
        self._seen = handle.getMapState("seen", "block int", "bits binary")
        self._told = handle.getMapState("told", "block int", "bits binary")
        self._timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        total = self._total.get()[0] if self._total.exists() else 0
        seen, told, newest = _Marks(self._seen), _Marks(self._told), 0
        for row in rows:
            total = max(total, row.totalPaginas or 0)
            newest = max(newest, int(row.chegada.timestamp() * 1000))
            if row.pagina is not None and row.pagina > 0:
                if told.has(row.pagina):
                    told.put(row.pagina, False)
                    yield Row(lote=key[0], pagina=row.pagina, estado=LANDED)
                seen.put(row.pagina, True)
        self._total.update((total,))
        seen.store()
        told.store()
        if self._timer.exists():
            self._handle.deleteTimer(self._timer.get()[0])
        self._timer.update((newest + self._patience,))
        self._handle.registerTimer(newest + self._patience)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        seen, told = _Marks(self._seen), _Marks(self._told)
        for page in range(1, (self._total.get()[0] if self._total.exists() else 0) + 1):
            if not seen.has(page) and not told.has(page):
                told.put(page, True)
                yield Row(lote=key[0], pagina=page, estado=LATE)
        told.store()
        self._timer.clear()

    def close(self) -> None:
        pass


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """Map state and timers need this state store; a query keeps the one it was started with."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def late_pages(pages: DataFrame, patience: str = "1 hour", delay: str = "0 seconds") -> DataFrame:
    """Events of a stream of pages (lote, pagina, totalPaginas, chegada): a page is ``ausente`` when its run has landed
    nothing for ``patience`` and it is still not there, ``chegou`` when it lands after that."""
    seconds = pages.sparkSession.sql(f"select cast(interval '{patience}' as interval day to second) as i").first()["i"]
    timed = pages.select("lote", "pagina", "totalPaginas", F.col("chegada").cast("timestamp").alias("chegada")).withWatermark("chegada", delay)
    return timed.groupBy("lote").transformWithState(
        LatePages(int(seconds.total_seconds() * 1000)), outputStructType=EVENTS, outputMode="Append", timeMode="eventTime"
    )


def late_page_stream(pages: DataFrame, path: str, checkpoint: str, patience: str = "1 hour") -> StreamingQuery:
    """The events appended to a folder; what has landed so far, then stop."""
    with _rocksdb(pages.sparkSession):
        return (
            late_pages(pages, patience).writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def still_missing(events: DataFrame) -> DataFrame:
    """Pages reported and not taken back; the order of events does not matter, as the two alternate."""
    balance = F.sum(F.when(F.col("estado") == LATE, 1).otherwise(-1))
    return events.groupBy("lote", "pagina").agg(balance.alias("_saldo")).filter("_saldo > 0").drop("_saldo")
