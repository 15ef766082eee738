"""Stored tables by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.functions import dates
from noticelake.functions import predicates as p
from noticelake.schemas import PARTITION


class Tables:
    """Names to DataFrames; a table is opened when it is asked for."""

    def __init__(
        self,
        spark: SparkSession,
        frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
        by_period: Mapping[str, Callable[[str, str], DataFrame]] | None = None,
        parts: Mapping[str, Callable[[], list[str | None]]] | None = None,
        text_parts: Callable[[str], set[str | None] | None] | None = None,
    ):
        """``by_period``: how to make one period's rows of a table that is a view. ``parts``: the storage partitions
        of a table, in order. ``text_parts``: those of Silver that can hold a text which matches a pattern."""
        self.spark = spark
        self._parts = dict(parts or {})
        self._text_parts = text_parts
        self._frames = dict(frames)
        self._by_period = dict(by_period or {})

    def read(self, name: str) -> DataFrame:
        """S7."""
        frame = self._frames[name]
        return frame() if callable(frame) else frame

    def parts(self, name: str) -> list[str | None] | None:
        """Storage partitions in order, null first; None where the table is not stored in partitions."""
        return self._parts[name]() if name in self._parts else None

    def text_parts(self, pattern: str | None) -> set[str | None] | None:
        return self._text_parts(pattern) if pattern and self._text_parts else None

    def in_period(self, name: str, period: str | None) -> DataFrame:
        """the rows of one period (all without one). A stored table prunes its partitions by the filter;
        a view is made from the rows of those days alone."""
        if not period:
            return self.read(name)
        start, end = dates.split_period(period)
        made = self._by_period.get(name)
        return (made(start, end) if made else self.read(name)).filter(p.every(p.period_is(period)))

    def count(self, name: str) -> DataFrame:
        """One row (colecao, total); a name nobody stored has no rows."""
        if name not in self._frames:
            return self.spark.range(1).select(F.lit(name).alias("colecao"), F.lit(0).cast("long").alias("total"))
        return self.read(name).agg(F.lit(name).alias("colecao"), F.count("*").alias("total"))


def in_parts(parts: Iterable[str | None]) -> Column:
    """Rows of these storage partitions."""
    parts = list(parts)
    named = F.col(PARTITION).isin([part for part in parts if part is not None])
    return named | F.col(PARTITION).isNull() if None in parts else named


def published_slice(
    table: DataFrame, start: str, end: str, column: str, uf_column: str | None = None, uf: str | None = None
) -> DataFrame:
    """Rows of a date range: the exact text filter, and the partition filter it implies."""
    prune = dates.part_between(F.col(PARTITION), start, end) if PARTITION in table.columns else None
    in_state = p.state_is(uf, uf_column) if uf_column else None
    return table.filter(p.every(prune, p.published(start, end, column), in_state))


def bronze_slice(bronze: DataFrame, start: str, end: str, uf: str | None = None) -> DataFrame:
    """S5."""
    return published_slice(bronze, start, end, "dataPublicacaoPncp", "unidadeOrgao.ufSigla", uf)


def silver_slice(silver: DataFrame, start: str, end: str) -> DataFrame:
    """S6."""
    return published_slice(silver, start, end, "data_publicacao_pncp")
