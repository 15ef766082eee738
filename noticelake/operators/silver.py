"""Bronze records to flat, classified Silver rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from noticelake import vocabulary as v
from noticelake.functions import dates, text, values
from noticelake.schemas import PARTITION, SILVER_TYPES

_TYPED_BY = {DoubleType(): values.to_double, IntegerType(): values.to_whole}


def as_column(moment: datetime | Column | None) -> Column:
    """Load time: the given one, or now."""
    if moment is None:
        return F.current_timestamp()
    return moment if isinstance(moment, Column) else F.lit(moment)


def flatten(bronze: DataFrame) -> DataFrame:
    """P1 + P2: the 13 flat, typed columns."""
    def column(name: str, path: str) -> Column:
        typed = _TYPED_BY.get(SILVER_TYPES.get(name), lambda raw: raw)
        return typed(F.col(path)).alias(name)

    return bronze.select([column(name, path) for name, path in v.SILVER_COLUMNS.items()])


def classify(df: DataFrame, source: str = "objeto_compra", target: str = "ramo_mei", **rules) -> DataFrame:
    """P3 on any text column, with the default or other rules."""
    return df.withColumn(target, text.first_rule(F.col(source), **rules))


def stamp_load(df: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """P5."""
    return df.withColumn("data_coleta", as_column(as_of))


def add_partition(df: DataFrame, source: str, grain: str = "day") -> DataFrame:
    return df.withColumn(PARTITION, dates.publication_part(F.col(source), grain))


def with_dimensions(silver: DataFrame) -> DataFrame:
    """The derived columns Gold groups by: value band (P4), year (P8), month."""
    return silver.withColumns(
        {
            "faixa_valor": values.band(F.col("valor_total_estimado")),
            "ano": F.col("ano_compra").cast("int"),
            "mes": dates.month_of(F.col("data_publicacao_pncp")),
        }
    )
