"""The questions users are shown, as queries (§2.14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake import vocabulary as v
from noticelake.functions import values
from noticelake.operators.ranking import ordered, top
from noticelake.plans import tools
from noticelake.sources.tables import Tables


def busiest_state(tables: Tables) -> DataFrame:
    """State (and period) with most contracts."""
    return tools.resumo_por_estado(tables, limite=1)


def total_value_in(tables: Tables, uf: str) -> DataFrame:
    """Total value of a state over its stored rows."""
    rows = tables.read(v.GOLD_STATE).filter(F.col("uf") == uf.upper())
    return rows.groupBy("uf").agg(values.money_sum_rounded(F.col("valor_total")).alias("valor_total"))


def richest_category(tables: Tables) -> DataFrame:
    """Category with the greatest value."""
    return top(tools.resumo_por_ramo_mei(tables), ("-valor_total", "ramo_mei"), 1)


def above_value(tables: Tables, ramo_mei: str, minimum: float) -> DataFrame:
    """Every contract of a category above a value."""
    rows = tables.read(v.SILVER)
    return rows.filter((F.col("ramo_mei") == ramo_mei) & (F.col("valor_total_estimado") > minimum))


def state_regions(spark: SparkSession) -> DataFrame:
    """(uf, regiao) of the 27 Brazilian states."""
    pairs = [(uf, region) for region, states in v.REGIONS.items() for uf in states]
    return spark.createDataFrame(pairs, "uf string, regiao string")


def compare_region(tables: Tables, regions: DataFrame, regiao: str) -> DataFrame:
    """States of one region side by side.

    ``regions`` has a row per state; whether it is broadcast is left to Spark,
    which knows its size.
    """
    wanted = regions.filter(F.col("regiao") == regiao).select("uf")
    return _by_state(tables.read(v.GOLD_STATE).join(wanted, "uf", "left_semi"))


def compare_states(tables: Tables, states: Sequence[str]) -> DataFrame:
    """Named states side by side."""
    return _by_state(tables.read(v.GOLD_STATE).filter(F.col("uf").isin([s.upper() for s in states])))


def _by_state(rows: DataFrame) -> DataFrame:
    summed = rows.groupBy("uf").agg(
        F.sum("total_contratacoes").alias("total_contratacoes"),
        values.money_sum_rounded(F.col("valor_total")).alias("valor_total"),
    )
    return ordered(summed, ("-total_contratacoes", "uf"))
