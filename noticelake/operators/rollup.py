"""Gold aggregates.

A Gold table is a `Rollup`: grouping keys, measures, order. All five are computed
in one of three ways with equal results:

* `rollup`        one table from Silver rows;
* `from_cells`    one table from the shared pre-aggregate `cells`;
* `grouping_sets` all five in one query, the row copies made after `cells` has
                  pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake import vocabulary as v
from noticelake.functions import values
from noticelake.operators.ranking import ordered
from noticelake.operators.silver import as_column, with_dimensions

VALUE = "valor_total_estimado"
BUYER = "cnpj_orgao"
SKETCH = "_orgaos"
SKETCH_LG_K = 14


@dataclass(frozen=True)
class Rollup:
    table: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    order: tuple[str, ...]
    by_period: bool = True


AREA = Rollup(
    v.GOLD_AREA, ("uf", "ramo_mei"), ("total_contratacoes", "valor_total", "valor_maximo"),
    ("uf", "-total_contratacoes", "ramo_mei"),
)
STATE = Rollup(
    v.GOLD_STATE, ("uf",), ("total_contratacoes", "valor_total", "orgaos_distintos"),
    ("-total_contratacoes", "uf"),
)
BAND = Rollup(
    v.GOLD_BAND, ("uf", "faixa_valor"), ("total_contratacoes", "valor_total"), ("uf", "faixa_valor"),
)
STATUS = Rollup(
    v.GOLD_STATUS, ("uf", "situacao_nome"), ("total_contratacoes", "valor_total"),
    ("uf", "-total_contratacoes", "situacao_nome"),
)
MONTH = Rollup(
    v.GOLD_MONTH, ("uf", "ano", "mes"), ("total_contratacoes", "valor_total", "orgaos_distintos"),
    ("uf", "ano", "mes"), by_period=False,
)
ROLLUPS = {r.table: r for r in (AREA, STATE, BAND, STATUS, MONTH)}

DIMENSIONS = ("uf", "ramo_mei", "faixa_valor", "situacao_nome", "ano", "mes", BUYER)


def _over_rows(measure: str) -> Column:
    value = F.col(VALUE)
    return {
        "total_contratacoes": lambda: F.count("*"),
        "valor_total": lambda: values.money_sum(value),
        "valor_maximo": lambda: values.zero_if_null(F.max(value)),
        "orgaos_distintos": lambda: F.count_distinct(F.col(BUYER)),
    }[measure]().alias(measure)


def _over_cells(measure: str) -> Column:
    return {
        "total_contratacoes": lambda: F.sum("_linhas"),
        "valor_total": lambda: values.join_parts(F.sum("_valor"), F.sum("_valor_fora")),
        "valor_maximo": lambda: values.zero_if_null(F.max("_maior")),
        "orgaos_distintos": lambda: F.count_distinct(F.col(BUYER)),
    }[measure]().alias(measure)


def rollup(silver: DataFrame, spec: Rollup, extra_keys: Iterable[str] = ()) -> DataFrame:
    """One Gold table from Silver rows.

    Counts and sums are combined in the map tasks. The distinct count is exact:
    Spark shuffles by (keys, buyer) first, so one huge state does not meet in one
    task before it has shrunk to a row per buyer and task.
    """
    keys = (*extra_keys, *spec.keys)
    return with_dimensions(silver).groupBy(*keys).agg(*[_over_rows(m) for m in spec.measures])


def rollup_approximate(silver: DataFrame, spec: Rollup, relative_error: float = 0.01) -> DataFrame:
    """`rollup` with sketched distinct counts: one shuffle, usable on streams."""
    measures = [
        F.approx_count_distinct(BUYER, relative_error).alias(m) if m == "orgaos_distintos" else _over_rows(m)
        for m in spec.measures
    ]
    return with_dimensions(silver).groupBy(*spec.keys).agg(*measures)


def cells(silver: DataFrame, extra_keys: Iterable[str] = ()) -> DataFrame:
    """Finest pre-aggregate all five tables can be built from."""
    value = F.col(VALUE)
    return (
        with_dimensions(silver)
        .groupBy(*extra_keys, *DIMENSIONS)
        .agg(
            F.count("*").alias("_linhas"),
            F.sum(values.fixed_part(value)).alias("_valor"),
            F.sum(values.outlier_part(value)).alias("_valor_fora"),
            F.max(value).alias("_maior"),
        )
    )


def sketch_cells(silver: DataFrame, extra_keys: Iterable[str] = (), lg_k: int = SKETCH_LG_K) -> DataFrame:
    """`cells` with a sketch of the buyers in place of a row per buyer: as many rows as there are groups, whatever
    the number of buyers. Sketches of cells merge to those of periods, months and totals.

    The standard error of a count is 1.04 / 2 ** (lg_k / 2), 0.8 % by default; up to about 2 ** lg_k / 8 buyers
    a sketch holds their hashes and the count is right."""
    value = F.col(VALUE)
    return (
        with_dimensions(silver)
        .groupBy(*extra_keys, *[d for d in DIMENSIONS if d != BUYER])
        .agg(
            F.count("*").alias("_linhas"),
            F.sum(values.fixed_part(value)).alias("_valor"),
            F.sum(values.outlier_part(value)).alias("_valor_fora"),
            F.max(value).alias("_maior"),
            F.hll_sketch_agg(BUYER, lg_k).alias(SKETCH),
        )
    )


def without_buyers(cell_rows: DataFrame, extra_keys: Iterable[str] = ()) -> DataFrame:
    """Cells added up over the buyers, for tables that do not count them; cells with sketches have no row per buyer
    and stay as they are."""
    if SKETCH in cell_rows.columns:
        return cell_rows
    keys = dict.fromkeys((*extra_keys, *[d for d in DIMENSIONS if d not in (BUYER, "ano")]))
    return cell_rows.groupBy(*keys).agg(
        F.sum("_linhas").alias("_linhas"), F.sum("_valor").alias("_valor"),
        F.sum("_valor_fora").alias("_valor_fora"), F.max("_maior").alias("_maior"),
    )


def _over_sketches(measure: str) -> Column:
    if measure == "orgaos_distintos":
        return F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(measure)
    return _over_cells(measure)


def from_cells(cell_rows: DataFrame, spec: Rollup, extra_keys: Iterable[str] = ()) -> DataFrame:
    """One Gold table from cells of either kind."""
    over = _over_sketches if SKETCH in cell_rows.columns else _over_cells
    return cell_rows.groupBy(*extra_keys, *spec.keys).agg(*[over(m) for m in spec.measures])


def grouping_sets(silver: DataFrame) -> DataFrame:
    """A6 in one query: rows of all five tables, told apart by ``tabela``."""
    keys = list(dict.fromkeys(k for r in ROLLUPS.values() for k in r.keys))
    measures = list(dict.fromkeys(m for r in ROLLUPS.values() for m in r.measures))
    grouped = cells(silver).groupingSets([list(r.keys) for r in ROLLUPS.values()], *keys)

    def bits(spec: Rollup) -> int:
        # grouping_id: one bit per key, set when the key is aggregated away
        return sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in spec.keys)

    table = F.lit(None).cast("string")
    for spec in ROLLUPS.values():
        table = F.when(F.col("_conjunto") == bits(spec), F.lit(spec.table)).otherwise(table)
    return (
        grouped.agg(F.grouping_id().alias("_conjunto"), *[_over_cells(m) for m in measures])
        .select(table.alias("tabela"), *keys, *measures)
    )


def stamp(df: DataFrame, period: tuple[str, str] | None, as_of: datetime | Column | None = None) -> DataFrame:
    """Constant period columns in front, refresh time at the end."""
    constants = [] if period is None else [
        F.lit(period[0]).alias("periodo_inicio"), F.lit(period[1]).alias("periodo_fim"),
    ]
    return df.select(*constants, *df.columns, as_column(as_of).alias("data_atualizacao"))


def in_order(df: DataFrame, spec: Rollup) -> DataFrame:
    """O1-O4 with the keys as tie-break."""
    return ordered(df, spec.order)
