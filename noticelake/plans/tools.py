"""The nine query tools (T1-T9) as functions from tables to a DataFrame.

Optional arguments that are empty add no filter (F7). Filters on grouping columns
pass below the aggregate and reach the scan. A limit becomes one top-k; without one,
a tool answers with every row.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake import vocabulary as v
from noticelake.functions import dates, values
from noticelake.functions import predicates as p
from noticelake.operators import rollup
from noticelake.operators.ranking import ordered, top
from noticelake.operators.silver import as_column
from noticelake.sources.tables import Tables, in_parts, published_slice


def contar_registros(tables: Tables, colecao: str) -> DataFrame:
    """T1."""
    return tables.count(colecao)


def resumo_por_estado(
    tables: Tables, periodo: str | None = None, uf: str | None = None, limite: int | None = None
) -> DataFrame:
    """Rows are state x period."""
    rows = tables.in_period(v.GOLD_STATE, periodo).filter(p.every(p.state_is(uf)))
    return top(rows, ("-total_contratacoes", "periodo_inicio", "periodo_fim", "uf"), limite)


def _summary(
    tables: Tables, spec: rollup.Rollup, group: str, name: str, uf: str | None, periodo: str | None, overlap: str
) -> DataFrame:
    """A Gold table summed over states and periods.

    Stored periods overlap by a day, so a sum over all of them counts most
    notices twice (D3); ``overlap="dedupe"`` sums Silver instead, each notice once.
    """
    if overlap not in ("keep", "dedupe"):
        raise ValueError(f"overlap must be 'keep' or 'dedupe', got {overlap!r}")
    if overlap == "keep":
        rows = tables.in_period(spec.table, periodo).filter(p.every(p.state_is(uf)))
    else:
        silver = tables.read(v.SILVER)
        if periodo:
            # the run's own filter: any number of days, partitions pruned
            silver = published_slice(silver, *dates.split_period(periodo), "data_publicacao_pncp")
        rows = rollup.rollup(silver.filter(p.every(p.state_is(uf))), spec)
    summed = rows.groupBy(F.col(group).alias(name)).agg(
        F.sum("total_contratacoes").alias("total_contratacoes"),
        values.money_sum_rounded(F.col("valor_total")).alias("valor_total"),
    )
    return ordered(summed, ("-total_contratacoes", name))


def resumo_por_ramo_mei(
    tables: Tables, uf: str | None = None, periodo: str | None = None, overlap: str = "keep"
) -> DataFrame:
    """T3."""
    return _summary(tables, rollup.AREA, "ramo_mei", "ramo_mei", uf, periodo, overlap)


def resumo_por_faixa_valor(
    tables: Tables, uf: str | None = None, periodo: str | None = None, overlap: str = "keep"
) -> DataFrame:
    """T4, with all five bands."""
    return _summary(tables, rollup.BAND, "faixa_valor", "faixa_valor", uf, periodo, overlap)


def resumo_por_situacao(
    tables: Tables, uf: str | None = None, periodo: str | None = None, overlap: str = "keep"
) -> DataFrame:
    """T5."""
    return _summary(tables, rollup.STATUS, "situacao_nome", "situacao", uf, periodo, overlap)


def evolucao_mensal(tables: Tables, uf: str | None = None, ano: int | None = None, limite: int | None = None) -> DataFrame:
    """T6."""
    rows = tables.read(v.GOLD_MONTH).filter(p.every(p.state_is(uf), p.year_is(ano)))
    return top(rows, ("ano", "mes", "uf"), limite)


def buscar_contratacoes(
    tables: Tables,
    uf: str | None = None,
    data_inicial: str | None = None,
    data_final: str | None = None,
    texto_objeto: str | None = None,
    ramo_mei: str | None = None,
    limite: int | None = None,
    valor_minimo: float | None = None,
) -> DataFrame:
    """T7; ``valor_minimo`` (exclusive) serves the question no tool could answer. An explicit ``limite`` is a
    top-k by date and key.

    On a stored table with text filters only partitions that can hold the text are opened; with a
    ``limite``, partitions are opened in order of date until it is reached."""
    rows, parts = tables.read(v.SILVER), tables.parts(v.SILVER)
    if data_inicial and data_final:
        rows = published_slice(rows, data_inicial, data_final, "data_publicacao_pncp")
        low, high = dates.bounds(data_inicial, data_final)
        parts = parts and [part for part in parts if part is None or low[: len(part)] <= part <= high[: len(part)]]
    possible = tables.text_parts(texto_objeto)
    if possible is not None:
        rows = rows.filter(in_parts(possible))
        parts = parts and [part for part in parts if part in possible]
    rows = rows.filter(
        p.every(
            p.state_is(uf),
            p.text_has(texto_objeto),
            p.category_is(ramo_mei),
            None if valor_minimo is None else F.col("valor_total_estimado") > valor_minimo,
        )
    )
    if limite is not None and limite >= 1 and parts:
        rows = _first_parts(rows, parts, limite)
    return top(rows, ("data_publicacao_pncp", v.SILVER_KEY), limite)


def total_linhas(answer: DataFrame) -> DataFrame:
    """The ``total_*`` that stands beside a tool's rows: how many there are."""
    return answer.agg(F.count("*").alias("total_linhas"))


def _first_parts(rows: DataFrame, parts: list[str | None], limit: int) -> DataFrame:
    """The rows of the first partitions that hold ``limit`` of them together, so that the first rows by date are
    among these. Partitions are named by the leading characters of the date; what has no such date is in
    the null partition and may come anywhere, so that one is always read. Twice as many are tried each time."""
    unnamed, named = [part for part in parts if part is None], [part for part in parts if part is not None]
    take = 1
    while take < len(named):
        # the null partition's rows do not count: they may come after those of partitions not yet opened
        if rows.filter(in_parts(named[:take])).limit(limit).count() >= limit:
            return rows.filter(in_parts([*unnamed, *named[:take]]))
        take *= 2
    return rows


def top_orgaos_contratantes(tables: Tables, uf: str | None = None, limite: int = 10) -> DataFrame:
    """Absent parts of the group are shown as N/A."""
    grouped = (
        tables.read(v.SILVER)
        .filter(p.every(p.state_is(uf)))
        .groupBy("razao_social", F.col("cnpj_orgao").alias("cnpj"), "uf")
        .agg(
            F.count("*").alias("total_contratacoes"),
            values.money_sum_rounded(F.col("valor_total_estimado")).alias("valor_total"),
        )
    )
    # ranked before naming: a null part and a literal "N/A" stay different groups
    best = top(grouped, ("-total_contratacoes", "cnpj", "razao_social", "uf"), limite)
    named = {c: F.coalesce(F.col(c), F.lit(v.ABSENT)) for c in ("razao_social", "cnpj", "uf")}
    return best.withColumns(named)


def painel(tables: Tables) -> DataFrame:
    """Rows of each of the seven tables."""
    return reduce(DataFrame.unionByName, [tables.count(name) for name in v.ALL_TABLES])


def estatisticas_gerais(tables: Tables, as_of: datetime | Column | None = None) -> DataFrame:
    """T9 in one row: counts, the contract of greatest value, the latest load.

    Silver is read once for its count, arg-max (A13) and latest load (A14); the
    one-row pieces meet in a union, not in a join.
    """
    greatest = F.max_by(
        F.struct("valor_total_estimado", "objeto_compra", "uf"), F.struct("valor_total_estimado", v.SILVER_KEY)
    )
    silver = tables.read(v.SILVER).agg(
        F.lit(v.SILVER).alias("colecao"),
        F.count("*").alias("total"),
        greatest.alias("maior_contratacao"),
        F.max("data_coleta").alias("ultima_atualizacao"),
    )
    others = [tables.count(name) for name in v.ALL_TABLES if name != v.SILVER]
    pieces = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), others, silver)

    def total(name: str) -> Column:
        return F.max(F.when(F.col("colecao") == name, F.col("total")))

    is_silver = F.col("colecao") == v.SILVER
    return pieces.agg(
        total(v.BRONZE).alias("camada_bronze_raw"),
        total(v.SILVER).alias("camada_silver_processadas"),
        *[total(name).alias(name) for name in v.GOLD_TABLES],
        F.max_by("maior_contratacao", is_silver.cast("int")).alias("maior_contratacao"),
        F.max("ultima_atualizacao").alias("ultima_atualizacao"),
    ).withColumn("timestamp_consulta", as_column(as_of))


TOOLS = {
    tool.__name__: tool
    for tool in (
        contar_registros,
        resumo_por_estado,
        resumo_por_ramo_mei,
        resumo_por_faixa_valor,
        resumo_por_situacao,
        evolucao_mensal,
        buscar_contratacoes,
        top_orgaos_contratantes,
        estatisticas_gerais,
    )
}


def call(tables: Tables, name: str, **arguments) -> DataFrame:
    """A tool by name."""
    if name not in TOOLS:
        raise KeyError(f"Ferramenta desconhecida: {name}")
    return TOOLS[name](tables, **arguments)
