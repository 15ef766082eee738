"""Arguments of the tools."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from noticelake import schemas
from noticelake import vocabulary as v
from noticelake.operators.ranking import top
from noticelake.plans import questions, tools
from noticelake.sources.tables import Tables


@pytest.fixture(scope="module")
def tables(spark):
    names = [*v.SILVER_COLUMNS, "ramo_mei"]
    base = dict.fromkeys(names)
    rows = []
    for i in range(60):
        row = {**base, "numero_controle_pncp": f"{i:03d}", "uf": "PE", "data_publicacao_pncp": "2026-01-01", "ramo_mei": "TI",
               "objeto_compra": "Aquisição", "valor_total_estimado": float(i), "cnpj_orgao": "1", "razao_social": "A"}
        rows.append(tuple(row[n] for n in names))
    rows += [tuple({**base, "numero_controle_pncp": "x"}[n] for n in names)] * 1
    schema = schemas.SILVER.fields[: len(v.SILVER_COLUMNS)] + [f for f in schemas.SILVER.fields if f.name == "ramo_mei"]
    silver = spark.createDataFrame(rows, type(schemas.SILVER)(schema)).withColumn("data_coleta", F.current_timestamp())
    state = spark.createDataFrame(
        [("20260101", "20260102", "PE", 5, 10.005, 1), ("20260102", "20260103", "PE", 5, 1.0, 1), ("20260101", "20260102", "AL", 7, 2.0, 1),
         ("20260101", "20260102", "SP", 9, 3.0, 1)],
        "periodo_inicio string, periodo_fim string, uf string, total_contratacoes long, valor_total double, orgaos_distintos long",
    )
    return Tables(spark, {v.SILVER: silver, v.GOLD_STATE: lambda: state})


def test_unknown_names(tables):
    with pytest.raises(KeyError):
        tools.call(tables, "outra")
    assert tools.contar_registros(tables, "outra").first()["total"] == 0
    assert tools.contar_registros(tables, v.SILVER).first()["total"] == 61


def test_limits(spark, tables):
    assert tools.buscar_contratacoes(tables, limite=500).count() == 61
    assert tools.buscar_contratacoes(tables).count() == 61
    assert tools.buscar_contratacoes(tables, limite=55).count() == 55
    assert tools.resumo_por_estado(tables, limite=2).count() == 2
    for bad in (0, -1):
        with pytest.raises(ValueError):
            top(spark.range(3), ["id"], bad)


def test_empty_arguments_add_no_filter(tables):
    assert tools.resumo_por_estado(tables, periodo="", uf="").count() == 4
    assert tools.resumo_por_estado(tables, periodo="20260101_20260102").count() == 3
    assert tools.resumo_por_estado(tables, uf="pe").count() == 2
    half = tools.buscar_contratacoes(tables, data_inicial="20270101", limite=50)
    assert half.count() == 50  # a date alone is no filter


def test_ties_are_in_a_fixed_order(tables):
    rows = tools.resumo_por_estado(tables).collect()
    assert [(r["uf"], r["periodo_inicio"]) for r in rows] == [
        ("SP", "20260101"), ("AL", "20260101"), ("PE", "20260101"), ("PE", "20260102"),
    ]


def test_search_text_is_a_regex_and_value_a_filter(tables):
    assert tools.buscar_contratacoes(tables, texto_objeto="^AQUISIÇÃO$", limite=50).count() == 50
    assert tools.buscar_contratacoes(tables, texto_objeto="^AQUISIÇÃO$").count() == 60
    assert tools.buscar_contratacoes(tables, texto_objeto="obra").count() == 0
    assert tools.buscar_contratacoes(tables, valor_minimo=57.0).count() == 2


def test_absent_buyer_is_named(tables):
    rows = [tuple(r) for r in tools.top_orgaos_contratantes(tables).collect()]
    assert [r[:4] for r in rows] == [("A", "1", "PE", 60), ("N/A", "N/A", "N/A", 1)]
    assert rows[1][4] == 0.0


def test_regions_of_brazil(spark, tables):
    regions = questions.state_regions(spark)
    assert regions.count() == 27 and regions.select("uf").distinct().count() == 27
    got = [(r["uf"], r["total_contratacoes"]) for r in questions.compare_region(tables, regions, "Nordeste").collect()]
    assert got == [("PE", 10), ("AL", 7)]


def test_bad_overlap(tables):
    with pytest.raises(ValueError):
        tools.resumo_por_ramo_mei(tables, overlap="x")
