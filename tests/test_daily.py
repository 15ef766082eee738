"""The daily run on stored tables, and relations between the Gold tables."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from noticelake import vocabulary as v
from noticelake.operators import periods, rollup
from noticelake.plans import daily, tools
from noticelake.registry.notices import silver_rows
from noticelake.sinks import json_rows
from noticelake.sources import pages
from noticelake.sources.tables import silver_slice
from tests.test_pages import land, notice

AS_OF = dt.datetime(2026, 2, 1)
SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module", params=["day", "year"])
def lake(spark, tmp_path_factory, request):
    """Three runs: a first one, one that changes and moves notices, one without any record."""
    root = tmp_path_factory.mktemp("lake")
    lake = daily.Lake(spark, str(root / "tables"), request.param)
    sp = {"unidadeOrgao": {"municipioNome": "Santos", "ufSigla": "SP"}, "orgaoEntidade": {"cnpj": "2", "razaoSocial": "B"}}
    land(root / "one", "20260115_20260116", {
        1: {"totalPaginas": 2, "totalRegistros": 5, "data": [
            notice("a"), notice("b", objetoCompra="Obra", valorTotalEstimado=None), notice("c", **sp)]},
        2: {"totalPaginas": 2, "totalRegistros": 5, "data": [
            notice("a", situacaoCompraNome="Encerrada", objetoCompra=None),
            notice("d", dataPublicacaoPncp="2026-01-16T23:59:59", valorTotalEstimado=900000.0, **sp)]},
    })
    land(root / "two", "20260116_20260117", {
        1: {"totalPaginas": 1, "totalRegistros": 3, "data": [
            notice("c", dataPublicacaoPncp="2026-02-16T08:00:00", **sp),
            notice("d", dataPublicacaoPncp="2026-01-16T23:59:59", situacaoCompraNome="Suspensa", **sp),
            notice("e", dataPublicacaoPncp="2026-01-17T00:00:00")]},
    })
    land(root / "three", "20260301_20260302", {1: {"totalPaginas": 1, "totalRegistros": 0, "data": []}})
    results = []
    for name, start, end in [("one", "20260115", "20260116"), ("two", "20260116", "20260117"), ("three", "20260301", "20260302")]:
        results.append(daily.run(lake, pages.read_pages(spark, str(root / name)), start, end, AS_OF))
    # the moved notice is published in a later period, run without new pages
    results.append(daily.run(lake, pages.read_pages(spark, str(root / "three")), "20260216", "20260217", AS_OF))
    return lake, results


def test_counts_of_each_run(lake):
    _, (one, two, three, later) = lake
    assert one["bronze"] == {"inseridos": 4, "atualizados": 0, "inalterados": 0, "mantidos": 0}
    assert two["bronze"] == {"inseridos": 1, "atualizados": 2, "inalterados": 0, "mantidos": two["bronze"]["mantidos"]}
    assert two["silver"]["inseridos"] == 1 and two["silver"]["total"] == 5
    assert three["bronze"] == daily.no_changes() and three["gold"] is False
    assert later["silver"]["atualizados"] == 1 and later["gold"] is True


def test_bronze_keeps_unlisted_fields(lake):
    a = lake[0].bronze.read().filter(F.col(v.BRONZE_KEY) == "a").first()
    assert a["situacaoCompraNome"] == "Encerrada"
    assert a["objetoCompra"] == "Serviço de limpeza"


def test_silver_is_typed_and_classified(lake):
    rows = {r["numero_controle_pncp"]: r for r in lake[0].silver.read().collect()}
    assert set(rows) == set("abcde")
    assert rows["b"]["ramo_mei"] == "Obras" and rows["b"]["valor_total_estimado"] is None
    assert rows["a"]["ano_compra"] == 2026 and rows["a"]["data_coleta"] == AS_OF


def test_period_tables(lake):
    state = lake[0].gold(v.GOLD_STATE).drop("data_atualizacao")
    assert rows_of(state) == sorted([
        ("20260115", "20260116", "PE", 2, 100.5, 1), ("20260115", "20260116", "SP", 1, 100.5, 1),
        ("20260116", "20260117", "PE", 1, 100.5, 1), ("20260116", "20260117", "SP", 1, 100.5, 1),
        ("20260216", "20260217", "SP", 1, 100.5, 1),
    ], key=str)


def test_months_follow_a_moved_notice(lake):
    months = lake[0].gold(v.GOLD_MONTH).select("ano", "mes", "uf", "total_contratacoes", "valor_total", "orgaos_distintos")
    assert rows_of(months) == sorted(
        [(2026, 1, "PE", 3, 201.0, 1), (2026, 1, "SP", 1, 100.5, 1), (2026, 2, "SP", 1, 100.5, 1)], key=str
    )


def test_run_again_changes_no_table(lake, spark):
    stored, _ = lake
    before = {name: rows_of(stored.gold(name)) for name in v.GOLD_TABLES}
    assert daily.refine(stored, "20260116", "20260117", AS_OF)["atualizados"] == 0
    daily.aggregate(stored, "20260116", "20260117", AS_OF)
    assert {name: rows_of(stored.gold(name)) for name in v.GOLD_TABLES} == before


def test_tools_on_stored_tables(lake):
    tables = lake[0].tables()
    panel = {r["colecao"]: r["total"] for r in tools.painel(tables).collect()}
    assert panel[v.BRONZE] == panel[v.SILVER] == 5 and panel[v.GOLD_STATE] == 5 and panel[v.GOLD_MONTH] == 3
    stats = tools.estatisticas_gerais(tables, AS_OF).first()
    assert stats["maior_contratacao"]["valor_total_estimado"] == 100.5
    assert stats["ultima_atualizacao"] == AS_OF
    found = tools.buscar_contratacoes(tables, uf="sp", data_inicial="20260101", data_final="20260131")
    assert [r["numero_controle_pncp"] for r in found.collect()] == ["d"]


@pytest.fixture(scope="module")
def silver(spark):
    return silver_rows(spark, SF_DIR).cache()


def test_each_period_table_counts_every_notice_of_its_period(silver):
    totals = {
        name: {(r[0], r[1]): (r[2], r[3]) for r in periods.sliding(silver, spec).groupBy("periodo_inicio", "uf").agg(
            F.sum("total_contratacoes"), F.round(F.sum("valor_total"), 2)).collect()}
        for name, spec in rollup.ROLLUPS.items() if spec.by_period
    }
    first = totals[v.GOLD_STATE]
    assert all(t == first for t in totals.values())
    # every notice lies in exactly two periods
    assert sum(n for n, _ in first.values()) == 2 * silver.count()


def test_all_periods_at_once_equal_single_runs(silver):
    everything = periods.sliding(silver, rollup.STATE)
    for start, end in [("19960214", "19960215"), ("19991231", "20000101")]:
        one = rollup.stamp(rollup.rollup(silver_slice(silver, start, end), rollup.STATE), (start, end)).drop("data_atualizacao")
        assert rows_of(everything.filter(F.col("periodo_inicio") == start)) == rows_of(one)


def test_last_second_with_a_fraction_belongs_to_one_period(silver):
    late = silver.limit(1).withColumn("data_publicacao_pncp", F.lit("1996-02-15T23:59:59.5"))
    assert [r["periodo_inicio"] for r in periods.in_periods(late).collect()] == ["19960215"]


def test_three_ways_to_gold_agree(silver):
    cells = rollup.cells(silver)
    at_once = rollup.grouping_sets(silver)
    for name, spec in rollup.ROLLUPS.items():
        direct = rows_of(rollup.rollup(silver, spec))
        assert rows_of(rollup.from_cells(cells, spec)) == direct
        assert rows_of(at_once.filter(F.col("tabela") == name).select(*spec.keys, *spec.measures)) == direct
    assert at_once.filter("tabela is null").count() == 0


def test_null_group_is_not_a_total(spark, silver):
    no_state = silver.withColumn("uf", F.when(F.col("uf") != "NATION_1", F.col("uf")))
    rows = rollup.grouping_sets(no_state).filter((F.col("tabela") == v.GOLD_STATE) & F.col("uf").isNull())
    assert rows.count() == 1


def test_group_of_nulls_sums_to_zero(silver):
    empty = silver.withColumn("valor_total_estimado", F.lit(None).cast("double"))
    assert {(r["valor_total"], r["valor_maximo"]) for r in rollup.rollup(empty, rollup.AREA).collect()} == {(0.0, 0.0)}


def test_approximate_buyers_are_near(silver):
    exact = {r["uf"]: r["orgaos_distintos"] for r in rollup.rollup(silver, rollup.STATE).collect()}
    near = {r["uf"]: r["orgaos_distintos"] for r in rollup.rollup_approximate(silver, rollup.STATE).collect()}
    assert all(abs(near[uf] - n) <= max(1, 0.05 * n) for uf, n in exact.items())


def test_json_keeps_nulls_accents_and_moments(spark, tmp_path):
    rows = spark.createDataFrame(
        [("Ação", None, AS_OF, 1)], "nome string, nada string, quando timestamp, _id int"
    )
    expected = {"nome": "Ação", "nada": None, "quando": "2026-02-01T00:00:00.000000"}
    text = json_rows.as_json(rows).first()[0]
    assert json.loads(text) == expected and "Ação" in text
    json_rows.write_json(rows, str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0]) == expected


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_dates_that_are_not_written_in_full(spark, tmp_path, grain):
    """They lie in the null partition, and their months count them in every run."""
    lake = daily.Lake(spark, str(tmp_path / "tables"), grain)
    land(tmp_path / "one", "20260101_20260102", {1: {"totalPaginas": "1", "totalRegistros": "3", "data": [
        notice("a", dataPublicacaoPncp="2026-01-01T10:00:00"), notice("b", dataPublicacaoPncp="2026-01-1"), notice("c", dataPublicacaoPncp="2026-01")]}})
    land(tmp_path / "two", "20260105_20260106", {1: {"totalPaginas": 1, "totalRegistros": 1, "data": [notice("d", dataPublicacaoPncp="2026-01-05T10:00:00")]}})
    daily.run(lake, pages.read_pages(spark, str(tmp_path / "one")), "20260101", "20260131", AS_OF)
    daily.run(lake, pages.read_pages(spark, str(tmp_path / "two")), "20260105", "20260106", AS_OF)
    stored = {r["numero_controle_pncp"] for r in lake.silver.read().collect()}
    month = {(r["mes"], r["total_contratacoes"]) for r in lake.gold(v.GOLD_MONTH).collect()}
    expected = lake.silver.read().select(F.month(F.try_to_date("data_publicacao_pncp")).alias("m")).groupBy("m").count()
    assert stored >= {"a", "b", "d"} and month == {(r["m"], r["count"]) for r in expected.collect()}


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_a_notice_that_leaves_its_period_alone(spark, tmp_path, grain):
    """Its old period's rows go, at once and when that period is run again; its month follows."""
    lake = daily.Lake(spark, str(tmp_path / "tables"), grain)
    land(tmp_path / "one", "20260105_20260106", {1: {"totalPaginas": 1, "totalRegistros": 1, "data": [notice("a", dataPublicacaoPncp="2026-01-05T10:00:00")]}})
    land(tmp_path / "two", "20260210_20260211", {1: {"totalPaginas": 1, "totalRegistros": 1, "data": [notice("a", dataPublicacaoPncp="2027-02-10T10:00:00")]}})
    land(tmp_path / "none", "20260105_20260106", {1: {"totalPaginas": 1, "totalRegistros": 0, "data": []}})
    daily.run(lake, pages.read_pages(spark, str(tmp_path / "one")), "20260105", "20260106", AS_OF)
    daily.run(lake, pages.read_pages(spark, str(tmp_path / "two")), "20270210", "20270211", AS_OF)
    periods_of = lambda name: {r["periodo_inicio"] for r in lake.gold(name).collect()}
    for name in v.GOLD_TABLES:
        if name != v.GOLD_MONTH:
            assert periods_of(name) == {"20270210"}
    assert {(r["mes"], r["total_contratacoes"]) for r in lake.gold(v.GOLD_MONTH).collect()} == {(2, 1)}
    assert daily.run(lake, pages.read_pages(spark, str(tmp_path / "none")), "20260105", "20260106", AS_OF)["gold"] is False
    assert periods_of(v.GOLD_STATE) == {"20270210"}


def test_orders_of_tables_and_tools(silver):
    """O1-O6 as they come, not sorted before they are compared."""
    for spec in rollup.ROLLUPS.values():
        rows = [tuple(r) for r in rollup.in_order(rollup.rollup(silver, spec), spec).collect()]
        names = rollup.in_order(rollup.rollup(silver, spec), spec).columns

        def rank(row, keys=spec.order, names=names):
            return tuple((-row[names.index(k[1:])] if k.startswith("-") else row[names.index(k)]) for k in keys)

        assert [rank(r) for r in rows] == sorted(rank(r) for r in rows)


def test_a_run_reads_only_its_partitions_of_silver(spark, tmp_path, monkeypatch):
    """The monthly table comes from stored cells: history is not opened again."""
    lake = daily.Lake(spark, str(tmp_path / "tables"), "day")
    for n, (day, following) in enumerate([("20260110", "20260111"), ("20260120", "20260121")]):
        iso = f"{day[:4]}-{day[4:6]}-{day[6:]}T10:00:00"
        land(tmp_path / str(n), f"{day}_{following}", {1: {"totalPaginas": 1, "totalRegistros": 1, "data": [notice(f"k{n}", dataPublicacaoPncp=iso)]}})
    daily.run(lake, pages.read_pages(spark, str(tmp_path / "0")), "20260110", "20260111", AS_OF)
    read, cells = set(), rollup.cells

    def noted(silver, extra_keys=()):
        if extra_keys and silver.sparkSession.conf.get("spark.test.cells", "") == "on":
            read.update(r[0] for r in silver.select(F.input_file_name()).distinct().collect())
            spark.conf.unset("spark.test.cells")
        return cells(silver, extra_keys)

    monkeypatch.setattr(rollup, "cells", noted)
    spark.conf.set("spark.test.cells", "on")
    daily.run(lake, pages.read_pages(spark, str(tmp_path / "1")), "20260120", "20260121", AS_OF)
    assert read and all("publication_part=2026-01-20" in f for f in read)
    assert [(r["mes"], r["total_contratacoes"]) for r in lake.gold(v.GOLD_MONTH).collect()] == [(1, 2)]
