"""Every stored period agrees with Silver after every run."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from noticelake import vocabulary as v
from noticelake.operators import periods, rollup
from noticelake.plans import daily
from noticelake.schemas import PARTITION
from noticelake.sources import pages
from noticelake.sources.tables import silver_slice
from tests.test_key_index import break_files
from tests.test_pages import land, notice

AS_OF = dt.datetime(2026, 2, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def agrees(lake):
    """Each stored period's four tables against Silver's rows of the period."""
    silver = lake.silver.read()
    stored = lake.stored_periods()
    for name, spec in rollup.ROLLUPS.items():
        if spec.by_period:
            expected = []
            for period in stored:
                expected += rows_of(rollup.stamp(rollup.rollup(silver_slice(silver, *period), spec), period, AS_OF))
            table = lake.gold(name).select(*daily.PERIOD, *spec.keys, *spec.measures, "data_atualizacao").drop("data_atualizacao")
            assert rows_of(table) == sorted((r[:-1] for r in expected), key=str), name
    months = lake.gold(v.GOLD_MONTH).select(*rollup.MONTH.keys, *rollup.MONTH.measures)
    assert rows_of(months) == rows_of(rollup.rollup(silver, rollup.MONTH))
    return stored


def run(lake, spark, folder, start, end, notices):
    land(folder, f"{start}_{end}", {1: {"totalPaginas": 1, "totalRegistros": len(notices), "data": notices}})
    return daily.run(lake, pages.read_pages(spark, str(folder)), start, end, AS_OF)


def at(key, day, status="Divulgada", **more):
    return notice(key, dataPublicacaoPncp=day if "T" in day else f"{day}T10:00:00", situacaoCompraNome=status, **more)


@pytest.mark.parametrize("grain", ["day", "year"])
def test_overlapping_runs(spark, tmp_path, grain):
    lake = daily.Lake(spark, str(tmp_path / "tables"), grain)
    run(lake, spark, tmp_path / "1", "20260115", "20260116", [at("a", "2026-01-15"), at("b", "2026-01-16"), at("c", "2026-01-16T23:59:59.5"), at("odd", "2026-1-16")])
    agrees(lake)
    # the day both runs cover: a status changes, a notice is added
    run(lake, spark, tmp_path / "2", "20260116", "20260117", [at("b", "2026-01-16", "Suspensa"), at("d", "2026-01-16"), at("e", "2026-01-17")])
    assert agrees(lake) == [("20260115", "20260116"), ("20260116", "20260117")]
    situation = {(r["periodo_inicio"], r["situacao_nome"]): r["total_contratacoes"] for r in lake.gold(v.GOLD_STATUS).collect()}
    assert situation["20260115", "Suspensa"] == 1 and situation["20260115", "Divulgada"] == 2
    # a long period, and one without a row; then a notice that moves out of three periods into another
    daily.aggregate(lake, "20260101", "20260131", AS_OF)
    assert daily.aggregate(lake, "20270101", "20270102", AS_OF) is False
    run(lake, spark, tmp_path / "3", "20260201", "20260202", [at("d", "2026-02-01"), at("odd", "2026-1-17", "Anulada")])
    assert len(agrees(lake)) == 4
    # the last notice of a period leaves
    run(lake, spark, tmp_path / "4", "20260202", "20260203", [at(k, "2026-02-03") for k in "acd"] + [at("b", "2026-02-02T23:59:59.9")])
    assert ("20260115", "20260116") not in agrees(lake)


def test_random_runs(spark, tmp_path):
    r = random.Random(4)
    lake = daily.Lake(spark, str(tmp_path / "tables"), "month")
    for step in range(5):
        day = dt.date(2026, 1, 29) + dt.timedelta(days=step)
        days = [day.isoformat(), (day + dt.timedelta(days=1)).isoformat(), "2026-01-30", "2026-3-01", "2026-02-01T23:59:59.1"]
        batch = [at(f"k{r.randrange(12)}", r.choice(days), r.choice(("Divulgada", "Suspensa")), valorTotalEstimado=r.choice((None, 10.5, 90000.0))) for _ in range(6)]
        run(lake, spark, tmp_path / str(step), f"{day:%Y%m%d}", f"{day + dt.timedelta(days=1):%Y%m%d}", batch)
        agrees(lake)


def test_unchanged_partitions_are_not_opened(spark, tmp_path):
    """A stored period is made from its days' cells: Silver's other partitions may be unreadable."""
    lake = daily.Lake(spark, str(tmp_path / "tables"), "day")
    run(lake, spark, tmp_path / "1", "20260115", "20260116", [at("a", "2026-01-15"), at("b", "2026-01-16")])
    lake.silver.upsert(daily.silver_batch(pages.records(pages.read_pages(spark, str(tmp_path / "1"))).filter("pos = 1").withColumn("situacaoCompraNome", F.lit("Suspensa")), AS_OF))
    break_files(tmp_path / "tables" / v.SILVER / f"{PARTITION}=2026-01-15")
    daily.aggregate(lake, "20260116", "20260117", AS_OF)
    status = rows_of(lake.gold(v.GOLD_STATUS).select(*daily.PERIOD, "situacao_nome", "total_contratacoes"))
    assert status == [("20260115", "20260116", "Divulgada", 1), ("20260115", "20260116", "Suspensa", 1), ("20260116", "20260117", "Suspensa", 1)]


@pytest.mark.parametrize("lost", ["replace_partitions", "_replace_months"])
def test_run_that_dies_is_made_good_by_the_next(spark, tmp_path, monkeypatch, lost):
    lake = daily.Lake(spark, str(tmp_path / "tables"), "day")
    run(lake, spark, tmp_path / "1", "20260115", "20260116", [at("a", "2026-01-15"), at("b", "2026-01-16")])

    def dies(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(daily, lost, dies)
        with pytest.raises(RuntimeError):
            # the notice moves away from the stored period: a second try of this run would not touch its old partition
            run(lake, spark, tmp_path / "2", "20260117", "20260118", [at("a", "2026-01-17")])
    run(lake, spark, tmp_path / "3", "20260119", "20260120", [at("z", "2026-01-19")])
    assert ("20260115", "20260116") in agrees(lake)
    assert not lake.silver.logged_parts()[1]


def test_periods_of_cells_equal_periods_of_rows(spark):
    from noticelake.registry.notices import silver_rows
    from noticelake.operators.silver import add_partition

    silver = add_partition(silver_rows(spark, "/root/testdata/sf0.001"), "data_publicacao_pncp")
    wanted = [("19960214", "19960215"), ("19960215", "19960216"), ("19950101", "20010801"), ("19960101", "19960131")]
    cells = periods.cells_in(periods.day_cells(silver), wanted)
    for spec in (rollup.STATE, rollup.AREA):
        made = rows_of(rollup.from_cells(cells, spec, daily.PERIOD))
        assert made == sorted(sum((rows_of(rollup.stamp(rollup.rollup(silver_slice(silver, *p), spec), p).drop("data_atualizacao")) for p in wanted), []), key=str)


def test_text_that_is_no_day_bounds_a_period_too(spark, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "tables"), "day")
    run(lake, spark, tmp_path / "1", "20260115", "20260116", [at("a", "2026-01-15"), at("b", "2026-01-16")])
    daily.aggregate(lake, "2026-01-15T10", "2026-01-15", AS_OF)
    run(lake, spark, tmp_path / "2", "20260115", "20260116", [at("a", "2026-01-15", "Suspensa")])
    assert ("2026-01-15T10", "2026-01-15") in agrees(lake)
