"""Sketched buyers: error, merging over days, periods and micro-batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from noticelake import schemas
from noticelake import vocabulary as v
from noticelake.operators import periods, rollup
from noticelake.operators.silver import add_partition
from noticelake.plans import daily
from noticelake.streaming import upsert as streams
from tests.test_stored_periods import at, run

LG_K = 14


def many(spark, n, buyers):
    """n notices of two states over 40 days; the second state has a third of the buyers."""
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("numero_controle_pncp"),
        F.when(F.col("id") % 2 == 0, "PE").otherwise("SP").alias("uf"),
        F.when(F.col("id") % 2 == 0, F.xxhash64(F.lit(1), "id") % buyers).otherwise(F.xxhash64(F.lit(2), "id") % (buyers // 3)).cast("string").alias("cnpj_orgao"),
        F.date_format(F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") % 40).cast("int")), "yyyy-MM-dd'T'10:00:00").alias("data_publicacao_pncp"),
    )
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.SILVER.fields if f.name not in (*rows.columns, schemas.PARTITION)]
    return add_partition(rows.select("*", *rest), "data_publicacao_pncp", "month").withColumn("valor_total_estimado", F.lit(2.5))


def counts(table, *keys):
    return {tuple(r[k] for k in (*keys, "uf")): (r["total_contratacoes"], r["valor_total"], r["orgaos_distintos"]) for r in table.collect()}


def close(got, exact, sigmas=4):
    """Counts and sums equal, distinct counts within so many standard errors."""
    assert got.keys() == exact.keys()
    for key, (n, value, distinct) in exact.items():
        assert got[key][:2] == (n, value)
        assert abs(got[key][2] - distinct) <= sigmas * 1.04 / 2 ** (LG_K / 2) * distinct


def test_error_is_bounded_and_cells_do_not_grow_with_buyers(spark):
    rows = many(spark, 300_000, 120_000).cache()
    cells = rollup.sketch_cells(rows)
    assert cells.count() < rollup.cells(rows).count() / 1000
    close(counts(rollup.from_cells(cells, rollup.STATE)), counts(rollup.rollup(rows, rollup.STATE)))
    days = periods.day_cells(rows, lg_k=LG_K).cache()
    close(counts(rollup.from_cells(days, rollup.MONTH), "mes"), counts(rollup.rollup(rows, rollup.MONTH), "mes"))
    wanted = [("20260101", "20260115"), ("20260115", "20260116")]
    exact = {}
    for start, end in wanted:
        exact |= {(start, *k): x for k, x in counts(rollup.rollup(rows.filter(F.col("data_publicacao_pncp").between(f"2026-01-{start[6:]}", f"2026-01-{end[6:]}T23:59:59")), rollup.STATE)).items()}
    close(counts(rollup.from_cells(periods.cells_in(days, wanted), rollup.STATE, daily.PERIOD), "periodo_inicio"), exact)


def test_few_buyers_and_none(spark):
    rows = many(spark, 900, 300)
    none = rows.withColumn("cnpj_orgao", F.when(F.col("uf") == "SP", F.col("cnpj_orgao")))
    for table in (rows, none, rows.limit(0)):
        assert counts(rollup.from_cells(rollup.sketch_cells(table), rollup.STATE)) == counts(rollup.rollup(table, rollup.STATE))


def test_stream_leaves_cells_that_merge(spark, tmp_path):
    rows = many(spark, 20_000, 9_000)
    rows.repartition(5).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # started again, it has nothing to add
        arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
        streams.finish(streams.cell_stream(arriving, rollup.sketch_cells, str(tmp_path / "cells"), str(tmp_path / "check")))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    assert cells.select("lote_fluxo").distinct().count() == 3
    close(counts(rollup.from_cells(cells, rollup.STATE)), counts(rollup.rollup(rows, rollup.STATE)))


def test_stored_periods_with_sketches(spark, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "tables"), "month", sketch_lg_k=LG_K)
    buyer = lambda n: {"orgaoEntidade": {"cnpj": str(n), "razaoSocial": "x"}}
    run(lake, spark, tmp_path / "1", "20260115", "20260116", [at("a", "2026-01-15", **buyer(1)), at("b", "2026-01-16", **buyer(2))])
    run(lake, spark, tmp_path / "2", "20260116", "20260117", [at("b", "2026-01-16", **buyer(1)), at("c", "2026-01-17", **buyer(3))])
    state = {(r["periodo_inicio"], r["orgaos_distintos"]) for r in lake.gold(v.GOLD_STATE).collect()}
    assert state == {("20260115", 1), ("20260116", 2)}
    assert [r["orgaos_distintos"] for r in lake.gold(v.GOLD_MONTH).collect()] == [2]
