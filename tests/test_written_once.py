"""Upserts write a row once, merge only what is repeated, and runs compare cells in one pass."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from noticelake import schemas
from noticelake import vocabulary as v
from noticelake.operators import periods, rollup
from noticelake.operators.reconcile import STATUS, reconcile
from noticelake.plans import daily
from noticelake.schemas import PARTITION
from noticelake.sinks import keyed, partitions
from noticelake.sinks.keyed import KeyedTable
from noticelake.sinks.versioned import VersionedTable

SCHEMA = StructType([StructField("k", StringType()), StructField("x", LongType()), StructField(PARTITION, StringType())])


def batch_of(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(path):
    return {os.path.basename(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_staged_files_become_the_table(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",))
    table.upsert(batch_of(spark, ("a", 1, "d1"), ("b", 2, "d2"), (None, 3, None)))
    old, staged = files(table.path), []
    whole = keyed.replace_partitions
    monkeypatch.setattr(keyed, "replace_partitions", lambda *a: staged.append(files(table.path + ".staged/rows")) or whole(*a))
    table.upsert(batch_of(spark, ("a", 9, "d2"), (None, 4, None)))
    assert rows_of(table.read()) == [("a", 9, "d2"), ("b", 2, "d2"), (None, 4, None)]
    assert staged[0] and files(table.path) == staged[0] and not staged[0] & old  # d1 has lost its only row


def test_move_broken_off_half_way_is_finished(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",))
    table.upsert(batch_of(spark, ("a", 1, "d1"), ("b", 2, "d2"), ("c", 3, "d3")))
    moves = []

    def breaks(*a, move=partitions.move_path):
        if moves:
            raise RuntimeError("driver lost")
        moves.append(a)
        move(*a)

    with monkeypatch.context() as patch:
        patch.setattr(partitions, "move_path", breaks)
        with pytest.raises(RuntimeError):
            table.upsert(batch_of(spark, ("a", 9, "d2"), ("c", 8, "d3")))
    table.upsert(batch_of(spark, ("z", 1, "d4")))
    assert rows_of(table.read()) == [("a", 9, "d2"), ("b", 2, "d2"), ("c", 8, "d3"), ("z", 1, "d4")]
    assert rows_of(table.index.read()) == [("a", "d2"), ("b", "d2"), ("c", "d3"), ("z", "d4")]


@pytest.mark.parametrize("most", [0, 1_000_000])
@pytest.mark.parametrize("kind", [KeyedTable, VersionedTable])
def test_only_repeated_keys_are_merged(spark, tmp_path, monkeypatch, kind, most):
    monkeypatch.setattr(keyed, "SMALL_BATCH", most)
    fields = schemas.BRONZE.fieldNames()
    notices = spark.createDataFrame(
        [
            dict(zip((v.BRONZE_KEY, "objetoCompra", "dataPublicacaoPncp", "lote", "pagina", "pos"), r))
            for r in [("a", "x", "2026-01-01", "1", 1, 0), ("b", "y", "2026-01-02", "1", 1, 1), ("a", None, "2026-02-01", "2", 1, 0),
                      (None, "n", None, "1", 2, 0), (None, "m", "2026-01-03", "1", 3, 0), ("c", None, None, "1", 4, 0)]
        ],
        StructType([f for f in schemas.BRONZE.fields if f.name != PARTITION]),
    )
    seen = []
    batch_of_all = daily.bronze_batch
    monkeypatch.setattr(daily, "bronze_batch", lambda rows, grain: seen.append(rows.count()) or batch_of_all(rows, grain))
    table = kind(spark, str(tmp_path / "t"), schemas.BRONZE, (v.BRONZE_KEY,), merge_fields=True)
    for _ in range(2):
        counts, _ = daily.upsert_bronze(table, notices, "month")
        assert rows_of(table.read().select(fields)) == rows_of(batch_of_all(notices, "month").select(fields))
    assert counts == {"inseridos": 0, "atualizados": 0, "inalterados": 4, "mantidos": 0}
    assert set(seen) == {6 if most == 0 else 4}


def test_first_batch_equals_a_join_with_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), merge_fields=True, partition_of=lambda: F.concat(F.lit("p"), F.col("k")))
    batch = batch_of(spark, ("a", 1, "d1"), (None, None, None))
    outcome = table._outcome(None, batch, 2)
    assert "Join" not in outcome._jdf.queryExecution().optimizedPlan().toString()
    whole = reconcile(table.read(), batch, ("k",), merge_fields=True, before=table._before()).withColumn(PARTITION, table.partition_of())
    assert outcome.columns == whole.columns and rows_of(outcome) == rows_of(whole)
    assert {r[STATUS] for r in outcome.collect()} == {"inserido"}


def test_differing_cells_in_one_shuffle(spark):
    schema = f"{PARTITION} string, {periods.DAY} string, {periods.LATE} boolean, mes int, _linhas long, _maior double"
    fresh = spark.createDataFrame([("1", "a", False, 1, 1, 1.0), ("1", "a", False, 1, 1, 1.0), ("1", "b", False, 2, 1, None), (None, None, None, None, 2, 0.0)], schema)
    stored = spark.createDataFrame([("1", "a", False, 1, 1, 1.0), ("1", "b", False, 2, 1, None), (None, None, None, None, 3, 0.0), ("2", "c", True, 3, 1, 1.0)], schema)
    old = fresh.exceptAll(stored).unionByName(stored.exceptAll(fresh))
    found = daily._differing(fresh, stored)
    assert rows_of(found) == rows_of(old.select(PARTITION, periods.DAY, periods.LATE, "mes").distinct())
    assert daily._differing(fresh, fresh).isEmpty()


def test_tables_without_buyers_come_from_fewer_rows(spark):
    from noticelake.registry.notices import silver_rows

    cells = rollup.cells(silver_rows(spark, "/root/testdata/sf0.001"))
    small = rollup.without_buyers(cells, ("mes",))
    assert rollup.BUYER not in small.columns and small.count() < cells.count()
    for spec in (rollup.AREA, rollup.BAND, rollup.STATUS):
        assert rows_of(rollup.from_cells(small, spec)) == rows_of(rollup.from_cells(cells, spec))
