"""One row per key, upsert as a join, stored keyed tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from noticelake import schemas
from noticelake import vocabulary as v
from noticelake.operators import latest, reconcile
from noticelake.schemas import PARTITION
from noticelake.sinks import keyed
from noticelake.sinks.keyed import KeyedTable


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_last_row_of_each_key_with_a_hot_key(spark):
    random.seed(7)
    data = [("hot" if random.random() < 0.4 else random.choice(["a", "b", None]), p, i) for p in range(20) for i in range(50)]
    df = spark.createDataFrame(data, "k string, page int, pos int").repartition(8)
    expected = {}
    for k, page, pos in data:
        expected[k] = max(expected.get(k, (-1, -1)), (page, pos))
    got = {r["k"]: (r["page"], r["pos"]) for r in latest.keep_last(df, ["k"], ["page", "pos"]).collect()}
    assert got == expected
    assert latest.keep_any(df, ["k"]).count() == len(expected)


def test_fields_merge_to_the_last_non_null(spark):
    df = spark.createDataFrame(
        [("a", 1, 0, "x", 1), ("a", 2, 0, None, 2), ("a", 2, 1, "y", None), (None, 1, 0, "n", None), (None, 2, 0, None, 9)],
        "k string, page int, pos int, s string, n int",
    )
    merged = latest.merge_last(df, ["k"], ["page", "pos"]).select("k", "s", "n")
    assert rows_of(merged) == sorted([("a", "y", 2), (None, "n", 9)], key=str)


STORED = [("a", 1, "x"), ("b", 2, "y"), ("c", None, "z"), (None, 5, "n")]
BATCH = [("a", 1, "x"), ("b", 3, None), ("d", 4, "w"), (None, None, "m")]


def pair(spark):
    schema = "k string, v int, s string"
    return spark.createDataFrame(STORED, schema), spark.createDataFrame(BATCH, schema)


def test_whole_row_and_field_merge(spark):
    stored, batch = pair(spark)
    assert rows_of(reconcile.upsert(stored, batch, ["k"])) == sorted(
        [("a", 1, "x"), ("b", 3, None), ("c", None, "z"), ("d", 4, "w"), (None, None, "m")], key=str
    )
    assert rows_of(reconcile.upsert(stored, batch, ["k"], merge_fields=True)) == sorted(
        [("a", 1, "x"), ("b", 3, "y"), ("c", None, "z"), ("d", 4, "w"), (None, 5, "m")], key=str
    )


def test_outcome_counts(spark):
    stored, batch = pair(spark)
    counts = reconcile.change_counts(reconcile.reconcile(stored, batch, ["k"])).first().asDict()
    assert counts == {"inseridos": 1, "atualizados": 2, "inalterados": 1, "mantidos": 1}
    ignoring = reconcile.reconcile(stored, batch, ["k"], ignore=["v", "s"])
    assert reconcile.change_counts(ignoring).first()["atualizados"] == 0


@pytest.mark.parametrize("merge", [False, True])
def test_upsert_twice_changes_nothing(spark, merge):
    stored, batch = pair(spark)
    once = reconcile.upsert(stored, batch, ["k"], merge)
    again = reconcile.reconcile(once, batch, ["k"], merge)
    assert rows_of(again.drop(reconcile.STATUS)) == rows_of(once)
    assert reconcile.change_counts(again).first()["atualizados"] == 0


def test_nested_object_is_one_field(spark):
    stored = spark.createDataFrame([("a", (1, 2))], "k string, o struct<p:int,q:int>")
    batch = spark.createDataFrame([("a", (9, None))], "k string, o struct<p:int,q:int>")
    merged = reconcile.upsert(stored, batch, ["k"], merge_fields=True).first()
    assert tuple(merged["o"]) == (9, None)


def test_columns_of_one_side_survive(spark):
    stored = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", "new"), ("b", "only")], "k string, w string")
    merged = reconcile.upsert(stored, batch, ["k"], merge_fields=True)
    assert rows_of(merged) == sorted([("a", 1, "new"), ("b", None, "only")], key=str)


def test_unique_keys_are_demanded(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert rows_of(reconcile.repeated_keys(df, ["a", "b"])) == [(1, 1, 2)]
    with pytest.raises(ValueError):
        reconcile.require_unique(df, ["a", "b"])
    assert reconcile.require_unique(df.distinct(), ["a", "b"]).count() == 2


SCHEMA = StructType(
    [StructField("k", StringType()), StructField("v", IntegerType()), StructField(PARTITION, StringType())]
)


def batch_of(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_stored_table_moves_keys_and_empties_partitions(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",))
    assert table.read().count() == 0
    counts, touched = table.upsert(batch_of(spark, ("a", 1, "d1"), ("b", 2, "d2"), ("c", 3, "d2"), (None, 4, None)))
    assert counts == {"inseridos": 4, "atualizados": 0, "inalterados": 0, "mantidos": 0}
    counts, touched = table.upsert(batch_of(spark, ("a", 10, "d3"), ("b", 2, "d2"), (None, 5, None)))
    assert counts == {"inseridos": 0, "atualizados": 2, "inalterados": 1, "mantidos": 1}
    assert set(touched) == {"d1", "d2", "d3", None}
    expected = sorted([("a", 10, "d3"), ("b", 2, "d2"), ("c", 3, "d2"), (None, 5, None)], key=str)
    assert rows_of(table.read()) == expected
    assert rows_of(KeyedTable(spark, table.path, SCHEMA, ("k",)).read()) == expected
    table.upsert(batch_of(spark, (None, 6, "d3")))
    assert table.read().filter("k is null").select("v", PARTITION).first().asDict() == {"v": 6, PARTITION: "d3"}
    assert table.read().count() == 4


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), keys_may_move=False)
    table.upsert(batch_of(spark, ("a", 1, "d1"), ("b", 2, "d2")))
    files = {p.name for p in (tmp_path / "t" / f"{PARTITION}=d1").glob("*.parquet")}
    table.upsert(batch_of(spark, ("b", 3, "d2")))
    assert {p.name for p in (tmp_path / "t" / f"{PARTITION}=d1").glob("*.parquet")} == files
    assert rows_of(table.read()) == [("a", 1, "d1"), ("b", 3, "d2")]


def test_repeated_batch_key_is_refused_and_nothing_changes(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",))
    table.upsert(batch_of(spark, ("a", 1, "d1")))
    with pytest.raises(ValueError):
        table.upsert(batch_of(spark, ("b", 1, "d1"), ("b", 2, "d1")))
    assert rows_of(table.read()) == [("a", 1, "d1")]


@pytest.mark.parametrize("merge", [False, True])
def test_interrupted_upsert_is_finished_by_the_next(spark, tmp_path, monkeypatch, merge):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), merge_fields=merge)
    table.upsert(batch_of(spark, ("a", 1, "d1"), ("b", 2, "d2")))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(keyed, "replace_partitions", lost)
        with pytest.raises(RuntimeError):
            table.upsert(batch_of(spark, ("a", 9, "d2")))
    assert rows_of(table.read()) == [("a", 1, "d1"), ("b", 2, "d2")]
    table.upsert(batch_of(spark, ("c", 3, "d1")))
    assert rows_of(table.read()) == [("a", 9, "d2"), ("b", 2, "d2"), ("c", 3, "d1")]


def test_half_written_stage_is_ignored(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",))
    table.upsert(batch_of(spark, ("a", 1, "d1")))
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(f"{table.path}.staged/rows")
    (tmp_path / "t.staged" / "rows" / "_SUCCESS").unlink()
    table.upsert(batch_of(spark, ("b", 1, "d1")))
    assert rows_of(table.read()) == [("a", 1, "d1"), ("b", 1, "d1")]


def test_sparse_rows_need_the_key_scan(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"), schemas.BRONZE, (v.BRONZE_KEY,), merge_fields=True, keys_may_move=False)
