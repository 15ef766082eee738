"""The index from keys to partitions, and upserts that read nothing else to find a key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from noticelake.schemas import PARTITION
from noticelake.sinks import key_index, keyed
from noticelake.sinks.key_index import BUCKET, ROUND
from noticelake.sinks.keyed import KeyedTable
from noticelake.workspace import drop_path
from tests.test_keys import SCHEMA, batch_of, rows_of


def table_of(spark, tmp_path, **more):
    return KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), **more)


def indexed(table):
    return {r["k"]: r[PARTITION] for r in table.index.read().collect()}


def break_files(folder):
    """Whoever reads a file of this partition fails."""
    files = list(folder.glob("*.parquet"))
    assert files
    for f in files:
        f.write_bytes(b"no parquet")
        (folder / f".{f.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("merge", [False, True])
def test_upsert_opens_no_partition_but_those_of_its_keys(spark, tmp_path, merge):
    table = table_of(spark, tmp_path, merge_fields=merge)
    table.upsert(batch_of(spark, ("a", 1, "d1"), ("b", 2, "d2"), ("c", 3, "d3")))
    break_files(tmp_path / "t" / f"{PARTITION}=d3")
    counts, touched = table.upsert(batch_of(spark, ("a", 9, "d2"), ("new", 4, "d4")))
    assert counts == {"inseridos": 1, "atualizados": 1, "inalterados": 0, "mantidos": 1}
    assert set(touched) == {"d1", "d2", "d4"}
    assert not (tmp_path / "t" / f"{PARTITION}=d1").exists()
    stored = spark.read.schema(SCHEMA).parquet(*[str(tmp_path / "t" / f"{PARTITION}=d{n}") for n in (2, 4)])
    assert {(r["k"], r["v"]) for r in stored.collect()} == {("a", 9), ("b", 2), ("new", 4)}
    with pytest.raises(Exception, match="parquet"):
        table.upsert(batch_of(spark, ("c", 5, "d2")))


def test_only_the_buckets_of_the_batch_are_opened(spark, tmp_path):
    table = table_of(spark, tmp_path)
    table.upsert(batch_of(spark, *[(f"k{i}", i, f"d{i % 5}") for i in range(200)]))
    batch = batch_of(spark, ("k7", 0, "d9"), ("new", 0, "d1"))
    buckets = [r[0] for r in batch.select(table.index.bucket()).distinct().collect()]
    others = [f for f in (tmp_path / "t.index" / f"{ROUND}=0").glob(f"{BUCKET}=*") if int(f.name.split("=")[1]) not in buckets]
    for folder in [*others, *(tmp_path / "t").glob(f"{PARTITION}=*")]:
        break_files(folder)
    assert len(others) > 30
    assert rows_of(table.index.stored_parts(batch.select("k", PARTITION), buckets)) == [("k7", "d9", "d2")]
    assert rows_of(table.touched_parts(batch, buckets)) == [("d1", False), ("d2", True), ("d9", False)]
    with pytest.raises(Exception, match="parquet"):
        table.index.read().collect()


def test_index_follows_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "ROUNDS", 3)
    table = table_of(spark, tmp_path, index_buckets=4)
    expected = {}
    for step in range(8):
        rows = [(None if i == 9 else f"k{i}", step, f"d{(i * step) % 7}") for i in range(step, step + 10)]
        table.upsert(batch_of(spark, *rows))
        expected.update({k: part for k, _, part in rows})
        assert indexed(table) == expected
        assert len(table.index.rounds()) <= 4
    assert {r["k"]: r[PARTITION] for r in table.read().collect()} == expected
    again = len(table.index.rounds())
    table.upsert(batch_of(spark, *rows))
    assert len(table.index.rounds()) == again  # nothing new, nothing moved: nothing is added


def test_lost_index_is_built_from_the_table(spark, tmp_path):
    table = table_of(spark, tmp_path)
    table.upsert(batch_of(spark, ("a", 1, "d1"), (None, 2, None)))
    drop_path(spark, table.index.path)
    table.upsert(batch_of(spark, ("a", 2, "d2"), (None, 3, "d1")))
    assert rows_of(table.read()) == sorted([("a", 2, "d2"), (None, 3, "d1")], key=str)
    assert indexed(table) == {"a": "d2", None: "d1"}


def test_upsert_lost_before_the_index_is_written(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    table.upsert(batch_of(spark, ("a", 1, "d1")))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(key_index.KeyIndex, "add", lost)
        with pytest.raises(RuntimeError):
            table.upsert(batch_of(spark, ("a", 2, "d2"), ("b", 2, "d2")))
    assert indexed(table) == {"a": "d1"}
    table.upsert(batch_of(spark, ("b", 3, "d3")))
    assert indexed(table) == {"a": "d2", "b": "d3"}
    assert rows_of(table.read()) == [("a", 2, "d2"), ("b", 3, "d3")]


def test_half_written_round_is_none(spark, tmp_path):
    table = table_of(spark, tmp_path)
    table.upsert(batch_of(spark, ("a", 1, "d1")))
    table.index.add(batch_of(spark, ("a", 1, "wrong")))
    (tmp_path / "t.index" / f"{ROUND}=1" / "_SUCCESS").unlink()
    assert indexed(table) == {"a": "d1"}
    table.upsert(batch_of(spark, ("b", 1, "d1")))
    assert indexed(table) == {"a": "d1", "b": "d1"}


def test_counts_are_taken_from_the_write(spark, tmp_path, monkeypatch):
    """No aggregation over the staged rows, and none over kept ones."""
    table = table_of(spark, tmp_path)
    table.upsert(batch_of(spark, *[(f"k{i}", i, "d1") for i in range(50)]))
    asked = []
    monkeypatch.setattr(keyed.KeyedTable, "_staged_rows", lambda self, whole=keyed.KeyedTable._staged_rows: asked.append(1) or whole(self))
    counts, _ = table.upsert(batch_of(spark, ("k1", 7, "d1"), ("k2", 2, "d1"), ("x", 1, "d1")))
    assert counts == {"inseridos": 1, "atualizados": 1, "inalterados": 1, "mantidos": 48}
    assert len(asked) == 1  # by the move alone


def test_days_of_changed_rows(spark, tmp_path):
    schema = StructType([*SCHEMA.fields, StructField("day", StringType())])
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ("k",), date="day")

    def of(*rows):
        return spark.createDataFrame(list(rows), schema)

    _, parts = table.upsert(of(("a", 1, "2026-01", "2026-01-15T10"), ("b", 1, "2026-01", "2026-01-16T11"), ("c", 1, None, None)))
    assert (parts.left, parts.days) == ([], ["2026-01-15", "2026-01-16"])
    _, parts = table.upsert(of(("a", 1, "2026-01", "2026-01-17T10"), ("b", 1, "2026-01", "2026-01-16T11"), ("c", 2, None, None)))
    assert (parts.left, parts.days) == (["2026-01-15"], ["2026-01-15", "2026-01-17"])
    _, parts = table.upsert(of(("a", 2, "2026-01", "2026-01-17T10")))
    assert (parts.left, parts.days) == ([], ["2026-01-17"])


def test_empty_batch(spark, tmp_path):
    table = table_of(spark, tmp_path)
    assert table.upsert(batch_of(spark))[0] == {"inseridos": 0, "atualizados": 0, "inalterados": 0, "mantidos": 0}
    table.upsert(batch_of(spark, ("a", 1, "d1")))
    assert table.upsert(batch_of(spark).filter(F.lit(False)))[0]["mantidos"] == 0
    assert rows_of(table.read()) == [("a", 1, "d1")]
