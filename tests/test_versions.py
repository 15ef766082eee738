"""Versions: readers keep theirs, two writers at once, what a lost upsert leaves."""

from __future__ import annotations

import datetime as dt

import pytest

from noticelake import vocabulary as v
from noticelake.plans import daily, tools
from noticelake.schemas import PARTITION
from noticelake.sinks import key_index, versioned
from noticelake.sinks.versioned import ConcurrentUpsert, VersionedTable
from noticelake.workspace import child_names, create_exclusively, read_text
from tests.test_key_index import break_files
from tests.test_keys import SCHEMA, batch_of, rows_of
from tests.test_stored_periods import agrees, at, run


def table_of(spark, tmp_path, **more):
    return VersionedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), **more)


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "x" / "1")
    assert create_exclusively(spark, path, "one") and not create_exclusively(spark, path, "two")
    assert read_text(spark, path) == "one" and [n for n in child_names(spark, str(tmp_path / "x")) if not n.startswith(".")] == ["1"]


@pytest.mark.parametrize("merge", [False, True])
def test_upserts_move_keys_and_empty_partitions(spark, tmp_path, merge):
    table = table_of(spark, tmp_path, merge_fields=merge)
    assert table.read().count() == 0 and not table.exists()
    counts, _ = table.upsert(batch_of(spark, ("a", 1, "d1"), ("b", 2, "d2"), ("c", 3, "d2"), (None, 4, None)))
    assert counts == {"inseridos": 4, "atualizados": 0, "inalterados": 0, "mantidos": 0}
    counts, touched = table.upsert(batch_of(spark, ("a", 10, "d3"), ("b", 2, "d2"), (None, 5, None)))
    assert counts == {"inseridos": 0, "atualizados": 2, "inalterados": 1, "mantidos": 1} and set(touched) == {"d1", "d2", "d3", None}
    assert rows_of(table.read()) == sorted([("a", 10, "d3"), ("b", 2, "d2"), ("c", 3, "d2"), (None, 5, None)], key=str)
    assert table.parts() == [None, "d2", "d3"]
    assert rows_of(table.read(1)) == sorted([("a", 1, "d1"), ("b", 2, "d2"), ("c", 3, "d2"), (None, 4, None)], key=str)
    with pytest.raises(ValueError):
        table.upsert(batch_of(spark, ("z", 1, "d1"), ("z", 2, "d1")))
    assert table.versions() == [1, 2]


def test_reader_keeps_the_version_it_opened(spark, tmp_path):
    table = table_of(spark, tmp_path)
    table.upsert(batch_of(spark, ("a", 1, "d1"), ("b", 1, "d2")))
    opened = table.read()
    table.upsert(batch_of(spark, ("a", 2, "d3"), ("b", 2, "d2")))
    assert rows_of(opened) == [("a", 1, "d1"), ("b", 1, "d2")]
    assert rows_of(table.read()) == [("a", 2, "d3"), ("b", 2, "d2")]


def test_of_two_writers_one_is_published(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    table.upsert(batch_of(spark, ("a", 1, "d1")))
    create = versioned.create_exclusively

    def other_first(*arguments):
        monkeypatch.setattr(versioned, "create_exclusively", create)
        table.upsert(batch_of(spark, ("a", 2, "d2"), ("x", 1, "d1")))
        return create(*arguments)

    monkeypatch.setattr(versioned, "create_exclusively", other_first)
    before = set(child_names(spark, table.path))
    with pytest.raises(ConcurrentUpsert):
        table.upsert(batch_of(spark, ("a", 3, "d1"), ("y", 1, "d1")))
    assert rows_of(table.read()) == [("a", 2, "d2"), ("x", 1, "d1")] and table.versions() == [1, 2]
    # the one that failed leaves nothing behind
    assert len([n for n in set(child_names(spark, table.path)) - before if n.startswith("_versao=")]) == 1
    table.upsert(batch_of(spark, ("a", 3, "d1"), ("y", 1, "d1")))
    assert rows_of(table.read()) == [("a", 3, "d1"), ("x", 1, "d1"), ("y", 1, "d1")]


def test_lost_upsert_is_no_version(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    table.upsert(batch_of(spark, ("a", 1, "d1")))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(versioned, "create_exclusively", lost)
        with pytest.raises(RuntimeError):
            table.upsert(batch_of(spark, ("a", 9, "d2"), ("b", 1, "d2")))
    assert rows_of(table.read()) == [("a", 1, "d1")]
    table.upsert(batch_of(spark, ("b", 3, "d3")))
    assert rows_of(table.read()) == [("a", 1, "d1"), ("b", 3, "d3")]
    table.expire(1)
    named = {f for f in table.version().folders.values()} | {r.split("/")[0] for r in table.version().rounds}
    assert {n for n in child_names(spark, table.path) if not n.startswith(".")} == named | {"_versions"}
    assert rows_of(table.read()) == [("a", 1, "d1"), ("b", 3, "d3")] and table.versions() == [2]


def test_index_and_untouched_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "ROUNDS", 2)
    table, expected = table_of(spark, tmp_path, index_buckets=4), {}
    for step in range(6):
        rows = [(f"k{i}", step, f"d{(i * step) % 5}") for i in range(step, step + 6)]
        table.upsert(batch_of(spark, *rows))
        expected.update({k: part for k, _, part in rows})
        assert {r["k"]: r[PARTITION] for r in table.index.read().collect()} == expected == {r["k"]: r[PARTITION] for r in table.read().collect()}
        assert len(table.version().rounds) <= 2
    folder = table.version().folders["d0"]
    break_files(tmp_path / "t" / folder / f"{PARTITION}=d0")
    table.upsert(batch_of(spark, ("new", 1, "d9")))
    assert table.version().folders["d0"] == folder


def test_lake_with_versions(spark, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "tables"), "day", versions=True, text_index=True)
    run(lake, spark, tmp_path / "1", "20260115", "20260116", [at("a", "2026-01-15", objetoCompra="Obra"), at("b", "2026-01-16")])
    run(lake, spark, tmp_path / "2", "20260116", "20260117", [at("a", "2026-01-16", "Suspensa", objetoCompra="Obra"), at("c", "2026-01-17")])
    assert len(agrees(lake)) == 2
    assert [r["numero_controle_pncp"] for r in tools.buscar_contratacoes(lake.tables(), texto_objeto="obra", limite=5).collect()] == ["a"]
    assert lake.silver.versions() == [1, 2] and lake.bronze.read(1).count() == 2
    assert daily.refine(lake, "20260116", "20260117", dt.datetime(2026, 2, 1))["atualizados"] == 0
    assert {r["colecao"]: r["total"] for r in tools.painel(lake.tables()).collect()}[v.SILVER] == 3
