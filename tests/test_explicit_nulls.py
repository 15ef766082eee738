"""A field given as null empties the stored one; a field that is left out leaves it (K1)."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from noticelake import vocabulary as v
from noticelake.operators import latest, reconcile
from noticelake.plans import daily
from noticelake.schemas import NULLS
from noticelake.sources import pages
from noticelake.streaming import upsert as streams
from tests.test_pages import land, notice


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def without(record, *names):
    return {k: x for k, x in record.items() if k not in names}


def test_nulls_of_pages(spark, tmp_path):
    bare = without(notice("b"), "objetoCompra")
    land(tmp_path, "r", {
        1: {"totalPaginas": 4, "data": [notice("a", objetoCompra=None, orgaoEntidade=None, valorTotalEstimado=[None]), bare]},
        2: {"totalPaginas": 4, "data": None}, 3: "no json", 4: {"totalPaginas": 4, "data": []},
        5: json.dumps([{"data": [notice("c", anoCompra=None)]}, {"data": [notice("d", unidadeOrgao={"ufSigla": None})]}]),
    })
    records = pages.records(pages.read_pages(spark, str(tmp_path), explicit_nulls=True))
    assert {r[v.BRONZE_KEY]: r[NULLS] for r in records.collect()} == {"a": ["objetoCompra", "orgaoEntidade"], "b": [], "c": ["anoCompra"], "d": []}
    plain = pages.records(pages.read_pages(spark, str(tmp_path)))
    assert NULLS not in plain.columns and rows_of(plain) == rows_of(records.drop(NULLS))


def test_compacted_lines(spark, tmp_path):
    (tmp_path / "lote=x").mkdir()
    lines = [{"numeroPagina": n, "totalPaginas": 2, "data": [notice(f"k{n}", objetoCompra=None)]} for n in (1, 2)]
    (tmp_path / "lote=x" / "all.json").write_text("\n".join(map(json.dumps, lines)) + "\nbroken {", encoding="utf-8")
    records = pages.records(pages.read_pages(spark, str(tmp_path), one_page_per_file=False, explicit_nulls=True))
    assert {(r[v.BRONZE_KEY], r["pagina"], *r[NULLS]) for r in records.collect()} == {("k1", 1, "objetoCompra"), ("k2", 2, "objetoCompra")}


def test_last_given_value_counts_null_or_not(spark):
    rows = [("a", 1, "x", 1, []), ("a", 2, None, None, ["s"]), ("a", 3, None, 3, []), ("b", 1, None, None, ["s", "n"]), ("b", 2, "y", None, []), (None, 1, None, 5, [])]
    merged = latest.merge_last(spark.createDataFrame(rows, f"k string, page int, s string, n int, {NULLS} array<string>"), ["k"], ["page"], NULLS)
    assert rows_of(merged.select("k", "s", "n", NULLS)) == sorted([("a", None, 3, ["s"]), ("b", "y", None, ["n"]), (None, None, 5, [])], key=str)


def test_merge_and_its_counts(spark):
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, None), ("d", 4, "z")], "k string, v int, s string")
    batch = spark.createDataFrame(
        [("a", None, None, ["s"]), ("b", None, None, []), ("c", None, None, ["s"]), ("d", 9, None, None), ("new", 1, None, ["s"])], f"k string, v int, s string, {NULLS} array<string>"
    )
    out = reconcile.reconcile(stored, batch, ["k"], merge_fields=True, nulls=NULLS)
    assert rows_of(out) == [("a", 1, None, "atualizado"), ("b", 2, "y", "inalterado"), ("c", 3, None, "inalterado"), ("d", 9, "z", "atualizado"), ("new", 1, None, "inserido")]
    # once more changes nothing
    again = reconcile.reconcile(out.drop(reconcile.STATUS), batch, ["k"], merge_fields=True, nulls=NULLS)
    assert reconcile.change_counts(again).first()["atualizados"] == 0


@pytest.mark.parametrize("explicit", [True, False])
@pytest.mark.parametrize("stream", [True, False])
def test_run_empties_silver_fields(spark, tmp_path, explicit, stream):
    lake = daily.Lake(spark, str(tmp_path / "lake"))
    first, second = tmp_path / "in" / "1", tmp_path / "in" / "2"
    land(first, "20260115_20260116", {1: {"totalPaginas": 1, "data": [notice("a", objetoCompra="Obra"), notice("b", objetoCompra="Obra")]}})
    again = [notice("a", objetoCompra=None, valorTotalEstimado=None), without(notice("b"), "objetoCompra", "valorTotalEstimado")]
    for folder in (first, second):
        if folder == second:
            land(second, "20260116_20260117", {1: {"totalPaginas": 1, "data": again}})
        if stream:
            records = pages.records(pages.stream_pages(spark, str(tmp_path / "in"), explicit_nulls=explicit))
            streams.finish(streams.lake_stream(records, lake, str(tmp_path / "check")))
        else:
            daily.run(lake, pages.read_pages(spark, str(folder), explicit_nulls=explicit), "20260115", "20260116", dt.datetime(2026, 2, 1))
    got = {r["numero_controle_pncp"]: (r["objeto_compra"], r["valor_total_estimado"], r["ramo_mei"]) for r in lake.silver.read().collect()}
    assert got["b"] == ("Obra", 100.5, "Obras")
    assert got["a"] == ((None, None, v.CATEGORY_DEFAULT) if explicit else ("Obra", 100.5, "Obras"))


def test_emptied_date_moves_the_notice_to_the_null_partition(spark, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "lake"))
    for n, date in enumerate(("2026-01-15T10:00:00", None)):
        land(tmp_path / str(n), "20260115_20260116", {1: {"totalPaginas": 1, "data": [notice("a", dataPublicacaoPncp=date)]}})
        daily.ingest(lake, pages.read_pages(spark, str(tmp_path / str(n)), explicit_nulls=True))
    stored = lake.bronze.read()
    assert rows_of(stored.select(v.BRONZE_KEY, "dataPublicacaoPncp", "publication_part")) == [("a", None, None)]
    assert stored.filter(F.col("objetoCompra").isNotNull()).count() == 1
