"""Landed pages: reading, bad bodies, missing pages."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from noticelake import vocabulary as v
from noticelake.operators import silver
from noticelake.plans import daily
from noticelake.plans.daily import Lake
from noticelake.sources import pages


def notice(key, **fields):
    base = {
        "numeroControlePNCP": key, "anoCompra": 2026, "objetoCompra": "Serviço de limpeza",
        "dataPublicacaoPncp": "2026-01-15T10:20:30", "modalidadeId": 8, "modalidadeNome": "Dispensa",
        "situacaoCompraId": "1", "situacaoCompraNome": "Divulgada no PNCP", "valorTotalEstimado": 100.5,
        "orgaoEntidade": {"cnpj": "1", "razaoSocial": "Órgão"}, "unidadeOrgao": {"municipioNome": "Recife", "ufSigla": "PE"},
    }
    return {**base, **fields}


def land(root, run, bodies):
    for number, body in bodies.items():
        folder = root / f"lote={run}" / f"pagina={number}"
        folder.mkdir(parents=True)
        text = body if isinstance(body, str) else json.dumps(body, ensure_ascii=False, indent=1)
        (folder / "corpo.json").write_text(text, encoding="utf-8")


@pytest.fixture
def landed(spark, tmp_path):
    first = notice("k1")
    changed = notice("k1", situacaoCompraNome="Encerrada", valorTotalEstimado=None)
    bare = notice("k2", valorTotalEstimado="77.5", anoCompra="2025", situacaoCompraId=3)
    del bare["orgaoEntidade"]
    land(tmp_path, "20260115_20260116", {
        1: {"totalPaginas": 3, "totalRegistros": 5, "data": [first, bare]},
        2: "",
        3: {"totalPaginas": 3, "totalRegistros": 5, "data": [changed, notice(None), notice(None, objetoCompra="Obra")]},
    })
    land(tmp_path, "20260116_20260117", {1: {"data": [notice("k9")]}})
    land(tmp_path, "20260117_20260118", {1: {"totalPaginas": 2, "totalRegistros": 0}, 2: "<html>erro</html>"})
    return pages.read_pages(spark, str(tmp_path))


def test_pages_and_records(landed):
    seen = {(r["lote"][:8], r["pagina"], r["totalPaginas"]) for r in landed.collect()}
    assert seen == {("20260115", 1, 3), ("20260115", 3, 3), ("20260116", 1, 1), ("20260117", 1, 2)}
    rows = pages.records(landed).select("lote", "pagina", "pos", v.BRONZE_KEY).collect()
    assert sorted((r[1], r[2], str(r[3])) for r in rows if r[0].startswith("20260115")) == [
        (1, 0, "k1"), (1, 1, "k2"), (3, 0, "k1"), (3, 1, "None"), (3, 2, "None"),
    ]
    assert len(rows) == 6


def test_missing_pages(landed):
    got = {(r["lote"][:8], r["pagina"]) for r in pages.missing_pages(landed).collect()}
    assert got == {("20260115", 2), ("20260117", 2)}


def test_many_missing_pages(spark):
    landed = spark.createDataFrame([("r", 1, 25_001), (None, 2, 3)], "lote string, pagina int, totalPaginas int")
    missing = pages.missing_pages(landed)
    assert missing.filter("lote = 'r'").count() == 25_000
    assert sorted(r[0] for r in missing.filter("lote is null").select("pagina").collect()) == [1, 3]
    assert missing.filter("lote = 'r'").agg(F.max("pagina")).first()[0] == 25_001


def test_silver_types_survive_mixed_json(landed):
    rows = {r["numero_controle_pncp"]: r for r in silver.flatten(pages.records(landed)).filter("razao_social is null").collect()}
    assert rows["k2"]["valor_total_estimado"] == 77.5
    assert rows["k2"]["ano_compra"] == 2025
    assert rows["k2"]["situacao_id"] == "3"
    assert rows["k2"]["cnpj_orgao"] is None


def test_compacted_lines(spark, tmp_path):
    folder = tmp_path / "lote=20260115_20260116"
    folder.mkdir()
    lines = [
        {"numeroPagina": n, "totalPaginas": 3, "totalRegistros": 2, "data": [notice(f"k{n}")]} for n in (1, 3)
    ]
    (folder / "x.json").write_text("\n".join(json.dumps(x) for x in lines))
    read = pages.read_pages(spark, str(tmp_path), one_page_per_file=False)
    assert sorted((r["pagina"], r["pos"], r[v.BRONZE_KEY]) for r in pages.records(read).collect()) == [
        (1, 0, "k1"), (3, 0, "k3"),
    ]
    assert [r["pagina"] for r in pages.missing_pages(read).collect()] == [2]


def test_requested_range_modality_state(landed):
    notices = pages.records(landed)
    assert pages.requested(notices, "20260115", "20260115", uf="pe").count() == 6
    assert pages.requested(notices, "20260115", "20260115", uf="SP").count() == 0
    assert pages.requested(notices, "20260116", "20260117").count() == 0
    assert pages.requested(notices, "20260101", "20260131", modality=6).count() == 0


def test_bare_records(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([notice("a"), {"numeroControlePNCP": "b"}]))
    rows = silver.flatten(pages.read_records(spark, str(tmp_path / "r.json")))
    assert sorted((r["numero_controle_pncp"], r["uf"]) for r in rows.collect()) == [("a", "PE"), ("b", None)]


SPOILT = {
    1: '{"totalPaginas":9,"data":[1,{"numeroControlePNCP":"a"},"x",null,[2],{"numeroControlePNCP":"b","orgaoEntidade":5}]}',
    2: '{"totalPaginas":9,"data":{"numeroControlePNCP":"c"}}', 3: '{"totalPaginas":9,"data":[{"numeroControlePNCP":"d"', 4: "[1, 2]", 5: '"s"', 6: "",
    7: '{"totalPaginas":9}', 8: '{"totalPaginas":9,"data":null}', 9: '{"totalPaginas":9,"data":[]}',
}


def test_rejected_content(spark, tmp_path):
    land(tmp_path, "r", SPOILT)
    records = pages.records(pages.read_pages(spark, str(tmp_path))).select(v.BRONZE_KEY, "pagina", "pos")
    assert sorted(map(tuple, records.collect())) == [("a", 1, 1), ("b", 1, 5)]
    found = pages.rejected(spark, str(tmp_path))
    got = {(r["pagina"], r["posicao"], r["motivo"], r["conteudo"]) for r in found.collect()}
    assert got == {
        (1, 0, pages.NO_RECORD, "1"), (1, 2, pages.NO_RECORD, '"x"'), (1, 3, pages.NO_RECORD, "null"), (1, 4, pages.NO_RECORD, "[2]"),
        (2, None, pages.NO_LIST, '{"numeroControlePNCP":"c"}'), (3, None, pages.BAD_BODY, None), (4, None, pages.BAD_BODY, None), (5, None, pages.BAD_BODY, None),
    }
    assert found.count() == len(got) and {r["arquivo"].rsplit("/", 2)[1] for r in found.collect()} == {f"pagina={n}" for n in (1, 2, 3, 4, 5)}
    # the empty file is no page that was landed: it is missing, as are the bodies that cannot be read
    assert {r["pagina"] for r in pages.missing_pages(pages.read_pages(spark, str(tmp_path))).collect()} == {3, 4, 5, 6}


def test_rejected_content_is_kept_by_run(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.rejected().count() == 0
    for run, bodies in (("r1", SPOILT), ("r2", {1: SPOILT[3]}), ("r1", {10: SPOILT[4]})):
        folder = tmp_path / f"{run}-{len(bodies)}"
        land(folder, run, bodies)
        counts = daily.run(lake, pages.read_pages(spark, str(folder)), "20260115", "20260116", rejected=pages.rejected(spark, str(folder)))["rejeitados"]
        assert counts == {run: 8 if len(bodies) > 1 else 1}
    assert sorted((r["lote"], r["pagina"]) for r in lake.rejected().collect()) == [("r1", 10), ("r2", 1)]
    assert daily.keep_rejected(lake, pages.rejected(spark, str(folder)).limit(0)) == {}


def test_runs_outside_of_a_request_are_not_opened(spark, tmp_path):
    for day in range(10, 16):
        land(tmp_path, f"202601{day}_202601{day + 1}", {1: {"totalPaginas": 1, "data": [notice(f"k{day}", dataPublicacaoPncp=f"2026-01-{day}T10:00:00")]}})
    land(tmp_path, "extra", {1: {"totalPaginas": 1, "data": [notice("x", dataPublicacaoPncp="2026-01-12T11:00:00"), notice("y", dataPublicacaoPncp="2026-03-01")]}})
    frame = pages.read_requested(spark, str(tmp_path), "20260112", "20260112")
    assert sorted(r[v.BRONZE_KEY] for r in frame.collect()) == ["k12", "x"]
    opened = {f.split("lote=")[1].split("/")[0] for f in frame.inputFiles()}
    assert opened == {"20260111_20260112", "20260112_20260113", "extra"}
    assert {r[v.BRONZE_KEY] for r in pages.read_requested(spark, str(tmp_path), "20260112", "20260113", explicit_nulls=True).collect()} == {"k12", "k13", "x"}
    assert pages.read_requested(spark, str(tmp_path), "20250101", "20250102").count() == 0
    assert pages.read_requested(spark, str(tmp_path / "lote=extra"), "20260101", "20260131").count() == 0
    assert pages.read_requested(spark, str(tmp_path / "nowhere"), "20260101", "20260131").count() == 0
