"""Text filters by partition, and first rows without a whole scan."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from noticelake import vocabulary as v
from noticelake.functions import text
from noticelake.operators import trigrams
from noticelake.plans import daily, tools
from noticelake.schemas import PARTITION
from tests.test_key_index import break_files
from tests.test_stored_periods import at, run

AS_OF = dt.datetime(2026, 2, 1)


def parts_of(spark, texts, pattern):
    """Partitions by the filters, and those that truly hold a match."""
    rows = spark.createDataFrame(texts, f"objeto_compra string, {PARTITION} string")
    wanted = trigrams.fixed_places(spark, pattern)
    true = {r[0] for r in rows.filter(text.search(F.col("objeto_compra"), pattern)).select(PARTITION).collect()}
    return (None if wanted is None else trigrams.partitions_with(trigrams.filters(rows), wanted)), true


def test_filters_never_miss_a_match(spark):
    r = random.Random(3)
    words = ["limpeza", "LICENÇA", "İnstalação", "straße", "ſoftware", "Kelvin", "ΣΟΦΟΣ", "obra\nde reforma", "ab", "", "ΐτ", "😀😀😀x", "ﬁnal", "ǅungla"]
    texts = [(None if k % 17 == 0 else " ".join(r.choice(words) for _ in range(3)), None if k % 11 == 0 else f"p{k % 23}") for k in range(120)]
    for pattern in ("limpeza", "licença|obra", "instalação", "STRASSE", "software", "kelvin", "σοφος|limpeza.*licença", "obra\nde", "😀😀😀", "final", "ǆungla"):
        possible, true = parts_of(spark, texts, pattern)
        assert possible is not None and true <= possible, pattern


def test_filters_skip(spark):
    texts = [(f"palavra{k} comum", f"p{k}") for k in range(100, 140)] + [(None, "empty"), ("xy", "short")]
    assert parts_of(spark, texts, "palavra107")[0] == {"p107"}
    assert parts_of(spark, texts, "PALAVRA107|a130")[0] == {"p107", "p130"}
    assert parts_of(spark, texts, "palavra1.*comum")[0] >= {"p100", "p139"} and not {"empty", "short"} & parts_of(spark, texts, "comum")[0]
    assert parts_of(spark, texts, "nenhures")[0] == set()


@pytest.mark.parametrize("pattern", ["ab", "limpeza|ab", "li[mn]peza", "(limpeza)", "limpe?za", "a.b.c", "^limpeza", r"limpeza\b", "limpeza|", ".*"])
def test_patterns_without_fixed_text_scan_everything(spark, pattern):
    assert trigrams.fixed_places(spark, pattern) is None


@pytest.fixture
def lake(spark, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "tables"), "day", text_index=True)
    run(lake, spark, tmp_path / "1", "20260110", "20260120", [at(f"k{d}", f"2026-01-{d}", objetoCompra=f"Serviço raro{d}") for d in range(10, 21)] + [at("odd", "2026-01-1:T", objetoCompra="Obra")])
    return lake


def found(lake, **arguments):
    return [r["numero_controle_pncp"] for r in tools.buscar_contratacoes(lake.tables(), **arguments).collect()]


def silver_folder(tmp_path, day):
    return tmp_path / "tables" / v.SILVER / f"{PARTITION}=2026-01-{day}"


def test_search_opens_only_partitions_that_can_match(lake, spark, tmp_path):
    for day in (10, 12, 20):
        break_files(silver_folder(tmp_path, day))
    assert found(lake, texto_objeto="RARO13|raro15") == ["k13", "k15"]
    assert found(lake, texto_objeto="obra") == ["odd"]
    assert found(lake, texto_objeto="nenhures") == []
    with pytest.raises(Exception, match="(?i)parquet"):
        found(lake, texto_objeto="raro1[35]")


def test_changed_partitions_are_searched_before_and_after_the_next_run(lake, spark, tmp_path):
    rows = lake.silver.read().filter("numero_controle_pncp = 'k13'").withColumn("objeto_compra", F.lit("Novidade"))
    lake.silver.upsert(rows)
    assert found(lake, texto_objeto="novidade") == ["k13"]
    daily.aggregate(lake, "20260110", "20260120", AS_OF)
    assert lake.silver.logged_parts() == (set(), [])
    assert lake.text_parts("novidade") == {"2026-01-13"} and lake.text_parts("raro13") == set()
    assert found(lake, texto_objeto="novidade") == ["k13"]


def test_a_limit_alone_opens_the_first_partition(lake, tmp_path):
    whole = found(lake)
    for limit in (1, 2, 5, 11, 12, 40):
        assert found(lake, limite=limit) == whole[:limit]
    for day in range(11, 21):
        break_files(silver_folder(tmp_path, day))
    assert found(lake, limite=1) == ["k10"]
    assert found(lake, limite=1, uf="PE") == whole[:1]
    assert found(lake, limite=1, data_inicial="20260101", data_final="20260131") == ["k10"]


def test_walk_with_filters_equals_the_scan(lake):
    for arguments in ({"uf": "SP"}, {"texto_objeto": "raro1"}, {"data_inicial": "20260112", "data_final": "20260114"}, {"texto_objeto": "raro2|raro19"}):
        assert found(lake, limite=2, **arguments) == found(lake, **arguments)[:2]
    with pytest.raises(ValueError):
        found(lake, limite=0)


def test_lakes_without_filters_scan(spark, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "tables"), "year")
    run(lake, spark, tmp_path / "1", "20260110", "20260111", [at("a", "2026-01-10", objetoCompra="Obra")])
    assert lake.text_parts("obra") is None and found(lake, texto_objeto="obra", limite=1) == ["a"]
