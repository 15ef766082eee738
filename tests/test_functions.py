"""Column expressions on edge values."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from noticelake.functions import dates, text, values
from noticelake.operators import silver


def column(spark, items, expression, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


def test_category_rules_in_order(spark):
    cases = {
        "COBRANÇA de multas": "Obras",
        "Calçamento com sistema": "Obras",
        "Manutenção de equipamento": "Serviços",
        "Parati turismo": "TI",
        "curso de TI": "Outros",
        "Servico sem acento": "Outros",
        None: "Outros",
        "": "Outros",
        "AQUISIÇÃO de cadeiras": "Compras",
    }
    assert column(spark, list(cases), text.first_rule) == list(cases.values())


def test_plain_and_regex_rules_agree(spark):
    texts = ["uma obra", "OBRA", "cobra criada", "nada", None, "a.b", "axb", ""]
    plain = column(spark, texts, lambda c: text.first_rule(c, [("sim", "obra|criada")], "não"))
    regex = column(spark, texts, lambda c: text.first_rule(c, [("sim", "(obra|criada)")], "não"))
    assert plain == regex
    assert column(spark, texts, lambda c: text.first_rule(c, [("sim", "^a.b$")], "não")) == [
        "não", "não", "não", "não", "não", "sim", "sim", "não",
    ]


def test_search_ignores_case_of_accents(spark):
    assert column(spark, ["LICENÇA", "licença", "licenca", None], lambda c: text.search(c, "Licença")) == [
        True, True, False, None,
    ]


def test_bands_include_their_bound(spark):
    amounts = [None, math.nan, 0.0, 17600.0, 17600.01, 80000.0, 500000.0, 500000.01, math.inf, -1.0]
    assert column(spark, amounts, values.band, "double") == [
        "Sem valor informado", "Sem valor informado", "Ate R$17.600", "Ate R$17.600", "R$17.601 a R$80.000",
        "R$17.601 a R$80.000", "R$80.001 a R$500.000", "Acima de R$500.000", "Acima de R$500.000", "Ate R$17.600",
    ]


def test_casts_give_null_not_errors(spark):
    assert column(spark, ["1.5", "abc", None, "NaN", "1e3", ""], values.to_double) == [1.5, None, None, None, 1000.0, None]
    assert column(spark, ["2026", "2026.0", "x", None, "99999999999"], values.to_whole) == [2026, 2026, None, None, None]
    assert column(spark, ["2026-01-15T10:20:30", "xx", None, "2026-12-01"], dates.month_of) == [1, None, None, 12]


def test_money_sum_is_exact_and_whole(spark):
    def total(amounts):
        rows = spark.createDataFrame([(x,) for x in amounts], "x double")
        return rows.agg(values.money_sum(F.col("x")).alias("t")).first()[0]

    assert total([0.1] * 10) == 1.0
    assert total([None, None]) == 0.0
    assert total([]) == 0.0
    assert total([1.5, None]) == 1.5
    assert total([1e30, 2.0]) == 1e30 + 2.0
    assert total([math.inf, 1.0]) == math.inf


def test_money_is_rounded_as_decimal(spark):
    rows = spark.createDataFrame([(2.675,)], "x double")
    assert rows.agg(values.money_sum_rounded(F.col("x"))).first()[0] == 2.68


def test_range_is_inclusive_text_order(spark):
    stamps = ["2026-01-01", "2026-01-31T23:59:59", "2026-01-31T23:59:59.5", "2026-02-01", None, "2025-12-31T23:59:59"]
    inside = column(spark, stamps, lambda c: dates.published_between(c, "20260101", "20260131"))
    assert inside == [True, True, False, False, None, False]


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_partition_filter_never_prunes_a_match(spark, grain):
    stamps = ["2026-01-01", "2026-01-31T23:59:59", "2026-02-01", "junk", "2026-13-77", "", "2026", "2026-01-31T23:59:59.5"]
    rows = spark.createDataFrame([(s,) for s in stamps], "s string")
    rows = rows.withColumn("part", dates.publication_part(F.col("s"), grain))
    for start, end in [("20260101", "20260131"), ("2026", "20260131"), ("20251231", "20261399")]:
        match = dates.published_between(F.col("s"), start, end)
        kept = dates.part_between(F.col("part"), start, end)
        assert rows.filter(match & ~kept).count() == 0


def test_compact_dates(spark):
    assert dates.iso_day("20260131") == "2026-01-31"
    assert dates.iso_day("2026-01-31") == "2026-01-31"
    assert column(spark, ["20260131", "202601", None], dates.iso_day_of) == ["2026-01-31", "202601", None]
    assert dates.split_period("20260101_20260102") == ("20260101", "20260102")
    with pytest.raises(ValueError):
        dates.split_period("20260101")


def test_load_time_can_be_given(spark):
    rows = silver.stamp_load(spark.range(1), F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    assert rows.selectExpr("cast(data_coleta as string)").first()[0] == "2026-01-01 00:00:00"
    assert silver.stamp_load(spark.range(1)).first()["data_coleta"] is not None
