"""Stream forms against their batch forms."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from noticelake import schemas
from noticelake import vocabulary as v
from noticelake.functions import values
from noticelake.operators import silver
from noticelake.plans.daily import Lake
from noticelake.sinks.keyed import KeyedTable
from noticelake.sources import pages
from noticelake.streaming import dedup, missing, sliding
from noticelake.streaming import upsert as streams
from noticelake.schemas import PARTITION
from tests.test_key_index import break_files
from tests.test_pages import land, notice

EVENTS = "id string, ts timestamp, n int"


def write_events(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode(mode).parquet(path)


def moment(hour, second=0):
    return dt.datetime(2026, 1, 1) + dt.timedelta(hours=hour, seconds=second)


@pytest.mark.parametrize("spread", [1, 8])
def test_hot_key_is_kept_once_over_batches(spark, tmp_path, spread):
    source = str(tmp_path / "in")
    for part in range(3):
        rows = [("hot", moment(part, s), s) for s in range(200)] + [(f"k{part}-{s}", moment(part, s), s) for s in range(50)]
        write_events(spark, source, rows + rows[:20])
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    once = dedup.first_seen(stream, ["id"], "ts", "2 days", spread)
    streams.finish(streams.append_stream(once, str(tmp_path / "out"), str(tmp_path / "check")))
    got = sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(["hot"] + [f"k{p}-{s}" for p in range(3) for s in range(50)])


def test_periods_of_a_stream_equal_the_table(spark, tmp_path):
    source = str(tmp_path / "in")
    for part in range(3):
        write_events(spark, source, [(f"u{i % 3}", moment(24 * part + i), i) for i in range(20)])
    measures = [F.count("*").alias("total"), values.money_sum(F.col("n").cast("double")).alias("soma")]
    table = sliding.sliding_periods(spark.read.schema(EVENTS).parquet(source), "ts", ["id"], measures)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    totals = sliding.sliding_periods(stream, "ts", ["id"], measures)
    streams.finish(streams.replace_stream(totals, str(tmp_path / "out"), str(tmp_path / "check")))
    got = sorted(map(tuple, spark.read.schema(totals.schema).parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(tuple, table.collect()))
    assert {r[0] for r in got} == {"20251231", "20260101", "20260102", "20260103"}


@pytest.mark.parametrize("layer", ["bronze", "lake"])
def test_pages_arriving_over_time(spark, tmp_path, layer):
    source = tmp_path / "in"
    lake = Lake(spark, str(tmp_path / "lake"))
    table = KeyedTable(spark, str(tmp_path / "t"), schemas.BRONZE, (v.BRONZE_KEY,), merge_fields=True)

    def arrive():
        records, check = pages.records(pages.stream_pages(spark, str(source), files_per_batch=2)), str(tmp_path / "check")
        if layer == "lake":
            streams.finish(streams.lake_stream(records, lake, check))
        else:
            streams.finish(streams.upsert_stream(records, table, streams.to_bronze_rows(), check))

    def stored():
        return silver.flatten(table.read()) if layer == "bronze" else lake.silver.read()

    land(source, "20260115_20260116", {
        n: {"totalPaginas": 3, "data": [notice(f"k{n}"), notice("same", situacaoCompraNome=f"s{n}", objetoCompra="Obra")]} for n in (1, 2, 3)
    })
    arrive()
    assert stored().count() == 4
    again = notice("same", situacaoCompraNome="last", objetoCompra=None, valorTotalEstimado=None)
    land(source, "20260116_20260117", {1: {"totalPaginas": 1, "data": [again]}, 2: ""})
    arrive()
    arrive()
    rows = {r["numero_controle_pncp"]: r for r in stored().collect()}
    assert rows.keys() == {"k1", "k2", "k3", "same"} and rows["same"]["situacao_nome"] == "last"
    # fields that the repeat leaves out stay as they are stored, in Silver as in Bronze
    assert rows["same"]["objeto_compra"] == "Obra" and rows["same"]["valor_total_estimado"] == 100.5
    if layer == "lake":
        assert rows["same"]["ramo_mei"] == "Obras"


def test_updates_of_periods_with_bounded_state(spark, tmp_path):
    """Late rows, a restart between arrivals: the table equals the batch, and state of closed periods is gone."""
    source, check = str(tmp_path / "in"), str(tmp_path / "check")
    measures = [F.count("*").alias("total"), values.money_sum(F.col("n").cast("double")).alias("soma")]
    states, stored = [], None
    for day in range(12):
        late = [("late", moment(24 * (day - 1) + 1), 7)] if day % 3 == 2 else []
        write_events(spark, source, [(f"u{i % 3}", moment(24 * day + i), i) for i in range(20)] + late)
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
        totals = sliding.sliding_periods(stream, "ts", ["id"], measures, delay="2 days")
        stored = stored or streams.period_table(totals, str(tmp_path / "out"), ["id"])
        query = streams.period_stream(totals, stored, check)
        streams.finish(query)
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    table = sliding.sliding_periods(spark.read.schema(EVENTS).parquet(source), "ts", ["id"], measures)
    got = sorted(map(tuple, stored.read().drop(PARTITION).collect()))
    assert got == sorted(map(tuple, table.collect()))
    assert any(r[2] == "late" for r in got)
    # 13 periods and 4 keys went through; periods that the watermark has passed are gone
    assert max(states) <= 20 and any(b < a for a, b in zip(states, states[1:]))


def test_stream_opens_only_the_partitions_of_its_keys(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))

    def arrive():
        streams.finish(streams.lake_stream(pages.records(pages.stream_pages(spark, str(source))), lake, str(tmp_path / "check")))

    land(source, "20260115_20260116", {1: {"totalPaginas": 1, "data": [notice("a"), notice("b", dataPublicacaoPncp="2026-01-16T08:00:00")]}})
    arrive()
    for table in (v.BRONZE, v.SILVER):
        break_files(tmp_path / "lake" / table / f"{PARTITION}=2026-01-16")
    land(source, "20260117_20260118", {1: {"totalPaginas": 1, "data": [notice("a", dataPublicacaoPncp="2026-01-17T08:00:00"), notice("c")]}})
    arrive()
    rows = lake.silver.read().filter(F.col(PARTITION) != "2026-01-16").collect()
    assert {(r["numero_controle_pncp"], r[PARTITION]) for r in rows} == {("a", "2026-01-17"), ("c", "2026-01-15")}


def test_late_pages_are_reported_and_taken_back(spark, tmp_path):
    """Two runs, a patience of an hour, totals that grow, repeats, a restart at every step."""
    source, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    schema, landed, told = "lote string, pagina int, totalPaginas int, chegada timestamp", [], []

    def arrive(*rows):
        landed.extend(rows)
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        streams.finish(missing.late_page_stream(spark.readStream.schema(schema).parquet(source), out, check, "1 hour"))
        events = spark.read.schema(missing.EVENTS).parquet(out)
        new = sorted(set(map(tuple, events.collect())) - set(told), key=str)
        told.extend(new)
        return new, sorted(tuple(r) for r in missing.still_missing(events).collect())

    assert arrive(("a", 1, 4, moment(0)), ("a", 3, None, moment(0)), ("b", 2, 2, moment(0)))[0] == []
    # an hour has passed for both, as another run lands
    new, now = arrive(("c", 1, 1, moment(2)))
    assert now == [("a", 2), ("a", 4), ("b", 1)] and {e[2] for e in new} == {missing.LATE}
    new, now = arrive(("a", 2, 4, moment(2.5)), ("b", 1, 2, moment(2.5)), ("b", 1, 2, moment(2.5)))
    assert new == [("a", 2, missing.LANDED), ("b", 1, missing.LANDED)] and now == [("a", 4)]
    # more pages are announced, far apart
    new, now = arrive(("a", 20_000, 20_001, moment(3)), ("c", 1, 1, moment(5)))
    assert now == sorted([("a", 4)] + [("a", n) for n in range(5, 20_000)] + [("a", 20_001)])
    batch = pages.missing_pages(spark.createDataFrame(landed, schema))
    assert sorted(map(tuple, batch.collect())) == now
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "HDFS").find("RocksDB") < 0
