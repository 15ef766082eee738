"""The registered queries: name -> function of (spark, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake import schemas
from noticelake import vocabulary as v
from noticelake.functions import dates, text, values
from noticelake.functions import predicates as p
from noticelake.operators import latest, periods, reconcile, rollup, silver
from noticelake.plans import daily, questions, tools
from noticelake.registry.notices import (
    all_tables,
    bronze_rows,
    nest,
    notices,
    silver_rows,
    table,
    write_pages,
)
from noticelake.sinks import json_rows
from noticelake.sinks.keyed import KeyedTable
from noticelake.sinks.versioned import VersionedTable
from noticelake.sources import pages
from noticelake.sources.tables import Tables, bronze_slice, silver_slice
from noticelake.streaming import dedup, missing, sliding
from noticelake.streaming import upsert as streams
from noticelake.workspace import fresh_dir, scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: All order dates; also the one period the plain Gold queries are made for.
FIRST_DAY, LAST_DAY = "19950101", "20010801"
PERIOD = (FIRST_DAY, LAST_DAY)
A_PERIOD = "19960214_19960215"
#: A period of 31 days: no run has made it.
A_MONTH = "19960101_19960131"
A_STATE = "nation_7"
A_STATE_IN_PERIOD = "nation_15"
A_REGION = "ASIA"
ACCENTED = "ÉMENT|ÜN|AÑO|ÇÃO"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- projections and rules -------------------------------------------------


@query
def silver_view(spark, sf):
    """P3 P4 P8 P9 beside the 13 columns."""
    return silver.with_dimensions(silver.classify(notices(spark, sf)))


@query
def classify_ramo(spark, sf):
    """P3."""
    return notices(spark, sf).transform(silver.classify).select("numero_controle_pncp", "ramo_mei")


@query
def classify_documents(spark, sf):
    """P3 on whole document texts."""
    return silver.classify(table(spark, sf, "documents"), "text", "ramo_mei").select("doc_id", "ramo_mei")


@query
def bucketize_valor(spark, sf):
    """P4 F9."""
    value = F.col("valor_total_estimado")
    return notices(spark, sf).select("numero_controle_pncp", value, values.band(value).alias("faixa_valor"))


@query
def casts(spark, sf):
    """P2 P8 P9 on text that is often no number and no date."""
    raw = F.col("o_orderpriority")
    mixed = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("string")).otherwise(raw)
    moment = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(raw)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        values.to_double(mixed).alias("valor"),
        values.to_whole(F.col("o_orderkey").cast("string")).alias("numero"),
        values.to_whole(raw).alias("prioridade"),
        dates.month_of(moment).alias("mes"),
    )


@query
def compact_dates(spark, sf):
    """Compact to ISO, other lengths passed through, period split."""
    compact = dates.compact_day_of(F.col("o_orderdate"))
    short = F.when(F.col("o_orderstatus") == "F", compact).otherwise(F.date_format("o_orderdate", "yyyyMM"))
    period = F.split(F.concat_ws("_", compact, dates.compact_day_of(F.date_add("o_orderdate", 1))), "_")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.iso_day_of(short).alias("dia"),
        period[0].alias("periodo_inicio"),
        period[1].alias("periodo_fim"),
    )


# --- filters ---------------------------------------------------------------


@query
def range_lexicographic(spark, sf):
    """F1 on text dates, one in six with a fraction in the last second."""
    stamp = F.when(
        F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd'T23:59:59.5'")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T23:59:59'"))
    rows = table(spark, sf, "orders").select("o_orderkey", stamp.alias("publicado"))
    return rows.filter(dates.published_between(F.col("publicado"), "19960101", "19961231"))


@query
def regex_ci_unicode(spark, sf):
    """F5."""
    return table(spark, sf, "documents").filter(text.search(F.col("text"), ACCENTED)).select("doc_id", "lang")


@query
def optional_filters(spark, sf):
    """Two given arguments, one empty."""
    keep = p.every(p.state_is(A_STATE), p.category_is("Obras"), p.text_has(""))
    return silver_rows(spark, sf).filter(keep).select("numero_controle_pncp", "uf", "ramo_mei")


# --- sources ---------------------------------------------------------------


def _landed(spark: SparkSession, sf: str, one_page_per_file: bool = True) -> DataFrame:
    path = write_pages(bronze_rows(spark, sf), fresh_dir(spark, "pages"), one_page_per_file)
    return pages.read_pages(spark, path, one_page_per_file)


@contextmanager
def _landing(spark: SparkSession, nested: DataFrame) -> Iterator[DataFrame]:
    """Pages that are there only as long as a run needs them."""
    with scratch(spark, "pages") as path:
        write_pages(nested, path, one_page_per_file=False)
        yield pages.read_pages(spark, path, one_page_per_file=False)


@query
def pages_explode(spark, sf):
    """One page a file; run and page from the path, place from the array."""
    return pages.records(_landed(spark, sf)).select(
        "lote", "pagina", "pos", F.col(v.BRONZE_KEY).alias("numero_controle_pncp"), F.col("unidadeOrgao.ufSigla").alias("uf")
    )


@query
def page_totals(spark, sf):
    """The envelope of each page."""
    return _landed(spark, sf, one_page_per_file=False).select(
        "lote", "pagina", "totalPaginas", "totalRegistros", F.size("data").alias("registros")
    )


@query
def bronze_flatten(spark, sf):
    """Landed JSON back to 13 typed columns."""
    return silver.flatten(pages.records(_landed(spark, sf, one_page_per_file=False)))


@query
def source_request(spark, sf):
    """S2 F8."""
    rows = pages.requested(bronze_rows(spark, sf), "19970101", "19971231", v.MODALITY, A_STATE)
    return rows.select(F.col(v.BRONZE_KEY).alias("numero_controle_pncp"), "dataPublicacaoPncp")


@query
def source_pages_pushed(spark, sf):
    """A request answered from the pages of the runs that meet its range; a run a month is landed."""
    path, date = fresh_dir(spark, "pages"), F.to_date(F.substring("dataPublicacaoPncp", 1, 10))
    run = F.concat_ws("_", F.date_format(F.trunc(date, "month"), "yyyyMMdd"), F.date_format(F.last_day(date), "yyyyMMdd"))
    write_pages(nest(notices(spark, sf)).withColumn("lote", run), path, one_page_per_file=False)
    rows = pages.read_requested(spark, path, "19970110", "19970215", v.MODALITY, A_STATE, one_page_per_file=False)
    return rows.select(F.col(v.BRONZE_KEY).alias("numero_controle_pncp"), "dataPublicacaoPncp")


@query
def missing_pages(spark, sf):
    """S3: order priorities as runs, customers with an order in it as landed pages."""
    landed = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("lote"), F.col("o_custkey").cast("int").alias("pagina"),
        F.col("o_custkey").cast("int").alias("totalPaginas"),
    )
    return pages.missing_pages(landed)


@query
def missing_pages_landed(spark, sf):
    """S3 on landed pages: every third one is lost, totals come as text."""
    path = fresh_dir(spark, "pages")
    write_pages(bronze_rows(spark, sf), path, one_page_per_file=False, lost=F.col("pagina") % 3 == 1, text_totals=True)
    return pages.missing_pages(pages.read_pages(spark, path, one_page_per_file=False))


@query
def bronze_period(spark, sf):
    """S5 from stored, partitioned Parquet."""
    path = fresh_dir(spark, "bronze")
    rows = silver.add_partition(nest(notices(spark, sf)), "dataPublicacaoPncp", "month")
    rows.hint("rebalance", schemas.PARTITION).write.partitionBy(schemas.PARTITION).parquet(path)
    stored = spark.read.parquet(path)
    return bronze_slice(stored, "19960115", "19960310", A_STATE).select(
        F.col(v.BRONZE_KEY).alias("numero_controle_pncp"), "dataPublicacaoPncp"
    )


@query
def silver_period(spark, sf):
    """S6 F1."""
    return silver_slice(silver_rows(spark, sf), "19960115", "19960310").select(*v.SILVER_COLUMNS, "ramo_mei")


def _spoilt_pages(spark: SparkSession, sf: str) -> str:
    """Landed pages where every 7th order is a bare number and every 11th page is cut off in the middle."""
    path, key = fresh_dir(spark, "pages"), F.col(v.BRONZE_KEY).cast("long")
    rows = bronze_rows(spark, sf)
    record = F.to_json(F.struct(*[c for c in rows.columns if c not in ("lote", "pagina")]))
    each = rows.select("lote", "pagina", F.struct(key.alias("k"), F.when(key % 7 == 0, key.cast("string")).otherwise(record).alias("r")).alias("own"))
    bodies = each.groupBy("lote", "pagina").agg(F.array_sort(F.collect_list("own")).alias("all"))
    body = F.concat(F.lit('{"totalPaginas":1,"data":['), F.array_join(F.transform("all", lambda x: x["r"]), ","), F.lit("]}"))
    cut = F.when(F.col("pagina") % 11 == 0, F.substring(body, F.lit(1), F.length(body) - 5)).otherwise(body)
    bodies.select("lote", "pagina", cut.alias("value")).write.partitionBy("lote", "pagina").text(path)
    return path


@query
def rejected_records(spark, sf):
    """Content that is no page or no record, kept beside Bronze."""
    lake = daily.Lake(spark, fresh_dir(spark, "lake"))
    daily.keep_rejected(lake, pages.rejected(spark, _spoilt_pages(spark, sf)))
    return lake.rejected().drop("arquivo")


@query
def records_beside_rejected(spark, sf):
    """The records of the same pages; one that is no record costs no other."""
    return pages.records(pages.read_pages(spark, _spoilt_pages(spark, sf))).select("lote", "pagina", "pos", F.col(v.BRONZE_KEY).alias("numero_controle_pncp"))


# --- one row per key, upsert -----------------------------------------------


def _orders_and_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Every order, and every finished order once more with a new price and no priority."""
    orders = table(spark, sf, "orders").drop("o_orderdate")
    finished = orders.filter("o_orderstatus = 'F'")
    changed = finished.withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "o_orderpriority": F.lit(None).cast("string")}
    )
    return orders.withColumn("pagina", F.lit(1)).unionByName(changed.withColumn("pagina", F.lit(2)))


@query
def dedupe_keep_last(spark, sf):
    """A15 W1."""
    return latest.keep_last(_orders_and_changes(spark, sf), ["o_orderkey"], ["pagina"])


@query
def dedupe_any(spark, sf):
    """A15, plain form; only the keys are determined."""
    return latest.keep_any(_orders_and_changes(spark, sf), ["o_orderkey"]).select("o_orderkey")


@query
def dedupe_by_customer(spark, sf):
    """W1 with many rows a key: the last order of each customer."""
    return latest.keep_last(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query
def merge_last_fields(spark, sf):
    """W1 per field: the price changes, the emptied priority survives."""
    return latest.merge_last(_orders_and_changes(spark, sf), ["o_orderkey"], ["pagina"]).drop("pagina")


def _stored_and_batch(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored: finished and pending orders. Batch: open ones, and the finished with changes to some."""
    orders = table(spark, sf, "orders").drop("o_orderdate")
    stored = orders.filter("o_orderstatus in ('F', 'P')")
    batch = orders.filter("o_orderstatus in ('F', 'O')").withColumns(
        {
            "o_totalprice": F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice")).otherwise(
                F.col("o_totalprice") * 2
            ),
            "o_orderpriority": F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")),
        }
    )
    return stored, batch


@query
def upsert_rows(spark, sf):
    """K2."""
    stored, batch = _stored_and_batch(spark, sf)
    return reconcile.upsert(stored, batch, ["o_orderkey"])


@query
def upsert_field_merge(spark, sf):
    """K1."""
    stored, batch = _stored_and_batch(spark, sf)
    return reconcile.upsert(stored, batch, ["o_orderkey"], merge_fields=True)


@query
def upsert_status(spark, sf):
    """K4 per row."""
    stored, batch = _stored_and_batch(spark, sf)
    return reconcile.reconcile(stored, batch, ["o_orderkey"]).select("o_orderkey", reconcile.STATUS)


@query
def upsert_counts(spark, sf):
    """K4."""
    stored, batch = _stored_and_batch(spark, sf)
    return reconcile.change_counts(reconcile.reconcile(stored, batch, ["o_orderkey"]))


@query
def upsert_counts_ignoring(spark, sf):
    """K4 where a changed price alone is no update."""
    stored, batch = _stored_and_batch(spark, sf)
    return reconcile.change_counts(
        reconcile.reconcile(stored, batch, ["o_orderkey"], ignore=["o_totalprice"])
    )


@query
def key_uniqueness(spark, sf):
    """K5."""
    return reconcile.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _as_silver(flat: DataFrame) -> DataFrame:
    rows = silver.stamp_load(silver.classify(flat), F.to_timestamp("data_publicacao_pncp"))
    return silver.add_partition(rows, "data_publicacao_pncp", "year")


@query
def table_upsert_rows(spark, sf):
    """K2 K5 on a stored table: new rows, changed rows, rows that move to another partition."""
    return _changed_and_moved(spark, sf, KeyedTable(spark, fresh_dir(spark, "silver"), schemas.SILVER, (v.SILVER_KEY,)))


@query
def table_upsert_versions(spark, sf):
    """K2 K5, the same on a table whose readers switch to a version at once."""
    return _changed_and_moved(spark, sf, VersionedTable(spark, fresh_dir(spark, "silver"), schemas.SILVER, (v.SILVER_KEY,)))


def _changed_and_moved(spark: SparkSession, sf: str, stored: KeyedTable) -> DataFrame:
    flat = notices(spark, sf)
    stored.upsert(_as_silver(flat.filter("situacao_id <> 'O'")))
    moved = F.concat(F.lit("2002-05-01"), F.substring("data_publicacao_pncp", 11, 9))
    again = flat.filter("situacao_id <> 'F'").withColumn(
        "data_publicacao_pncp", F.when(F.col("situacao_id") == "P", moved).otherwise(F.col("data_publicacao_pncp"))
    )
    stored.upsert(_as_silver(again))
    return stored.read().select(*v.SILVER_COLUMNS, "ramo_mei")


@query
def table_upsert_fields(spark, sf):
    """K1 on a stored table: the batch knows only the status name, other fields survive."""
    stored = KeyedTable(
        spark, fresh_dir(spark, "bronze"), schemas.BRONZE, (v.BRONZE_KEY,), merge_fields=True
    )
    sparse = {
        f.name: F.lit(None).cast(f.dataType)
        for f in schemas.NOTICE.fields
        if f.name not in (v.BRONZE_KEY, "dataPublicacaoPncp", "situacaoCompraNome")
    }
    with _landing(spark, bronze_rows(spark, sf)) as landed:
        records = pages.records(landed)
        stored.upsert(daily.bronze_batch(records, "year"))
        batch = records.filter("situacaoCompraId = 'P'").withColumns({**sparse, "situacaoCompraNome": F.lit("Anulada")})
        stored.upsert(daily.bronze_batch(batch, "year"))
    return silver.flatten(stored.read())


@query
def upsert_field_merge_explicit_null(spark, sf):
    """K1 W1 on landed pages: pending notices come again, the even ones with text, value and buyer as null, which
    empties them, the others without these fields, which leaves them; every third one has its text after all, on a
    later page."""
    stored = KeyedTable(spark, fresh_dir(spark, "bronze"), schemas.BRONZE, (v.BRONZE_KEY,), merge_fields=True)
    rows = nest(notices(spark, sf))
    number = F.col(v.BRONZE_KEY).cast("long")
    empty = {c: F.lit(None).cast(schemas.NOTICE[c].dataType) for c in ("objetoCompra", "valorTotalEstimado", "orgaoEntidade")}
    with scratch(spark, "pages") as path:
        write_pages(rows, path, one_page_per_file=False)
        stored.upsert(daily.bronze_batch(pages.records(pages.read_pages(spark, path, False, explicit_nulls=True)), "year"))
    pending = rows.filter("situacaoCompraId = 'P'").withColumns(empty)
    with scratch(spark, "pages") as path:
        write_pages(pending.filter(number % 2 == 0).withColumn("lote", F.lit("a")), path, False, keep_nulls=True)
        write_pages(pending.filter(number % 2 == 1).withColumn("lote", F.lit("a2")), path, False, mode="append")
        later = rows.filter("situacaoCompraId = 'P'").filter(number % 3 == 0).select(v.BRONZE_KEY, "dataPublicacaoPncp", "objetoCompra", F.lit("b").alias("lote"), "pagina")
        write_pages(later, path, False, mode="append")
        stored.upsert(daily.bronze_batch(pages.records(pages.read_pages(spark, path, False, explicit_nulls=True)), "year"))
    return silver.flatten(stored.read())


# --- Gold ------------------------------------------------------------------


def _gold(spec: rollup.Rollup) -> Query:
    def run(spark, sf):
        rows = silver_rows(spark, sf)
        if spec.by_period:
            rows = silver_slice(rows, *PERIOD)
        table_ = rollup.stamp(rollup.rollup(rows, spec), PERIOD if spec.by_period else None)
        return rollup.in_order(table_, spec).drop("data_atualizacao")

    return run


def _gold_sliding(spec: rollup.Rollup) -> Query:
    return lambda spark, sf: periods.sliding(silver_rows(spark, sf), spec)


QUERIES.update(
    {
        "gold_area": _gold(rollup.AREA),
        "gold_estado": _gold(rollup.STATE),
        "gold_faixa": _gold(rollup.BAND),
        "gold_situacao": _gold(rollup.STATUS),
        "gold_por_mes": _gold(rollup.MONTH),
        "gold_sliding_periods": _gold_sliding(rollup.STATE),
        "gold_sliding_area": _gold_sliding(rollup.AREA),
        "gold_sliding_faixa": _gold_sliding(rollup.BAND),
        "gold_sliding_situacao": _gold_sliding(rollup.STATUS),
    }
)


@query
def gold_grouping_sets(spark, sf):
    """A6."""
    return rollup.grouping_sets(silver_rows(spark, sf))


@query
def gold_from_cells(spark, sf):
    """A6 by way of the shared pre-aggregate: the monthly table."""
    return rollup.from_cells(rollup.cells(silver_rows(spark, sf)), rollup.MONTH)


@query
def gold_estado_approx(spark, sf):
    """A2 with buyers sketched in cells; below some thousand buyers a group the counts are exact."""
    return rollup.from_cells(rollup.sketch_cells(silver_rows(spark, sf)), rollup.STATE)


@query
def gold_por_mes_approx(spark, sf):
    """A5 from day cells with sketches: those of a month's days are merged."""
    rows = silver.add_partition(silver_rows(spark, sf), "data_publicacao_pncp", "month")
    return rollup.from_cells(periods.day_cells(rows, lg_k=rollup.SKETCH_LG_K), rollup.MONTH)


@query
def daily_run_approx(spark, sf):
    """K3 A2: a stored lake that keeps sketches; two periods, one made from the other's day cells."""
    lake = daily.Lake(spark, fresh_dir(spark, "lake"), grain="year", sketch_lg_k=rollup.SKETCH_LG_K)
    lake.silver.upsert(_as_silver(notices(spark, sf)))
    for period in OVERLAPPING[:2]:
        daily.aggregate(lake, *period)
    return lake.gold(v.GOLD_STATE).drop("data_atualizacao")


def _two_runs(spark: SparkSession, sf: str, grain: str = "year", **options) -> daily.Lake:
    """All notices landed and run; then every pending one republished as closed and run again."""
    lake = daily.Lake(spark, fresh_dir(spark, "lake"), grain=grain, **options)
    as_of = F.to_timestamp(F.lit("2002-01-01 00:00:00"))
    with _landing(spark, bronze_rows(spark, sf)) as landed:
        daily.run(lake, landed, FIRST_DAY, LAST_DAY, as_of)
    closed = nest(notices(spark, sf)).filter("situacaoCompraId = 'P'").withColumns(
        {
            "situacaoCompraNome": F.lit("Encerrada"),
            "valorTotalEstimado": F.lit(None).cast("double"),
            "lote": F.lit("republicadas"),
        }
    )
    with _landing(spark, closed) as landed:
        daily.run(lake, landed, FIRST_DAY, LAST_DAY, as_of)
        # a run without a record or a row changes nothing
        daily.run(lake, landed.limit(0), "20200101", "20200102", as_of)
    return lake


_stored: dict[tuple[str, str], daily.Lake] = {}


def _stored_lake(spark: SparkSession, sf: str) -> daily.Lake:
    """A lake with two stored periods, all days and `A_PERIOD`; made once a session, then only read."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        lake = daily.Lake(spark, fresh_dir(spark, "lake"), grain="month", text_index=True)
        with _landing(spark, bronze_rows(spark, sf)) as landed:
            daily.ingest(lake, landed)
        refined = daily.refine(lake, FIRST_DAY, LAST_DAY, F.to_timestamp("data_publicacao_pncp"))
        as_of = F.to_timestamp(F.lit("2002-01-01 00:00:00"))
        daily.aggregate(lake, FIRST_DAY, LAST_DAY, as_of, refined["partes"])
        daily.aggregate(lake, *A_PERIOD.split("_"), as_of)
        _stored[key] = lake
    return _stored[key]


@query
def daily_run_situacao(spark, sf):
    """K1 K2 K3 K7 P6 over two runs: no stale status group stays."""
    return _two_runs(spark, sf).gold(v.GOLD_STATUS).drop("data_atualizacao")


@query
def daily_run_versions(spark, sf):
    """K1 K2 K3 K7 over two runs where Bronze and Silver are published version by version."""
    return _two_runs(spark, sf, versions=True).gold(v.GOLD_STATUS).drop("data_atualizacao")


@query
def daily_run_mes(spark, sf):
    """K3 on the monthly table, whole months from all of Silver."""
    return _two_runs(spark, sf).gold(v.GOLD_MONTH).drop("data_atualizacao")


@query
def daily_run_mes_by_month(spark, sf):
    """The same where Bronze and Silver are stored by month: other months are not read."""
    return _two_runs(spark, sf, "month").gold(v.GOLD_MONTH).drop("data_atualizacao")


#: Stored periods of `daily_run_overlapping`; the last one is run after the others.
OVERLAPPING = ((FIRST_DAY, LAST_DAY), ("19960214", "19960215"), ("19960215", "19960216"), ("19960216", "19960217"))


@query
def daily_run_overlapping(spark, sf):
    """A run adds notices to a day and closes others, which three stored periods cover; all of them follow."""
    lake = daily.Lake(spark, fresh_dir(spark, "lake"), grain="month")
    as_of = F.to_timestamp(F.lit("2002-01-01 00:00:00"))
    rows = nest(notices(spark, sf))
    late = F.col("dataPublicacaoPncp").startswith("1996-02-16") & (F.col(v.BRONZE_KEY).cast("long") % 3 == 0)
    with _landing(spark, rows.filter(~late)) as landed:
        daily.ingest(lake, landed)
    daily.refine(lake, FIRST_DAY, LAST_DAY, as_of)
    for period in OVERLAPPING[:-1]:
        daily.aggregate(lake, *period, as_of)
    closed = F.when(F.col("situacaoCompraId") == "P", "Encerrada").otherwise(F.col("situacaoCompraNome"))
    again = rows.filter(dates.published_between(F.col("dataPublicacaoPncp"), *OVERLAPPING[-1]))
    with _landing(spark, again.filter(late | (F.col("situacaoCompraId") == "P")).withColumns({"situacaoCompraNome": closed, "lote": F.lit("republicadas")})) as landed:
        daily.run(lake, landed, *OVERLAPPING[-1], as_of)
    return lake.gold(v.GOLD_STATUS).drop("data_atualizacao")


@query
def table_upsert_moved_dates(spark, sf):
    """K1 where a correction changes the date: to another ISO date, to one that isn't ISO, and to none (the
    stored one stays). Read back through the period filter, so the partition must follow the merged date."""
    lake = daily.Lake(spark, fresh_dir(spark, "lake"), grain="month")
    date = F.col("dataPublicacaoPncp")
    corrected = (
        F.when(F.col("situacaoCompraId") == "F", F.concat(F.lit("1999-05-"), F.substring(date, 9, 11)))
        .when(F.col("situacaoCompraId") == "O", F.concat(F.lit("1999-6-"), F.substring(date, 9, 11)))
    )
    with _landing(spark, bronze_rows(spark, sf)) as landed:
        records = pages.records(landed)
        lake.bronze.upsert(daily.bronze_batch(records, lake.grain))
        sparse = records.withColumns({"dataPublicacaoPncp": corrected, "objetoCompra": F.lit(None).cast("string")})
        lake.bronze.upsert(daily.bronze_batch(sparse, lake.grain))
    found = bronze_slice(lake.bronze.read(), "19960201", "19991231")
    return found.select(F.col(v.BRONZE_KEY).alias("numero_controle_pncp"), "dataPublicacaoPncp", "objetoCompra")


@query
def records_flatten(spark, sf):
    """Bare records, one JSON file a partition."""
    path = fresh_dir(spark, "records")
    bronze_rows(spark, sf).drop("lote", "pagina").write.json(path)
    return silver.flatten(pages.read_records(spark, path))


# --- tools -----------------------------------------------------------------


@query
def tool_contar(spark, sf):
    """Three tables, and a name nobody stored."""
    tables = all_tables(spark, sf)
    counted = tools.contar_registros(tables, v.SILVER)
    for name in (v.BRONZE, v.GOLD_STATE, "inexistente"):
        counted = counted.unionByName(tools.contar_registros(tables, name))
    return counted


def _tool(name: str, **arguments) -> Query:
    return lambda spark, sf: tools.call(all_tables(spark, sf), name, **arguments).drop("data_atualizacao")


QUERIES.update(
    {
        "tool_resumo_estado": _tool("resumo_por_estado"),
        "tool_resumo_estado_periodo": _tool("resumo_por_estado", periodo=A_PERIOD),
        "tool_resumo_estado_uf": _tool("resumo_por_estado", uf=A_STATE, limite=100),
        "tool_resumo_ramo": _tool("resumo_por_ramo_mei"),
        "tool_resumo_ramo_uf": _tool("resumo_por_ramo_mei", uf=A_STATE),
        "tool_resumo_ramo_periodo": _tool("resumo_por_ramo_mei", periodo=A_PERIOD),
        "tool_resumo_ramo_dedupe": _tool("resumo_por_ramo_mei", overlap="dedupe"),
        "tool_resumo_faixa": _tool("resumo_por_faixa_valor"),
        "tool_resumo_faixa_uf_periodo": _tool(
            "resumo_por_faixa_valor", uf=A_STATE_IN_PERIOD, periodo=A_PERIOD
        ),
        "tool_resumo_situacao": _tool("resumo_por_situacao"),
        "tool_resumo_situacao_dedupe": _tool(
            "resumo_por_situacao", periodo=A_PERIOD, overlap="dedupe"
        ),
        "tool_resumo_situacao_dedupe_mes": _tool("resumo_por_situacao", periodo=A_MONTH, overlap="dedupe"),
        "tool_evolucao_mensal": _tool("evolucao_mensal"),
        "tool_evolucao_mensal_ano": _tool("evolucao_mensal", uf=A_STATE, ano=1997),
        "tool_top_orgaos": _tool("top_orgaos_contratantes"),
        "tool_top_orgaos_uf": _tool("top_orgaos_contratantes", uf=A_STATE, limite=5),
    }
)


def _on_lake(name: str, **arguments) -> Query:
    """A tool on stored tables, the way users take; nothing is derived again."""
    return lambda spark, sf: tools.call(_stored_lake(spark, sf).tables(), name, **arguments).drop("data_atualizacao", "data_coleta", schemas.PARTITION)


QUERIES.update(
    {
        "tool_resumo_estado_lake": _on_lake("resumo_por_estado", periodo=A_PERIOD),
        "tool_resumo_ramo_lake": _on_lake("resumo_por_ramo_mei", uf=A_STATE_IN_PERIOD, periodo=A_PERIOD),
        "tool_resumo_faixa_lake": _on_lake("resumo_por_faixa_valor", periodo=A_PERIOD),
        "tool_resumo_situacao_lake": _on_lake("resumo_por_situacao", periodo=A_MONTH, overlap="dedupe"),
        "tool_evolucao_mensal_lake": _on_lake("evolucao_mensal", ano=1997),
        "tool_buscar_lake": _on_lake(
            "buscar_contratacoes", uf=A_STATE, data_inicial="19960101", data_final="19961231", texto_objeto="reforma|LICENÇA"
        ),
    }
)


def _found_in_lake(spark: SparkSession, sf: str, **arguments) -> DataFrame:
    return tools.buscar_contratacoes(_stored_lake(spark, sf).tables(), **arguments).drop("data_coleta", schemas.PARTITION)


@query
def tool_buscar_indexed(spark, sf):
    """A text search that opens the partitions whose filters have the words' trigrams."""
    return _found_in_lake(spark, sf, uf=A_STATE, data_inicial="19960101", data_final="19961231", texto_objeto="reforma|LICENÇA", limite=100)


@query
def tool_buscar_first(spark, sf):
    """T7 O8 with a limit alone: partitions are opened in order of date until it is reached."""
    return _found_in_lake(spark, sf, limite=10)


@query
def tool_estatisticas_lake(spark, sf):
    """T9 where counts come from stored tables."""
    return _statistics(tools.estatisticas_gerais(_stored_lake(spark, sf).tables()))


def _found(spark: SparkSession, sf: str, **arguments) -> DataFrame:
    return tools.buscar_contratacoes(all_tables(spark, sf), **arguments).drop("data_coleta")


@query
def tool_buscar(spark, sf):
    """T7 F1 F2 F5 F6 O8."""
    return _found(
        spark, sf, uf=A_STATE, data_inicial="19960101", data_final="19961231", texto_objeto="reforma|LICENÇA",
        limite=100,
    )


@query
def tool_buscar_sem_filtro(spark, sf):
    """T7 with a limit alone."""
    return _found(spark, sf, limite=10)


@query
def tool_top_orgaos_ausentes(spark, sf):
    """Buyers without name and number."""
    known = F.col("cnpj_orgao").cast("long") % 2 == 1
    rows = silver_rows(spark, sf).withColumns({c: F.when(known, F.col(c)) for c in ("cnpj_orgao", "razao_social")})
    return tools.top_orgaos_contratantes(Tables(spark, {v.SILVER: rows}))


@query
def tool_painel(spark, sf):
    """A12."""
    return tools.painel(all_tables(spark, sf))


@query
def tool_estatisticas(spark, sf):
    """T9 A12 A13 A14 P13 O10 O11."""
    return _statistics(tools.estatisticas_gerais(all_tables(spark, sf)))


def _statistics(row: DataFrame) -> DataFrame:
    greatest = F.col("maior_contratacao")
    return row.select(
        "camada_bronze_raw",
        "camada_silver_processadas",
        *v.GOLD_TABLES,
        greatest["valor_total_estimado"].alias("maior_valor"),
        greatest["objeto_compra"].alias("maior_objeto"),
        greatest["uf"].alias("maior_uf"),
        F.date_format("ultima_atualizacao", "yyyy-MM-dd HH:mm:ss").alias("ultima_atualizacao"),
    )


@query
def tool_total_linhas(spark, sf):
    """The totals beside the rows of three tools."""
    tables, asked = all_tables(spark, sf), {
        "resumo_por_estado": {"uf": A_STATE}, "evolucao_mensal": {"ano": 1997}, "buscar_contratacoes": {"uf": A_STATE, "texto_objeto": "reforma", "limite": 5},
    }
    each = [tools.total_linhas(tools.call(tables, name, **arguments)).select(F.lit(name).alias("ferramenta"), "total_linhas") for name, arguments in asked.items()]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query
def json_written(spark, sf):
    """K6: rows written as JSON lines and read again as text."""
    path = f"{fresh_dir(spark, 'json')}/rows"
    rows = rollup.rollup(silver_rows(spark, sf), rollup.STATUS)
    json_rows.write_json(rows.select("uf", "situacao_nome", "total_contratacoes"), path)
    return spark.read.text(path).withColumnRenamed("value", "documento")


@query
def to_json_rows(spark, sf):
    """K6 over all Silver columns, moments and nulls included."""
    return json_rows.as_json(silver_rows(spark, sf))


@query
def to_json_gold(spark, sf):
    """K6 over text and counts."""
    rows = rollup.rollup(silver_rows(spark, sf), rollup.STATUS)
    return json_rows.as_json(rows.select("uf", "situacao_nome", "total_contratacoes"))


# --- questions -------------------------------------------------------------


@query
def acc_estado_com_mais(spark, sf):
    return questions.busiest_state(all_tables(spark, sf)).drop("data_atualizacao")


@query
def acc_valor_em_uf(spark, sf):
    return questions.total_value_in(all_tables(spark, sf), A_STATE)


@query
def acc_ramo_maior_valor(spark, sf):
    return questions.richest_category(all_tables(spark, sf))


@query
def acc_limpeza_no_mes(spark, sf):
    return _found(spark, sf, data_inicial="19960101", data_final="19960131", texto_objeto="limpeza")


@query
def acc_ti_no_ano(spark, sf):
    return _found(spark, sf, data_inicial="19960101", data_final="19961231", ramo_mei="TI")


@query
def acc_mes_a_mes_no_ano(spark, sf):
    """Month by month of a year, every state."""
    return tools.evolucao_mensal(all_tables(spark, sf), ano=1997).drop("data_atualizacao")


@query
def acc_ti_acima_80k(spark, sf):
    rows = questions.above_value(all_tables(spark, sf), "TI", 80000.0)
    return rows.select("numero_controle_pncp", "uf", "valor_total_estimado")


@query
def acc_compare_region(spark, sf):
    regions = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("uf"), F.col("r_name").alias("regiao"))
    )
    return questions.compare_region(all_tables(spark, sf), regions, A_REGION)


@query
def acc_compare_states(spark, sf):
    return questions.compare_states(all_tables(spark, sf), ["nation_1", "nation_7", "nation_12"])


# --- streams ---------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    # a pattern, as a stream's plain path must be a folder
    return spark.readStream.schema(events.schema).parquet(f"{sf.rstrip('/')}/events.parque[t]")


@query
def stream_dedup(spark, sf):
    """Every event sent twice."""
    twice = _event_stream(spark, sf).unionByName(_event_stream(spark, sf))
    once = dedup.first_seen(twice, ["event_id"], "ts", "31 days").drop("props", "ts")
    path = fresh_dir(spark, "events")
    with scratch(spark, "checkpoint") as checkpoint:
        streams.finish(streams.append_stream(once, path, checkpoint))
    return spark.read.schema(once.schema).parquet(path)


@query
def stream_sliding(spark, sf):
    """X1 as a stream, complete output."""
    measures = [F.count("*").alias("total"), values.money_sum(F.col("value")).alias("valor_total")]
    totals = sliding.sliding_periods(_event_stream(spark, sf), "ts", ["event_type"], measures)
    path = fresh_dir(spark, "periods")
    with scratch(spark, "checkpoint") as checkpoint:
        streams.finish(streams.replace_stream(totals, path, checkpoint))
    return spark.read.schema(totals.schema).parquet(path)


@query
def stream_sliding_update(spark, sf):
    """X1 as a stream with bounded state: update output into a partition a period. Three arrivals, one event in ten
    a day late, and a restart before the last."""
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    arrives = F.when(F.col("event_id") % 10 == 0, F.col("ts") + F.expr("interval 1 day")).otherwise(F.col("ts"))
    turns = [F.dayofmonth(arrives).between(*days) & (F.month(arrives) == 1) for days in ((1, 9), (10, 19), (20, 31))]
    turns[-1] = turns[-1] | (F.month(arrives) != 1)
    measures = [F.count("*").alias("total"), values.money_sum(F.col("value")).alias("valor_total")]
    with scratch(spark, "events") as landing, scratch(spark, "checkpoint") as checkpoint:
        stored = None
        for number, turn in enumerate(turns):
            events.filter(turn).coalesce(1).write.mode("append").parquet(landing)
            if number == 0:
                continue  # the first two arrive before the stream begins, one a batch
            stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landing)
            totals = sliding.sliding_periods(stream, "ts", ["event_type"], measures, delay="2 days")
            stored = stored or streams.period_table(totals, fresh_dir(spark, "periods"), ["event_type"])
            streams.finish(streams.period_stream(totals, stored, checkpoint))
    return stored.read().drop(schemas.PARTITION)


@query
def stream_missing_pages(spark, sf):
    """S3 as a stream: every third page is late and reported; half of these land afterwards and are taken back."""
    path, lost = fresh_dir(spark, "late"), F.col("pagina") % 3 == 1
    with scratch(spark, "pages") as landing, scratch(spark, "checkpoint") as checkpoint:
        write_pages(bronze_rows(spark, sf), landing, one_page_per_file=False, lost=lost)
        for late in (None, lost & (F.col("pagina") % 2 == 0)):
            if late is not None:
                write_pages(bronze_rows(spark, sf), landing, one_page_per_file=False, mode="append", lost=~late)
            arriving = pages.stream_pages(spark, landing, one_page_per_file=False, landed_at=True)
            streams.finish(missing.late_page_stream(arriving, path, checkpoint, "0 seconds"))
    return missing.still_missing(spark.read.schema(missing.EVENTS).parquet(path))


@query
def stream_estado_approx(spark, sf):
    """A2 on a stream: every micro-batch leaves cells with sketches, which are merged when they are read."""
    path = fresh_dir(spark, "cells")
    rows = silver_rows(spark, sf)
    with scratch(spark, "silver") as landing, scratch(spark, "checkpoint") as checkpoint:
        rows.repartitionByRange(4, "numero_controle_pncp").write.parquet(landing)
        arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        streams.finish(streams.cell_stream(arriving, rollup.sketch_cells, path, checkpoint))
    return rollup.from_cells(spark.read.schema(rollup.sketch_cells(rows).schema).parquet(path), rollup.STATE)


@query
def stream_upsert_bronze(spark, sf):
    """X2 K1 into a versioned Bronze alone: pages in several micro-batches, pending notices again as closed."""
    rows = nest(notices(spark, sf))
    closed = rows.filter("situacaoCompraId = 'P'").withColumns({"situacaoCompraNome": F.lit("Encerrada"), "objetoCompra": F.lit(None).cast("string"), "lote": F.lit("republicadas")})
    table_ = VersionedTable(spark, fresh_dir(spark, "bronze"), schemas.BRONZE, (v.BRONZE_KEY,), merge_fields=True)
    with scratch(spark, "pages") as landing, scratch(spark, "checkpoint") as checkpoint:
        write_pages(rows, landing, one_page_per_file=False)
        write_pages(closed, landing, one_page_per_file=False, mode="append")
        arriving = pages.records(pages.stream_pages(spark, landing, one_page_per_file=False, files_per_batch=4))
        streams.finish(streams.upsert_stream(arriving, table_, streams.to_landed_rows("year"), checkpoint, streams.to_bronze_rows("year")))
    return silver.classify(silver.flatten(table_.read()))


@query
def stream_upsert(spark, sf):
    """Pages arriving in several micro-batches, the pending notices republished at the end without
    value and text, which stay as they are stored."""
    rows = nest(notices(spark, sf))
    closed = rows.filter("situacaoCompraId = 'P'").withColumns(
        {
            "situacaoCompraNome": F.lit("Encerrada"),
            "objetoCompra": F.lit(None).cast("string"),
            "valorTotalEstimado": F.lit(None).cast("double"),
            "lote": F.lit("republicadas"),
        }
    )
    lake = daily.Lake(spark, fresh_dir(spark, "lake"), grain="year")
    as_of = F.to_timestamp("data_publicacao_pncp")
    with scratch(spark, "pages") as landing, scratch(spark, "checkpoint") as checkpoint:
        write_pages(rows, landing, one_page_per_file=False)
        write_pages(closed, landing, one_page_per_file=False, mode="append")
        arriving = pages.records(pages.stream_pages(spark, landing, one_page_per_file=False, files_per_batch=3))
        streams.finish(streams.lake_stream(arriving, lake, checkpoint, as_of))
    return lake.silver.read().select(*v.SILVER_COLUMNS, "ramo_mei")
