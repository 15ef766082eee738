"""Landed JSON pages.

One file is one page, or, for compacted landings, one line is one
page. Run and page number come from the path, as in
``.../lote=20260101_20260102/pagina=3/x.json`` or ``.../pagina_3.json``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from noticelake import vocabulary as v
from noticelake.functions import predicates as p
from noticelake.functions import values
from noticelake.schemas import ENVELOPE, NOTICE, NULLS, ORIGIN
from noticelake.workspace import child_names

_PAGE_IN_PATH = r"pagina[=_-]0*(\d+)"
_RUN_IN_PATH = r"lote[=_-]([^/]+)"
#: Reasons of rejected content.
BAD_BODY, NO_LIST, NO_RECORD = "corpo ilegível", "dados não são lista", "registro não é objeto"
#: Pages a missing-pages check lists at once.
_BLOCK = 10_000

#: A line of a compacted landing also carries its own page number.
LANDED = StructType(ENVELOPE.fields + [StructField("numeroPagina", IntegerType())])
_DATA_TEXTS = StructType([StructField("data", ArrayType(StringType()))])


def _from_path(pattern: str) -> Column:
    found = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return F.when(found != "", found)


def _readable(page: Column) -> Column:
    return page["data"].isNotNull() | page["totalPaginas"].isNotNull() | page["totalRegistros"].isNotNull()


def _pages(landed: Column, bodies: Column) -> Column:
    """Pages of a body, of which ``landed`` is what the parser made. One record that is no object empties its page's
    whole list in the parser; such pages are read again record by record, and that record alone is null."""
    texts = F.from_json(bodies, ArrayType(_DATA_TEXTS))

    def page(fields: Column, raw: Column) -> Column:
        data = F.coalesce(fields["data"], F.transform(raw["data"], lambda record: F.when(F.ltrim(record).startswith("{"), F.from_json(record, NOTICE))))
        return F.struct(*[(data if name == "data" else fields[name]).alias(name) for name in LANDED.fieldNames()])

    return F.when(F.exists(landed, lambda p: p["data"].isNull()), F.zip_with(landed, texts, page)).otherwise(landed)


def _given_as_null(notice: Column) -> Column:
    """Names of a notice's fields that are there and null. Under a schema they look like fields that are not there."""
    return F.array_compact(
        F.array(*[F.when(F.is_variant_null(F.variant_get(notice, f"$.{name}", "variant")), name) for name in NOTICE.fieldNames()])
    )


def _with_nulls(landed: Column) -> Column:
    """Each page with a list of such names per notice, from the same body read as VARIANT."""
    body = F.try_parse_json("value")
    whole = F.coalesce(F.try_variant_get(body, "$", "array<variant>"), F.array(body))

    def page(fields: Column, raw: Column) -> Column:
        nulls = F.transform(F.try_variant_get(raw, "$.data", "array<variant>"), _given_as_null)
        return F.struct(*[fields[name].alias(name) for name in LANDED.fieldNames()], nulls.alias(NULLS))

    return F.zip_with(landed, whole, page)


def _shape(bodies: DataFrame, explicit_nulls: bool = False, landed_at: bool = False) -> DataFrame:
    """Pages with run, number and total; bodies that are no page are left out.

    A body that cannot be read stands for no page at all, so `missing_pages`
    reports it (defect D7). ``inline_outer`` parses each body once: a filter on
    what it yields is not moved below it.
    """
    landed = _pages(F.col("_landed"), F.col("value"))
    # parsed in a step of its own: an expression that names it twice would parse twice
    parsed = bodies.select("value", F.col("_metadata"), F.from_json("value", ArrayType(LANDED)).alias("_landed"))
    return (
        parsed.select(
            _from_path(_RUN_IN_PATH).alias("lote"),
            _from_path(_PAGE_IN_PATH).cast("int").alias("_pagina"),
            *([F.col("_metadata.file_modification_time").alias("chegada")] if landed_at else []),
            F.inline_outer(_with_nulls(landed) if explicit_nulls else landed),
        )
        .filter(F.col("data").isNotNull() | F.col("totalPaginas").isNotNull() | F.col("totalRegistros").isNotNull())
        .select(
            "lote",
            F.coalesce("_pagina", "numeroPagina").alias("pagina"),
            # absent: one page; there but unreadable: null, so that it can be told from one
            F.when(F.col("totalPaginas").isNull(), 1).otherwise(values.to_whole(F.col("totalPaginas"))).alias("totalPaginas"),
            F.col("totalRegistros").try_cast("bigint").alias("totalRegistros"),
            "data",
            *([NULLS] if explicit_nulls else []),
            *(["chegada"] if landed_at else []),
        )
    )


# Run and page folders are read from the path, not as partitions. A page is small:
# read whole and parsed in place it costs a fraction of what the multi-line JSON
# reader takes per file (measured).
_BODIES = {"recursiveFileLookup": "true"}


def read_pages(spark: SparkSession, path: str, one_page_per_file: bool = True, explicit_nulls: bool = False) -> DataFrame:
    """Every landed page below ``path``. With ``explicit_nulls`` a field that is given as null is told from
    one that is left out: the first empties a stored field (K1), the second leaves it."""
    return _shape(spark.read.options(**_BODIES).text(path, wholetext=one_page_per_file), explicit_nulls)


def stream_pages(
    spark: SparkSession, path: str, one_page_per_file: bool = True, files_per_batch: int | None = None, explicit_nulls: bool = False,
    landed_at: bool = False,
) -> DataFrame:
    """S1 as a stream of newly landed files; with ``landed_at`` also when each one landed."""
    reader = spark.readStream.options(**_BODIES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _shape(reader.text(path, wholetext=one_page_per_file), explicit_nulls, landed_at)


def records(pages: DataFrame) -> DataFrame:
    """The notices of each page with their place in it; a page without data has none. What is no object is
    left out (see `rejected`)."""
    nulls = [F.coalesce(F.get(NULLS, "pos"), F.array().cast("array<string>")).alias(NULLS)] if NULLS in pages.columns else []
    each = pages.select("lote", "pagina", F.posexplode("data").alias("pos", "_notice"), *([NULLS] if nulls else []))
    return each.filter(F.col("_notice").isNotNull()).select("_notice.*", *ORIGIN.fieldNames(), *nulls)


def rejected(spark: SparkSession, path: str, one_page_per_file: bool = True) -> DataFrame:
    """What below ``path`` is no page or no record, with file, place, reason and, for a record, its text.

    A place is that of the record in its page; a body that is no page, or whose data is no list, has none."""
    bodies = spark.read.options(**_BODIES).text(path, wholetext=one_page_per_file)
    body = F.try_parse_json("value")
    whole = F.coalesce(F.try_variant_get(body, "$", "array<variant>"), F.array(body))
    # the rule by which pages are read, so that a body counts as one or the other
    unread = ~F.coalesce(F.exists(F.from_json("value", ArrayType(LANDED)), _readable), F.lit(False))
    each = bodies.select(
        _from_path(_RUN_IN_PATH).alias("lote"), _from_path(_PAGE_IN_PATH).cast("int").alias("_pagina"),
        F.col("_metadata.file_path").alias("arquivo"), unread.alias("_unread"), F.explode_outer(F.when(~unread, whole)).alias("_page"),
    )
    data = F.variant_get("_page", "$.data", "variant")
    records_ = F.try_variant_get("_page", "$.data", "array<variant>")
    no_list = data.isNotNull() & ~F.is_variant_null(data) & records_.isNull()
    odd = F.filter(F.transform(records_, lambda record, place: F.struct(place.alias("posicao"), record.alias("_record"))), lambda r: ~F.coalesce(F.schema_of_variant(r["_record"]).startswith("OBJECT"), F.lit(False)))
    reasons = (
        F.when(F.col("_unread"), F.array(F.struct(F.lit(None).cast("int").alias("posicao"), F.lit(BAD_BODY).alias("motivo"), F.lit(None).cast("string").alias("conteudo"))))
        .when(no_list, F.array(F.struct(F.lit(None).cast("int").alias("posicao"), F.lit(NO_LIST).alias("motivo"), F.to_json(data).alias("conteudo"))))
        .otherwise(F.transform(odd, lambda r: F.struct(r["posicao"].alias("posicao"), F.lit(NO_RECORD).alias("motivo"), F.to_json(r["_record"]).alias("conteudo"))))
    )
    page = F.coalesce("_pagina", F.try_variant_get("_page", "$.numeroPagina", "int")).alias("pagina")
    return each.select("lote", page, "arquivo", F.inline(reasons))


def read_records(spark: SparkSession, path: str, one_array_per_file: bool = False) -> DataFrame:
    """Bare notices under the explicit schema: a record or an array of them in each line (files split), or,
    with ``one_array_per_file``, in each file however it is broken into lines."""
    bodies = spark.read.text(path, wholetext=one_array_per_file)
    return bodies.select(F.inline(F.from_json("value", ArrayType(NOTICE))))


def requested(
    notices: DataFrame, start: str, end: str, modality: int | None = v.MODALITY, uf: str | None = None
) -> DataFrame:
    """What a request for a range, modality and state would have returned."""
    return notices.filter(
        p.every(
            p.published(start, end, "dataPublicacaoPncp"),
            p.modality_is(modality),
            p.state_is(uf, "unidadeOrgao.ufSigla"),
        )
    )


def runs_within(spark: SparkSession, path: str, start: str, end: str) -> list[str]:
    """Run folders below ``path`` that can hold notices of a range: those whose own interval meets it, and those whose
    name is no interval. A list of names; no page is opened."""
    kept = []
    for name in sorted(child_names(spark, path)):
        interval = re.fullmatch(r"lote[=_-](\d{8})_(\d{8})", name)
        if name.startswith("lote") and (interval is None or (interval[1] <= end and start <= interval[2])):
            kept.append(f"{path.rstrip('/')}/{name}")
    return kept


def read_requested(
    spark: SparkSession, path: str, start: str, end: str, modality: int | None = v.MODALITY, uf: str | None = None,
    one_page_per_file: bool = True, explicit_nulls: bool = False,
) -> DataFrame:
    """The notices of a request, from the pages of the runs that were asked for such days; no other run's pages
    are opened. Rests on a run holding nothing outside of its interval, which is what it asked for."""
    folders = runs_within(spark, path, start, end)
    bodies = spark.read.options(**_BODIES).text(folders, wholetext=one_page_per_file) if folders else spark.read.text([], wholetext=True)
    return requested(records(_shape(bodies, explicit_nulls)), start, end, modality, uf)


def missing_pages(pages: DataFrame) -> DataFrame:
    """S3: pages a run announced but nobody landed.

    The announced numbers are listed in blocks, so that no single array holds
    them all however many pages a run has.
    """
    announced = pages.groupBy("lote").agg(F.max("totalPaginas").alias("totalPaginas")).filter("totalPaginas > 0")
    first = F.col("_bloco") * _BLOCK + 1
    last = F.least(first + (_BLOCK - 1), F.col("totalPaginas"))
    expected = (
        announced.withColumn("_bloco", F.explode(F.sequence(F.lit(0), F.expr(f"(totalPaginas - 1) div {_BLOCK}").cast("int"))))
        .select("lote", F.explode(F.sequence(first, last)).alias("pagina"))
    )
    seen = pages.select("lote", "pagina").distinct()
    return expected.join(
        seen,
        expected["lote"].eqNullSafe(seen["lote"]) & (expected["pagina"] == seen["pagina"]),
        "left_anti",
    )
