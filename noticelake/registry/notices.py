"""Procurement notices seen in the order tables.

An order is a notice, its customer the buyer, the nation its state. The object
texts reach every category and trap of the keyword rules, the values every band
and its bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticelake import vocabulary as v
from noticelake.operators import silver
from noticelake.plans.gold import of_all_periods
from noticelake.sources.tables import Tables

_OBJECTS = (
    "Obra de REFORMA da escola",
    "Licença de SOFTWARE",
    "SERVIÇO de limpeza",
    "Aquisição de material",
    "Locação de imóvel",
    "COBRANÇA de tributos",
    "Calçamento com sistema de drenagem",
    "Servico sem acento",
    None,
    "Manutenção de equipamento",
)
_VALUES = {0: None, 1: 17600.0, 2: 80000.0, 3: 500000.0, 4: 750000.5}
_STATUS = {"O": "Divulgada", "F": "Encerrada"}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the files once per process."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13 flat Silver columns, one row per order."""
    key = F.col("o_orderkey")
    text = F.lit(None).cast("string")
    for rest, sample in enumerate(_OBJECTS):
        text = F.when(key % len(_OBJECTS) == rest, F.lit(sample)).otherwise(text)
    value = F.col("o_totalprice").cast("double")
    for rest, sample in _VALUES.items():
        value = F.when(key % 50 == rest, F.lit(sample).cast("double")).otherwise(value)
    status = F.lit("Suspensa")
    for code, label in _STATUS.items():
        status = F.when(F.col("o_orderstatus") == code, label).otherwise(status)
    joined = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    columns = {
        "numero_controle_pncp": key.cast("string"),
        "cnpj_orgao": F.col("o_custkey").cast("string"),
        "razao_social": F.col("c_name"),
        "municipio_nome": F.col("r_name"),
        "uf": F.col("n_name"),
        "data_publicacao_pncp": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        "ano_compra": (F.year("o_orderdate") - F.when(key % 40 == 0, 1).otherwise(0)).cast("int"),
        "objeto_compra": text,
        "modalidade_id": F.lit(v.MODALITY),
        "modalidade_nome": F.lit("Dispensa"),
        "situacao_id": F.col("o_orderstatus"),
        "situacao_nome": status,
        "valor_total_estimado": value,
    }
    return joined.select(*[expression.alias(name) for name, expression in columns.items()])


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver: classified, loaded at the moment of publication."""
    rows = silver.classify(notices(spark, sf_dir))
    return silver.stamp_load(rows, F.to_timestamp("data_publicacao_pncp"))


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same notices nested as they are landed, with run and page."""
    flat = notices(spark, sf_dir)
    return nest(flat)


def nest(flat: DataFrame) -> DataFrame:
    """Flat rows to landed records; the inverse of Silver's column map.

    Run: year of publication. Page: a block of 5000 order numbers.
    """
    plain = {path: name for name, path in v.SILVER_COLUMNS.items() if "." not in path}
    groups: dict[str, list] = {}
    for name, path in v.SILVER_COLUMNS.items():
        if "." in path:
            outer, inner = path.split(".")
            groups.setdefault(outer, []).append(F.col(name).alias(inner))
    return flat.select(
        *[F.col(name).alias(path) for path, name in plain.items()],
        *[F.struct(*inner).alias(outer) for outer, inner in groups.items()],
        F.substring("data_publicacao_pncp", 1, 4).alias("lote"),
        F.expr("cast(cast(numero_controle_pncp as bigint) div 5000 + 1 as int)").alias("pagina"),
    )


def write_pages(
    nested: DataFrame, path: str, one_page_per_file: bool = True, mode: str = "errorifexists",
    lost: Column | None = None, text_totals: bool = False, keep_nulls: bool = False,
) -> str:
    """Land nested records as page bodies below ``path``, in key order within a page.

    ``lost``: pages that never arrive; ``text_totals``: the envelope's totals come as text; ``keep_nulls``: a
    null field is written as null, else it is left out.
    """
    record = F.struct(v.BRONZE_KEY, *[c for c in nested.columns if c not in (v.BRONZE_KEY, "lote", "pagina")])
    bodies = nested.groupBy("lote", "pagina").agg(F.array_sort(F.collect_list(record)).alias("data"))
    totals = nested.groupBy("lote").agg(
        F.max("pagina").alias("totalPaginas"), F.count("*").alias("totalRegistros")
    )
    # a row a run: the pages are not shuffled to be joined with it
    landed = bodies.join(F.broadcast(totals), "lote")
    if lost is not None:
        landed = landed.filter(~lost)
    if text_totals:
        landed = landed.withColumns({c: F.col(c).cast("string") for c in ("totalPaginas", "totalRegistros")})
    nulls = {"ignoreNullFields": str(not keep_nulls).lower()}
    if one_page_per_file:
        landed.write.mode(mode).options(**nulls).partitionBy("lote", "pagina").json(path)
    else:
        (
            landed.withColumnRenamed("pagina", "numeroPagina").hint("rebalance", "lote")
            .write.mode(mode).options(**nulls).partitionBy("lote").json(path)
        )
    return path


def all_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The seven tables as if every daily run had been made."""
    return of_all_periods(bronze_rows(spark, sf_dir), silver_rows(spark, sf_dir))
