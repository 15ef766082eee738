"""Explicit schemas of every layer.

Scalars whose JSON type varies between landed pages (number in one, text in
another) are read as text and typed when Silver is built, so that no value is
lost to a parser that expects one type.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from noticelake import vocabulary as v


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


NOTICE = _struct(
    numeroControlePNCP=StringType(),
    anoCompra=StringType(),
    objetoCompra=StringType(),
    dataPublicacaoPncp=StringType(),
    modalidadeId=StringType(),
    modalidadeNome=StringType(),
    situacaoCompraId=StringType(),
    situacaoCompraNome=StringType(),
    valorTotalEstimado=StringType(),
    orgaoEntidade=_struct(cnpj=StringType(), razaoSocial=StringType()),
    unidadeOrgao=_struct(municipioNome=StringType(), ufSigla=StringType()),
)

#: Totals come as number or text, like the scalars of a notice.
ENVELOPE = _struct(
    totalPaginas=StringType(),
    totalRegistros=StringType(),
    data=ArrayType(NOTICE),
)

#: Where a record came from: run, page within the run, place within the page.
ORIGIN = _struct(lote=StringType(), pagina=IntegerType(), pos=IntegerType())

#: Landed content that is no page or no record.
REJECTED = _struct(
    lote=StringType(), pagina=IntegerType(), arquivo=StringType(), posicao=IntegerType(), motivo=StringType(), conteudo=StringType()
)

#: Beside a record or batch row: its top-level fields that were given as null, which is not the same as left out.
NULLS = "nulos"

#: Storage partition of Bronze and Silver (see functions.dates.publication_part).
PARTITION = "publication_part"

BRONZE = StructType(NOTICE.fields + ORIGIN.fields + [StructField(PARTITION, StringType())])

SILVER_TYPES = {
    "ano_compra": IntegerType(),
    "modalidade_id": IntegerType(),
    "valor_total_estimado": DoubleType(),
}

SILVER_FLAT = StructType(
    [StructField(name, SILVER_TYPES.get(name, StringType())) for name in v.SILVER_COLUMNS]
)

SILVER = StructType(
    SILVER_FLAT.fields
    + [
        StructField("ramo_mei", StringType()),
        StructField("data_coleta", TimestampType()),
        StructField(PARTITION, StringType()),
    ]
)

_PERIOD = _struct(periodo_inicio=StringType(), periodo_fim=StringType()).fields
_COUNT_SUM = _struct(total_contratacoes=LongType(), valor_total=DoubleType()).fields
_STAMP = _struct(data_atualizacao=TimestampType()).fields


def _gold(keys: StructType, extra: StructType | None = None, period: bool = True) -> StructType:
    return StructType(
        (_PERIOD if period else [])
        + keys.fields
        + _COUNT_SUM
        + (extra.fields if extra else [])
        + _STAMP
    )


GOLD = {
    v.GOLD_AREA: _gold(_struct(uf=StringType(), ramo_mei=StringType()), _struct(valor_maximo=DoubleType())),
    v.GOLD_STATE: _gold(_struct(uf=StringType()), _struct(orgaos_distintos=LongType())),
    v.GOLD_BAND: _gold(_struct(uf=StringType(), faixa_valor=StringType())),
    v.GOLD_STATUS: _gold(_struct(uf=StringType(), situacao_nome=StringType())),
    v.GOLD_MONTH: _gold(
        _struct(ano=IntegerType(), mes=IntegerType(), uf=StringType()),
        _struct(orgaos_distintos=LongType()),
        period=False,
    ),
}
