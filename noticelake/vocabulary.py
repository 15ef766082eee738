"""Fixed values.

Table names, labels, keyword patterns and bounds below are part of the result:
they must equal the published pipeline's for results to match, so they are
stated here as plain text and nowhere else.
"""

MODALITY = 8

# First matching rule wins; matched on the lower-cased object text.
CATEGORY_RULES = (
    ("Obras", "obra|constru|reforma|paviment|calçament|edificaç"),
    ("TI", "software|sistema|tecnologia|informátic|ti |suporte técnico|hardware"),
    ("Serviços", "serviç|manutenç|limpeza|vigilânc|conservaç|lavanderia|portaria|copeira"),
    ("Compras", "aquisiç|forneciment|material|equipament|produto|compra|item|insumo"),
)
CATEGORY_DEFAULT = "Outros"

# Inclusive upper bounds.
VALUE_BANDS = (
    (17600.0, "Ate R$17.600"),
    (80000.0, "R$17.601 a R$80.000"),
    (500000.0, "R$80.001 a R$500.000"),
)
VALUE_BAND_ABOVE = "Acima de R$500.000"
VALUE_BAND_MISSING = "Sem valor informado"

ABSENT = "N/A"

BRONZE = "contratacoes_raw"
SILVER = "contratacoes_processadas"
GOLD_AREA = "gold_area_de_servico"
GOLD_STATE = "gold_estado"
GOLD_BAND = "gold_faixa_de_valor"
GOLD_STATUS = "gold_situacao"
GOLD_MONTH = "gold_por_mes"
GOLD_TABLES = (GOLD_AREA, GOLD_STATE, GOLD_BAND, GOLD_STATUS, GOLD_MONTH)
ALL_TABLES = (BRONZE, SILVER) + GOLD_TABLES

BRONZE_KEY = "numeroControlePNCP"
SILVER_KEY = "numero_controle_pncp"

# Silver column <- path in the landed record.
SILVER_COLUMNS = {
    "numero_controle_pncp": "numeroControlePNCP",
    "cnpj_orgao": "orgaoEntidade.cnpj",
    "razao_social": "orgaoEntidade.razaoSocial",
    "municipio_nome": "unidadeOrgao.municipioNome",
    "uf": "unidadeOrgao.ufSigla",
    "data_publicacao_pncp": "dataPublicacaoPncp",
    "ano_compra": "anoCompra",
    "objeto_compra": "objetoCompra",
    "modalidade_id": "modalidadeId",
    "modalidade_nome": "modalidadeNome",
    "situacao_id": "situacaoCompraId",
    "situacao_nome": "situacaoCompraNome",
    "valor_total_estimado": "valorTotalEstimado",
}

# Brazilian states by region (public geography), for questions about a region.
REGIONS = {
    "Norte": ("AC", "AM", "AP", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MS", "MT"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}
