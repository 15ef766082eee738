"""For each registered query the same result in plain SQL over the given tables.

Written from the meaning of the operators, not from their DataFrame form. Money is
summed as fixed-point on both sides, so sums do not depend on row order.
"""

from __future__ import annotations

from noticelake import vocabulary as v
from noticelake.registry import queries as q

PV = """pv as (
 select cast(o_orderkey as varchar) numero_controle_pncp, cast(o_custkey as varchar) cnpj_orgao,
  c_name razao_social, r_name municipio_nome, n_name uf,
  replace(cast(o_orderdate as varchar), ' ', 'T') data_publicacao_pncp,
  cast(year(o_orderdate) - case when o_orderkey % 40 = 0 then 1 else 0 end as integer) ano_compra,
  case o_orderkey % 10 when 0 then 'Obra de REFORMA da escola' when 1 then 'Licença de SOFTWARE'
   when 2 then 'SERVIÇO de limpeza' when 3 then 'Aquisição de material' when 4 then 'Locação de imóvel'
   when 5 then 'COBRANÇA de tributos' when 6 then 'Calçamento com sistema de drenagem'
   when 7 then 'Servico sem acento' when 8 then null else 'Manutenção de equipamento' end objeto_compra,
  cast(8 as integer) modalidade_id, 'Dispensa' modalidade_nome, o_orderstatus situacao_id,
  case o_orderstatus when 'O' then 'Divulgada' when 'F' then 'Encerrada' else 'Suspensa' end situacao_nome,
  case o_orderkey % 50 when 0 then null when 1 then 17600.0 when 2 then 80000.0 when 3 then 500000.0
   when 4 then 750000.5 else cast(o_totalprice as double) end valor_total_estimado
 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey)"""


def ramo(text: str) -> str:
    whens = " ".join(f"when regexp_matches(lower({text}), '{pattern}') then '{name}'" for name, pattern in v.CATEGORY_RULES)
    return f"case {whens} else '{v.CATEGORY_DEFAULT}' end"


def money(column: str, places: int | None = None) -> str:
    total = f"sum(cast({column} as decimal(28,4)))"
    if places is not None:
        total = f"round({total}, {places})"
    return f"coalesce(cast({total} as double), 0.0)"


_BANDS = " ".join(f"when valor_total_estimado <= {limit} then '{name}'" for limit, name in v.VALUE_BANDS)
FAIXA = (
    f"case when valor_total_estimado is null then '{v.VALUE_BAND_MISSING}' {_BANDS} else '{v.VALUE_BAND_ABOVE}' end"
)
FLAT = ", ".join(v.SILVER_COLUMNS)

SILVER = f"""{PV}, silver as (
 select *, {ramo('objeto_compra')} ramo_mei, {FAIXA} faixa_valor, ano_compra ano,
  cast(month(cast(data_publicacao_pncp as timestamp)) as integer) mes,
  cast(data_publicacao_pncp as timestamp) data_coleta from pv)"""

# one row per notice and two-day period that covers it
PERIODS = f"""{SILVER}, em_periodo as (
 select silver.*, strftime(cast(data_coleta as date) - k, '%Y%m%d') periodo_inicio,
  strftime(cast(data_coleta as date) - k + 1, '%Y%m%d') periodo_fim
 from silver, (values (0), (1)) t(k))"""

COUNT = "count(*) total_contratacoes"
SUM = f"{money('valor_total_estimado')} valor_total"
BUYERS = "count(distinct cnpj_orgao) orgaos_distintos"
LARGEST = "coalesce(max(valor_total_estimado), 0.0) valor_maximo"


def gold(keys: str, measures: str, source: str = "silver", period: bool = True) -> str:
    fixed = f"'{q.FIRST_DAY}' periodo_inicio, '{q.LAST_DAY}' periodo_fim, " if period else ""
    return f"with {SILVER} select {fixed}{keys}, {measures} from {source} group by {keys}"


def sliding(keys: str, measures: str) -> str:
    return f"select periodo_inicio, periodo_fim, {keys}, {measures} from em_periodo group by periodo_inicio, periodo_fim, {keys}"


GOLD_STATE = sliding("uf", f"{COUNT}, {SUM}, {BUYERS}")
GOLD_AREA = sliding("uf, ramo_mei", f"{COUNT}, {SUM}, {LARGEST}")
GOLD_BAND = sliding("uf, faixa_valor", f"{COUNT}, {SUM}")
GOLD_STATUS = sliding("uf, situacao_nome", f"{COUNT}, {SUM}")
GOLD_MONTH = f"select uf, ano, mes, {COUNT}, {SUM}, {BUYERS} from silver group by uf, ano, mes"

ALL_GOLD = f"""{PERIODS}, gold_estado as ({GOLD_STATE}), gold_area_de_servico as ({GOLD_AREA}),
 gold_faixa_de_valor as ({GOLD_BAND}), gold_situacao as ({GOLD_STATUS}), gold_por_mes as ({GOLD_MONTH})"""

STATE = q.A_STATE.upper()
START, END = q.A_PERIOD.split("_")
IN_PERIOD = f"periodo_inicio = '{START}' and periodo_fim = '{END}'"


def summary(table: str, group: str, name: str, where: str = "true") -> str:
    return f"""with {ALL_GOLD} select {group} {name}, cast(sum(total_contratacoes) as bigint) total_contratacoes,
 {money('valor_total', 2)} valor_total from {table} where {where} group by {group}
 order by total_contratacoes desc, {name}"""


def first(limit: int | None) -> str:
    return f" limit {limit}" if limit else ""


def state_rows(where: str, limit: int | None = None) -> str:
    return f"""with {ALL_GOLD} select * from gold_estado where {where}
 order by total_contratacoes desc, periodo_inicio, periodo_fim, uf{first(limit)}"""


def found(where: str, limit: int | None = None) -> str:
    return f"""with {SILVER} select {FLAT}, ramo_mei from silver where {where}
 order by data_publicacao_pncp, numero_controle_pncp{first(limit)}"""


def month_rows(where: str) -> str:
    return f"with {ALL_GOLD} select * from gold_por_mes where {where} order by ano, mes, uf"


def top_buyers(where: str, limit: int) -> str:
    return f"""with {SILVER} select razao_social, cnpj_orgao cnpj, uf, {COUNT}, {money('valor_total_estimado', 2)} valor_total
 from silver where {where} group by all order by total_contratacoes desc, cnpj, razao_social, uf limit {limit}"""


def between(start: str, end: str, column: str = "data_publicacao_pncp") -> str:
    return f"{column} >= '{start}' and {column} <= '{end}T23:59:59'"


def states(where: str) -> str:
    return f"""with {ALL_GOLD} select uf, cast(sum(total_contratacoes) as bigint) total_contratacoes,
 {money('valor_total', 2)} valor_total from gold_estado where {where} group by uf"""


TWICE = """twice as (
 select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, cast(1 as integer) pagina from orders
 union all
 select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, null, 2 from orders where o_orderstatus = 'F')"""

CHANGES = """stored as (select * exclude o_orderdate from orders where o_orderstatus in ('F', 'P')),
batch as (
 select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderpriority = '5-LOW' then o_totalprice else o_totalprice * 2 end o_totalprice,
  case when o_orderpriority <> '1-URGENT' then o_orderpriority end o_orderpriority
 from orders where o_orderstatus in ('F', 'O'))"""

STATUS = f"""{CHANGES}, estados as (
 select coalesce(s.o_orderkey, b.o_orderkey) o_orderkey,
  case when s.o_orderkey is null then 'inserido' when b.o_orderkey is null then 'mantido'
   when s.o_totalprice is not distinct from b.o_totalprice
    and s.o_orderpriority is not distinct from b.o_orderpriority then 'inalterado' else 'atualizado' end estado,
  s.o_orderpriority is not distinct from b.o_orderpriority mesma_prioridade
 from stored s full join batch b on s.o_orderkey = b.o_orderkey)"""

BRONZE = f"""{PV}, bronze as (
 select *, substr(data_publicacao_pncp, 1, 4) lote,
  cast(cast(numero_controle_pncp as bigint) // 5000 + 1 as integer) pagina from pv)"""

# after both daily runs: pending notices closed, their stored value kept
CLOSED = f"""{PV}, silver as (
 select * replace (case situacao_nome when 'Suspensa' then 'Encerrada' else situacao_nome end as situacao_nome),
  ano_compra ano, cast(month(cast(data_publicacao_pncp as timestamp)) as integer) mes from pv)"""

ORACLES: dict[str, str] = {
    "silver_view": f"with {SILVER} select * exclude data_coleta from silver",
    "classify_ramo": f"with {SILVER} select numero_controle_pncp, ramo_mei from silver",
    "classify_documents": f"select doc_id, {ramo('text')} ramo_mei from documents",
    "bucketize_valor": f"with {SILVER} select numero_controle_pncp, valor_total_estimado, faixa_valor from silver",
    "casts": """select o_orderkey, case when o_orderstatus = 'F' then o_totalprice end valor,
 cast(o_orderkey as integer) numero, cast(null as integer) prioridade,
 case when o_orderstatus = 'F' then cast(month(o_orderdate) as integer) end mes from orders""",
    "compact_dates": """select o_orderkey,
 case when o_orderstatus = 'F' then strftime(o_orderdate, '%Y-%m-%d') else strftime(o_orderdate, '%Y%m') end dia,
 strftime(o_orderdate, '%Y%m%d') periodo_inicio, strftime(o_orderdate + interval 1 day, '%Y%m%d') periodo_fim
 from orders""",
    "range_lexicographic": f"""with t as (
 select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || 'T23:59:59'
  || case when o_orderpriority = '1-URGENT' then '.5' else '' end publicado from orders)
 select * from t where {between('1996-01-01', '1996-12-31', 'publicado')}""",
    "regex_ci_unicode": f"select doc_id, lang from documents where regexp_matches(text, '{q.ACCENTED}', 'i')",
    "optional_filters": f"""with {SILVER} select numero_controle_pncp, uf, ramo_mei from silver
 where uf = '{STATE}' and ramo_mei = 'Obras'""",
    "pages_explode": f"""with {BRONZE} select lote, pagina,
 cast(row_number() over (partition by lote, pagina order by numero_controle_pncp) - 1 as integer) pos,
 numero_controle_pncp, uf from bronze""",
    "page_totals": f"""with {BRONZE}, t as (
 select lote, max(pagina) as "totalPaginas", count(*) as "totalRegistros" from bronze group by lote)
 select lote, pagina, "totalPaginas", "totalRegistros", cast(count(*) as integer) registros
 from bronze join t using (lote) group by all""",
    "bronze_flatten": f"with {PV} select * from pv",
    "source_request": f"""with {PV} select numero_controle_pncp, data_publicacao_pncp as "dataPublicacaoPncp" from pv
 where {between('1997-01-01', '1997-12-31')} and modalidade_id = 8 and uf = '{STATE}'""",
    "missing_pages": """with n as (select o_orderpriority lote, max(o_custkey) total from orders group by 1),
 esperadas as (select lote, unnest(range(1, total + 1)) pagina from n)
 select lote, cast(pagina as integer) pagina from esperadas
 where (lote, pagina) not in (select (o_orderpriority, o_custkey) from orders)""",
    "missing_pages_landed": f"""with {BRONZE}, totais as (
 select lote, max(pagina) total from bronze group by lote having count(*) filter (pagina % 3 <> 1) > 0),
 esperadas as (select lote, unnest(range(1, total + 1)) pagina from totais)
 select lote, cast(pagina as integer) pagina from esperadas
 where (lote, pagina) not in (select (lote, pagina) from bronze where pagina % 3 <> 1)""",
    "bronze_period": f"""with {PV} select numero_controle_pncp, data_publicacao_pncp as "dataPublicacaoPncp" from pv
 where {between('1996-01-15', '1996-03-10')} and uf = '{STATE}'""",
    "silver_period": f"with {SILVER} select {FLAT}, ramo_mei from silver where {between('1996-01-15', '1996-03-10')}",
    "dedupe_keep_last": f"""with {TWICE} select * from twice
 qualify row_number() over (partition by o_orderkey order by pagina desc) = 1""",
    "dedupe_any": f"with {TWICE} select distinct o_orderkey from twice",
    "dedupe_by_customer": """select * exclude o_orderdate from orders
 qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
    "merge_last_fields": """select o_orderkey, o_custkey, o_orderstatus,
 case when o_orderstatus = 'F' then o_totalprice + 1 else o_totalprice end o_totalprice, o_orderpriority from orders""",
    "upsert_rows": f"""with {CHANGES} select * from stored where o_orderkey not in (select o_orderkey from batch)
 union all select * from batch""",
    "upsert_field_merge": f"""with {CHANGES} select coalesce(b.o_orderkey, s.o_orderkey) o_orderkey,
 coalesce(b.o_custkey, s.o_custkey) o_custkey, coalesce(b.o_orderstatus, s.o_orderstatus) o_orderstatus,
 coalesce(b.o_totalprice, s.o_totalprice) o_totalprice, coalesce(b.o_orderpriority, s.o_orderpriority) o_orderpriority
 from stored s full join batch b on s.o_orderkey = b.o_orderkey""",
    "upsert_status": f"with {STATUS} select o_orderkey, estado from estados",
    "upsert_counts": f"""with {STATUS} select count(*) filter (estado = 'inserido') inseridos,
 count(*) filter (estado = 'atualizado') atualizados, count(*) filter (estado = 'inalterado') inalterados,
 count(*) filter (estado = 'mantido') mantidos from estados""",
    "upsert_counts_ignoring": f"""with {STATUS} select count(*) filter (estado = 'inserido') inseridos,
 count(*) filter (estado in ('inalterado', 'atualizado') and not mesma_prioridade) atualizados,
 count(*) filter (estado in ('inalterado', 'atualizado') and mesma_prioridade) inalterados,
 count(*) filter (estado = 'mantido') mantidos from estados""",
    "key_uniqueness": """select l_orderkey, l_linenumber, count(*) ocorrencias from lineitem
 group by 1, 2 having count(*) > 1""",
    "table_upsert_rows": f"""with {SILVER} select {FLAT}, ramo_mei from (
 select * replace (case when situacao_id = 'P' then '2002-05-01T00:00:00' else data_publicacao_pncp end
  as data_publicacao_pncp) from silver)""",
    "table_upsert_fields": f"""with {PV} select * replace (
 case when situacao_id = 'P' then 'Anulada' else situacao_nome end as situacao_nome) from pv""",
    "gold_area": gold("uf, ramo_mei", f"{COUNT}, {SUM}, {LARGEST}"),
    "gold_estado": gold("uf", f"{COUNT}, {SUM}, {BUYERS}"),
    "gold_faixa": gold("uf, faixa_valor", f"{COUNT}, {SUM}"),
    "gold_situacao": gold("uf, situacao_nome", f"{COUNT}, {SUM}"),
    "gold_por_mes": gold("uf, ano, mes", f"{COUNT}, {SUM}, {BUYERS}", period=False),
    "gold_from_cells": gold("uf, ano, mes", f"{COUNT}, {SUM}, {BUYERS}", period=False),
    "gold_sliding_periods": f"with {PERIODS} {GOLD_STATE}",
    "gold_sliding_area": f"with {PERIODS} {GOLD_AREA}",
    "gold_sliding_faixa": f"with {PERIODS} {GOLD_BAND}",
    "gold_sliding_situacao": f"with {PERIODS} {GOLD_STATUS}",
    "gold_grouping_sets": f"""with {SILVER} select
 case grouping(uf, ramo_mei, faixa_valor, situacao_nome, ano, mes)
  when 15 then 'gold_area_de_servico' when 31 then 'gold_estado' when 23 then 'gold_faixa_de_valor'
  when 27 then 'gold_situacao' when 28 then 'gold_por_mes' end tabela,
 uf, ramo_mei, faixa_valor, situacao_nome, ano, mes, {COUNT}, {SUM}, {LARGEST}, {BUYERS} from silver
 group by grouping sets ((uf, ramo_mei), (uf), (uf, faixa_valor), (uf, situacao_nome), (uf, ano, mes))""",
    "daily_run_situacao": f"""with {CLOSED} select '{q.FIRST_DAY}' periodo_inicio, '{q.LAST_DAY}' periodo_fim,
 uf, situacao_nome, {COUNT}, {SUM} from silver group by uf, situacao_nome""",
    "daily_run_mes": f"with {CLOSED} {GOLD_MONTH}",
    "daily_run_mes_by_month": f"with {CLOSED} {GOLD_MONTH}",
    "gold_estado_approx": f"with {SILVER} select uf, {COUNT}, {SUM}, {BUYERS} from silver group by uf",
    "stream_estado_approx": f"with {SILVER} select uf, {COUNT}, {SUM}, {BUYERS} from silver group by uf",
    "gold_por_mes_approx": f"with {SILVER} {GOLD_MONTH}",
    "daily_run_approx": f"""with {SILVER}, periodos(periodo_inicio, periodo_fim) as (values {", ".join(str(x) for x in q.OVERLAPPING[:2])})
 select periodo_inicio, periodo_fim, uf, {COUNT}, {SUM}, {BUYERS} from silver join periodos
  on strftime(cast(data_coleta as date), '%Y%m%d') between periodo_inicio and periodo_fim group by all""",
    "upsert_field_merge_explicit_null": f"""with {PV}, p as (select *, situacao_id = 'P' and cast(numero_controle_pncp as bigint) % 2 = 0 vazia from pv)
 select * exclude vazia replace (case when vazia then null else cnpj_orgao end as cnpj_orgao,
  case when vazia then null else razao_social end as razao_social,
  case when vazia and cast(numero_controle_pncp as bigint) % 3 <> 0 then null else objeto_compra end as objeto_compra,
  case when vazia then null else valor_total_estimado end as valor_total_estimado) from p""",
    "daily_run_overlapping": f"""with {SILVER}, fechadas as (select * replace (case when situacao_id = 'P' and {between('1996-02-16', '1996-02-17')}
  then 'Encerrada' else situacao_nome end as situacao_nome) from silver),
 periodos(periodo_inicio, periodo_fim) as (values {", ".join(str(x) for x in q.OVERLAPPING)})
 select periodo_inicio, periodo_fim, uf, situacao_nome, {COUNT}, {SUM} from fechadas join periodos
  on strftime(cast(data_coleta as date), '%Y%m%d') between periodo_inicio and periodo_fim group by all""",
    "records_flatten": f"with {PV} select * from pv",
    "table_upsert_moved_dates": f"""with {PV}, corrigidas as (select numero_controle_pncp,
  case situacao_id when 'F' then '1999-05-' || substr(data_publicacao_pncp, 9, 11)
   when 'O' then '1999-6-' || substr(data_publicacao_pncp, 9, 11) else data_publicacao_pncp end as "dataPublicacaoPncp",
  objeto_compra as "objetoCompra" from pv)
 select * from corrigidas where {between('1996-02-01', '1999-12-31', '"dataPublicacaoPncp"')}""",
    "tool_contar": f"""with {ALL_GOLD} select 'contratacoes_processadas' colecao, count(*) total from silver
 union all select 'contratacoes_raw', count(*) from pv union all select 'gold_estado', count(*) from gold_estado
 union all select 'inexistente', 0""",
    "tool_resumo_estado": state_rows("true"),
    "tool_resumo_estado_periodo": state_rows(IN_PERIOD),
    "tool_resumo_estado_uf": state_rows(f"uf = '{STATE}'", 100),
    "tool_resumo_ramo": summary("gold_area_de_servico", "ramo_mei", "ramo_mei"),
    "tool_resumo_ramo_uf": summary("gold_area_de_servico", "ramo_mei", "ramo_mei", f"uf = '{STATE}'"),
    "tool_resumo_ramo_periodo": summary("gold_area_de_servico", "ramo_mei", "ramo_mei", IN_PERIOD),
    "tool_resumo_ramo_dedupe": f"""with {SILVER} select ramo_mei, {COUNT}, {money('valor_total_estimado', 2)} valor_total
 from silver group by ramo_mei""",
    "tool_resumo_faixa": summary("gold_faixa_de_valor", "faixa_valor", "faixa_valor"),
    "tool_resumo_faixa_uf_periodo": summary(
        "gold_faixa_de_valor", "faixa_valor", "faixa_valor", f"uf = '{q.A_STATE_IN_PERIOD.upper()}' and {IN_PERIOD}"
    ),
    "tool_resumo_situacao": summary("gold_situacao", "situacao_nome", "situacao"),
    "tool_resumo_situacao_dedupe": f"""with {SILVER} select situacao_nome situacao, {COUNT},
 {money('valor_total_estimado', 2)} valor_total from silver where {between('1996-02-14', '1996-02-15')}
 group by situacao_nome""",
    "tool_resumo_situacao_dedupe_mes": f"""with {SILVER} select situacao_nome situacao, {COUNT},
 {money('valor_total_estimado', 2)} valor_total from silver where {between('1996-01-01', '1996-01-31')}
 group by situacao_nome""",
    "tool_evolucao_mensal": month_rows("true"),
    "tool_evolucao_mensal_ano": month_rows(f"uf = '{STATE}' and ano = 1997"),
    "tool_top_orgaos": top_buyers("true", 10),
    "tool_top_orgaos_uf": top_buyers(f"uf = '{STATE}'", 5),
    "tool_top_orgaos_ausentes": f"""with {SILVER}, g as (
 select case when cast(cnpj_orgao as bigint) % 2 = 1 then razao_social end razao_social,
  case when cast(cnpj_orgao as bigint) % 2 = 1 then cnpj_orgao end cnpj, uf, {COUNT}, {money('valor_total_estimado', 2)} valor_total
 from silver group by all order by total_contratacoes desc, cnpj nulls first, razao_social nulls first, uf limit 10)
 select * replace (coalesce(razao_social, 'N/A') as razao_social, coalesce(cnpj, 'N/A') as cnpj) from g""",
    "tool_buscar": found(
        f"uf = '{STATE}' and {between('1996-01-01', '1996-12-31')}"
        " and regexp_matches(objeto_compra, 'reforma|LICENÇA', 'i')",
        100,
    ),
    "tool_buscar_sem_filtro": found("true", 10),
    "tool_resumo_estado_lake": state_rows(IN_PERIOD),
    "tool_resumo_ramo_lake": summary(
        "gold_area_de_servico", "ramo_mei", "ramo_mei", f"uf = '{q.A_STATE_IN_PERIOD.upper()}' and {IN_PERIOD}"
    ),
    "tool_resumo_faixa_lake": summary("gold_faixa_de_valor", "faixa_valor", "faixa_valor", IN_PERIOD),
    "tool_resumo_situacao_lake": f"""with {SILVER} select situacao_nome situacao, {COUNT},
 {money('valor_total_estimado', 2)} valor_total from silver where {between('1996-01-01', '1996-01-31')}
 group by situacao_nome""",
    "tool_evolucao_mensal_lake": month_rows("ano = 1997"),
    "tool_buscar_lake": found(
        f"uf = '{STATE}' and {between('1996-01-01', '1996-12-31')}"
        " and regexp_matches(objeto_compra, 'reforma|LICENÇA', 'i')"
    ),
    "tool_estatisticas_lake": f"""with {ALL_GOLD}, maior as (
 select * from silver order by valor_total_estimado desc nulls last, numero_controle_pncp desc limit 1)
 select (select count(*) from pv) camada_bronze_raw, (select count(*) from silver) camada_silver_processadas, """
    + ", ".join(
        f"(select count(*) from (select distinct {keys} from silver)) + (select count(*) from {name} where {IN_PERIOD}) {name}"
        for name, keys in {
            "gold_area_de_servico": "uf, ramo_mei", "gold_estado": "uf", "gold_faixa_de_valor": "uf, faixa_valor",
            "gold_situacao": "uf, situacao_nome",
        }.items()
    )
    + """, (select count(*) from gold_por_mes) gold_por_mes, valor_total_estimado maior_valor, objeto_compra maior_objeto,
 uf maior_uf, (select strftime(max(data_coleta), '%Y-%m-%d %H:%M:%S') from silver) ultima_atualizacao from maior""",
    "tool_painel": f"with {ALL_GOLD} select 'contratacoes_raw' colecao, count(*) total from pv union all "
    "select 'contratacoes_processadas', count(*) from silver union all "
    + " union all ".join(f"select '{name}', count(*) from {name}" for name in v.GOLD_TABLES),
    "tool_estatisticas": f"""with {ALL_GOLD}, maior as (
 select * from silver order by valor_total_estimado desc nulls last, numero_controle_pncp desc limit 1)
 select (select count(*) from pv) camada_bronze_raw, (select count(*) from silver) camada_silver_processadas, """
    + ", ".join(f"(select count(*) from {name}) {name}" for name in v.GOLD_TABLES)
    + """, valor_total_estimado maior_valor, objeto_compra maior_objeto, uf maior_uf,
 (select strftime(max(data_coleta), '%Y-%m-%d %H:%M:%S') from silver) ultima_atualizacao from maior""",
    "to_json_rows": f"with {SILVER} select '{{' || " + " || ',' || ".join(
        f"""'"{name}":' || coalesce({text}, 'null')"""
        for name, text in {
            **{c: f"""'"' || {c} || '"'""" for c in v.SILVER_COLUMNS},
            "ano_compra": "cast(ano_compra as varchar)",
            "modalidade_id": "cast(modalidade_id as varchar)",
            "valor_total_estimado": "cast(valor_total_estimado as varchar)",
            "ramo_mei": """'"' || ramo_mei || '"'""",
            "data_coleta": """'"' || data_publicacao_pncp || '.000000"'""",
        }.items()
    ) + " || '}' documento from silver",
    "to_json_gold": f"""with {SILVER} select '{{"uf":"' || uf || '","situacao_nome":"' || situacao_nome
 || '","total_contratacoes":' || count(*) || '}}' documento from silver group by uf, situacao_nome""",
    "acc_estado_com_mais": state_rows("true", 1),
    "acc_valor_em_uf": f"""with {ALL_GOLD} select uf, {money('valor_total', 2)} valor_total
 from gold_estado where uf = '{STATE}' group by uf""",
    "acc_ramo_maior_valor": f"""with {ALL_GOLD} select ramo_mei, cast(sum(total_contratacoes) as bigint) total_contratacoes,
 {money('valor_total', 2)} valor_total from gold_area_de_servico group by ramo_mei
 order by valor_total desc, ramo_mei limit 1""",
    "acc_limpeza_no_mes": found(
        f"{between('1996-01-01', '1996-01-31')} and regexp_matches(objeto_compra, 'limpeza', 'i')"
    ),
    "acc_ti_no_ano": found(f"{between('1996-01-01', '1996-12-31')} and ramo_mei = 'TI'"),
    "acc_mes_a_mes_no_ano": month_rows("ano = 1997"),
    "acc_ti_acima_80k": f"""with {SILVER} select numero_controle_pncp, uf, valor_total_estimado from silver
 where ramo_mei = 'TI' and valor_total_estimado > 80000""",
    "acc_compare_region": states(
        f"uf in (select n_name from nation join region on n_regionkey = r_regionkey where r_name = '{q.A_REGION}')"
    ),
    "acc_compare_states": states("uf in ('NATION_1', 'NATION_7', 'NATION_12')"),
    "stream_dedup": "select event_id, user_id, event_type, value from events",
    "stream_sliding": f"""select strftime(cast(ts as date) - k, '%Y%m%d') periodo_inicio,
 strftime(cast(ts as date) - k + 1, '%Y%m%d') periodo_fim, event_type, count(*) total, {money('value')} valor_total
 from events, (values (0), (1)) t(k) group by 1, 2, 3""",
    "stream_upsert": f"""with {SILVER} select {FLAT}, ramo_mei from (
 select * replace (case situacao_nome when 'Suspensa' then 'Encerrada' else situacao_nome end as situacao_nome)
 from silver)""",
}
ORACLES["stream_sliding_update"] = ORACLES["stream_sliding"]
ORACLES["tool_buscar_indexed"] = ORACLES["tool_buscar"]
ORACLES["tool_buscar_first"] = ORACLES["tool_buscar_sem_filtro"]

_LANDED = f"""{PV}, landed as (select substr(data_publicacao_pncp, 1, 4) lote, cast(k // 5000 + 1 as integer) pagina, k,
  cast(row_number() over (partition by substr(data_publicacao_pncp, 1, 4), k // 5000 order by k) - 1 as integer) posicao
 from (select *, cast(numero_controle_pncp as bigint) k from pv))"""
ORACLES["rejected_records"] = f"""with {_LANDED}
 select lote, pagina, posicao, 'registro não é objeto' motivo, cast(k as varchar) conteudo from landed where pagina % 11 <> 0 and k % 7 = 0
 union all select distinct lote, pagina, cast(null as integer), 'corpo ilegível', cast(null as varchar) from landed where pagina % 11 = 0"""
ORACLES["records_beside_rejected"] = f"""with {_LANDED} select lote, pagina, posicao pos, cast(k as varchar) numero_controle_pncp
 from landed where pagina % 11 <> 0 and k % 7 <> 0"""
ORACLES["stream_missing_pages"] = f"""with {_LANDED}, lotes as (select lote, max(pagina) ultima from landed
  group by lote having count(*) filter (pagina % 3 <> 1 or pagina % 2 = 0) > 0)
 select lote, cast(p as integer) pagina from lotes, unnest(range(1, ultima + 1)) t(p)
 where (lote, p) not in (select lote, pagina from landed where pagina % 3 <> 1 or pagina % 2 = 0)"""
ORACLES["table_upsert_versions"] = ORACLES["table_upsert_rows"]
ORACLES["daily_run_versions"] = ORACLES["daily_run_situacao"]
ORACLES["json_written"] = ORACLES["to_json_gold"]
ORACLES["stream_upsert_bronze"] = ORACLES["stream_upsert"]
ORACLES["tool_total_linhas"] = f"""with {ALL_GOLD} select 'resumo_por_estado' ferramenta, count(*) total_linhas from gold_estado where uf = '{STATE}'
 union all select 'evolucao_mensal', count(*) from gold_por_mes where ano = 1997
 union all select 'buscar_contratacoes', least(5, count(*)) from silver where uf = '{STATE}' and regexp_matches(objeto_compra, 'reforma', 'i')"""
ORACLES["source_pages_pushed"] = f"""with {PV} select numero_controle_pncp, data_publicacao_pncp as "dataPublicacaoPncp" from pv
 where {between('1997-01-10', '1997-02-15')} and uf = '{STATE}'"""
