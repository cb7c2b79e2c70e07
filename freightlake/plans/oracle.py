"""SQL (DuckDB) statements of the same queries, for the correctness check.

The CTE chain mirrors ``freightlake.plans.domain``: mapping -> silver ->
staging -> dimensions -> fact -> daily summary.  Rounding is done on
``DECIMAL(38,10)`` then cast to DOUBLE in both engines (see ``round_half_up``).
"""

from __future__ import annotations

from freightlake.sources.driver_tables import ORACLE_CTES


def r2(expr: str, scale: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def hash_key(col: str) -> str:
    return (f"CAST(('0x' || substr(md5(coalesce(CAST({col} AS VARCHAR), "
            f"'_dbt_utils_surrogate_key_null_')), 1, 15)) AS BIGINT)")


STATUSES = "('EM_TRANSITO','PARADO','CHEGOU','SAIU','MANUTENCAO','CARREGANDO','DESCARREGANDO')"

DUR = "((epoch_us(e.data_fim) // 1000000 - epoch_us(e.data_inicio) // 1000000) / 60)"

SILVER = f"""
silver AS (
  SELECT e.evento_id, e.vagao_id, e.contrato_id, e.status, e.data_inicio, e.data_fim, e.updated_at,
         regexp_replace(upper(trim(e.status)), '\\s+', '_', 'g') AS status_norm,
         {DUR} AS duracao_minutos,
         w.tipo_vagao, w.capacidade_ton, w.ano_fabricacao,
         c.cliente_nome, c.sla_horas, c.segmento,
         CASE WHEN {DUR} > c.sla_horas * 60 THEN true ELSE false END AS sla_violado,
         CAST(e.data_inicio AS DATE) AS _partition_date
  FROM ev e
  LEFT JOIN wagons w ON e.vagao_id = w.vagao_id
  LEFT JOIN contracts c ON e.contrato_id = c.contrato_id
  WHERE e.evento_id IS NOT NULL)"""

GATE = """
gate AS (
  SELECT * REPLACE (CASE WHEN evento_id % 53 = 8 THEN NULL WHEN evento_id % 97 = 42 THEN evento_id - 1
                         ELSE evento_id END AS evento_id,
                    CASE WHEN evento_id % 61 = 5 THEN NULL ELSE data_inicio END AS data_inicio)
  FROM silver)"""

STG = """
stg AS (
  SELECT evento_id, vagao_id, contrato_id, status_norm AS status_evento,
         data_inicio AS iniciado_em, data_fim AS finalizado_em,
         CAST(duracao_minutos AS DECIMAL(10,2)) AS duracao_minutos,
         tipo_vagao, CAST(capacidade_ton AS DECIMAL(10,2)) AS capacidade_ton,
         CAST(ano_fabricacao AS INTEGER) AS vagao_ano_fabricacao,
         cliente_nome, CAST(sla_horas AS DECIMAL(6,2)) AS sla_horas_contrato, segmento,
         CAST(sla_violado AS BOOLEAN) AS sla_violado, _partition_date AS data_particao
  FROM silver
  WHERE evento_id IS NOT NULL AND data_inicio IS NOT NULL
    AND (data_fim IS NULL OR data_fim >= data_inicio)),
stg_wagons AS (
  SELECT vagao_id, tipo_vagao, CAST(capacidade_ton AS DECIMAL(10,2)) AS capacidade_ton,
         CAST(ano_fabricacao AS INTEGER) AS ano_fabricacao, fabricante,
         CAST(ultima_revisao AS DATE) AS data_ultima_revisao, ativo
  FROM wagons WHERE vagao_id IS NOT NULL AND ativo = true)"""

DIMS = f"""
dim_wagons AS (SELECT {hash_key('vagao_id')} AS vagao_sk, * FROM stg_wagons),
dim_contracts AS (SELECT {hash_key('contrato_id')} AS contrato_sk, * FROM contracts)"""

_D = "CAST(s.duracao_minutos AS DOUBLE)"
_S = "CAST(s.sla_horas_contrato AS DOUBLE)"

FACT = f"""
fact AS (
  SELECT md5(coalesce(CAST(s.evento_id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS evento_sk,
         s.evento_id,
         coalesce(dw.vagao_sk, -1) AS vagao_sk,
         coalesce(dc.contrato_sk, -1) AS contrato_sk,
         CAST(coalesce(CASE WHEN s.data_particao >= DATE '2020-01-01'
                  THEN CAST(strftime(s.data_particao, '%Y%m%d') AS INTEGER) END, -1) AS INTEGER) AS data_sk,
         s.status_evento, s.iniciado_em, s.finalizado_em, s.duracao_minutos,
         CASE WHEN {_D} >= 60 THEN {r2(f'{_D} / 60.0')} END AS duracao_horas,
         CASE WHEN {_S} > 0 THEN {r2(f'{_D} / ({_S} * 60) * 100')} END AS pct_sla_utilizado,
         s.sla_violado,
         CASE WHEN s.status_evento IN ('PARADO','MANUTENCAO') AND {_D} > 120 THEN true ELSE false END AS parada_critica,
         s.cliente_nome, s.segmento, s.tipo_vagao, s.capacidade_ton, s.sla_horas_contrato, s.data_particao
  FROM stg s
  LEFT JOIN dim_wagons dw ON s.vagao_id = dw.vagao_id
  LEFT JOIN dim_contracts dc ON s.contrato_id = dc.contrato_id)"""

DAILY = f"""
daily AS (
  SELECT data_particao, cliente_nome, segmento, tipo_vagao,
         count(*) AS total_eventos,
         count(*) FILTER (WHERE sla_violado) AS total_violacoes,
         count(*) FILTER (WHERE parada_critica) AS paradas_criticas,
         {r2('CAST(sum(duracao_minutos) AS DOUBLE) / nullif(count(duracao_minutos), 0)')} AS duracao_media_min,
         {r2('CAST(sum(CAST(pct_sla_utilizado AS DECIMAL(12,2))) AS DOUBLE) / nullif(count(pct_sla_utilizado), 0)')} AS pct_sla_medio,
         max(pct_sla_utilizado) AS pct_sla_maximo,
         {r2('count(*) FILTER (WHERE sla_violado) * 100.0 / nullif(count(*), 0)')} AS taxa_violacao_pct
  FROM fact
  WHERE data_particao >= DATE '2024-01-31' - INTERVAL 90 DAY
  GROUP BY 1, 2, 3, 4)"""

MART = """
client_totals AS (
  SELECT cliente_nome, CAST(sum(total_violacoes) AS BIGINT) AS total_violacoes_cliente_periodo
  FROM daily GROUP BY 1),
mart AS (
  SELECT d.*, t.total_violacoes_cliente_periodo,
         row_number() OVER (ORDER BY t.total_violacoes_cliente_periodo DESC NULLS LAST,
                                     d.cliente_nome ASC NULLS LAST, d.data_particao ASC NULLS LAST,
                                     d.segmento ASC NULLS LAST, d.tipo_vagao ASC NULLS LAST) AS total_violacoes_desc
  FROM daily d JOIN client_totals t ON d.cliente_nome IS NOT DISTINCT FROM t.cliente_nome)"""


def with_ctes(*parts: str) -> str:
    """``WITH`` + the mapping CTEs + the given CTE blocks (in order)."""
    blocks = [ORACLE_CTES.strip().rstrip(",")] + [p.strip().rstrip(",") for p in parts]
    return "WITH " + ",\n".join(blocks) + "\n"


CHAIN_SILVER = (SILVER,)
CHAIN_GATE = (SILVER, GATE)
CHAIN_STG = (SILVER, STG)
CHAIN_FACT = (SILVER, STG, DIMS, FACT)
CHAIN_DAILY = (SILVER, STG, DIMS, FACT, DAILY)
CHAIN_MART = (SILVER, STG, DIMS, FACT, DAILY, MART)

FACT_OUT = """evento_sk, evento_id, vagao_sk, contrato_sk, data_sk, status_evento, iniciado_em,
  finalizado_em, CAST(duracao_minutos AS DOUBLE) AS duracao_minutos, duracao_horas, pct_sla_utilizado,
  sla_violado, parada_critica, cliente_nome, segmento, tipo_vagao,
  CAST(capacidade_ton AS DOUBLE) AS capacidade_ton, CAST(sla_horas_contrato AS DOUBLE) AS sla_horas_contrato,
  data_particao"""
