"""Registered queries: name -> (Spark plan over the driver tables, DuckDB SQL).

Every query reads whole driver tables (or tables Spark derives from them).
Queries that exercise a sink write to a new folder under
``spark.checkpoint.dir`` and return what they read back.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.functions.expressions import (
    duration_hours,
    invalid_status,
    round_half_up,
    status_norm,
)
from freightlake.operators import checks, dedup, dims, gold, history, metrics, quality, upsert, validity
from freightlake.operators.checks import ColumnTest
from freightlake.operators.enrich import sla_rate_by_client
from freightlake.operators.schema_ops import add_audit, evolve_union
from freightlake.plans import domain as dm
from freightlake.plans import journal, tables
from freightlake.plans import oracle as o
from freightlake.schemas import VALID_STATUSES
from freightlake.session import scratch_path
from freightlake.sources import driver_tables as dt
from freightlake.sources.raw import read_with_quarantine


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, operators)
        return fn
    return deco


# ---------------------------------------------------------------------------
# silver: flagship, normalisation, duration, enrichment
# ---------------------------------------------------------------------------

@register("sla_rate_by_client", "J1 J2 P1 P2 P3 P4 A2 A3 A6", o.with_ctes(*o.CHAIN_SILVER) + f"""
SELECT cliente_nome, count(*) AS total_eventos,
       count(*) FILTER (WHERE sla_violado) AS total_violacoes,
       {o.r2('count(*) FILTER (WHERE sla_violado) * 100.0 / count(*)')} AS taxa_violacao_pct
FROM silver GROUP BY 1""")
def q_sla_rate_by_client(spark, sf):
    return sla_rate_by_client(dm.silver_events(spark, sf))


@register("status_normalised", "P1 P15", o.with_ctes() + f"""
SELECT evento_id, status,
       regexp_replace(upper(trim(status)), '\\s+', '_', 'g') AS status_norm,
       NOT (regexp_replace(upper(trim(status)), '\\s+', '_', 'g') IN {o.STATUSES}) AS status_invalido
FROM ev""")
def q_status_normalised(spark, sf):
    ev = dt.raw_events(spark, sf)
    return ev.select("evento_id", "status", status_norm("status").alias("status_norm"),
                     invalid_status(status_norm("status")).alias("status_invalido"))


@register("event_duration", "P2 P10", o.with_ctes() + f"""
SELECT e.evento_id, e.data_inicio, e.data_fim, {o.DUR} AS duracao_minutos,
       CASE WHEN {o.DUR} >= 60 THEN {o.r2(o.DUR + ' / 60.0')} END AS duracao_horas
FROM ev e""")
def q_event_duration(spark, sf):
    from freightlake.functions.expressions import duration_minutes
    ev = dt.raw_events(spark, sf)
    d = duration_minutes("data_inicio", "data_fim")
    return ev.select("evento_id", "data_inicio", "data_fim", d.alias("duracao_minutos"),
                     duration_hours(d).alias("duracao_horas"))


@register("enriched_events", "J1 J2 P1 P2 P3 P4 V5", o.with_ctes(*o.CHAIN_SILVER) + """
SELECT * FROM silver""")
def q_enriched_events(spark, sf):
    return dm.no_run_clock(dm.silver_events(spark, sf)).drop(
        "_source_domain", "_job_run_id")


# ---------------------------------------------------------------------------
# staging, dimensions, fact, marts
# ---------------------------------------------------------------------------

@register("stg_events", "P5 P6", o.with_ctes(*o.CHAIN_STG) + """
SELECT evento_id, vagao_id, contrato_id, status_evento, iniciado_em, finalizado_em,
       CAST(duracao_minutos AS DOUBLE) AS duracao_minutos, tipo_vagao,
       CAST(capacidade_ton AS DOUBLE) AS capacidade_ton, vagao_ano_fabricacao, cliente_nome,
       CAST(sla_horas_contrato AS DOUBLE) AS sla_horas_contrato, segmento, sla_violado, data_particao
FROM stg""")
def q_stg_events(spark, sf):
    return dm.decimals_as_double(dm.no_run_clock(dm.staged_events(spark, sf)))


@register("stg_wagons", "P7", o.with_ctes(*o.CHAIN_STG) + """
SELECT vagao_id, tipo_vagao, CAST(capacidade_ton AS DOUBLE) AS capacidade_ton, ano_fabricacao,
       fabricante, data_ultima_revisao, ativo FROM stg_wagons""")
def q_stg_wagons(spark, sf):
    return dm.decimals_as_double(dm.no_run_clock(dm.staged_wagons(spark, sf)))


@register("dim_wagons", "D1", o.with_ctes(*o.CHAIN_STG, o.DIMS) + """
SELECT vagao_sk, vagao_id, tipo_vagao, CAST(capacidade_ton AS DOUBLE) AS capacidade_ton,
       ano_fabricacao, fabricante, data_ultima_revisao, ativo FROM dim_wagons""")
def q_dim_wagons(spark, sf):
    return dm.decimals_as_double(dm.no_run_clock(dm.wagon_dim(spark, sf)))


@register("dim_contracts", "D2", o.with_ctes(*o.CHAIN_STG, o.DIMS) + """
SELECT * FROM dim_contracts""")
def q_dim_contracts(spark, sf):
    return dm.contract_dim(spark, sf)


@register("dim_calendar", "D3", o.with_ctes() + """
SELECT CAST(d AS DATE) AS data_completa,
       CAST(strftime(d, '%Y%m%d') AS INTEGER) AS data_sk,
       CAST(year(d) AS INTEGER) AS ano, CAST(month(d) AS INTEGER) AS mes,
       CAST(day(d) AS INTEGER) AS dia, CAST(dayofweek(d) + 1 AS INTEGER) AS dia_semana
FROM (SELECT unnest(generate_series(DATE '2020-01-01',
                                    (SELECT max(CAST(data_inicio AS DATE)) FROM ev),
                                    INTERVAL 1 DAY)) AS d)""")
def q_dim_calendar(spark, sf):
    return dims.calendar_dim(dt.raw_events(spark, sf), "data_inicio")


@register("fact_events", "J3 J4 J5 P8 P9 P10 P11 P12 P16", o.with_ctes(*o.CHAIN_FACT) + f"""
SELECT {o.FACT_OUT} FROM fact""")
def q_fact_events(spark, sf):
    return dm.decimals_as_double(dm.no_run_clock(dm.fact_events(spark, sf)))


_CALENDAR_END = "2024-01-20"


@register("fact_calendar", "J5 D3 P9", o.with_ctes(*o.CHAIN_FACT) + f"""
SELECT evento_id, data_particao,
       CASE WHEN data_particao BETWEEN DATE '2020-01-01' AND DATE '{_CALENDAR_END}'
            THEN CAST(strftime(data_particao, '%Y%m%d') AS INTEGER) ELSE -1 END AS data_sk
FROM fact""")
def q_fact_calendar(spark, sf):
    # a calendar that ends before the last event: later days have no key
    ends = dt.raw_events(spark, sf).filter(F.col("data_inicio") < F.lit(f"{_CALENDAR_END} 23:59:59.999999").cast("timestamp_ntz"))
    fact = gold.build_fact(dm.staged_events(spark, sf), dm.wagon_dim(spark, sf), dm.contract_dim(spark, sf), dm.NOW,
                           calendar=dims.calendar_dim(ends, "data_inicio"))
    return fact.select("evento_id", "data_particao", "data_sk")


@register("sla_default", "P18 P3", o.with_ctes(*o.CHAIN_SILVER) + """
SELECT evento_id, coalesce(duracao_minutos > coalesce(sla_horas, 24) * 60, false) AS sla_violado FROM silver""")
def q_sla_default(spark, sf):
    from freightlake.functions.expressions import sla_violated
    silver = dm.silver_events(spark, sf)
    return silver.select("evento_id", sla_violated("duracao_minutos", "sla_horas", 24).alias("sla_violado"))


_FACT_NOW_OLD = "2024-01-28 06:00:00"
_FACT_CUT = "2024-01-27"
_FACT_AS_OF = "2024-01-30"


@register("fact_incremental", "K9 P13 M3", o.with_ctes(*o.CHAIN_FACT) + f"""
SELECT {o.FACT_OUT},
       CASE WHEN data_particao >= DATE '{_FACT_AS_OF}' - INTERVAL 3 DAY
            THEN TIMESTAMP '{dm.NOW}' ELSE TIMESTAMP '{_FACT_NOW_OLD}' END AS dbt_updated_at
FROM fact""")
def q_fact_incremental(spark, sf):
    stg = dm.staged_events(spark, sf)
    wd, cd = dm.wagon_dim(spark, sf), dm.contract_dim(spark, sf)
    # State of the fact after the run of the 28th: events up to the 27th.
    existing = gold.build_fact(stg.filter(F.col("data_particao") <= F.lit(_FACT_CUT).cast("date")),
                               wd, cd, _FACT_NOW_OLD)
    fact = gold.build_fact(stg, wd, cd, dm.NOW, existing=existing, as_of=_FACT_AS_OF, lookback_days=3)
    out = dm.decimals_as_double(fact.drop("ingerido_em", "processado_em"))
    return out.withColumn("dbt_updated_at", F.col("dbt_updated_at").cast("timestamp_ntz"))


@register("sla_daily", "A1 A2 A3 A4 A5 A6 P14", o.with_ctes(*o.CHAIN_DAILY) + """
SELECT * FROM daily""")
def q_sla_daily(spark, sf):
    return dm.sla_daily(spark, sf)


@register("sla_mart", "W2 W3", o.with_ctes(*o.CHAIN_MART) + """
SELECT * FROM mart""")
def q_sla_mart(spark, sf):
    return gold.sla_mart(dm.sla_daily(spark, sf))


# ---------------------------------------------------------------------------
# quality gate and tests
# ---------------------------------------------------------------------------

_GATE_COUNTS = f"""
counts AS (
  SELECT _partition_date, count(*) AS total,
         count(*) FILTER (WHERE evento_id IS NULL) AS nulls_evento_id,
         count(*) FILTER (WHERE vagao_id IS NULL) AS nulls_vagao_id,
         count(*) FILTER (WHERE status_norm IS NULL) AS nulls_status_norm,
         count(*) FILTER (WHERE data_inicio IS NULL) AS nulls_data_inicio,
         count(DISTINCT evento_id) + max(CASE WHEN evento_id IS NULL THEN 1 ELSE 0 END) AS distinct_pk,
         count(*) FILTER (WHERE NOT (status_norm IN {o.STATUSES})) AS invalid_status,
         count(*) FILTER (WHERE data_inicio > data_fim) AS temporal_violations
  FROM gate GROUP BY 1)"""


@register("gate_counts", "A7 A8", o.with_ctes(*o.CHAIN_GATE, _GATE_COUNTS) + """
SELECT * FROM counts""")
def q_gate_counts(spark, sf):
    return quality.gate_counts(dm.gate_rows(spark, sf), by=["_partition_date"])


def _pct_sql(col: str) -> str:
    return f"CAST({col} AS DOUBLE) / CAST(total AS DOUBLE) * 100.0"


def _fmt_sql(expr: str) -> str:
    return f"printf('%.2f%%', {o.r2(expr)})"


def _gate_failure_rows_sql() -> str:
    parts = []
    for c in ("evento_id", "vagao_id", "status_norm", "data_inicio"):
        p = _pct_sql(f"nulls_{c}")
        parts.append(f"""SELECT _partition_date, 'Completeness_{c}' AS rule, 'ERROR' AS severity,
  printf('column ''{c}'': %s null (threshold 1%%)', {_fmt_sql(p)}) AS message, '< 1%' AS threshold,
  {_fmt_sql(p)} AS actual FROM counts WHERE total > 0 AND {p} > 1.0""")
    parts.append("""SELECT _partition_date, 'Uniqueness_evento_id', 'ERROR',
  printf('primary key ''evento_id'' has %d duplicates', total - distinct_pk), '0 duplicatas',
  CAST(total - distinct_pk AS VARCHAR) FROM counts WHERE total > 0 AND total <> distinct_pk""")
    p = _pct_sql("invalid_status")
    parts.append(f"""SELECT _partition_date, 'ValidValues_status_norm', 'WARNING',
  printf('%s of rows with an invalid status', {_fmt_sql(p)}), '< 0.5%', {_fmt_sql(p)}
  FROM counts WHERE total > 0 AND {p} > 0.5""")
    parts.append("""SELECT _partition_date, 'TemporalConsistency', 'ERROR',
  printf('%d rows with data_inicio > data_fim', temporal_violations), '0',
  CAST(temporal_violations AS VARCHAR) FROM counts WHERE total > 0 AND temporal_violations > 0""")
    parts.append("""SELECT _partition_date, 'MinimumVolumeCheck', 'WARNING',
  printf('volume %d below the expected minimum of 500,000', total), '>= 500,000',
  CAST(total AS VARCHAR) FROM counts WHERE total > 0 AND total < 500000""")
    return "\nUNION ALL\n".join(parts)


def _gate_failures_sql() -> str:
    return o.with_ctes(*o.CHAIN_GATE, _GATE_COUNTS) + _gate_failure_rows_sql()


@register("gate_failures", "Q1 Q2 Q3 Q4 Q5 Q6 Q7", _gate_failures_sql())
def q_gate_failures(spark, sf):
    counts = quality.gate_counts(dm.gate_rows(spark, sf), by=["_partition_date"])
    return quality.gate_failures(counts, by=["_partition_date"])


def _gate_alerts_sql() -> str:
    failures = "failures AS (\n" + _gate_failure_rows_sql() + "\n)"
    return o.with_ctes(*o.CHAIN_GATE, _GATE_COUNTS, failures) + f"""
SELECT _partition_date,
       CAST(to_json({{'alert_type': 'DATA_QUALITY_FAILURE', 'table': 'silver.fato_eventos_ferroviarios',
                      'processing_date': '{dm.AS_OF}', 'timestamp': '{dm.NOW}',
                      'failures': list_sort(list({{'rule': rule, 'severity': severity, 'message': message,
                                                   'threshold': threshold, 'actual': actual}}))}}) AS VARCHAR)
         AS payload
FROM failures GROUP BY _partition_date"""


@register("gate_alerts", "Q8 Q9", _gate_alerts_sql())
def q_gate_alerts(spark, sf):
    counts = quality.gate_counts(dm.gate_rows(spark, sf), by=["_partition_date"])
    failures = quality.gate_failures(counts, by=["_partition_date"])
    return quality.alert_payload(failures, "silver.fato_eventos_ferroviarios", dm.AS_OF, dm.NOW,
                                 by=["_partition_date"])


@register("gate_empty_day", "Q1", o.with_ctes(*o.CHAIN_GATE) + """
SELECT 'NonEmptyTable' AS rule, 'CRITICAL' AS severity, 'table has no rows for the processing date' AS message,
       '> 0' AS threshold, CAST(n AS VARCHAR) AS actual
FROM (SELECT count(*) AS n FROM gate WHERE _partition_date = DATE '2024-03-01') WHERE n = 0""")
def q_gate_empty_day(spark, sf):
    day = dm.gate_rows(spark, sf).filter(F.col("_partition_date") == F.lit("2024-03-01").cast("date"))
    return quality.gate_failures(quality.gate_counts(day))


@register("gate_decisions", "Q8", o.with_ctes(*o.CHAIN_GATE, _GATE_COUNTS, "failures AS (\n" + _gate_failure_rows_sql() + "\n)") + """
SELECT c._partition_date, count(f.rule) FILTER (WHERE f.severity IN ('ERROR', 'CRITICAL')) AS blocking,
       count(f.rule) AS failures,
       CASE WHEN count(f.rule) FILTER (WHERE f.severity IN ('ERROR', 'CRITICAL')) > 0 THEN 'blocked' ELSE 'passed' END AS decision
FROM counts c LEFT JOIN failures f ON f._partition_date IS NOT DISTINCT FROM c._partition_date GROUP BY 1""")
def q_gate_decisions(spark, sf):
    counts = quality.gate_counts(dm.gate_rows(spark, sf), by=["_partition_date"])
    return quality.gate_decisions(counts, by=["_partition_date"])


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# The declared column tests of the four models.
def _column_tests(spark, sf) -> DataFrame:
    # the tests run on stored layer tables, each built once from the one before
    silver = _stored(dm.silver_events(spark, sf), "silver")
    stg = gold.stg_events(silver)
    stg_w = dm.staged_wagons(spark, sf)
    fact = _stored(gold.build_fact(stg, dm.wagon_dim(spark, sf), dm.contract_dim(spark, sf), dm.NOW), "fact")
    daily = gold.sla_daily(fact, as_of=dm.AS_OF, lookback_days=90)
    parts = [
        checks.run_column_tests("stg_eventos_ferroviarios", stg, [
            ColumnTest("evento_id", "not_null"), ColumnTest("evento_id", "unique"),
            ColumnTest("vagao_id", "not_null"),
            ColumnTest("vagao_id", "relationships", to=stg_w, to_field="vagao_id"),
            ColumnTest("status_evento", "not_null"),
            ColumnTest("status_evento", "accepted_values", values=VALID_STATUSES),
            ColumnTest("iniciado_em", "not_null"),
            ColumnTest("duracao_minutos", "between", min_value=0, max_value=43200),
            ColumnTest("sla_violado", "not_null"),
        ]),
        checks.run_column_tests("stg_vagoes", stg_w, [
            ColumnTest("vagao_id", "not_null"), ColumnTest("vagao_id", "unique"),
            ColumnTest("capacidade_ton", "between", min_value=1, max_value=200),
        ]),
        checks.run_column_tests("fct_eventos_ferroviarios", fact, [
            ColumnTest("evento_sk", "not_null"), ColumnTest("evento_sk", "unique"),
            ColumnTest("evento_id", "not_null"), ColumnTest("status_evento", "not_null"),
            ColumnTest("status_evento", "accepted_values", values=VALID_STATUSES),
            ColumnTest("duracao_minutos", "between", min_value=0, max_value=43200,
                       row_condition="duracao_minutos is not null"),
            ColumnTest("pct_sla_utilizado", "between", min_value=0, max_value=10000,
                       row_condition="pct_sla_utilizado is not null"),
            ColumnTest("data_particao", "not_null"), ColumnTest("dbt_updated_at", "not_null"),
        ]),
        checks.run_column_tests("mart_sla_violations", daily, [
            ColumnTest("data_particao", "not_null"), ColumnTest("cliente_nome", "not_null"),
            ColumnTest("taxa_violacao_pct", "between", min_value=0, max_value=100),
        ]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _t(model, col, test, expr, frm):
    return f"SELECT '{model}' AS model, '{col}' AS column_name, '{test}' AS test_name, CAST(({expr}) AS BIGINT) AS failures FROM {frm}"


def _column_tests_sql() -> str:
    av = f"count(DISTINCT status_evento) FILTER (WHERE status_evento IS NOT NULL AND status_evento NOT IN {o.STATUSES})"
    uq = "(SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
    s = [
        _t("stg_eventos_ferroviarios", "evento_id", "not_null", "count(*) FILTER (WHERE evento_id IS NULL)", "stg"),
        _t("stg_eventos_ferroviarios", "evento_id", "unique", uq.format(c="evento_id", m="stg"), "(SELECT 1)"),
        _t("stg_eventos_ferroviarios", "vagao_id", "not_null", "count(*) FILTER (WHERE vagao_id IS NULL)", "stg"),
        _t("stg_eventos_ferroviarios", "vagao_id", "relationships",
           "count(*) FILTER (WHERE s.vagao_id IS NOT NULL AND p.vagao_id IS NULL)",
           "stg s LEFT JOIN (SELECT DISTINCT vagao_id FROM stg_wagons) p ON s.vagao_id = p.vagao_id"),
        _t("stg_eventos_ferroviarios", "status_evento", "not_null", "count(*) FILTER (WHERE status_evento IS NULL)", "stg"),
        _t("stg_eventos_ferroviarios", "status_evento", "accepted_values", av, "stg"),
        _t("stg_eventos_ferroviarios", "iniciado_em", "not_null", "count(*) FILTER (WHERE iniciado_em IS NULL)", "stg"),
        _t("stg_eventos_ferroviarios", "duracao_minutos", "between",
           "count(*) FILTER (WHERE NOT (duracao_minutos >= 0 AND duracao_minutos <= 43200))", "stg"),
        _t("stg_eventos_ferroviarios", "sla_violado", "not_null", "count(*) FILTER (WHERE sla_violado IS NULL)", "stg"),
        _t("stg_vagoes", "vagao_id", "not_null", "count(*) FILTER (WHERE vagao_id IS NULL)", "stg_wagons"),
        _t("stg_vagoes", "vagao_id", "unique", uq.format(c="vagao_id", m="stg_wagons"), "(SELECT 1)"),
        _t("stg_vagoes", "capacidade_ton", "between",
           "count(*) FILTER (WHERE NOT (capacidade_ton >= 1 AND capacidade_ton <= 200))", "stg_wagons"),
        _t("fct_eventos_ferroviarios", "evento_sk", "not_null", "count(*) FILTER (WHERE evento_sk IS NULL)", "fact"),
        _t("fct_eventos_ferroviarios", "evento_sk", "unique", uq.format(c="evento_sk", m="fact"), "(SELECT 1)"),
        _t("fct_eventos_ferroviarios", "evento_id", "not_null", "count(*) FILTER (WHERE evento_id IS NULL)", "fact"),
        _t("fct_eventos_ferroviarios", "status_evento", "not_null", "count(*) FILTER (WHERE status_evento IS NULL)", "fact"),
        _t("fct_eventos_ferroviarios", "status_evento", "accepted_values", av, "fact"),
        _t("fct_eventos_ferroviarios", "duracao_minutos", "between",
           "count(*) FILTER (WHERE duracao_minutos IS NOT NULL AND NOT (duracao_minutos >= 0 AND duracao_minutos <= 43200))", "fact"),
        _t("fct_eventos_ferroviarios", "pct_sla_utilizado", "between",
           "count(*) FILTER (WHERE pct_sla_utilizado IS NOT NULL AND NOT (pct_sla_utilizado >= 0 AND pct_sla_utilizado <= 10000))", "fact"),
        _t("fct_eventos_ferroviarios", "data_particao", "not_null", "count(*) FILTER (WHERE data_particao IS NULL)", "fact"),
        _t("fct_eventos_ferroviarios", "dbt_updated_at", "not_null", "0", "(SELECT 1)"),
        _t("mart_sla_violations", "data_particao", "not_null", "count(*) FILTER (WHERE data_particao IS NULL)", "daily"),
        _t("mart_sla_violations", "cliente_nome", "not_null", "count(*) FILTER (WHERE cliente_nome IS NULL)", "daily"),
        _t("mart_sla_violations", "taxa_violacao_pct", "between",
           "count(*) FILTER (WHERE NOT (taxa_violacao_pct >= 0 AND taxa_violacao_pct <= 100))", "daily"),
    ]
    return o.with_ctes(*o.CHAIN_DAILY) + "\nUNION ALL\n".join(s)


@register("column_tests", "Q10 Q11 Q12 Q13 Q14 J7", _column_tests_sql())
def q_column_tests(spark, sf):
    return _column_tests(spark, sf)


_FRESH_NOW = "2024-01-31 12:00:00"


@register("freshness", "Q15", o.with_ctes(*o.CHAIN_SILVER) + f"""
SELECT 'silver.fato_eventos_ferroviarios' AS source, max_loaded_at,
       round((epoch_us(TIMESTAMP '{_FRESH_NOW}') // 1000000 - epoch_us(max_loaded_at) // 1000000) / 3600.0, 4) AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN (epoch_us(TIMESTAMP '{_FRESH_NOW}') // 1000000 - epoch_us(max_loaded_at) // 1000000) / 3600.0 > 25 THEN 'error'
            WHEN (epoch_us(TIMESTAMP '{_FRESH_NOW}') // 1000000 - epoch_us(max_loaded_at) // 1000000) / 3600.0 > 12 THEN 'warn'
            ELSE 'pass' END AS status
FROM (SELECT max(updated_at) AS max_loaded_at FROM silver)""")
def q_freshness(spark, sf):
    return checks.freshness(dm.silver_events(spark, sf), "updated_at", _FRESH_NOW,
                            "silver.fato_eventos_ferroviarios")


@register("ingest_alarms", "A10 Q16 A9", f"""
WITH c AS (SELECT count(*) AS raw, count(DISTINCT (l_orderkey, l_linenumber)) AS kept FROM lineitem),
m AS (
  SELECT 'RawRecordsRead' AS metric, CAST(raw AS DOUBLE) AS value FROM c
  UNION ALL SELECT 'DuplicatesRemoved', CAST(raw - kept AS DOUBLE) FROM c
  UNION ALL SELECT 'BronzeRecordsWritten', CAST(kept AS DOUBLE) FROM c)
SELECT m.metric, 'freightlake/pipeline' AS namespace, 'lineitem' AS domain, m.value, 'Count' AS unit,
       TIMESTAMP '{dm.NOW}' AS ts, r.comparison, r.threshold,
       coalesce(m.value > r.threshold, false) AS alarm
FROM m LEFT JOIN (SELECT 'DuplicatesRemoved' AS metric, '>' AS comparison, CAST(50000 AS DOUBLE) AS threshold) r
  ON m.metric = r.metric""")
def q_ingest_alarms(spark, sf):
    li = dt.table(spark, sf, "lineitem")
    m = metrics.ingest_metrics(li, ["l_orderkey", "l_linenumber"], "lineitem", dm.NOW)
    rules = metrics.alarm_rules(spark)
    out = metrics.alarms(m, rules, how="left")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# ---------------------------------------------------------------------------
# ingest: dedup, audit, as-of, schema evolution, quarantine, masking
# ---------------------------------------------------------------------------

_LI_KEYS = ["l_orderkey", "l_linenumber"]
_LI_TIES = ["l_partkey", "l_suppkey"]
_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
            "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@register("dedup_latest", "W1 O1", f"""
SELECT {_LI_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup_latest(spark, sf):
    return dedup.latest_per_key(dt.table(spark, sf, "lineitem"), _LI_KEYS, "l_shipdate", _LI_TIES)


@register("dedup_stats", "A8 A9", """
SELECT count(*) AS records_read, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates_removed
FROM lineitem""")
def q_dedup_stats(spark, sf):
    return dedup.dedup_stats(dt.table(spark, sf, "lineitem"), _LI_KEYS)


_AS_OF_LI = "1998-06-30"


@register("as_of_state", "K10", f"""
SELECT {_LI_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '{_AS_OF_LI} 00:00:00') WHERE rn = 1""")
def q_as_of_state(spark, sf):
    return history.as_of_state(dt.table(spark, sf, "lineitem"), _LI_KEYS, "l_shipdate",
                               f"{_AS_OF_LI} 00:00:00", _LI_TIES)


@register("audit_partition_counts", "V4", f"""
SELECT CAST(o_orderdate AS DATE) AS _partition_date, 'orders' AS _source_domain,
       'bronze_orders' AS _job_run_id, count(*) AS n_rows
FROM orders GROUP BY 1""")
def q_audit_partition_counts(spark, sf):
    df = add_audit(dt.table(spark, sf, "orders"), "orders", "o_orderdate", "bronze_orders", dm.NOW)
    return df.groupBy("_partition_date", "_source_domain", "_job_run_id").agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("masked_clients", "P17", """
SELECT c_custkey, sha256(c_name) AS c_name,
       regexp_replace(regexp_replace(regexp_replace(c_mktsegment, '[A-Z]', 'X', 'g'),
                                     '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_mktsegment,
       c_nationkey
FROM customer""")
def q_masked_clients(spark, sf):
    c = dt.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal")
    return history.mask_columns(c, {"c_name": "hash", "c_mktsegment": "mask", "c_acctbal": "drop"})


# Order-status update feed derived from line items (used by the upsert queries).
def _orders_target(spark, sf) -> DataFrame:
    return dt.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").alias("updated_at"))


def _orders_updates(spark, sf) -> DataFrame:
    li = dt.table(spark, sf, "lineitem")
    charge = (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * (F.lit(1) + F.col("l_tax")))
    # "every line status is F" as counts (fixed-width buffers keep the
    # aggregate hash-based; min/max over strings would force a sort aggregate)
    n = F.count("l_linestatus")
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.when((n > 0) & (F.count_if(F.col("l_linestatus") == "F") == n), "F")
         .when((n > 0) & (F.count_if(F.col("l_linestatus") == "O") == n), "O")
         .otherwise("P").alias("o_orderstatus"),
        round_half_up(F.sum(charge.try_cast("decimal(38,10)")), 2).alias("o_totalprice"),
        F.max("l_shipdate").alias("updated_at"),
    )


_UPSERT_SRC_SQL = f"""
t AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS updated_at FROM orders),
s AS (SELECT l_orderkey AS o_orderkey,
             CASE WHEN min(l_linestatus) = 'F' AND max(l_linestatus) = 'F' THEN 'F'
                  WHEN min(l_linestatus) = 'O' AND max(l_linestatus) = 'O' THEN 'O' ELSE 'P' END AS o_orderstatus,
             {o.r2('sum(CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DECIMAL(38,10)))')} AS o_totalprice,
             max(l_shipdate) AS updated_at
      FROM lineitem GROUP BY 1)"""


def _upsert_sql(cond: str) -> str:
    return f"""WITH {_UPSERT_SRC_SQL.strip()}
SELECT CASE WHEN s.o_orderkey IS NOT NULL AND (t.o_orderkey IS NULL OR {cond}) THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL AND (t.o_orderkey IS NULL OR {cond}) THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL AND (t.o_orderkey IS NULL OR {cond}) THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL AND (t.o_orderkey IS NULL OR {cond}) THEN s.updated_at ELSE t.updated_at END AS updated_at
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"""


@register("upsert_newer", "M1 M2 J6", _upsert_sql("coalesce(s.updated_at > t.updated_at, false)"))
def q_upsert_newer(spark, sf):
    return upsert.merge_upsert(_orders_target(spark, sf), _orders_updates(spark, sf),
                               "o_orderkey", newer="updated_at")


@register("upsert_replace", "M3", _upsert_sql("true"))
def q_upsert_replace(spark, sf):
    return upsert.merge_upsert(_orders_target(spark, sf), _orders_updates(spark, sf),
                               "o_orderkey", newer=None)


@register("upsert_idempotent", "M1 M4 K1 K2", f"""
SELECT *, CAST(date_trunc('month', updated_at) AS DATE) AS _partition_month FROM (
{_upsert_sql("coalesce(s.updated_at > t.updated_at, false)")})""")
def q_upsert_idempotent(spark, sf):
    # Orders span years: the table is partitioned by month of the watermark.
    # A key whose watermark moves to another month moves partition (K2).
    path = scratch_path(spark, "orders-bronze")
    part = F.trunc("updated_at", "month").alias("_partition_month")
    target = _orders_target(spark, sf).select("*", part)
    source = _orders_updates(spark, sf).select("*", part)
    tables.write_table(target, path, "_partition_month")
    batch = scratch_path(spark, "orders-updates")  # the landed batch, replayed twice
    source.write.parquet(batch)
    for _ in range(2):  # a second identical run must not change the table
        tables.write_merged(spark, spark.read.parquet(batch), path, "o_orderkey", newer="updated_at",
                            part_col="_partition_month", snapshot=False)
    return tables.read_table(spark, path)


# Orders without a usable date sit in the NULL partition: every 5th target row
# and every 7th update has none, so keys are new in, updated in, moved into and
# moved out of that partition.
@register("upsert_null_dates", "K2 V4 M1", f"""
WITH {_UPSERT_SRC_SQL.strip()},
tp AS (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(date_trunc('month', updated_at) AS DATE) END AS p FROM t),
sp AS (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(date_trunc('month', updated_at) AS DATE) END AS p FROM s)
SELECT CASE WHEN w THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN w THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN w THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN w THEN s.updated_at ELSE t.updated_at END AS updated_at,
       CASE WHEN w THEN s.p ELSE t.p END AS _partition_month
FROM (SELECT tp.o_orderkey AS tk, sp.o_orderkey AS sk,
             sp.o_orderkey IS NOT NULL AND (tp.o_orderkey IS NULL OR coalesce(sp.updated_at > tp.updated_at, false)) AS w
      FROM tp FULL OUTER JOIN sp ON tp.o_orderkey = sp.o_orderkey) m
LEFT JOIN tp t ON t.o_orderkey = m.tk LEFT JOIN sp s ON s.o_orderkey = m.sk""")
def q_upsert_null_dates(spark, sf):
    path = scratch_path(spark, "orders-null-dates")
    part = lambda n: F.when(F.col("o_orderkey") % n != 0, F.trunc("updated_at", "month")).alias("_partition_month")
    tables.write_merged(spark, _orders_target(spark, sf).select("*", part(5)), path, "o_orderkey",
                        newer="updated_at", part_col="_partition_month")
    for _ in range(2):
        tables.write_merged(spark, _orders_updates(spark, sf).select("*", part(7)), path, "o_orderkey",
                            newer="updated_at", part_col="_partition_month")
    return tables.read_table(spark, path)


# Three merges: the orders, the updates with a column the table lacks, then
# orders of other keys without it; the column and its values must stay.
@register("upsert_new_column", "K2 V3 M1", f"""
WITH {_UPSERT_SRC_SQL.strip()},
n AS (SELECT l_orderkey AS o_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       n.n_lines, CAST(date_trunc('month', coalesce(s.updated_at, t.updated_at)) AS DATE) AS _partition_month
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey LEFT JOIN n ON n.o_orderkey = s.o_orderkey""")
def q_upsert_new_column(spark, sf):
    path = scratch_path(spark, "orders-new-column")
    cols = ["o_orderkey", "o_orderstatus", F.trunc("updated_at", "month").alias("_partition_month")]
    orders = _orders_target(spark, sf).select(*cols)
    updates = _orders_updates(spark, sf).select(*cols)
    lines = dt.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"))
    untouched = orders.join(updates, "o_orderkey", "left_anti")
    touched = orders.join(updates, "o_orderkey", "left_semi")
    for batch in (touched, updates.join(lines, "o_orderkey"), untouched):
        tables.write_merged(spark, batch, path, "o_orderkey", part_col="_partition_month")
    return tables.read_table(spark, path)


# Keys as text without order (a digest leads): the index finds partitions that min/max
# ranges cannot.  Four merges: all orders, the updates twice, then the updates of a third
# of the keys with later watermarks.
@register("upsert_indexed", "K2 M1 M2", f"""
WITH m AS ({_upsert_sql("coalesce(s.updated_at > t.updated_at, false)")}),
w AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
             CASE WHEN o_orderkey % 3 = 0 AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
                  THEN CAST(updated_at AS DATE) + 40 ELSE CAST(updated_at AS DATE) END AS updated_at FROM m)
SELECT md5(CAST(o_orderkey AS VARCHAR)) AS pedido, o_orderstatus, o_totalprice, updated_at,
       CAST(date_trunc('month', updated_at) AS DATE) AS _partition_month FROM w""")
def q_upsert_indexed(spark, sf):
    path = scratch_path(spark, "orders-indexed")

    def keyed(df):
        return df.select(F.md5(F.col("o_orderkey").cast("string")).alias("pedido"), "o_orderstatus", "o_totalprice",
                         F.col("updated_at").cast("date").alias("updated_at"),
                         F.trunc("updated_at", "month").alias("_partition_month"))

    orders, updates = _orders_target(spark, sf), _stored(_orders_updates(spark, sf), "updates")
    first = _stored(upsert.merge_upsert(orders, updates, "o_orderkey", newer="updated_at"), "merged")
    later = (first.filter("o_orderkey % 3 = 0").join(updates.select("o_orderkey"), "o_orderkey", "left_semi")
             .withColumn("updated_at", F.date_add("updated_at", 40)))
    for batch in (orders, updates, updates, later):
        tables.write_merged(spark, keyed(batch), path, "pedido", newer="updated_at", part_col="_partition_month", index_buckets=8)
    return tables.read_table(spark, path)


# A column that a merge added is there for layer reads and for SQL.
@register("layer_added_column", "S5 S7 S11 V3 K2", """
WITH n AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderstatus, n_lines, CAST(date_trunc('year', o_orderdate) AS DATE) AS _partition_date,
       (SELECT sum(n_lines)::BIGINT FROM n WHERE l_orderkey IN (SELECT o_orderkey FROM orders)) AS all_lines
FROM orders LEFT JOIN n ON o_orderkey = l_orderkey""")
def q_layer_added_column(spark, sf):
    from freightlake.sources.raw import read_layer, register_layers
    path = scratch_path(spark, "orders-layer")
    orders = dt.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.trunc("o_orderdate", "year").alias("_partition_date"))
    lines = dt.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    tables.write_merged(spark, orders, path, "o_orderkey")
    tables.write_merged(spark, orders.join(lines, "o_orderkey"), path, "o_orderkey")
    register_layers(spark, {"orders_layer": path})
    total = spark.sql("SELECT sum(n_lines) AS all_lines FROM orders_layer")
    return read_layer(spark, path).crossJoin(F.broadcast(total))  # one row


# A journaled table after three merges: the orders, updates of two thirds of the keys, and
# later updates of the even keys.  States and versions come from the journal alone.
_JOURNAL_RUNS = [("orders", "2024-01-01 06:00:00"), ("updates", "2024-01-02 06:00:00"), ("later", "2024-01-03 06:00:00")]


def _merged_sql(target: str, source: str) -> str:
    wins = "s.o_orderkey IS NOT NULL AND (t.o_orderkey IS NULL OR coalesce(s.updated_at > t.updated_at, false))"
    cols = ("o_orderkey", "o_orderstatus", "o_totalprice", "updated_at")
    return (f"SELECT {', '.join(f'CASE WHEN {wins} THEN s.{c} ELSE t.{c} END AS {c}' for c in cols)} "
            f"FROM {target} t FULL OUTER JOIN {source} s ON t.o_orderkey = s.o_orderkey")


_JOURNAL_SQL = f"""WITH {_UPSERT_SRC_SQL.strip()},
s1 AS (SELECT * REPLACE (CAST(updated_at AS DATE) AS updated_at) FROM t),
b2 AS (SELECT * REPLACE (CAST(updated_at AS DATE) AS updated_at) FROM s WHERE o_orderkey % 3 <> 0),
b3 AS (SELECT * REPLACE (CAST(updated_at AS DATE) + 40 AS updated_at, 'L' AS o_orderstatus) FROM s WHERE o_orderkey % 2 = 0),
s2 AS ({_merged_sql("s1", "b2")}),
s3 AS ({_merged_sql("s2", "b3")})"""


def _journaled_orders(spark, sf) -> str:
    path = scratch_path(spark, "orders-journal")
    day = F.col("updated_at").cast("date")
    orders = _orders_target(spark, sf).withColumn("updated_at", day)
    updates = _stored(_orders_updates(spark, sf).withColumn("updated_at", day), "updates")
    batches = [orders, updates.filter("o_orderkey % 3 <> 0"),
               updates.filter("o_orderkey % 2 = 0").withColumns({
                   "updated_at": F.date_add("updated_at", 40), "o_orderstatus": F.lit("L")})]
    for batch, (run_id, at) in zip(batches, _JOURNAL_RUNS):
        tables.write_merged(spark, batch.withColumn("_partition_year", F.trunc("updated_at", "year")), path, "o_orderkey",
                            newer="updated_at", part_col="_partition_year", run=journal.Run(run_id, at))
    return path


@register("merged_as_of", "K10 K2", _JOURNAL_SQL + """
SELECT *, CAST(date_trunc('year', updated_at) AS DATE) AS _partition_year, '2024-01-01' AS as_of FROM s1
UNION ALL SELECT *, CAST(date_trunc('year', updated_at) AS DATE), '2024-01-02' FROM s2
UNION ALL SELECT *, CAST(date_trunc('year', updated_at) AS DATE), '2024-01-03' FROM s3""")
def q_merged_as_of(spark, sf):
    path = _journaled_orders(spark, sf)
    states = [journal.state_at(spark, path, f"{at[:10]} 23:59:59").withColumn("as_of", F.lit(at[:10])) for _, at in _JOURNAL_RUNS]
    return states[0].unionByName(states[1]).unionByName(states[2])


@register("row_versions", "K10 K2", _JOURNAL_SQL + """,
v AS (SELECT *, 1 AS n FROM s1 UNION ALL SELECT *, 2 FROM s2 UNION ALL SELECT *, 3 FROM s3),
c AS (SELECT *, lag(n) OVER w AS pn, lag(updated_at) OVER w AS pu FROM v
      WHERE o_orderkey IS NOT NULL WINDOW w AS (PARTITION BY o_orderkey ORDER BY n)),
k AS (SELECT * FROM c WHERE pn IS NULL OR updated_at > pu OR (updated_at IS NOT NULL AND pu IS NULL))
SELECT o_orderkey, o_orderstatus, o_totalprice, updated_at, CAST(date_trunc('year', updated_at) AS DATE) AS _partition_year,
       TIMESTAMP '2024-01-01 06:00:00' + to_days(n - 1) AS valid_from,
       TIMESTAMP '2024-01-01 06:00:00' + to_days(lead(n) OVER (PARTITION BY o_orderkey ORDER BY n) - 1) AS valid_to FROM k
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice, updated_at, CAST(date_trunc('year', updated_at) AS DATE),
       TIMESTAMP '2024-01-01 06:00:00' + to_days(n - 1), NULL
FROM (SELECT o_orderkey, o_orderstatus, o_totalprice, updated_at, 1 AS n FROM s1 WHERE o_orderkey IS NULL) x""")
def q_row_versions(spark, sf):
    out = journal.versions(spark, _journaled_orders(spark, sf))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})


# Contracts whose SLA changes twice in the month (a run each), joined to the events as of
# their instant: an event before the first run has no contract.
@register("sla_as_of_event", "D2 K10 J2", o.with_ctes() + """
SELECT e.evento_id, e.contrato_id, e.updated_at, c.cliente_nome,
       CASE WHEN c.contrato_id IS NULL THEN NULL
            WHEN e.updated_at >= TIMESTAMP '2024-01-21 00:00:00' AND c.contrato_id % 5 = 0 THEN 6
            WHEN e.updated_at >= TIMESTAMP '2024-01-11 00:00:00' AND c.contrato_id % 3 = 0 THEN c.sla_horas + 2
            ELSE c.sla_horas END AS sla_horas
FROM ev e LEFT JOIN contracts c ON e.contrato_id = c.contrato_id AND e.updated_at >= TIMESTAMP '2024-01-05 00:00:00'""")
def q_sla_as_of_event(spark, sf):
    path = scratch_path(spark, "contracts-journal")
    contracts = dt.raw_contracts(spark, sf)
    first = contracts.filter("contrato_id % 3 = 0").withColumn("sla_horas", F.col("sla_horas") + 2)
    second = contracts.filter("contrato_id % 5 = 0").withColumn("sla_horas", F.lit(6))
    for batch, run_id, at in ((contracts, "all", "2024-01-05 00:00:00"), (first, "first", "2024-01-11 00:00:00"),
                              (second, "second", "2024-01-21 00:00:00")):
        tables.write_merged(spark, batch, path, "contrato_id", part_col="segmento", run=journal.Run(run_id, at))
    events = dt.raw_events(spark, sf).select("evento_id", "contrato_id", "updated_at")
    return validity.as_of_join(events, journal.versions(spark, path), "contrato_id", "updated_at", ["cliente_nome", "sla_horas"])


@register("repeated_source_keys", "M4", """
SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def q_repeated_source_keys(spark, sf):
    return upsert.duplicate_source_keys(dt.table(spark, sf, "lineitem"), ["l_orderkey"])


@register("upsert_bucketed", "M1 K2 (bucketed)", f"""
SELECT *, CAST(date_trunc('month', updated_at) AS DATE) AS _partition_month FROM (
{_upsert_sql("coalesce(s.updated_at > t.updated_at, false)")})""")
def q_upsert_bucketed(spark, sf):
    # Same batch as upsert_idempotent, into a catalog table bucketed by the key
    # (external, in the shared folder): the merge reads the target by bucket.
    import uuid
    from freightlake.plans import bucketed
    name = f"fl_orders_{uuid.uuid4().hex[:10]}"
    part = F.trunc("updated_at", "month").alias("_partition_month")
    bucketed.create_keyed_table(_orders_target(spark, sf).select("*", part), name, ["o_orderkey"],
                                "_partition_month", buckets=4, path=scratch_path(spark, name))
    source = _orders_updates(spark, sf).select("*", part)
    for _ in range(2):
        bucketed.merge_into_table(spark, source, name, "o_orderkey", "updated_at", "_partition_month")
    return spark.table(name)


@register("schema_evolution", "V3", """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, NULL::BIGINT AS n_lines FROM orders
UNION ALL
SELECT l_orderkey, NULL, NULL, max(l_shipdate), count(*) FROM lineitem GROUP BY l_orderkey""")
def q_schema_evolution(spark, sf):
    existing = dt.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    incoming = dt.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("o_orderdate"), F.count(F.lit(1)).alias("n_lines"))
    return evolve_union(existing, incoming)


_QUARANTINE_SCHEMA = "evento_id long, vagao_id long, status string"


@register("corrupt_split", "S3 S10", o.with_ctes() + """
SELECT CASE WHEN status = 'error' THEN NULL ELSE evento_id END AS evento_id,
       CASE WHEN status = 'error' THEN NULL ELSE vagao_id END AS vagao_id,
       CASE WHEN status = 'error' THEN NULL ELSE status END AS status,
       CASE WHEN status = 'error' THEN '{"evento_id":' || evento_id || ',"vagao_id":' || vagao_id
            || ',"status":"' || status || '"' END AS _raw,
       coalesce(status = 'error', false) AS _quarantined
FROM ev""")
def q_corrupt_split(spark, sf):
    path = scratch_path(spark, "landing-json")
    ev = dt.raw_events(spark, sf)
    j = F.to_json(F.struct("evento_id", "vagao_id", "status"))
    # Error events arrive truncated (no closing brace): malformed lines.
    line = F.when(F.col("status") == "error", F.expr("substring(_j, 1, length(_j) - 1)")).otherwise(F.col("_j"))
    ev.withColumn("_j", j).select(line.alias("value")).write.text(path)
    schema = spark.createDataFrame([], _QUARANTINE_SCHEMA).schema
    good, bad = read_with_quarantine(spark, path, schema, partition_date=dm.AS_OF)
    return (good.select("*", F.lit(None).cast("string").alias("_raw"), F.lit(False).alias("_quarantined"))
            .unionByName(bad.select("evento_id", "vagao_id", "status", "_raw",
                                    F.lit(True).alias("_quarantined"))))


# Events as JSON lines of a later producer: a new field, a new field inside a known
# object, an amount that became text, an id that became text, an object that became a
# number, and truncated lines.
_MEASURE_SCHEMA = "evento_id long, status string, medida struct<valor:double,unidade:string>"
_MEASURE_SQL = """
e AS (SELECT event_id AS id, event_type AS status, event_id % 31 = 5 AS cut, event_id % 5 = 1 AS lot, event_id % 7 = 2 AS tare,
             event_id % 11 = 3 AS text_value, event_id % 13 = 4 AS text_id, event_id % 17 = 6 AS number FROM events),
u AS (SELECT * FROM e WHERE NOT cut)"""


def _measure_lines(spark, sf) -> str:
    i = F.col("event_id")
    amount = (i % 1000 + 0.5).cast("double")
    parts = [
        F.concat(F.lit('"evento_id":'), F.when(i % 13 == 4, F.concat(F.lit('"E'), i, F.lit('"'))).otherwise(i.cast("string"))),
        F.when(F.col("event_type").isNotNull(), F.concat(F.lit('"status":"'), "event_type", F.lit('"'))),
        F.when(i % 5 == 1, F.concat(F.lit('"lote":"L'), i % 7, F.lit('"'))),
        F.when(i % 17 == 6, F.lit('"medida":7')).otherwise(F.concat(
            F.lit('"medida":{"valor":'), F.when(i % 11 == 3, F.lit('"n/a"')).otherwise(amount.cast("string")),
            F.when(i % 7 == 2, F.lit(',"tara":{"kg":12}')).otherwise(""), F.lit(',"unidade":"t"}')))]
    line = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    path = scratch_path(spark, "measures-json")
    dt.table(spark, sf, "events").select(
        F.when(i % 31 == 5, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line).alias("value")).write.text(path)
    return path


@register("rescued_fields", "S10 V2", f"""WITH {_MEASURE_SQL.strip()}
SELECT CASE WHEN NOT text_id THEN id END AS evento_id, status,
       CASE WHEN NOT number AND NOT text_value THEN (id % 1000) + 0.5 END::DOUBLE AS valor, CASE WHEN NOT number THEN 't' END AS unidade,
       CASE WHEN lot THEN '"L' || (id % 7) || '"' END AS lote, CASE WHEN tare AND NOT number THEN '{{"kg":12}}' END AS tara,
       CASE WHEN text_id THEN '"E' || id || '"' END AS id_text, false AS quarantined
FROM u UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, true FROM e WHERE cut""")
def q_rescued_fields(spark, sf):
    from freightlake.sources import dead_letter
    rows, bad = dead_letter.read_rescued(spark, _measure_lines(spark, sf), T.StructType.fromDDL(_MEASURE_SCHEMA))
    found = F.from_json("_rescued", "map<string,string>")
    return rows.select("evento_id", "status", "medida.valor", "medida.unidade", found["lote"].alias("lote"),
                       found["medida.tara"].alias("tara"), found["evento_id"].alias("id_text"), F.lit(False).alias("quarantined")).unionByName(
        bad.select(F.lit(True).alias("quarantined")), allowMissingColumns=True)


@register("dead_letter_fields", "S10 V2", f"""WITH {_MEASURE_SQL.strip()}
SELECT * FROM (
  SELECT 'lote' AS path, 'STRING' AS type, 'unknown_field' AS reason, count(*) AS n FROM u WHERE lot
  UNION ALL SELECT 'medida.tara', 'OBJECT<kg: BIGINT>', 'unknown_field', count(*) FROM u WHERE tare AND NOT number
  UNION ALL SELECT 'medida.valor', 'STRING', 'retyped', count(*) FROM u WHERE text_value AND NOT number
  UNION ALL SELECT 'evento_id', 'STRING', 'retyped', count(*) FROM u WHERE text_id
  UNION ALL SELECT 'medida', 'BIGINT', 'retyped', count(*) FROM u WHERE number) WHERE n > 0""")
def q_dead_letter_fields(spark, sf):
    from freightlake.sources import dead_letter
    rows, _ = dead_letter.read_rescued(spark, _measure_lines(spark, sf), T.StructType.fromDDL(_MEASURE_SCHEMA))
    return dead_letter.dead_letters(rows)


# Two unique columns and an accepted-values list over the gate's faulty rows, in one scan.
@register("unique_columns", "Q10 Q11 Q12", o.with_ctes(*o.CHAIN_GATE) + "\nUNION ALL\n".join([
    "SELECT 'silver' AS model, 'evento_id' AS column_name, 'not_null' AS test_name, count(*) FILTER (WHERE evento_id IS NULL) AS failures FROM gate",
    *[f"SELECT 'silver', '{c}', 'unique', count(*) FROM (SELECT {c} FROM gate WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
      for c in ("evento_id", "vagao_id")],
    "SELECT 'silver', 'status_norm', 'accepted_values', count(DISTINCT status_norm) FROM gate WHERE status_norm NOT IN ('PARADO', 'CHEGOU')"]))
def q_unique_columns(spark, sf):
    return checks.run_column_tests("silver", dm.gate_rows(spark, sf), [
        ColumnTest("evento_id", "not_null"), ColumnTest("evento_id", "unique"), ColumnTest("vagao_id", "unique"),
        ColumnTest("status_norm", "accepted_values", values=["PARADO", "CHEGOU"])])


# ---------------------------------------------------------------------------
# publishing: day publish, reprocessing, load control
# ---------------------------------------------------------------------------

_REPROCESS_DAYS = 3


def _publish(spark, sf):
    daily = dm.sla_daily(spark, sf)
    path = scratch_path(spark, "mart-daily")
    days = tables.publish_days(spark, daily, path, None, "data_particao")
    cut = str(_days_before(dm.AS_OF, _REPROCESS_DAYS))
    redo = [d for d in days if d >= cut]  # the reprocess window: bounded by the days list
    tables.publish_days(spark, daily, path, redo, "data_particao")
    return path, days, redo


def _days_before(day: str, n: int):
    import datetime as _dt
    return _dt.date.fromisoformat(day) - _dt.timedelta(days=n)


@register("day_publish", "K3 K5 K7 U1", o.with_ctes(*o.CHAIN_DAILY) + """
SELECT * FROM daily""")
def q_day_publish(spark, sf):
    path, _, _ = _publish(spark, sf)
    return spark.read.parquet(path)


_LOAD_T1 = "2024-01-31 07:00:00"
_LOAD_T2 = "2024-01-31 09:30:00"


@register("load_control", "K4", o.with_ctes(*o.CHAIN_DAILY) + f"""
SELECT 'mart_sla_violations' AS domain, d AS processing_date,
       CASE WHEN d >= DATE '{dm.AS_OF}' - INTERVAL {_REPROCESS_DAYS} DAY THEN TIMESTAMP '{_LOAD_T2}'
            ELSE TIMESTAMP '{_LOAD_T1}' END AS loaded_at, 'SUCCESS' AS status
FROM (SELECT DISTINCT data_particao AS d FROM daily)""")
def q_load_control(spark, sf):
    daily = dm.sla_daily(spark, sf)
    days = daily.select(F.col("data_particao").alias("processing_date")).distinct()
    cut = F.date_sub(F.lit(dm.AS_OF).cast("date"), _REPROCESS_DAYS)
    path = scratch_path(spark, "load-control")
    tables.append_load_control(tables.load_control_rows(days, "mart_sla_violations", _LOAD_T1), path)
    tables.append_load_control(tables.load_control_rows(
        days.filter(F.col("processing_date") >= cut), "mart_sla_violations", _LOAD_T2), path)
    latest = tables.latest_load_status(spark.read.parquet(path))
    return latest.withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


# ---------------------------------------------------------------------------
# layer tables: SQL over registered layers, clustered fact files
# ---------------------------------------------------------------------------

_LAYER_SQL = """
SELECT segmento, _partition_date, count(*) AS eventos,
       count(CASE WHEN sla_violado THEN 1 END) AS violacoes,
       count(DISTINCT vagao_id) AS vagoes
FROM silver
WHERE status_norm IN ('PARADO', 'MANUTENCAO', 'EM_TRANSITO')
GROUP BY segmento, _partition_date"""


@register("layer_sql", "S5 S7 S11 K1", o.with_ctes(*o.CHAIN_SILVER) + _LAYER_SQL)
def q_layer_sql(spark, sf):
    from freightlake.sources.raw import register_layers
    path = scratch_path(spark, "silver-layer")
    tables.write_table(dm.no_run_clock(dm.silver_events(spark, sf)), path, "_partition_date")
    register_layers(spark, {"silver": path})
    return spark.sql(_LAYER_SQL)


@register("fact_publish", "O2 K1 K7", o.with_ctes(*o.CHAIN_FACT) + f"""
SELECT {o.FACT_OUT} FROM fact""")
def q_fact_publish(spark, sf):
    path = scratch_path(spark, "gold-fact")
    fact = dm.decimals_as_double(dm.no_run_clock(dm.fact_events(spark, sf)))
    tables.write_table(fact, path, "data_particao", sort_cols=gold.FACT_SORT)
    return spark.read.parquet(path)


# One run over all events as one JSON drop, with an explicit schema; twice, so
# that the second run must leave the tables as they are.
def _day_run(spark, sf, times: int = 2):
    from freightlake.plans.daily_run import Layout, run_day
    from freightlake.schemas import events_schema
    drop, layout = scratch_path(spark, "drop-json"), Layout(scratch_path(spark, "lake"))
    dt.raw_events(spark, sf).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(drop)
    for i in range(times):
        run_day(spark, drop, dt.raw_wagons(spark, sf), dt.raw_contracts(spark, sf), layout, dm.AS_OF, dm.NOW, f"run-{i}",
                fmt="json", schema=events_schema(T.LongType()), fail_on_error=False)
    return layout


@register("day_run_fact", "K1 K2 M1 M2 Q8 S10", o.with_ctes(*o.CHAIN_FACT) + f"""
SELECT {o.FACT_OUT} FROM fact""")
def q_day_run_fact(spark, sf):
    layout = _day_run(spark, sf)
    fact = tables.read_table(spark, layout.fact)
    return dm.decimals_as_double(dm.no_run_clock(fact))


_RUN_COUNTS = (_GATE_COUNTS.replace("SELECT _partition_date,", "SELECT CAST(NULL AS DATE) AS _partition_date,")
               .replace("FROM gate GROUP BY 1)", "FROM silver)"))


@register("day_run_alerts", "Q8 Q9 A7", o.with_ctes(*o.CHAIN_SILVER, _RUN_COUNTS, "failures AS (\n" + _gate_failure_rows_sql() + "\n)") + """
SELECT 'run-0' AS run_id, rule, severity, message, threshold, actual FROM failures""")
def q_day_run_alerts(spark, sf):
    alerts = spark.read.parquet(_day_run(spark, sf, 1).alerts)
    rows = F.from_json("payload", "failures array<struct<rule string, severity string, message string, threshold string, actual string>>")
    return alerts.select("run_id", F.explode(rows["failures"]).alias("f")).select("run_id", "f.*")


@register("fact_sorted_files", "O2 K1", o.with_ctes(*o.CHAIN_FACT) + """
SELECT data_particao, count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_order FROM fact GROUP BY 1""")
def q_fact_sorted_files(spark, sf):
    # rows of a file that stand before their predecessor in the sort order
    from pyspark.sql import Window
    path = scratch_path(spark, "gold-fact")
    tables.write_table(dm.fact_events(spark, sf), path, "data_particao", sort_cols=gold.FACT_SORT)
    rows = spark.read.parquet(path).select("data_particao", "status_evento", F.col("_metadata.file_path").alias("f"),
                                           F.col("_metadata.row_index").alias("i"))
    before = F.lag("status_evento").over(Window.partitionBy("f").orderBy("i"))
    wrong = (before > F.col("status_evento")) | (before.isNotNull() & F.col("status_evento").isNull())
    return rows.withColumn("wrong", wrong).groupBy("data_particao").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("wrong").alias("out_of_order"))


@register("layer_day", "S5 S6 K1", o.with_ctes(*o.CHAIN_SILVER) + """
SELECT evento_id, vagao_id, status_norm, sla_violado, _partition_date FROM silver
WHERE _partition_date = DATE '2024-01-15'""")
def q_layer_day(spark, sf):
    from freightlake.sources.raw import read_layer
    path = scratch_path(spark, "silver-layer")
    tables.write_table(dm.silver_events(spark, sf).select("evento_id", "vagao_id", "status_norm", "sla_violado", "_partition_date"),
                       path, "_partition_date")
    return read_layer(spark, path, "2024-01-15")


@register("raw_csv", "S1 S2", """
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer""")
def q_raw_csv(spark, sf):
    from freightlake.sources.raw import read_raw
    path = scratch_path(spark, "csv-drop")  # the path names the format
    dt.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").write.option(
        "header", True).csv(path)
    out = read_raw(spark, path)
    return out.withColumns({c: F.col(c).cast("long") for c in ("c_custkey", "c_nationkey")})


@register("raw_json", "S1 S3", o.with_ctes() + """
SELECT evento_id, vagao_id, status FROM ev""")
def q_raw_json(spark, sf):
    from freightlake.sources.raw import read_raw
    path = scratch_path(spark, "json-drop")
    dt.raw_events(spark, sf).select("evento_id", "vagao_id", "status").write.json(path)
    return read_raw(spark, path, schema="evento_id long, vagao_id long, status string")


@register("landing_complete_days", "K6 S8 S9", o.with_ctes() + """
SELECT evento_id, vagao_id, status, CAST(data_inicio AS DATE) AS date FROM ev
WHERE CAST(data_inicio AS DATE) <> DATE '2024-01-17'""")
def q_landing_complete_days(spark, sf):
    # every day is landed and marked, but one day loses its marker: it is not complete
    from freightlake.sources.raw import read_raw
    path = scratch_path(spark, "landing-json")
    ev = dt.raw_events(spark, sf).select("evento_id", "vagao_id", "status", F.to_date("data_inicio").alias("date"))
    tables.write_landing(ev, path)
    tables.delete_path(spark, f"{tables.partition_dir(path, 'date', '2024-01-17')}/_SUCCESS")
    return read_raw(spark, path, "json", "evento_id long, vagao_id long, status string, date date", require_success=True)


@register("table_statistics", "K8", "SELECT count(*) AS n_rows FROM orders")
def q_table_statistics(spark, sf):
    import uuid
    name, path = f"fl_stats_{uuid.uuid4().hex[:10]}", scratch_path(spark, "orders-table")
    dt.table(spark, sf, "orders").write.parquet(path)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    tables.analyze_table(spark, name)
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Statistics'")
    return info.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("n_rows"))


@register("schema_drift", "V1 V2", """
SELECT 'o_clerk' AS "column", 'missing' AS change, count(*) AS n_rows FROM orders
UNION ALL SELECT 'o_orderdate', 'retyped', count(*) FROM orders
UNION ALL SELECT 'o_orderpriority', 'added', count(*) FROM orders""")
def q_schema_drift(spark, sf):
    # a contract that lacks one column, has one more and another type of a third
    from freightlake.operators.schema_ops import require_columns, schema_drift
    orders = require_columns(dt.table(spark, sf, "orders"), ["o_orderkey", "o_orderdate"])
    known = [f for f in orders.schema.fields if f.name != "o_orderpriority"]
    contract = T.StructType([T.StructField(f.name, T.StringType() if f.name == "o_orderdate" else f.dataType) for f in known]
                            + [T.StructField("o_clerk", T.StringType())])
    n = orders.agg(F.count(F.lit(1)).alias("n_rows"))
    return schema_drift(spark, orders, contract).select("column", "change").join(n)


def _register_streams() -> None:
    import freightlake.streaming.queries  # noqa: F401  (registers the stream queries)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _register_streams()
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    _register_streams()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
