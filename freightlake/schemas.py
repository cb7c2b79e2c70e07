"""Explicit schemas of the domain tables (no inference in production reads)."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must match the source system.
VALID_STATUSES = ["EM_TRANSITO", "PARADO", "CHEGOU", "SAIU", "MANUTENCAO", "CARREGANDO", "DESCARREGANDO"]
CRITICAL_STOP_STATUSES = ["PARADO", "MANUTENCAO"]
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
CRITICAL_COLUMNS = ["evento_id", "vagao_id", "status_norm", "data_inicio"]


def events_schema(ids: T.DataType = T.StringType()) -> T.StructType:
    """The events contract.  Ids are text (like ``evt_001``); sources with
    numeric ids pass their type."""
    return T.StructType([
        T.StructField("evento_id", ids),
        T.StructField("vagao_id", ids),
        T.StructField("contrato_id", ids),
        T.StructField("status", T.StringType()),
        T.StructField("data_inicio", T.TimestampNTZType()),
        T.StructField("data_fim", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ])


def wagons_schema(ids: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("vagao_id", ids),
        T.StructField("tipo_vagao", T.StringType()),
        T.StructField("capacidade_ton", T.IntegerType()),
        T.StructField("ano_fabricacao", T.IntegerType()),
        T.StructField("fabricante", T.StringType()),
        T.StructField("ultima_revisao", T.StringType()),
        T.StructField("ativo", T.BooleanType()),
    ])


def contracts_schema(ids: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("contrato_id", ids),
        T.StructField("cliente_nome", T.StringType()),
        T.StructField("segmento", T.StringType()),
        T.StructField("sla_horas", T.IntegerType()),
    ])


EVENTS, WAGONS, CONTRACTS = events_schema(), wagons_schema(), contracts_schema()

AUDIT = T.StructType([
    T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_source_domain", T.StringType()),
    T.StructField("_partition_date", T.DateType()),
    T.StructField("_job_run_id", T.StringType()),
])

GATE_FAILURE = T.StructType([
    T.StructField("rule", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("threshold", T.StringType()),
    T.StructField("actual", T.StringType()),
])

METRIC = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

LOAD_CONTROL = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("processing_date", T.DateType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
])
