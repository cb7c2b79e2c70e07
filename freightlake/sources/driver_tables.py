"""Domain tables derived from the driver's parquet tables.

The driver ships TPC-H-like tables; the freight domain is mapped onto them with
a fixed, deterministic rule so that Spark and the SQL oracle see the same rows:

* events   -> freight events   (one row per event, end = next event of the user)
* part     -> wagons
* customer -> contracts        (one segment has no SLA)

Every derived table is computed by Spark from the whole input table.  Some
events become boundary rows (``boundary_rows``): NULL and unmatched ids, NULL
status, reversed times and starts months back.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlake.operators.sequence import next_by_day

# Fixed values of the mapping (event type -> raw status text; segment -> SLA hours).
STATUS_BY_EVENT_TYPE = {
    "click": "  em  transito ",
    "view": "parado",
    "purchase": "Chegou",
    "signup": "manutencao",
}
SLA_HOURS_BY_SEGMENT = {"AUTOMOBILE": 4, "BUILDING": 8, "FURNITURE": 12, "HOUSEHOLD": 24}
WAGON_REVISION_DATE = "2023-06-15"
UNMATCHED = 1_000_000_000

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def case_map(col: str, mapping: dict, keep_other: bool):
    """CASE col WHEN k THEN v ... ELSE col (keep_other) or NULL END."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, F.lit(v)) if expr is None
                else expr.when(F.col(col) == k, F.lit(v)))
    return expr.otherwise(F.col(col)) if keep_other else expr


def plain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freight events: evento_id, vagao_id, contrato_id, status, data_inicio,
    data_fim, updated_at."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    ev = next_by_day(ev, "user_id", "ts", "event_id", "data_fim")
    return ev.select(
        F.col("event_id").alias("evento_id"),
        F.col("user_id").alias("vagao_id"),
        F.col("user_id").alias("contrato_id"),
        case_map("event_type", STATUS_BY_EVENT_TYPE, keep_other=True).alias("status"),
        F.col("ts").alias("data_inicio"),
        F.col("data_fim"),
        F.col("ts").alias("updated_at"),
    )


def boundary_rows(events: DataFrame) -> DataFrame:
    """Some events, chosen by id, with NULL or unmatched ids, NULL status, an end
    before the start, or a start 120 days back (error events keep ids and status)."""
    e, known = F.col("evento_id"), F.col("status") != "error"
    old = e % 89 == 7
    back = F.expr("INTERVAL 120 DAYS")
    return events.select(
        F.when(known & (e % 101 == 50), None).otherwise(e).alias("evento_id"),
        F.when(known & (e % 23 == 5), None).when(e % 11 == 3, F.col("vagao_id") + UNMATCHED)
         .otherwise(F.col("vagao_id")).alias("vagao_id"),
        F.when(known & (e % 19 == 4), None).when(e % 13 == 7, F.col("contrato_id") + UNMATCHED)
         .otherwise(F.col("contrato_id")).alias("contrato_id"),
        F.when(known & (e % 37 == 3), None).otherwise(F.col("status")).alias("status"),
        F.when(old, F.col("data_inicio") - back).otherwise(F.col("data_inicio")).alias("data_inicio"),
        F.when(old, F.col("data_fim") - back).when(e % 83 == 9, F.col("data_inicio") - F.expr("INTERVAL 30 MINUTES"))
         .otherwise(F.col("data_fim")).alias("data_fim"),
        "updated_at",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary_rows(plain_events(spark, sf_dir))


def raw_wagons(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("vagao_id"),
        F.col("p_type").alias("tipo_vagao"),
        F.col("p_size").alias("capacidade_ton"),
        (F.lit(1970) + F.col("p_size")).alias("ano_fabricacao"),
        F.col("p_brand").alias("fabricante"),
        F.lit(WAGON_REVISION_DATE).alias("ultima_revisao"),
        (F.col("p_partkey") % 4 != 0).alias("ativo"),
    )


def raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("contrato_id"),
        F.col("c_name").alias("cliente_nome"),
        F.col("c_mktsegment").alias("segmento"),
        case_map("c_mktsegment", SLA_HOURS_BY_SEGMENT, keep_other=False).alias("sla_horas"),
    )


# The same mapping for the SQL oracle (DuckDB), as common table expressions.
ORACLE_CTES = """
pe AS (
  SELECT event_id AS evento_id, user_id AS vagao_id, user_id AS contrato_id,
         CASE event_type WHEN 'click' THEN '  em  transito ' WHEN 'view' THEN 'parado'
              WHEN 'purchase' THEN 'Chegou' WHEN 'signup' THEN 'manutencao'
              ELSE event_type END AS status,
         ts AS data_inicio,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id NULLS LAST) AS data_fim,
         ts AS updated_at
  FROM events),
ev AS (
  SELECT CASE WHEN status <> 'error' AND evento_id % 101 = 50 THEN NULL ELSE evento_id END AS evento_id,
         CASE WHEN status <> 'error' AND evento_id % 23 = 5 THEN NULL
              WHEN evento_id % 11 = 3 THEN vagao_id + 1000000000 ELSE vagao_id END AS vagao_id,
         CASE WHEN status <> 'error' AND evento_id % 19 = 4 THEN NULL
              WHEN evento_id % 13 = 7 THEN contrato_id + 1000000000 ELSE contrato_id END AS contrato_id,
         CASE WHEN status <> 'error' AND evento_id % 37 = 3 THEN NULL ELSE status END AS status,
         CASE WHEN evento_id % 89 = 7 THEN data_inicio - INTERVAL 120 DAY ELSE data_inicio END AS data_inicio,
         CASE WHEN evento_id % 89 = 7 THEN data_fim - INTERVAL 120 DAY
              WHEN evento_id % 83 = 9 THEN data_inicio - INTERVAL 30 MINUTE ELSE data_fim END AS data_fim,
         updated_at
  FROM pe),
wagons AS (
  SELECT p_partkey AS vagao_id, p_type AS tipo_vagao, p_size AS capacidade_ton,
         1970 + p_size AS ano_fabricacao, p_brand AS fabricante,
         '2023-06-15' AS ultima_revisao, p_partkey % 4 <> 0 AS ativo
  FROM part),
contracts AS (
  SELECT c_custkey AS contrato_id, c_name AS cliente_nome, c_mktsegment AS segmento,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 4 WHEN 'BUILDING' THEN 8
              WHEN 'FURNITURE' THEN 12 WHEN 'HOUSEHOLD' THEN 24 END AS sla_horas
  FROM customer)
"""
