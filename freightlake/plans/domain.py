"""Domain layer builders over the driver tables (bronze -> silver -> gold).

Run parameters are fixed here so that every registered query is
deterministic: the run clock, the as-of date and the run id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlake.operators import dims, gold
from freightlake.operators.enrich import transform_silver
from freightlake.operators.schema_ops import add_audit
from freightlake.sources import driver_tables as dt

# Fixed run parameters of the registered queries.
NOW = "2024-01-31 06:00:00"
AS_OF = "2024-01-31"
RUN_ID = "bronze_eventos"
DOMAIN = "eventos_ferroviarios"


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_audit(
        dt.raw_events(spark, sf_dir), DOMAIN, "updated_at", RUN_ID, NOW)


def silver_events(spark: SparkSession, sf_dir: str, now: str = NOW) -> DataFrame:
    return transform_silver(
        bronze_events(spark, sf_dir), dt.raw_wagons(spark, sf_dir), dt.raw_contracts(spark, sf_dir), now)


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stg_events(silver_events(spark, sf_dir))


def staged_wagons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stg_wagons(dt.raw_wagons(spark, sf_dir))


def wagon_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.wagon_dim(staged_wagons(spark, sf_dir))


def contract_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.contract_dim(dt.raw_contracts(spark, sf_dir))


def fact_events(spark: SparkSession, sf_dir: str, now: str = NOW) -> DataFrame:
    return gold.build_fact(
        staged_events(spark, sf_dir), wagon_dim(spark, sf_dir), contract_dim(spark, sf_dir), now)


def sla_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.sla_daily(
        fact_events(spark, sf_dir), as_of=AS_OF, lookback_days=90)


def gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows as a faulty run would leave them: NULL and repeated ids, NULL
    starts (chosen by id)."""
    e = F.col("evento_id")
    return silver_events(spark, sf_dir).withColumns({
        "data_inicio": F.when(e % 61 == 5, None).otherwise(F.col("data_inicio")),
        "evento_id": F.when(e % 53 == 8, None).when(e % 97 == 42, e - 1).otherwise(e)})


def no_run_clock(df: DataFrame) -> DataFrame:
    """Drop run-instant columns (they carry the wall clock, not data)."""
    return df.drop("ingerido_em", "processado_em", "dbt_updated_at", "atualizado_em",
                   "_silver_processed_at", "_ingested_at")


def decimals_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("double")
                           for f in df.schema.fields if f.dataType.typeName() == "decimal"})
