"""Bronze -> silver: normalise, measure, enrich with wagon and contract, flag SLA.

Join strategy is left to Catalyst + AQE: a dimension is broadcast only when its
measured runtime size is under ``spark.sql.autoBroadcastJoinThreshold``; above
that the join is a sort-merge join, and AQE splits a skewed event partition
(a hot wagon or contract key) across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.functions.expressions import (
    duration_minutes,
    sla_violated,
    status_norm,
    to_day,
    ts_literal,
)

WAGON_COLUMNS = ["vagao_id", "tipo_vagao", "capacidade_ton", "ano_fabricacao"]
CONTRACT_COLUMNS = ["contrato_id", "cliente_nome", "sla_horas", "segmento"]


def normalise_events(events: DataFrame) -> DataFrame:
    """P1 + P2: ``status_norm`` and ``duracao_minutos``."""
    return events.withColumns({
        "status_norm": status_norm("status"),
        "duracao_minutos": duration_minutes("data_inicio", "data_fim"),
    })


def enrich_events(events: DataFrame, wagons: DataFrame, contracts: DataFrame,
                  default_sla_hours: float | None = None) -> DataFrame:
    """J1, J2, P3, P4 without the run metadata.

    The NULL-key filter (P4) runs before the joins: rows it drops would only
    be dropped later, so the result is the same and the joins see fewer rows.
    Duplicate dimension keys fan out, as a left join does.
    """
    df = normalise_events(events).filter(F.col("evento_id").isNotNull())
    df = df.join(wagons.select(*WAGON_COLUMNS), on="vagao_id", how="left")
    df = df.join(contracts.select(*CONTRACT_COLUMNS), on="contrato_id", how="left")
    return df.withColumn("sla_violado",
                         sla_violated("duracao_minutos", "sla_horas", default_sla_hours))


def silver_metadata(df: DataFrame, now) -> DataFrame:
    """V5: processing instant (a parameter) and the start-date partition."""
    return df.withColumns({
        "_silver_processed_at": ts_literal(now),
        "_partition_date": to_day("data_inicio"),
    })


def transform_silver(events: DataFrame, wagons: DataFrame, contracts: DataFrame, now,
                     default_sla_hours: float | None = None) -> DataFrame:
    """The whole bronze -> silver event transform."""
    return silver_metadata(enrich_events(events, wagons, contracts, default_sla_hours), now)


def sla_rate_by_client(silver: DataFrame) -> DataFrame:
    """Flagship: SLA violation rate per client (A2, A3, A6 over J2 + P3)."""
    from freightlake.functions.expressions import round_half_up

    n = F.count(F.lit(1))
    viol = F.count_if(F.col("sla_violado"))
    return silver.groupBy("cliente_nome").agg(
        n.alias("total_eventos"),
        viol.alias("total_violacoes"),
        round_half_up(viol.cast("double") * F.lit(100.0) / n, 2).alias("taxa_violacao_pct"),
    )
