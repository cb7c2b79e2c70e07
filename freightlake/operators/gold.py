"""Staging views, the event fact and the SLA marts (gold).

P5-P7 staging, J3-J5 + P8-P12 + P16 fact, P13/K9 incremental fact,
A1-A6 + P14 daily SLA summary, W2-W3 client ranking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlake.functions.expressions import (
    critical_stop,
    duration_hours,
    lookback,
    pct_sla_used,
    round_half_up,
    surrogate_key,
    ts_literal,
    unknown_member,
)
from freightlake.operators.dims import CALENDAR_START, date_key
from freightlake.operators.upsert import merge_upsert

FACT_SORT = ["data_particao", "status_evento"]
MART_KEYS = ["data_particao", "cliente_nome", "segmento", "tipo_vagao"]


def _opt(df: DataFrame, name: str, typ: str):
    return (F.col(name) if name in df.columns else F.lit(None)).cast(typ)


def stg_events(silver: DataFrame) -> DataFrame:
    """P5 + P6: renamed and typed events; open events kept, reversed ones dropped."""
    keep = (F.col("evento_id").isNotNull() & F.col("data_inicio").isNotNull()
            & (F.col("data_fim").isNull() | (F.col("data_fim") >= F.col("data_inicio"))))
    return silver.filter(keep).select(
        "evento_id", "vagao_id", "contrato_id",
        F.col("status_norm").alias("status_evento"),
        F.col("data_inicio").cast("timestamp_ntz").alias("iniciado_em"),
        F.col("data_fim").cast("timestamp_ntz").alias("finalizado_em"),
        F.col("duracao_minutos").try_cast("decimal(10,2)").alias("duracao_minutos"),
        "tipo_vagao",
        F.col("capacidade_ton").try_cast("decimal(10,2)").alias("capacidade_ton"),
        F.col("ano_fabricacao").try_cast("int").alias("vagao_ano_fabricacao"),
        "cliente_nome",
        F.col("sla_horas").try_cast("decimal(6,2)").alias("sla_horas_contrato"),
        "segmento",
        F.col("sla_violado").cast("boolean").alias("sla_violado"),
        F.col("_partition_date").alias("data_particao"),
        _opt(silver, "_ingested_at", "timestamp").alias("ingerido_em"),
        _opt(silver, "_silver_processed_at", "timestamp").alias("processado_em"),
    )


def stg_wagons(wagons: DataFrame) -> DataFrame:
    """Typed active wagons (a NULL ``ativo`` is not active)."""
    return wagons.filter(F.col("vagao_id").isNotNull() & (F.col("ativo") == F.lit(True))).select(
        "vagao_id", "tipo_vagao",
        F.col("capacidade_ton").try_cast("decimal(10,2)").alias("capacidade_ton"),
        F.col("ano_fabricacao").try_cast("int").alias("ano_fabricacao"),
        "fabricante",
        F.try_to_date(F.col("ultima_revisao").cast("string")).alias("data_ultima_revisao"),
        "ativo",
        _opt(wagons, "_ingested_at", "timestamp").alias("atualizado_em"),
    )


def build_fact(stg: DataFrame, wagon_dim: DataFrame, contract_dim: DataFrame, now,
               calendar: DataFrame | None = None, calendar_start: str = CALENDAR_START,
               existing: DataFrame | None = None, as_of=None, lookback_days: int = 3) -> DataFrame:
    """J3-J5, P8-P12, P16; K9/P13/M3 when ``existing`` is given.

    ``existing=None`` builds the whole fact.  Otherwise only events of the
    last ``lookback_days`` before ``as_of`` are rebuilt and merged into
    ``existing`` by ``evento_id`` (matches replaced).

    ``calendar=None`` computes ``data_sk`` directly: the calendar dimension
    holds every day from ``calendar_start`` on, and its key is the date as
    yyyymmdd, so the lookup needs no join.  Pass a calendar to join it instead.
    """
    ev = stg
    if existing is not None:
        if as_of is None:
            raise ValueError("incremental build needs as_of")
        first_day = F.date_sub(F.lit(str(as_of)).cast("date"), lookback_days)
        # The second conjunct is implied by the first (the partition date is the
        # start's date) but is on the raw timestamp, so it reaches the Parquet
        # scan as a pushed filter and row groups of older events are skipped.
        ev = ev.filter(lookback("data_particao", as_of, lookback_days)
                       & (F.col("iniciado_em") >= first_day.cast("timestamp_ntz")))
    df = (ev.join(wagon_dim.select("vagao_id", "vagao_sk"), "vagao_id", "left")
            .join(contract_dim.select("contrato_id", "contrato_sk"), "contrato_id", "left"))
    if calendar is None:
        data_sk = F.when(F.col("data_particao") >= F.lit(calendar_start).cast("date"),
                         date_key("data_particao"))
    else:
        cal = calendar.select(F.col("data_completa").alias("_cal_date"), F.col("data_sk").alias("_cal_sk"))
        df = df.join(cal, F.col("data_particao") == F.col("_cal_date"), "left")
        data_sk = F.col("_cal_sk")
    dur = F.col("duracao_minutos").cast("double")
    sla = F.col("sla_horas_contrato").cast("double")
    fact = df.select(
        surrogate_key("evento_id").alias("evento_sk"),
        "evento_id",
        unknown_member("vagao_sk").alias("vagao_sk"),
        unknown_member("contrato_sk").alias("contrato_sk"),
        unknown_member(data_sk).cast("int").alias("data_sk"),
        "status_evento", "iniciado_em", "finalizado_em", "duracao_minutos",
        duration_hours(dur).alias("duracao_horas"),
        pct_sla_used(dur, sla).alias("pct_sla_utilizado"),
        "sla_violado",
        critical_stop("status_evento", dur).alias("parada_critica"),
        "cliente_nome", "segmento", "tipo_vagao", "capacidade_ton", "sla_horas_contrato",
        "data_particao", "ingerido_em", "processado_em",
        ts_literal(now).alias("dbt_updated_at"),
    )
    if existing is not None:
        fact = merge_upsert(existing, fact, "evento_id", newer=None)
    return fact


def sla_daily(fact: DataFrame, as_of=None, lookback_days: int = 90) -> DataFrame:
    """A1-A6 (+P14): per day, client, segment and wagon type.

    Averages are exact decimal sums over non-NULL counts, rounded half up, so
    the result does not depend on the order rows are added in.
    """
    f = fact if as_of is None else fact.filter(lookback("data_particao", as_of, lookback_days))
    n = F.count(F.lit(1))
    viol = F.count_if(F.col("sla_violado"))
    pct_dec = F.col("pct_sla_utilizado").try_cast("decimal(12,2)")
    return f.groupBy(*MART_KEYS).agg(
        n.alias("total_eventos"),
        viol.alias("total_violacoes"),
        F.count_if(F.col("parada_critica")).alias("paradas_criticas"),
        round_half_up(F.try_divide(F.sum("duracao_minutos").cast("double"),
                                   F.count("duracao_minutos")), 2).alias("duracao_media_min"),
        round_half_up(F.try_divide(F.sum(pct_dec).cast("double"),
                                   F.count(pct_dec)), 2).alias("pct_sla_medio"),
        F.max("pct_sla_utilizado").alias("pct_sla_maximo"),
        round_half_up(F.try_divide(viol.cast("double") * F.lit(100.0), n), 2).alias("taxa_violacao_pct"),
    )


def sla_mart(daily: DataFrame) -> DataFrame:
    """W2 + W3: client total over the period and the global position by it.

    Rows are ordered by client total, client and mart key, so all rows of a
    client are neighbours: the position is the number of rows of the clients
    before it (a running sum over one row for each client) plus the place among
    the client's own rows.
    """
    totals = daily.groupBy(F.col("cliente_nome").alias("_client")).agg(
        F.sum("total_violacoes").alias("total_violacoes_cliente_periodo"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.col("total_violacoes_cliente_periodo").desc_nulls_last(),
                            F.col("_client").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy("cliente_nome").orderBy(
        *[F.col(c).asc_nulls_last() for c in ("data_particao", "segmento", "tipo_vagao")])
    ranked = daily.withColumn("_place", F.row_number().over(own))
    return (ranked.join(offsets, F.col("cliente_nome").eqNullSafe(F.col("_client")))
            .withColumn("total_violacoes_desc", F.col("_before") + F.col("_place"))
            .drop("_client", "_before", "_place"))
