"""Dimensions: wagon (D1), contract (D2), calendar (D3).

Surrogate keys are a pure function of the natural key (first 60 bits of the
MD5 of its text), so they are stable across runs and need no global sort,
no shuffle and no sequence state.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.schemas import SURROGATE_NULL

CALENDAR_START = "2020-01-01"  # project start date (fixed value of the source config)


def hash_key(col) -> Column:
    """Deterministic positive BIGINT key from a natural key."""
    c = F.col(col) if isinstance(col, str) else col
    text = F.coalesce(c.cast("string"), F.lit(SURROGATE_NULL))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def wagon_dim(stg_wagons: DataFrame) -> DataFrame:
    """D1 (SCD type 1): active wagons from staging with ``vagao_sk``."""
    return stg_wagons.select(hash_key("vagao_id").alias("vagao_sk"), *stg_wagons.columns)


def contract_dim(contracts: DataFrame) -> DataFrame:
    """Contracts with ``contrato_sk``."""
    return contracts.select(hash_key("contrato_id").alias("contrato_sk"), *contracts.columns)


def date_key(col) -> Column:
    """``data_sk``: the date as a yyyymmdd INT."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyyMMdd").cast("int")


def calendar_dim(dates: DataFrame, date_col: str, start: str | _dt.date = CALENDAR_START) -> DataFrame:
    """D3: one row per day from ``start`` to the last date in ``dates``.

    Bounds come from one aggregate over the data; the days are generated by
    ``sequence`` + ``explode`` (rows = days in range, a few thousand at most).
    """
    bounds = dates.agg(F.max(F.col(date_col).cast("date")).alias("_end"))
    days = bounds.select(F.explode(F.sequence(
        F.lit(str(start)).cast("date"), F.col("_end"), F.expr("INTERVAL 1 DAY"))).alias("data_completa"))
    return days.select(
        "data_completa",
        date_key("data_completa").alias("data_sk"),
        F.year("data_completa").alias("ano"),
        F.month("data_completa").alias("mes"),
        F.dayofmonth("data_completa").alias("dia"),
        F.dayofweek("data_completa").alias("dia_semana"),
    )
