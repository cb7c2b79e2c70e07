"""Scalar expressions: boundary rows (NULLs, ties, exact thresholds)."""

import hashlib

from pyspark.sql import functions as F

from freightlake.functions import (
    critical_stop,
    duration_hours,
    duration_minutes,
    invalid_status,
    lookback,
    mask_hash,
    mask_text,
    pct_sla_used,
    round_half_up,
    sla_violated,
    status_norm,
    surrogate_key,
)


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_status_normalisation(spark):
    got = one(spark, status_norm("s"), [("  em   transito ",), ("parado\t",), (None,), ("Chegou",)], "s string")
    # trim strips spaces only: a trailing tab becomes a trailing underscore
    assert got == ["EM_TRANSITO", "PARADO_", None, "CHEGOU"]


def test_duration_whole_seconds_and_nulls(spark):
    data = [("2024-01-01 00:00:00.9", "2024-01-01 00:01:00.1"),  # 59.2 s real, 60 s truncated
            ("2024-01-01 00:00:00", None),
            ("2024-01-01 01:00:00", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(data, "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    got = [r[0] for r in df.select(duration_minutes("a", "b")).collect()]
    assert got == [1.0, None, -60.0]


def test_sla_violation_strict_and_null_false(spark):
    data = [(240.0, 4), (240.01, 4), (None, 4), (500.0, None), (1.0, 0)]
    got = one(spark, sla_violated("d", "s"), data, "d double, s int")
    assert got == [False, True, False, False, True]
    # optional default SLA for contracts without one
    got = one(spark, sla_violated("d", "s", 8), data, "d double, s int")
    assert got == [False, True, False, True, True]


def test_duration_hours_threshold(spark):
    got = one(spark, duration_hours("d"), [(59.99,), (60.0,), (60.3,), (None,)], "d double")
    assert got == [None, 1.0, 1.01, None]


def test_pct_sla_guard_and_rounding(spark):
    got = one(spark, pct_sla_used("d", "s"), [(0.06, 4.0), (120.0, 0.0), (120.0, None), (240.0, 4.0)],
              "d double, s double")
    assert got == [0.03, None, None, 100.0]


def test_critical_stop(spark):
    data = [("PARADO", 121.0), ("PARADO", 120.0), ("MANUTENCAO", 500.0), ("EM_TRANSITO", 999.0),
            (None, 999.0), ("PARADO", None)]
    assert one(spark, critical_stop("s", "d"), data, "s string, d double") == [True, False, True, False, False, False]


def test_invalid_status_null_neither(spark):
    got = one(spark, invalid_status("s"), [("PARADO",), ("ERROR",), (None,)], "s string")
    assert got == [False, True, None]


def test_round_half_up_is_decimal_based(spark):
    got = one(spark, round_half_up("x", 2), [(1.005,), (-1.005,), (2.675,), (0.125,)], "x double")
    assert got == [1.01, -1.01, 2.68, 0.13]


def test_surrogate_key_md5_with_null_token(spark):
    got = one(spark, surrogate_key("k"), [(7,), (None,)], "k long")
    assert got[0] == hashlib.md5(b"7").hexdigest()
    assert got[1] == hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()
    two = one(spark, surrogate_key("a", "b"), [(1, None)], "a long, b long")[0]
    assert two == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()


def test_lookback_inclusive(spark):
    import datetime as dt
    got = one(spark, lookback("d", "2024-01-30", 3),
              [(dt.date(2024, 1, 26),), (dt.date(2024, 1, 27),), (dt.date(2024, 1, 30),)], "d date")
    assert got == [False, True, True]


def test_masking(spark):
    assert one(spark, mask_text("s"), [("Ab#12",)], "s string") == ["Xx#nn"]
    assert one(spark, mask_hash("s"), [("abc",)], "s string") == [hashlib.sha256(b"abc").hexdigest()]


def test_malformed_text_times_give_null_not_failure(spark):
    from freightlake.operators.schema_ops import add_audit
    df = spark.createDataFrame([("2024-01-15 10:00:00", "2024-01-15 11:00:00"), ("abc", "2024-01-15 11:00:00")],
                               "a string, b string")
    assert [r[0] for r in df.select(duration_minutes("a", "b")).collect()] == [60.0, None]
    out = add_audit(df, "d", "a", "r", "2024-01-16 00:00:00").select("_partition_date").collect()
    assert [str(r[0]) if r[0] else None for r in out] == ["2024-01-15", None]
