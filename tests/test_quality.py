"""One-pass gate (A7, Q1-Q9), column tests (Q10-Q14, J7), freshness, alarms."""

import json

import pytest

from freightlake.operators import checks, metrics, quality
from freightlake.operators.checks import ColumnTest

SCHEMA = "evento_id string, vagao_id string, status_norm string, data_inicio timestamp, data_fim timestamp"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ok_row(i, status="PARADO"):
    from datetime import datetime
    return (f"e{i}", "w", status, datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 1, 0))


def failures(spark, rows, **kw):
    counts = quality.gate_counts(frame(spark, rows))
    return {r["rule"]: r for r in quality.gate_failures(counts, min_rows=kw.get("min_rows", 0)).collect()}


def test_empty_input_only_critical(spark):
    got = failures(spark, [], min_rows=10)
    assert list(got) == ["NonEmptyTable"] and got["NonEmptyTable"]["severity"] == "CRITICAL"


def test_null_share_exactly_one_percent_passes(spark):
    rows = [ok_row(i) for i in range(99)] + [(None, "w", "PARADO", None, None)]
    got = failures(spark, rows)
    assert "Completeness_evento_id" not in got  # 1.00% is not > 1%
    rows = [ok_row(i) for i in range(98)] + [(None, "w", "PARADO", None, None)] * 2
    got = failures(spark, rows)
    assert got["Completeness_evento_id"]["actual"] == "2.00%"
    assert got["Completeness_data_inicio"]["severity"] == "ERROR"


def test_uniqueness_counts_null_as_one_key(spark):
    rows = [ok_row(1), ok_row(1), (None, "w", "PARADO", None, None), (None, "w", "PARADO", None, None)]
    rows += [ok_row(i) for i in range(2, 300)]
    got = failures(spark, rows)
    assert got["Uniqueness_evento_id"]["actual"] == "2"


def test_invalid_share_threshold_and_null_status(spark):
    rows = [ok_row(i) for i in range(199)] + [ok_row(999, "ERROR")]  # exactly 0.5%
    assert "ValidValues_status_norm" not in failures(spark, rows)
    rows = [ok_row(i) for i in range(198)] + [ok_row(998, "ERROR"), ok_row(999, None)]
    got = failures(spark, rows)  # NULL is not invalid: still 0.5%
    assert "ValidValues_status_norm" not in got
    rows = [ok_row(i) for i in range(198)] + [ok_row(998, "ERROR"), ok_row(999, "X")]
    assert failures(spark, rows)["ValidValues_status_norm"]["actual"] == "1.00%"


def test_temporal_and_volume(spark):
    from datetime import datetime
    bad = ("e-x", "w", "PARADO", datetime(2024, 1, 2), datetime(2024, 1, 1))
    open_ = ("e-y", "w", "PARADO", datetime(2024, 1, 2), None)
    got = failures(spark, [ok_row(1), bad, open_], min_rows=500_000)
    assert got["TemporalConsistency"]["actual"] == "1"
    assert got["MinimumVolumeCheck"]["threshold"] == ">= 500,000"
    assert got["MinimumVolumeCheck"]["severity"] == "WARNING"


def test_gate_raises_only_on_blocking(spark):
    counts = quality.gate_counts(frame(spark, [ok_row(1)]))
    warn_only = quality.gate_failures(counts, min_rows=10)
    assert [f["rule"] for f in quality.gate(warn_only)] == ["MinimumVolumeCheck"]
    empty = quality.gate_failures(quality.gate_counts(frame(spark, [])))
    with pytest.raises(quality.QualityGateError):
        quality.gate(empty)
    assert len(quality.gate(empty, fail_on_error=False)) == 1


def test_gate_is_one_aggregate_per_group(spark):
    rows = [ok_row(i) for i in range(10)]
    counts = quality.gate_counts(frame(spark, rows), by=["vagao_id"])
    assert counts.count() == 1 and counts.collect()[0]["total"] == 10


def test_alert_payload_json(spark):
    counts = quality.gate_counts(frame(spark, [ok_row(1)]))
    f = quality.gate_failures(counts, min_rows=10)
    payload = json.loads(quality.alert_payload(f, "silver.t", "2024-01-01", "2024-01-02T00:00:00").collect()[0][0])
    assert payload["alert_type"] == "DATA_QUALITY_FAILURE"
    assert payload["failures"][0]["rule"] == "MinimumVolumeCheck"


def test_column_tests_semantics(spark):
    df = spark.createDataFrame([(1, "A", 5.0), (1, "B", None), (2, "Z", 500.0), (3, "Z", -1.0),
                                (None, None, 3.0), (4, "Y", 7.0)], "k int, s string, x double")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    res = checks.run_column_tests("m", df, [
        ColumnTest("k", "not_null"), ColumnTest("k", "unique"),
        ColumnTest("s", "accepted_values", values=["A", "B"]),
        ColumnTest("x", "between", min_value=0, max_value=100),
        ColumnTest("x", "between", min_value=0, max_value=100, row_condition="s = 'Z'"),
        ColumnTest("k", "relationships", to=parent, to_field="k"),
    ])
    got = [(r["test_name"], r["failures"]) for r in res.collect()]
    assert ("not_null", 1) in got
    assert ("unique", 1) in got            # one repeated value (1)
    assert ("accepted_values", 2) in got   # distinct unexpected values Z, Y; NULL passes
    assert ("between", 2) in got           # 500 and -1; NULL passes
    assert got.count(("between", 2)) == 2  # both rows have s = 'Z'
    assert ("relationships", 2) in got     # 3 and 4 have no parent; NULL ignored


def test_orphans_left_anti(spark):
    child = spark.createDataFrame([(1,), (5,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert [r["k"] for r in checks.orphans(child, "k", parent, "k").collect()] == [5]


def test_freshness_levels(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string")
    status = lambda now: checks.freshness(df, "t", now, "s").collect()[0]["status"]
    assert status("2024-01-01 12:00:00") == "pass"
    assert status("2024-01-01 12:00:01") == "warn"
    assert status("2024-01-02 01:00:01") == "error"


def test_metric_alarms(spark):
    m = metrics.metric_rows(spark, {"JobFailure": 0, "DuplicatesRemoved": 50001, "Other": 9}, "d", "2024-01-01 00:00:00")
    got = {r["metric"]: r["alarm"] for r in metrics.alarms(m, metrics.alarm_rules(spark), how="left").collect()}
    assert got == {"JobFailure": False, "DuplicatesRemoved": True, "Other": False}
