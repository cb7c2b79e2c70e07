"""Bronze ingest: dedup, required columns, audit columns, landing, readers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from freightlake.operators.dedup import dedup_stats, latest_per_key
from freightlake.operators.schema_ops import (
    SchemaValidationError,
    add_audit,
    evolve_union,
    missing_columns,
    require_columns,
    schema_drift,
)
from freightlake.plans.tables import write_landing
from freightlake.schemas import EVENTS
from freightlake.sources.raw import complete_day_dirs, format_for_path, read_raw

COLS = ["evento_id", "updated_at", "status"]
#: One batch with every case: a key seen once, a key whose newest row is in the
#: middle, an exact repeat, a NULL watermark and two NULL keys.
BATCH = [
    ("north-1", "2025-03-02 04:10:00", "SAIU"),
    ("north-2", "2025-03-01 09:00:00", "SAIU"), ("north-2", "2025-03-03 09:00:00", "CHEGOU"),
    ("north-2", "2025-03-02 09:00:00", "PARADO"),
    ("south-9", "2025-03-05 23:59:59", "PARADO"), ("south-9", "2025-03-05 23:59:59", "PARADO"),
    ("east-4", None, "SAIU"), ("east-4", "2025-02-28 00:00:00", "CARREGANDO"),
    (None, "2025-03-04 01:00:00", "SAIU"), (None, "2025-03-04 02:00:00", "CHEGOU"),
]
KEPT = {("north-1", "SAIU"), ("north-2", "CHEGOU"), ("south-9", "PARADO"), ("east-4", "CARREGANDO"), (None, "CHEGOU")}


def test_newest_row_of_each_key_stays(spark):
    kept = latest_per_key(spark.createDataFrame(BATCH, COLS), "evento_id", "updated_at")
    rows = [(r["evento_id"], r["status"]) for r in kept.collect()]
    assert len(rows) == len(KEPT) and set(rows) == KEPT


def test_required_columns_are_checked_before_any_job(spark):
    df = spark.createDataFrame(BATCH, COLS)
    assert require_columns(df, COLS) is df
    assert missing_columns(df, ["status", "run", "evento_id", "origin"]) == ["run", "origin"]
    with pytest.raises(SchemaValidationError) as e:
        require_columns(df, ["status", "run", "origin"])
    assert e.value.missing == ["run", "origin"]


def test_audit_columns_follow_the_watermark(spark):
    out = add_audit(spark.createDataFrame([*BATCH, ("odd", "not a time", "SAIU")], COLS), "wagons", "updated_at",
                    "nightly-7", "2025-03-06 02:00:00")
    for r in out.collect():
        day = None if r["updated_at"] in (None, "not a time") else r["updated_at"][:10]
        assert (None if r["_partition_date"] is None else str(r["_partition_date"])) == day
        assert (r["_source_domain"], r["_job_run_id"], str(r["_ingested_at"])) == ("wagons", "nightly-7", "2025-03-06 02:00:00")


def test_landing_keeps_records_and_marks_days_last(spark, tmp_path):
    root = str(tmp_path / "partners")
    given = {7: ("São João", "2025-03-01"), 8: ("Łódź", "2025-03-01"), 9: ("Zürich", "2025-03-04")}
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in given.items()], "id int, nome string, date string")
    out = write_landing(df, root, "date")
    assert (out["rows"], out["days"]) == (3, ["2025-03-01", "2025-03-04"])
    found = {}
    for day in out["days"]:
        folder = os.path.join(root, f"date={day}")
        assert os.path.exists(os.path.join(folder, "_SUCCESS"))
        for f in os.listdir(folder):
            if f.endswith(".json"):
                with open(os.path.join(folder, f), encoding="utf-8") as fh:
                    found |= {r["id"]: (r["nome"], day) for r in map(json.loads, filter(str.strip, fh))}
    assert found == given
    os.remove(os.path.join(root, "date=2025-03-04", "_SUCCESS"))  # a day that is not complete is not read
    assert [d.rsplit("=", 1)[1] for d in complete_day_dirs(spark, root)] == ["2025-03-01"]
    got = read_raw(spark, root, fmt="json", require_success=True)
    assert sorted(r["id"] for r in got.collect()) == [7, 8] and "date" in got.columns


def test_tie_breaks_make_choice_deterministic(spark):
    df = spark.createDataFrame([("k", "t", "A"), ("k", "t", "C"), ("k", "t", "B")], COLS)
    row = latest_per_key(df, "evento_id", "updated_at", ["status"]).collect()[0]
    assert row["status"] == "C"


def test_dedup_plans_group_limit_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("wm"))
    plan = latest_per_key(df, "k", "wm")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_distinct_keys_count_null_as_one(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    row = dedup_stats(df, "k").collect()[0]
    assert (row["records_read"], row["distinct_keys"], row["duplicates_removed"]) == (3, 2, 1)


def test_format_rule_csv_first():
    assert format_for_path("s3://raw/json_exports/csv/x") == "csv"
    assert format_for_path("/raw/eventos/JSON/2024") == "json"
    assert format_for_path("/raw/eventos/") == "parquet"


def test_read_raw_by_format(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    df.write.option("header", True).csv(str(tmp_path / "drop_csv"))
    df.write.json(str(tmp_path / "drop_json"))
    df.write.parquet(str(tmp_path / "drop_parquet"))
    for name in ("drop_csv", "drop_json", "drop_parquet"):
        got = read_raw(spark, str(tmp_path / name))
        assert sorted((int(r["id"]), r["v"]) for r in got.collect()) == [(1, "a"), (2, "b")]


def test_json_line_mode_is_default(spark, tmp_path):
    p = tmp_path / "json_lines"
    p.mkdir()
    (p / "a.json").write_text('{"id": 1}\n{"id": 2}\n{"id": 3}\n')
    assert read_raw(spark, str(p)).count() == 3
    assert read_raw(spark, str(p), multiline=True).count() == 1


def test_schema_drift_report(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "evento_id int, status string, extra double")
    rep = {(r["column"], r["change"]) for r in schema_drift(spark, df, EVENTS).collect()}
    assert ("evento_id", "retyped") in rep
    assert ("extra", "added") in rep
    assert ("data_inicio", "missing") in rep


def test_append_new_columns(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, "b", 9)], "id int, v string, w int")
    rows = sorted(evolve_union(old, new).collect(), key=lambda r: r["id"])
    assert rows[0]["w"] is None and rows[1]["w"] == 9


def test_landing_marks_empty_day_complete(spark, tmp_path):
    root = str(tmp_path / "landing_empty")
    df = spark.createDataFrame([(1, "2024-01-15")], "id int, date string")
    out = write_landing(df, root, "date", days=["2024-01-15", "2024-01-16"])  # the 16th had no rows
    assert out["rows"] == 1
    assert os.path.exists(os.path.join(root, "date=2024-01-16", "_SUCCESS"))
    days = [d.rsplit("=", 1)[1] for d in complete_day_dirs(spark, root)]
    assert days == ["2024-01-15", "2024-01-16"]
    got = read_raw(spark, root, fmt="json", schema="id int", require_success=True)
    assert [r["id"] for r in got.collect()] == [1]
