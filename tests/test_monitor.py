"""Counters and alarms from the progress events of streams; batches bounded by size."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from freightlake.operators import metrics
from freightlake.operators.schema_ops import require_columns
from freightlake.streaming import monitor as mon
from freightlake.streaming import streams as st

SCHEMA = "id long, ts timestamp"


def _write(spark, path, rows):
    spark.createDataFrame(rows, "id long, ts string").withColumn("ts", F.col("ts").cast("timestamp")) \
        .coalesce(1).write.mode("append").parquet(path)


def _values(spark, path, now="2024-01-01 06:00:00"):
    return {(r.domain, r.metric): r.value for r in mon.stream_metrics(spark, path, now).collect()}


def test_counters_over_batches_and_restarts(spark, tmp_path):
    src, found, out, ckpt = (str(tmp_path / n) for n in ("src", "found", "out", "ckpt"))

    def run():
        raw = mon.counted(st.file_stream(spark, src, SCHEMA, max_files_per_trigger=1), "d", "ts", RawRecordsRead=F.count(F.lit(1)))
        kept = mon.counted(st.dedup_stream(raw, ["id"], "ts", "1 hour"), "d", BronzeRecordsWritten=F.count(F.lit(1)))
        writer = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
        with mon.StreamMonitor(spark, found, now="2024-01-01 06:00:00") as monitor:
            mon.run_monitored(writer, monitor, "d")

    _write(spark, src, [(1, "2024-01-01 05:00:00"), (1, "2024-01-01 05:01:00"), (2, "2024-01-01 05:30:00")])
    _write(spark, src, [(2, "2024-01-01 05:31:00"), (3, "2024-01-01 05:59:00")])
    run()
    first = _values(spark, found)
    assert first[("d", "RawRecordsRead")] == 5 and first[("d", "BronzeRecordsWritten")] == 3
    assert first[("d", "DuplicatesRemoved")] == 2 and first[("d", "JobSuccess")] == 1
    assert first[("d", mon.AGE)] == 30 * 60 * 1000  # the older batch; the newer one lags a minute
    _write(spark, src, [(4, "2024-01-01 05:59:30")])
    run()
    second = _values(spark, found)
    assert second[("d", "RawRecordsRead")] == 6 and second[("d", "JobSuccess")] == 2
    assert spark.read.parquet(out).count() == second[("d", "BronzeRecordsWritten")] == 4


def test_failures_raise_alarms(spark, tmp_path):
    src, found = str(tmp_path / "src"), str(tmp_path / "found")
    _write(spark, src, [(1, "2024-01-01 05:00:00")])

    def writer(fn, name):
        return st.file_stream(spark, src, SCHEMA).writeStream.foreachBatch(fn).option("checkpointLocation", str(tmp_path / name))

    def breaks(batch, batch_id):
        raise RuntimeError("no sink")

    with mon.StreamMonitor(spark, found) as monitor:
        mon.run_monitored(writer(lambda b, i: require_columns(b, ["vagao_id"]), "a"), monitor, "schema", fails=True)
        mon.run_monitored(writer(breaks, "b"), monitor, "broken", fails=True)
        with pytest.raises(Exception, match="no sink"):
            mon.run_monitored(writer(breaks, "c"), monitor, "broken")
        mon.run_monitored(writer(lambda b, i: None, "d"), monitor, "fine")
    got = metrics.alarms(mon.stream_metrics(spark, found, "2024-01-01 06:00:00"), metrics.alarm_rules(spark), how="left").collect()
    assert {(r.domain, r.metric, r.value, r.alarm) for r in got} == {
        ("schema", "JobFailure", 1.0, True), ("schema", "SchemaValidationFailure", 1.0, True),
        ("broken", "JobFailure", 2.0, True), ("fine", "JobSuccess", 1.0, False)}


def test_a_batch_reported_twice_counts_once(spark, tmp_path):
    found = str(tmp_path / "found")
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [("RawRecordsRead", "d", v, "Count", "q", run, batch, at + dt.timedelta(minutes=k))
            for k, (v, run, batch) in enumerate([(5.0, "r1", 0), (7.0, "r1", 1), (9.0, "r2", 1)])]
    spark.createDataFrame(rows, mon.ROW_SCHEMA).write.parquet(found)
    assert _values(spark, found) == {("d", "RawRecordsRead"): 14.0}


def test_nothing_heard_is_an_empty_flush(spark, tmp_path):
    monitor = mon.StreamMonitor(spark, str(tmp_path / "found"))
    assert monitor.flush() == 0 and not os.path.exists(monitor.path)


def test_batches_bounded_by_bytes(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for i in range(4):
        _write(spark, src, [(i, "2024-01-01 05:00:00")])
    largest = max(os.path.getsize(f"{src}/{f}") for f in os.listdir(src) if f.endswith(".parquet"))
    seen = []
    stream = st.file_stream(spark, src, SCHEMA, max_bytes_per_trigger=2 * largest + 1)
    st.run_foreach_batch(stream, lambda b, i: seen.append(b.count()), out)
    assert seen == [2, 2]
