"""Streaming operators: availableNow runs equal the batch result on closed data."""

import os

from pyspark.sql import functions as F

from freightlake.streaming import streams as st


def _write(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).write.parquet(path)


def test_windows_emit_only_closed_windows(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = [(i, f"2024-01-01 0{h}:{m:02d}:00", "A" if i % 2 else "B", 1.5)
            for i, (h, m) in enumerate([(0, 5), (0, 50), (1, 10), (2, 30), (5, 0), (5, 59)])]
    _write(spark, rows, "id long, ts string, k string, v double", src)
    stream = st.file_stream(spark, src, "id long, ts string, k string, v double").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    agg = st.windowed_counts(stream, "ts", "1 hour", "2 hours", ["k"], "v")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    st.to_parquet_sink(agg, out, ck)
    got = sorted((str(r["window_start"]), r["k"], r["n_events"]) for r in spark.read.parquet(out).collect())
    # watermark = 05:59 - 2h = 03:59: windows ending at or before it are final
    assert got == [("2024-01-01 00:00:00", "A", 1), ("2024-01-01 00:00:00", "B", 1),
                   ("2024-01-01 01:00:00", "B", 1), ("2024-01-01 02:00:00", "A", 1)]
    # a restart with the same checkpoint and no new files adds nothing (exactly once)
    st.to_parquet_sink(agg, out, ck)
    assert spark.read.parquet(out).count() == 4


def test_stream_dedup_within_watermark(spark, tmp_path):
    src = str(tmp_path / "src")
    _write(spark, [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:10:00"), (2, "2024-01-01 00:20:00")],
           "id long, ts string", src)
    stream = st.file_stream(spark, src, "id long, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    out = str(tmp_path / "out")
    st.to_parquet_sink(st.dedup_stream(stream, ["id"], "ts", "1 hour"), out, str(tmp_path / "ck"))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_stream_upsert_replay_is_idempotent(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "bronze")
    _write(spark, [("a", 1, "2024-01-01 00:00:00"), ("a", 2, "2024-01-02 00:00:00"),
                   ("b", 1, "2024-01-01 00:00:00")], "k string, v long, wm string", src)
    stream = st.file_stream(spark, src, "k string, v long, wm string").withColumn(
        "wm", F.col("wm").cast("timestamp"))
    writer = st.upsert_batch_writer(spark, table, ["k"], "wm")
    st.run_foreach_batch(stream, writer, str(tmp_path / "ck1"))
    st.run_foreach_batch(stream, writer, str(tmp_path / "ck2"))  # replay from scratch
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(table).collect())
    assert got == [("a", 2), ("b", 1)]
    assert not os.path.exists(os.path.join(table, "_partition_date=2024-01-01", "x"))


def test_hot_status_expiry(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "status")
    _write(spark, [(1, 10, "PARADO", "2024-01-01 00:00:00"), (2, 10, "CHEGOU", "2024-01-01 06:00:00"),
                   (3, 20, "SAIU", "2023-12-30 00:00:00")],
           "evento_id long, vagao_id long, status_norm string, updated_at string", src)
    stream = st.file_stream(spark, src, "evento_id long, vagao_id long, status_norm string, updated_at string")
    stream = stream.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    st.run_foreach_batch(stream, st.status_batch_writer(spark, table, 24), str(tmp_path / "ck"))
    cur = st.current_status(spark.read.parquet(table), "2024-01-01 12:00:00")
    assert [(r["vagao_id"], r["status_norm"]) for r in cur.collect()] == [(10, "CHEGOU")]


def test_interval_join_bounds(spark, tmp_path):
    s_dir, e_dir = str(tmp_path / "s"), str(tmp_path / "e")
    _write(spark, [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00"), (3, "2024-01-01 00:00:00")],
           "id long, t0 string", s_dir)
    _write(spark, [(1, "2024-01-01 05:00:00"), (2, "2024-01-02 00:00:01"), (3, "2023-12-31 23:00:00")],
           "id long, t1 string", e_dir)
    s = st.file_stream(spark, s_dir, "id long, t0 string").withColumn("t0", F.col("t0").cast("timestamp"))
    e = st.file_stream(spark, e_dir, "id long, t1 string").withColumn("t1", F.col("t1").cast("timestamp"))
    out = str(tmp_path / "out")
    st.to_parquet_sink(st.interval_join(s, e, "id", "t0", "t1", "24 HOURS", "1 hour"), out, str(tmp_path / "ck"))
    assert [r["id"] for r in spark.read.parquet(out).collect()] == [1]


def test_status_expiry_and_pruned_read(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "status")
    _write(spark, [(1, 10, "PARADO", "2024-01-01 00:00:00"), (2, 11, "SAIU", "2024-01-03 05:00:00"),
                   (3, 12, "CHEGOU", "2024-01-04 01:00:00")],
           "evento_id long, vagao_id long, status_norm string, updated_at string", src)
    stream = st.file_stream(spark, src, "evento_id long, vagao_id long, status_norm string, updated_at string")
    stream = stream.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    st.run_foreach_batch(stream, st.status_batch_writer(spark, table, 24), str(tmp_path / "ck"))
    cur = st.current_status(spark.read.parquet(table), "2024-01-04 02:00:00")
    assert "PartitionFilters" in cur._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["vagao_id"] for r in cur.collect()) == [11, 12]
    removed = st.expire_status(spark, table, "2024-01-04 02:00:00", 24)
    assert [p.rsplit("=", 1)[1] for p in removed] == ["2024-01-01"]
    after = st.current_status(spark.read.parquet(table), "2024-01-04 02:00:00")
    assert sorted(r["vagao_id"] for r in after.collect()) == [11, 12]


def test_landing_lag_metrics_raise_alarm(spark, tmp_path):
    from freightlake.operators import metrics
    from freightlake.sources.raw import CORRUPT
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text('{"id": 1, "ts": "2024-01-01 00:00:00"}\n{"id": 2, "ts": "2024-01-01 00:10:00"}\n{"id": 3,\n')
    stream = st.file_stream(spark, str(land), f"id long, ts timestamp, {CORRUPT} string", fmt="json",
                            corrupt_column=CORRUPT)
    good, bad, m = str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "metrics")
    writer = st.landing_batch_writer(good, bad, "date", "ts", metrics_path=m, domain="events",
                                     now="2024-01-01 00:20:00")
    st.run_foreach_batch(stream, writer, str(tmp_path / "ck"))
    rows = {r["metric"]: r["value"] for r in spark.read.parquet(m).collect()}
    assert rows == {"IteratorAgeMilliseconds": 600000.0, "RecordsProcessed": 2.0}
    alarm = {r["metric"]: r["alarm"] for r in metrics.alarms(
        spark.read.parquet(m).drop("batch_id"), metrics.alarm_rules(spark)).collect()}
    assert alarm == {"IteratorAgeMilliseconds": True}
    assert spark.read.parquet(bad).count() == 1


def test_restart_processes_only_new_files(spark, tmp_path):
    """A second run on the same checkpoint reads only files that arrived since."""
    src, table, ck = tmp_path / "src", str(tmp_path / "bronze"), str(tmp_path / "ck")
    schema = "k string, v long, wm string"
    spark.createDataFrame([("a", 1, "2024-01-01 00:00:00"), ("b", 1, "2024-01-01 00:00:00")], schema) \
        .coalesce(1).write.mode("append").parquet(str(src))
    stream = lambda: st.file_stream(spark, str(src), schema).withColumn(
        "wm", F.col("wm").cast("timestamp"))
    seen = []
    base = st.upsert_batch_writer(spark, table, ["k"], "wm")

    def writer(batch, batch_id):
        seen.append(batch.count())
        base(batch, batch_id)

    st.run_foreach_batch(stream().select("*"), writer, ck)
    spark.createDataFrame([("a", 2, "2024-01-02 00:00:00"), ("c", 1, "2024-01-02 00:00:00")], schema) \
        .coalesce(1).write.mode("append").parquet(str(src))  # a new file lands
    st.run_foreach_batch(stream().select("*"), writer, ck)
    assert seen == [2, 2]
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(table).collect())
    assert got == [("a", 2), ("b", 1), ("c", 1)]
