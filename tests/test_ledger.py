"""A batch enters the ledger together with its rows, and late rows are added to written windows."""

import datetime

import pytest
from pyspark.sql import functions as F

from freightlake.plans import tables
from freightlake.streaming import streams as st

SCHEMA = "k string, wm long, d string"


def dated(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select("k", "wm", F.col("d").cast("date").alias("_partition_date"))


def keys(spark, path):
    return sorted((str(r["k"]), r["wm"]) for r in tables.read_table(spark, path).collect())


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("stop_at", ["before_stage", "after_stage", "after_data", "after_entry"])
def test_a_write_is_in_the_table_once_wherever_it_stops(spark, tmp_path, monkeypatch, first, stop_at):
    path = str(tmp_path / "t")
    want = [("None", 5), ("a", 2), ("b", 1)]
    if not first:
        tables.write_merged(spark, dated(spark, [("z", 1, "2024-01-03"), ("a", 1, "2024-01-02")]), path, "k", newer="wm", commit="w/0")
        want = [*want, ("z", 1)]
    batch = dated(spark, [("a", 2, "2024-01-01"), ("b", 1, None), (None, 5, "2024-01-01")])
    originals = {n: getattr(tables, n) for n in ("_stage_write", "finish_merge", "record_commit")}

    def stop(*args, **kw):
        raise RuntimeError("stopped")

    def after(name):
        def run(*args, **kw):
            originals[name](*args, **kw)
            raise RuntimeError("stopped")
        return run

    with monkeypatch.context() as m:
        if stop_at == "before_stage":
            m.setattr(tables, "_stage_write", stop)
        elif stop_at == "after_stage":
            m.setattr(tables, "_stage_write", after("_stage_write"))
        else:
            m.setattr(tables, "record_commit", stop if stop_at == "after_data" else after("record_commit"))
        with pytest.raises(RuntimeError):
            tables.write_merged(spark, batch, path, "k", newer="wm", commit="w/1")
    for _ in range(2):  # replays
        if not tables.is_committed(spark, path, "w/1"):
            tables.write_merged(spark, batch, path, "k", newer="wm", commit="w/1")
        assert keys(spark, path) == sorted(want)
    assert not tables.is_committed(spark, path, "w/0") and not tables.path_exists(spark, f"{path}/_merge_stage")


def test_two_writers_keep_their_own_entries(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (0, 1):
        for w in ("x", "y"):
            tables.write_merged(spark, dated(spark, [(None, n, "2024-01-01")]), path, "k", newer="wm", commit=f"{w}/{n}")
            tables.write_merged(spark, dated(spark, [(None, n, "2024-01-01")]), path, "k", newer="wm", commit=f"{w}/{n}")
    assert [w for _, w in keys(spark, path)] == [0, 0, 1, 1]
    nothing = dated(spark, [])
    tables.write_merged(spark, nothing, path, "k", newer="wm", commit="x/2")
    assert tables.is_committed(spark, path, "x/2") and not tables.is_committed(spark, path, "x/1")


def test_late_rows_are_added_and_counted_and_replays_change_nothing(spark, tmp_path):
    path = str(tmp_path / "w")
    writer = st.window_partials_writer(path, "ts", "1 hour", "1 hour", ["k"], "v")

    def batch(*rows):
        return spark.createDataFrame([(datetime.datetime.fromisoformat(f"2024-01-01 {t}") if t else None, k, 1.0) for t, k in rows],
                                     "ts timestamp, k string, v double")

    batches = [batch(("00:10", "a"), ("01:50", "a"), ("05:00", "b"), (None, "a")), batch(("00:20", "a"), ("04:30", "b"), ("09:00", "a")),
               batch(("04:40", "b"), ("09:10", "a"))]
    for i, b in enumerate(batches):
        writer(b, i)
        writer(b, i)
    got = {(str(r.window_start)[11:13], r.k): (r.n_events, r.value_sum, r.n_late) for r in st.merged_windows(spark, path, "1 hour").collect()}
    assert got == {("00", "a"): (2, 2.0, 1), ("01", "a"): (1, 1.0, 0), ("05", "b"): (1, 1.0, 0), ("04", "b"): (2, 2.0, 1)}
    found = {r.batch_id: r.value for r in st.late_row_metrics(spark, path, "d", "2024-01-02 00:00:00").collect()}
    assert found == {0: 0.0, 1: 1.0, 2: 1.0}
