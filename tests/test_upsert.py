"""Upsert semantics (M1-M4) and the touched-partition writer (K2)."""

import os

import pytest
from pyspark.sql import functions as F

from freightlake.operators.upsert import AmbiguousMergeError, merge_actions, merge_upsert
from freightlake.plans import tables

SCHEMA = "k string, wm int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))


def test_merge_cases(spark):
    target = spark.createDataFrame([
        ("newer", 1, "t"), ("tie", 5, "t"), ("older", 9, "t"), ("nullwm", None, "t"),
        ("keep", 1, "t"), (None, 1, "t-null"),
    ], SCHEMA)
    source = spark.createDataFrame([
        ("newer", 2, "s"), ("tie", 5, "s"), ("older", 3, "s"), ("nullwm", 7, "s"),
        ("insert", 1, "s"), (None, 1, "s-null"),
    ], SCHEMA)
    got = rows(merge_upsert(target, source, "k", newer="wm"))
    assert got == rows(spark.createDataFrame([
        ("newer", 2, "s"), ("tie", 5, "t"), ("older", 9, "t"), ("nullwm", None, "t"),
        ("keep", 1, "t"), (None, 1, "t-null"), ("insert", 1, "s"), (None, 1, "s-null"),
    ], SCHEMA))


def test_merge_unconditional_replace(spark):
    target = spark.createDataFrame([("a", 9, "t"), ("b", 1, "t")], SCHEMA)
    source = spark.createDataFrame([("a", 1, "s")], SCHEMA)
    assert rows(merge_upsert(target, source, "k")) == [("a", 1, "s"), ("b", 1, "t")]


def test_merge_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1, "t"), ("b", 1, "t")], SCHEMA)
    source = spark.createDataFrame([("a", 2, "s"), ("c", 1, "s")], SCHEMA)
    once = merge_upsert(target, source, "k", newer="wm")
    twice = merge_upsert(once, source, "k", newer="wm")
    assert rows(once) == rows(twice)


def test_null_keys_inserted_every_run(spark):
    target = spark.createDataFrame([("a", 1, "t")], SCHEMA)
    source = spark.createDataFrame([(None, 1, "s")], SCHEMA)
    once = merge_upsert(target, source, "k", newer="wm")
    twice = merge_upsert(once, source, "k", newer="wm")
    assert twice.filter(F.col("k").isNull()).count() == 2


def test_duplicate_source_key_is_ambiguous(spark):
    target = spark.createDataFrame([("a", 1, "t")], SCHEMA)
    source = spark.createDataFrame([("a", 2, "s"), ("a", 3, "s"), (None, 1, "x"), (None, 1, "y")], SCHEMA)
    with pytest.raises(AmbiguousMergeError):
        merge_upsert(target, source, "k", newer="wm", check_unique=True)
    ok = spark.createDataFrame([(None, 1, "x"), (None, 1, "y")], SCHEMA)
    assert merge_upsert(target, ok, "k", newer="wm", check_unique=True).count() == 3


def test_merge_with_new_source_column(spark):
    target = spark.createDataFrame([("a", 1, "t")], SCHEMA)
    source = spark.createDataFrame([("b", 1, "s", 5)], SCHEMA + ", extra int")
    got = {r["k"]: r["extra"] for r in merge_upsert(target, source, "k").collect()}
    assert got == {"a": None, "b": 5}


def test_merge_actions_report(spark):
    target = spark.createDataFrame([("a", 1, "t"), ("b", 5, "t")], SCHEMA)
    source = spark.createDataFrame([("a", 2, "s"), ("b", 5, "s"), ("c", 1, "s")], SCHEMA)
    got = {r["k"]: r["_merge_action"] for r in merge_actions(target, source, "k", "wm").collect()}
    assert got == {"a": "update", "b": "keep_target", "c": "insert"}


def _table_rows(spark, path):
    return rows(spark.read.parquet(path).select("k", "wm", "v", F.col("_partition_date").cast("string")))


def test_merged_write_moves_key_and_empties_partition(spark, tmp_path):
    path = str(tmp_path / "bronze")
    day = F.to_date(F.col("ts")).alias("_partition_date")
    target = spark.createDataFrame([
        ("a", 1, "t", "2024-01-01 10:00:00"),  # alone on the 1st: will move away
        ("b", 1, "t", "2024-01-02 10:00:00"),
        ("c", 1, "t", "2024-01-03 10:00:00"),
    ], SCHEMA + ", ts string").select("k", "wm", "v", day)
    source = spark.createDataFrame([
        ("a", 2, "s", "2024-01-03 09:00:00"),   # key a moves from the 1st to the 3rd
        ("d", 1, "s", "2024-01-04 09:00:00"),
    ], SCHEMA + ", ts string").select("k", "wm", "v", day)
    tables.write_table(target, path)
    stats = tables.write_merged(spark, source, path, "k", newer="wm")
    assert stats == {"touched": 3, "emptied": 1}
    assert not os.path.exists(os.path.join(path, "_partition_date=2024-01-01"))
    expected = rows(merge_upsert(target, source, "k", newer="wm").select(
        "k", "wm", "v", F.col("_partition_date").cast("string")))
    assert _table_rows(spark, path) == expected
    # untouched partition files are not rewritten
    before = sorted(os.listdir(os.path.join(path, "_partition_date=2024-01-02")))
    tables.write_merged(spark, source, path, "k", newer="wm")
    assert sorted(os.listdir(os.path.join(path, "_partition_date=2024-01-02"))) == before
    assert _table_rows(spark, path) == expected


def test_publish_days_idempotent_and_removes_empty_day(spark, tmp_path):
    path = str(tmp_path / "gold")
    df = spark.createDataFrame([("a", 1, "x", "2024-01-01"), ("b", 1, "x", "2024-01-02")],
                               SCHEMA + ", d string").select("k", "wm", "v", F.col("d").cast("date").alias("_partition_date"))
    tables.publish_days(spark, df, path, ["2024-01-01", "2024-01-02"])
    tables.publish_days(spark, df, path, ["2024-01-02"])
    assert len(_table_rows(spark, path)) == 2
    only_first = df.filter(F.col("k") == "a")
    tables.publish_days(spark, only_first, path, ["2024-01-02"])  # day 2 reprocessed: now empty
    assert [r[0] for r in _table_rows(spark, path)] == ["a"]


def test_load_control_latest(spark, tmp_path):
    path = str(tmp_path / "control")
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "processing_date string")
    tables.append_load_control(tables.load_control_rows(days, "d", "2024-01-03 01:00:00", "FAILED"), path)
    tables.append_load_control(tables.load_control_rows(days.filter(F.col("processing_date") == "2024-01-01"), "d", "2024-01-03 02:00:00"), path)
    got = {str(r["processing_date"]): r["status"] for r in tables.latest_load_status(spark.read.parquet(path)).collect()}
    assert got == {"2024-01-01": "SUCCESS", "2024-01-02": "FAILED"}


def test_clustered_write_sorted_files(spark, tmp_path):
    import pyarrow.parquet as pq
    path = str(tmp_path / "fact")
    df = spark.range(0, 2000).select(
        (F.col("id") % 3).cast("string").alias("status"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("_partition_date"),
        "id")
    tables.write_table(df, path, sort_cols=["status", "id"])
    for d in os.listdir(path):
        if not d.startswith("_partition_date="):
            continue
        for f in os.listdir(os.path.join(path, d)):
            if f.endswith(".parquet"):
                t = pq.read_table(os.path.join(path, d, f)).to_pydict()
                pairs = list(zip(t["status"], t["id"]))
                assert pairs == sorted(pairs)
    assert spark.read.parquet(path).count() == 2000


def test_analyze_catalog_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS fl_analyze_t USING parquet LOCATION '{path}'")
    tables.analyze_table(spark, "fl_analyze_t")
    stats = [r for r in spark.sql("DESCRIBE TABLE EXTENDED fl_analyze_t").collect() if r[0] == "Statistics"]
    assert stats and "10 rows" in stats[0][1]
    spark.sql("DROP TABLE fl_analyze_t")


def test_key_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 10).alias("_partition_date")).write.partitionBy(
        "_partition_date").parquet(path)
    target = spark.read.parquet(path).withColumn("wm", F.lit(1))
    source = spark.createDataFrame([(500, 3, 2), (510, 4, 1)], "k long, _partition_date long, wm int")
    most, rng = tables.batch_profile(source, ["k"])
    eff = tables.effective_rows(target, source, ["k"], "wm", "_partition_date", rng)
    plan = eff._jdf.queryExecution().executedPlan().toString()
    assert most == 1 and "GreaterThanOrEqual(k,500)" in plan and "LessThanOrEqual(k,510)" in plan
    assert [(r["k"], r["_old"]) for r in eff.collect()] == [(500, 0)]  # 510 is a tie: nothing to do
    assert sorted(tables.touched_values(eff, "_partition_date")) == [0, 3]


def _dated(spark, rows_, schema=SCHEMA + ", d string"):
    df = spark.createDataFrame(rows_, schema)
    return df.select(*[c for c in df.columns if c != "d"], F.col("d").cast("date").alias("_partition_date"))


def _all(spark, path):
    df = tables.read_table(spark, path)
    return rows(df.select(*[F.col(c).cast("string") for c in sorted(df.columns)]))


def _null_dates(spark):
    target = _dated(spark, [("a", 1, "t", None), ("b", 1, "t", None), ("c", 1, "t", "2024-01-01"), ("d", 1, "t", "2024-01-01")])
    source = _dated(spark, [("a", 2, "s", None), ("b", 2, "s", "2024-01-02"), ("c", 2, "s", None), ("e", 1, "s", None)])
    return target, source


def test_null_partitions_new_updated_and_moved(spark, tmp_path):
    path = str(tmp_path / "t")
    target, source = _null_dates(spark)
    tables.write_merged(spark, target, path, "k", newer="wm")
    want = rows(merge_upsert(target, source, "k", newer="wm").select(
        F.col("_partition_date").cast("string"), "k", "v", F.col("wm").cast("string")))
    assert tables.write_merged(spark, source, path, "k", newer="wm") == {"touched": 3, "emptied": 0}
    assert _all(spark, path) == want
    assert tables.write_merged(spark, source, path, "k", newer="wm")["touched"] == 0  # a replay rewrites nothing
    assert _all(spark, path) == want
    moved = _dated(spark, [(k, 9, "m", "2024-01-05") for k in "ace"])
    assert tables.write_merged(spark, moved, path, "k", newer="wm")["emptied"] == 1
    assert not os.path.exists(os.path.join(path, f"_partition_date={tables.NULL_PARTITION}"))
    assert len(_all(spark, path)) == 5


@pytest.mark.parametrize("stop_at", ["before_overwrite", "inside_overwrite", "before_delete"])
def test_stopped_merge_is_finished_by_the_next(spark, tmp_path, monkeypatch, stop_at):
    path = str(tmp_path / "t")
    target = _dated(spark, [("a", 1, "t", "2024-01-01"), ("b", 1, "t", "2024-01-02"), ("c", 1, "t", "2024-01-02")])
    source = _dated(spark, [("a", 2, "s", "2024-01-02"), ("b", 2, "s", "2024-01-03")])
    tables.write_merged(spark, target, path, "k", newer="wm")
    want = rows(merge_upsert(target, source, "k", newer="wm").select(
        F.col("_partition_date").cast("string"), "k", "v", F.col("wm").cast("string")))
    write, delete = tables.write_table, tables.delete_path

    def stopping_write(df, to, *args, **kw):
        if kw.get("dynamic"):
            if stop_at == "inside_overwrite":  # one partition is already gone, none is back
                delete(spark, tables.partition_dir(path, "_partition_date", "2024-01-02"))
            if stop_at != "before_delete":
                raise RuntimeError("stopped")
        return write(df, to, *args, **kw)

    def stopping_delete(s, at):
        if stop_at == "before_delete" and at.endswith("2024-01-01"):
            raise RuntimeError("stopped")
        return delete(s, at)

    with monkeypatch.context() as m:
        m.setattr(tables, "write_table", stopping_write)
        m.setattr(tables, "delete_path", stopping_delete)
        with pytest.raises(RuntimeError):
            tables.write_merged(spark, source, path, "k", newer="wm")
    tables.write_merged(spark, source, path, "k", newer="wm")
    assert _all(spark, path) == want
    assert not tables.path_exists(spark, f"{path}/_merge_stage")


def test_new_column_stays_when_the_next_batch_lacks_it(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_merged(spark, _dated(spark, [("a", 1, "t", "2024-01-01"), ("z", 1, "t", "2024-01-09")]), path, "k", newer="wm")
    wide = _dated(spark, [("b", 1, "s", "2024-01-01", 7)], SCHEMA + ", d string, extra int")
    tables.write_merged(spark, wide, path, "k", newer="wm")
    tables.write_merged(spark, _dated(spark, [("c", 1, "s", "2024-01-01")]), path, "k", newer="wm")
    got = {r["k"]: r["extra"] for r in tables.read_table(spark, path).collect()}
    assert got == {"a": None, "b": 7, "c": None, "z": None}


def test_lookup_bound_sends_older_rows_to_their_own_path(spark, tmp_path):
    path, late = str(tmp_path / "t"), str(tmp_path / "late")
    tables.write_merged(spark, _dated(spark, [("a", 1, "t", "2024-01-01"), ("b", 1, "t", "2024-01-05")]), path, "k", newer="wm")
    batch = _dated(spark, [("b", 2, "s", "2024-01-05"), ("o", 1, "s", "2024-01-02"), ("n", 1, "s", None)])
    import datetime
    stats = tables.write_merged(spark, batch, path, "k", newer="wm", since=datetime.date(2024, 1, 4), late_path=late)
    assert stats["touched"] == 2
    assert sorted(r["k"] for r in tables.read_table(spark, path).collect()) == ["a", "b", "n"]
    assert [r["k"] for r in spark.read.parquet(late).collect()] == ["o"]


def test_clean_scratch_removes_only_old_scratch_folders(spark):
    import time
    from freightlake.session import scratch_path
    old, new = scratch_path(spark, "old-thing"), scratch_path(spark, "new-thing")
    spark.range(3).write.parquet(old)
    spark.range(3).write.parquet(new)
    fs, p = tables._fs_path(spark, old)
    fs.setTimes(p, int(time.time() * 1000) - 48 * 3600 * 1000, -1)
    removed = tables.clean_scratch(spark, older_than_hours=24)
    assert any(r.rstrip("/").endswith(old.rsplit("/", 1)[1]) for r in removed)
    assert tables.path_exists(spark, new)
    assert not tables.path_exists(spark, old)


def test_merged_write_rejects_repeated_batch_key(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([("a", 1, "t", "2024-01-01")], SCHEMA + ", d string").select(
        "k", "wm", "v", F.col("d").cast("date").alias("_partition_date"))
    tables.write_table(base, path)
    dup = spark.createDataFrame([("a", 2, "s", "2024-01-01"), ("a", 3, "s", "2024-01-01")],
                                SCHEMA + ", d string").select(
        "k", "wm", "v", F.col("d").cast("date").alias("_partition_date"))
    with pytest.raises(AmbiguousMergeError):
        tables.write_merged(spark, dup, path, "k", newer="wm")
    most, _ = tables.batch_profile(dup, ["k"])
    assert most == 2


def test_batch_profile_composite_keys_ignore_null_parts(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, None), (None, 5), (3, 7)], "a long, b long")
    most, cond = tables.batch_profile(df, ["a", "b"])
    assert most == 2  # (1, 10) twice; rows with a NULL part never match, never repeat
    probe = spark.createDataFrame([(1, 10), (3, 7), (2, 8), (3, 11), (0, 7)], "a long, b long")
    assert sorted(tuple(r) for r in probe.filter(cond).collect()) == [(1, 10), (2, 8), (3, 7)]
    none_most, none_cond = tables.batch_profile(spark.createDataFrame([(None, 1)], "a long, b long"), ["a", "b"])
    assert none_most == 0 and probe.filter(none_cond).count() == 0


def test_merges_join_keys_only_and_repeated_target_keys_as_before(spark, tmp_path):
    now = _dated(spark, [("a", 1, "t", "2024-01-01"), ("b", 1, "t", "2024-01-02"), (None, 1, "t", "2024-01-01")])
    batch = _dated(spark, [("a", 2, "s", "2024-01-02"), ("n", 1, "s", "2024-01-01"), (None, 1, "s", None)])
    hits = batch.withColumn("_hit", F.when(F.col("k") == "a", True)).withColumn("_old", F.lit(None))
    got = tables.replaced(now, hits, ["k"])
    assert rows(got.select("k", "wm", "v")) == rows(merge_upsert(now, batch, "k").select("k", "wm", "v"))
    assert "FullOuter" not in got._jdf.queryExecution().executedPlan().toString()
    twice = now.unionByName(now).unionByName(_dated(spark, [("a", 9, "t", "2024-01-01")]))
    for i, buckets in enumerate((None, 2)):
        path = str(tmp_path / f"t{i}")
        tables.write_table(twice, path)
        tables.save_schema(spark, path, twice.schema)
        tables.write_merged(spark, batch.filter("k = 'a'").withColumn("wm", F.lit(10)), path, "k", newer="wm", index_buckets=buckets)
        a = [r["wm"] for r in tables.read_table(spark, path).filter("k = 'a'").collect()]
        assert a == [10] * (9 if buckets is None else 3)
        tables.write_merged(spark, batch.limit(0), path, "k", newer="wm", index_buckets=buckets)  # an empty batch
