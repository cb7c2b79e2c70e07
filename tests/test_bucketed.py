"""Bucketed catalog-table merges: same result as the pure merge, target not shuffled."""

import pytest
from pyspark.sql import functions as F

from freightlake.operators.upsert import merge_upsert
from freightlake.plans import bucketed

SCHEMA = "k long, wm int, v string, d string"


def rows(df):
    return sorted((tuple(r) for r in df.select("k", "wm", "v", "d").collect()), key=repr)


@pytest.fixture()
def table(spark, tmp_path):
    name = f"fl_bucketed_{tmp_path.name[-8:].replace('-', '_')}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_merge_equals_pure_merge(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle join path
    try:
        target = spark.range(0, 400).select(
            F.col("id").alias("k"), F.lit(1).alias("wm"), F.lit("t").alias("v"),
            (F.col("id") % 4).cast("string").alias("d"))
        bucketed.create_keyed_table(target, table, ["k"], "d", buckets=8)
        source = spark.createDataFrame(
            [(3, 2, "s", "9"), (5, 1, "s", "1"), (1000, 1, "s", "2"), (None, 1, "s", "2")], SCHEMA)
        want = rows(merge_upsert(spark.table(table), source, "k", "wm"))
        stats = bucketed.merge_into_table(spark, source, table, "k", "wm", "d")
        assert stats["touched"] == 3  # key 3 moves from '3' to '9', inserts go to '2'; the tie changes nothing
        assert rows(spark.table(table)) == want
        # the merge join reads the target by bucket: only the batch side is exchanged
        batch = source.repartition(8, "k")
        merged = merge_upsert(spark.table(table), batch, "k", "wm", salt_null_keys=False)
        merged.write.format("noop").mode("overwrite").save()
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") <= 2  # the batch only (its keyed and its NULL-key rows)
        scan_lines = [ln for ln in plan.splitlines() if "FileScan" in ln and table in ln]
        assert any("SelectedBucketsCount" in ln and "IsNotNull(k)" in ln for ln in scan_lines)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_bucketed_merge_drops_emptied_partition(spark, table):
    target = spark.createDataFrame([(1, 1, "t", "a"), (2, 1, "t", "b")], SCHEMA)
    bucketed.create_keyed_table(target, table, ["k"], "d", buckets=4)
    source = spark.createDataFrame([(1, 2, "s", "b")], SCHEMA)  # key 1 leaves partition a
    stats = bucketed.merge_into_table(spark, source, table, "k", "wm", "d")
    assert stats == {"touched": 2, "emptied": 1}
    assert rows(spark.table(table)) == [(1, 2, "s", "b"), (2, 1, "t", "b")]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["d=b"]


def null_dates(spark):
    target = spark.createDataFrame([(1, 1, "t", None), (2, 1, "t", None), (3, 1, "t", "a"), (4, 1, "t", "a")], SCHEMA)
    source = spark.createDataFrame([(1, 2, "s", None), (2, 2, "s", "b"), (3, 2, "s", None), (5, 1, "s", None)], SCHEMA)
    want = [(1, 2, "s", None), (2, 2, "s", "b"), (3, 2, "s", None), (4, 1, "t", "a"), (5, 1, "s", None)]
    return target, source, want


def test_null_partitions_are_kept(spark, table):
    target, source, want = null_dates(spark)
    bucketed.create_keyed_table(target, table, ["k"], "d", buckets=4)
    for touched in (3, 0):  # the second, identical run touches nothing
        assert bucketed.merge_into_table(spark, source, table, "k", "wm", "d")["touched"] == touched
        assert rows(spark.table(table)) == sorted(want, key=repr)
    moved = spark.createDataFrame([(1, 3, "m", "a"), (3, 3, "m", "a"), (5, 3, "m", "a")], SCHEMA)
    assert bucketed.merge_into_table(spark, moved, table, "k", "wm", "d")["emptied"] == 1  # the NULL partition
    assert rows(spark.table(table)) == sorted([(1, 3, "m", "a"), (2, 2, "s", "b"), (3, 3, "m", "a"), (4, 1, "t", "a"), (5, 3, "m", "a")], key=repr)


def test_a_stopped_merge_is_finished_from_its_stage(spark, table, monkeypatch):
    target, source, want = null_dates(spark)
    bucketed.create_keyed_table(target, table, ["k"], "d", buckets=4)
    with monkeypatch.context() as m:
        m.setattr(bucketed, "finish_merge", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped"))
                  if bucketed.path_exists(spark, bucketed._stage_of(spark, table)) else None)
        with pytest.raises(RuntimeError):
            bucketed.merge_into_table(spark, source, table, "k", "wm", "d")
    assert bucketed.merge_into_table(spark, source, table, "k", "wm", "d")["touched"] == 0
    assert rows(spark.table(table)) == sorted(want, key=repr)


def test_new_columns_and_repeated_keys(spark, table):
    from freightlake.operators.upsert import AmbiguousMergeError
    target = spark.createDataFrame([(1, 1, "t", "a")], SCHEMA)
    bucketed.create_keyed_table(target, table, ["k"], "d", buckets=4)
    wide = spark.createDataFrame([(2, 1, "s", "a", 7)], SCHEMA + ", extra int")
    bucketed.merge_into_table(spark, wide, table, "k", "wm", "d")
    bucketed.merge_into_table(spark, spark.createDataFrame([(3, 1, "s", "a")], SCHEMA), table, "k", "wm", "d")
    assert {r["k"]: r["extra"] for r in spark.table(table).collect()} == {1: None, 2: 7, 3: None}
    with pytest.raises(AmbiguousMergeError):
        bucketed.merge_into_table(spark, spark.createDataFrame([(4, 1, "s", "a"), (4, 2, "s", "a")], SCHEMA), table, "k", "wm", "d")
