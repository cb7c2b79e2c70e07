"""Merged writes: staged folders are moved, keys are matched alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from freightlake.plans import journal, tables


def dated(spark, rows):
    return spark.createDataFrame(rows, "k string, wm int, v string, d string").select(
        "k", "wm", "v", F.col("d").cast("date").alias("_partition_date"))


def content(spark, path):
    return sorted(str(tuple(r)) for r in tables.read_table(spark, path).select("k", "wm", "v", "_partition_date").collect())


def files(spark, path):
    return {f.rsplit("/", 2)[-1] for f in tables.glob_paths(spark, f"{path}/_partition_date=*/*.parquet")}


TARGET = [("a", 1, "t", "2024-01-01"), ("b", 1, "t", "2024-01-02"), ("c", 1, "t", "2024-01-03"), ("n", 1, "t", None)]
BATCH = [("a", 2, "s", "2024-01-02"), ("b", 2, "s", "2024-01-02"), ("n", 2, "s", "2024-01-04"), (None, 2, "s", "2024-01-01")]
WANT = sorted(["('c', 1, 't', datetime.date(2024, 1, 3))", "('a', 2, 's', datetime.date(2024, 1, 2))",
               "('b', 2, 's', datetime.date(2024, 1, 2))", "('n', 2, 's', datetime.date(2024, 1, 4))",
               "(None, 2, 's', datetime.date(2024, 1, 1))"])


@pytest.mark.parametrize("moves", [None, 1])
def test_staged_files_become_the_tables_and_a_stop_between_two_moves_is_finished(spark, tmp_path, monkeypatch, moves):
    path = str(tmp_path / "t")
    tables.write_merged(spark, dated(spark, TARGET), path, "k", newer="wm")
    stage, finish, glob, staged = tables._stage_write, tables.finish_merge, tables.glob_paths, set()

    def staging(*args):
        out = stage(*args)
        staged.update(files(spark, f"{path}/_merge_stage/data"))
        return out

    def stopping(s, pattern):  # the folders after the first are out of reach
        found = glob(s, pattern)
        return [*found[:1], f"{path}/none"] if pattern.endswith("_merge_stage/data/_partition_date=*") else found

    monkeypatch.setattr(tables, "_stage_write", staging)
    if moves is None:
        tables.write_merged(spark, dated(spark, BATCH), path, "k", newer="wm")
    else:
        with monkeypatch.context() as m:
            m.setattr(tables, "finish_merge", lambda s, p, c: tables.path_exists(s, f"{p}/_merge_stage/touched") and (
                m.setattr(tables, "glob_paths", stopping), finish(s, p, c)))
            with pytest.raises(Exception):
                tables.write_merged(spark, dated(spark, BATCH), path, "k", newer="wm")
        assert tables.finish_merge(spark, path)
    assert content(spark, path) == WANT and staged and staged <= files(spark, path)
    assert not tables.path_exists(spark, tables.partition_dir(path, "_partition_date", None))
    assert not tables.path_exists(spark, f"{path}/_merge_stage")


def test_a_stage_of_an_earlier_version_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_merged(spark, dated(spark, TARGET), path, "k", newer="wm")
    tables.write_table(dated(spark, [("n", 2, "s", "2024-01-04")]), f"{path}/_merge_stage/data")
    spark.createDataFrame([(None,), ("2024-01-04",)], "part string").coalesce(1).write.parquet(f"{path}/_merge_stage/touched")
    assert tables.finish_merge(spark, path)
    assert [c for c in content(spark, path) if "'n'" in c] == ["('n', 2, 's', datetime.date(2024, 1, 4))"]
    assert len(content(spark, path)) == 4


@pytest.mark.parametrize("buckets", [None, 2])
@pytest.mark.parametrize("newer", [None, "wm"])
def test_only_keys_meet_the_target_and_replaced_partitions_are_not_read(spark, tmp_path, monkeypatch, buckets, newer):
    path, met, kept = str(tmp_path / "t"), [], []
    tables.write_merged(spark, dated(spark, TARGET), path, "k", newer=newer, index_buckets=buckets)
    changes, partly = tables._changes, tables.partly_kept
    monkeypatch.setattr(tables, "_changes", lambda source, *a: met.append(source.columns) or changes(source, *a))
    monkeypatch.setattr(tables, "partly_kept", lambda *a: kept.append(partly(*a)) or kept[-1])
    late = [("c", 0, "old", "2024-01-03")] if newer else []  # loses, so that not the whole batch wins
    tables.write_merged(spark, dated(spark, BATCH + late), path, "k", newer=newer, index_buckets=buckets)
    assert content(spark, path) == WANT
    assert met and all("v" not in columns for columns in met)
    assert kept == [[]]  # each touched partition's rows are all replaced


def test_the_state_after_the_last_run_joins_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for n, rows in enumerate((TARGET, BATCH)):
        tables.write_merged(spark, dated(spark, rows), path, "k", newer="wm", run=journal.Run(f"r{n}", f"2024-02-0{n + 1} 00:00:00"))
    last, first = (journal.state_at(spark, path, f"2024-02-0{n} 12:00:00") for n in (2, 1))
    assert "Join" not in last._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(str(tuple(r)) for r in last.select("k", "wm", "v", "_partition_date").collect()) == WANT
    assert sorted(r["v"] for r in first.collect()) == ["t"] * 4
