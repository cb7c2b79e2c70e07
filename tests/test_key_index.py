"""Key index: look-ups read the batch's buckets only, stops are repaired, increments compact."""

import pytest
from pyspark.sql import functions as F

from freightlake.operators.upsert import merge_upsert
from freightlake.plans import key_index, tables

SCHEMA = "k string, wm long, v string, d string"


def dated(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select("k", "wm", "v", F.col("d").cast("date").alias("_partition_date"))


def content(df):
    return sorted((tuple(r) for r in df.select("k", "wm", "v", F.col("_partition_date").cast("string")).collect()), key=str)


def target(spark, n=200):
    return dated(spark, [(f"key-{i}", i % 5, "t", f"2024-01-{1 + i % 9:02d}") for i in range(n)] + [(None, 1, "t", "2024-01-01")])


def batch(spark, salt=1):
    rows = [(f"key-{i}", 3, f"s{salt}", f"2024-01-{1 + (i + salt) % 9:02d}") for i in range(0, 12)]
    return dated(spark, rows + [(f"new-{salt}", 1, "s", None), (None, 9, "s", "2024-01-02"), ("key-50", None, "s", "2024-01-03")])


def in_index(spark, path):
    index = key_index.load(spark, path)
    found = key_index.look_up(spark, index, tables.read_table(spark, path))
    return sorted((r["k"], r["_mark"], str(r["_part"])) for r in found.collect())


def in_table(spark, path):
    return sorted((r["k"], r["wm"], str(r["_partition_date"])) for r in tables.read_table(spark, path).filter("k IS NOT NULL").collect())


def test_merges_equal_those_without_an_index(spark, tmp_path):
    path = str(tmp_path / "t")
    now = target(spark)
    tables.write_merged(spark, now, path, "k", newer="wm", index_buckets=16)
    for salt in (1, 2, 1):
        tables.write_merged(spark, batch(spark, salt), path, "k", newer="wm")
        now = merge_upsert(now, batch(spark, salt), "k", newer="wm")
    assert content(tables.read_table(spark, path)) == content(now)
    assert in_index(spark, path) == in_table(spark, path)


def test_look_up_reads_the_buckets_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_merged(spark, target(spark), path, "k", newer="wm", index_buckets=16)
    index = key_index.load(spark, path)
    one = dated(spark, [("key-7", 9, "s", "2024-01-01"), ("key-9", 9, "s", "2024-01-01")])
    wanted = {r[0] for r in one.select(index.bucket()).collect()}
    files = key_index.rows(spark, index, sorted(wanted)).select(F.input_file_name()).distinct().collect()
    assert {int(f[0].split("/bucket=")[1].split("/")[0]) for f in files} == wanted and len(wanted) < 16
    plan = key_index.look_up(spark, index, one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1][:80]
    assert str(tmp_path / "t") + "/_partition_date" not in plan  # the table itself is not read
    assert {r["k"] for r in key_index.look_up(spark, index, one).collect()} == {"key-7", "key-9"}


@pytest.mark.parametrize("stop_at", ["before_index", "after_index"])
def test_stop_between_data_and_index_is_repaired_by_the_next_merge(spark, tmp_path, monkeypatch, stop_at):
    path = str(tmp_path / "t")
    tables.write_merged(spark, target(spark), path, "k", newer="wm", index_buckets=4)
    want = content(merge_upsert(target(spark), batch(spark), "k", newer="wm"))
    apply, delete = key_index.apply_changes, tables.delete_path

    def stopping(*args):
        if stop_at == "after_index":
            apply(*args)
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(key_index, "apply_changes", stopping)
        with pytest.raises(RuntimeError):
            tables.write_merged(spark, batch(spark), path, "k", newer="wm")
    tables.write_merged(spark, batch(spark).filter("k IS NOT NULL"), path, "k", newer="wm")
    assert content(tables.read_table(spark, path)) == want and delete is tables.delete_path
    assert in_index(spark, path) == in_table(spark, path)


def test_increments_are_compacted(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(key_index, "INCREMENTS", 2)
    tables.write_merged(spark, target(spark, 40), path, "k", newer="wm", index_buckets=2)
    for i in range(5):
        tables.write_merged(spark, dated(spark, [(f"key-{i}", 100 + i, "s", "2024-02-01")]), path, "k", newer="wm")
    index = key_index.load(spark, path)
    assert key_index.next_seq(spark, index) <= 3 and "v=0" not in key_index._version(spark, index)
    assert in_index(spark, path) == in_table(spark, path)


def test_index_is_built_for_an_old_table_and_bound_to_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_merged(spark, target(spark, 30), path, "k", newer="wm")
    assert key_index.load(spark, path) is None
    tables.write_merged(spark, batch(spark), path, "k", newer="wm", index_buckets=4)
    assert in_index(spark, path) == in_table(spark, path)
    with pytest.raises(ValueError, match="key index"):
        tables.write_merged(spark, batch(spark, 2), path, "k")
    none = str(tmp_path / "none")
    tables.write_merged(spark, dated(spark, [(None, 1, "a", "2024-01-01")]), none, "k", newer="wm", index_buckets=4)
    tables.write_merged(spark, dated(spark, [("a", 1, "a", "2024-01-01")]), none, "k", newer="wm")
    assert in_index(spark, none) == in_table(spark, none)


def test_a_large_batch_does_not_shuffle_its_keys_to_drop_others(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_merged(spark, target(spark, 60), path, "k", newer="wm", index_buckets=2)
    tables.write_merged(spark, batch(spark), path, "k", newer="wm")  # a second row for some keys
    index = key_index.load(spark, path)
    large, small = target(spark, 50), dated(spark, [("key-7", 9, "s", "2024-01-01")])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan(key_index.candidates(spark, index, large)) and "LeftSemi" in plan(key_index.candidates(spark, index, small))
    for rows in (large, small):
        want = sorted((r["k"], r["_mark"], str(r["_part"])) for r in key_index.look_up(spark, index, rows).collect())
        found = key_index.candidates(spark, index, rows).join(rows.select("k"), "k").collect()
        assert sorted((r["k"], r["_mark"], str(r["_part"])) for r in found) == want
    files = [f for f in tables.glob_paths(spark, f"{path}/_key_index/v=*/seq=*/bucket=*/*.parquet")]
    assert files and all(".zstd." in f for f in files)


def test_text_keys_are_counted_by_hash_and_collisions_are_no_repeats(spark, monkeypatch):
    grouped = []
    group_by = type(target(spark)).groupBy
    monkeypatch.setattr(type(target(spark)), "groupBy", lambda df, *cols: grouped.append([str(c) for c in cols]) or group_by(df, *cols))
    rows = dated(spark, [("b", 1, "", None), ("a", 1, "", None), (None, 1, "", None), (None, 2, "", None)])
    most, cond = tables.batch_profile(rows, ["k"])
    assert most == 1 and ["k"] not in grouped
    assert [r["k"] for r in rows.filter(cond).orderBy("k").collect()] == ["a", "b"]
    assert tables.batch_profile(rows.union(rows), ["k"])[0] == 2
    assert tables.batch_profile(rows.filter("k IS NULL"), ["k"])[0] == 0
    monkeypatch.setattr(tables.F, "xxhash64", lambda *cols: F.length(F.col("v")))
    assert tables.batch_profile(rows, ["k"])[0] == 1 and ["k"] in grouped


def test_staged_rows_with_and_without_folders_are_entered(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_merged(spark, target(spark, 20), path, "k", newer="wm", index_buckets=2)
    index = key_index.load(spark, path)
    for n, key in enumerate(("flat", "folders")):
        rows = dated(spark, [(key, 1, "s", "2024-02-01")])
        if key == "flat":
            index.entries(rows, 1 + n).write.parquet(str(tmp_path / key))
        else:
            key_index.stage_changes(spark, index, rows, str(tmp_path / key))
        for _ in range(2):  # again after a stop
            key_index.apply_changes(spark, path, str(tmp_path / key))
        found = key_index.look_up(spark, index, rows).collect()
        assert [(r["k"], r["_mark"], str(r["_part"])) for r in found] == [(key, 1, "2024-02-01")]
    assert key_index.next_seq(spark, index) == 3
