"""Change journal: states and versions after merges, stops, NULL keys, refusals."""

import pytest
from pyspark.sql import functions as F

from freightlake.plans import journal, tables
from freightlake.plans.journal import JournalError, Run

SCHEMA = "k string, wm long, v string, d string"
DAYS = ["2024-03-01 00:00:00", "2024-03-02 00:00:00", "2024-03-03 00:00:00", "2024-03-04 00:00:00"]


def dated(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select("k", "wm", "v", F.col("d").cast("date").alias("_partition_date"))


def content(df):
    return sorted((tuple(r) for r in df.withColumns({c: F.col(c).cast("string") for c in df.columns}).collect()), key=str)


def batches(spark):
    first = [(f"k{i}", 1, "a", f"2024-01-0{1 + i % 3}") for i in range(30)] + [(None, 1, "a", "2024-01-01")] * 2
    second = [(f"k{i}", 2, "b", f"2024-01-0{1 + (i + 1) % 3}") for i in range(0, 30, 2)] + [(None, 1, "a", "2024-01-01"), ("new", 5, "b", None)]
    third = [(f"k{i}", 1 + i % 3, "c", "2024-01-09") for i in range(0, 30, 5)] + [("new", 9, "c", "2024-01-02"), (None, 7, "c", None)]
    return [dated(spark, rows) for rows in (first, second, third)]


def merge(spark, path, batch, n, **more):
    return tables.write_merged(spark, batch, path, "k", newer="wm", run=Run(f"run-{n}", DAYS[n]), **more)


def test_states_equal_the_tables_after_each_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    seen = []
    for n, batch in enumerate(batches(spark)):
        merge(spark, path, batch, n)
        seen.append(content(tables.read_table(spark, path)))
    for n, day in enumerate(DAYS[:3]):
        assert content(journal.state_at(spark, path, day)) == seen[n]
        later = day.replace("00:00:00", "13:00:00")
        assert content(journal.state_at(spark, path, later)) == seen[n]
        at = F.lit(day).cast("timestamp")
        held = journal.versions(spark, path).filter((F.col("valid_from") <= at) & F.coalesce(at < F.col("valid_to"), F.lit(True)))
        assert content(held.drop("valid_from", "valid_to")) == seen[n]
    assert journal.state_at(spark, path, "2024-02-01 00:00:00").count() == 0


def test_a_replayed_batch_leaves_no_run(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed = batches(spark)[0].filter("k IS NOT NULL")
    merge(spark, path, keyed, 0)
    assert merge(spark, path, keyed, 1)["touched"] == 0
    assert journal.runs(spark, path).count() == 1 and journal.changes(spark, path).count() == 0


@pytest.mark.parametrize("at", ["apply_stage", "_write"])
def test_a_stop_within_the_journal_is_repaired(spark, tmp_path, monkeypatch, at):
    path, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    b = batches(spark)
    for n in range(2):
        merge(spark, plain, b[n], n)
    merge(spark, path, b[0], 0)
    whole = getattr(journal, at)

    def stop(*args, **kwargs):
        if at == "_write" and not kwargs.get("dynamic"):
            return whole(*args, **kwargs)
        raise RuntimeError("stopped")

    monkeypatch.setattr(journal, at, stop)
    with pytest.raises(RuntimeError, match="stopped"):
        merge(spark, path, b[1], 1)
    monkeypatch.undo()
    assert tables.finish_merge(spark, path)
    assert content(tables.read_table(spark, path)) == content(tables.read_table(spark, plain))
    for day in DAYS[:2]:
        assert content(journal.state_at(spark, path, day)) == content(journal.state_at(spark, plain, day))


def test_a_stop_before_the_stage_is_complete_leaves_no_entry(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    b = batches(spark)
    merge(spark, path, b[0], 0)
    before = content(tables.read_table(spark, path))

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(tables, "_stage_write", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        merge(spark, path, b[1], 1)
    monkeypatch.undo()
    merge(spark, path, b[2], 2)
    assert journal.runs(spark, path).filter("run_id = 'run-1'").count() == 0
    assert content(journal.state_at(spark, path, DAYS[1])) == before


def test_new_columns_are_null_in_earlier_states(spark, tmp_path):
    path = str(tmp_path / "t")
    b = batches(spark)
    merge(spark, path, b[0], 0)
    merge(spark, path, b[1].withColumn("note", F.lit("n")), 1)
    state = journal.state_at(spark, path, DAYS[0])
    assert content(state.drop("note")) == content(b[0]) and state.filter("note IS NOT NULL").count() == 0


def test_journal_of_an_older_table(spark, tmp_path):
    path = str(tmp_path / "t")
    b = batches(spark)
    tables.write_merged(spark, b[0], path, "k", newer="wm", index_buckets=4)
    merge(spark, path, b[1], 1)
    with pytest.raises(JournalError, match="begins after"):
        journal.state_at(spark, path, DAYS[0])
    old = journal.versions(spark, path).filter("valid_from IS NULL")
    assert content(old.select(*b[0].columns)) == content(b[0])


def test_refusals(spark, tmp_path):
    path = str(tmp_path / "t")
    b = batches(spark)
    with pytest.raises(JournalError, match="no journal"):
        journal.state_at(spark, path, DAYS[0])
    merge(spark, path, b[0], 1)
    with pytest.raises(JournalError, match="needs a run"):
        tables.write_merged(spark, b[1], path, "k", newer="wm")
    with pytest.raises(JournalError, match="earlier"):
        merge(spark, path, b[1], 0)
    with pytest.raises(JournalError, match="is by"):
        tables.write_merged(spark, b[1].filter("k IS NOT NULL"), path, "v", run=Run("x", DAYS[2]))


def test_empty_table_and_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    none = batches(spark)[0].limit(0)
    merge(spark, path, none, 0)
    merge(spark, path, none, 1)
    assert journal.state_at(spark, path, DAYS[1]).count() == 0 and journal.versions(spark, path).count() == 0


def test_entries_of_a_table_written_without_a_schema_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    b = batches(spark)
    tables.write_table(b[0], path)
    tables.write_merged(spark, b[1].filter("k = 'new'"), path, "k", newer="wm", commit="stream/0")
    assert tables.read_table(spark, path).count() == b[0].count() + 1


def test_staged_changes_are_moved_and_a_second_time_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    b = batches(spark)
    merge(spark, path, b[0], 0)
    apply, staged = journal.apply_stage, []

    def twice(s, to, stage_dir):
        staged.extend(f.rsplit("/", 1)[1] for f in tables.glob_paths(s, f"{stage_dir}/changes/seq=*/*.parquet"))
        apply(s, to, stage_dir)
        apply(s, to, stage_dir)

    monkeypatch.setattr(journal, "apply_stage", twice)
    merge(spark, path, b[1], 1)
    entered = [f.rsplit("/", 1)[1] for f in tables.glob_paths(spark, f"{path}/_journal/changes/seq=*/*.parquet")]
    assert staged and sorted(entered) == sorted(staged)
