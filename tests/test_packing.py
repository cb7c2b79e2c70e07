"""Packing of small files: bins within the bound, equal rows, repair after a stop."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from freightlake.plans import packing


def _landed(spark, path, batches=4, days=3, rows=40):
    """Small files in ``date=/batch_id=`` folders; some dates are NULL, one folder name is escaped."""
    for b in range(batches):
        df = spark.range(rows).select(
            (F.col("id") + b * rows).alias("id"), F.repeat(F.lit("x"), 50).alias("t"),
            F.when(F.col("id") % 7 != 0, F.concat(F.lit("day "), F.col("id") % days)).alias("date"), F.lit(b).alias("batch_id"))
        df.coalesce(1).write.mode("append").partitionBy("date", "batch_id").parquet(path)


def _files(path):
    return sorted(f for f in glob.glob(f"{path}/**/*.parquet", recursive=True) if packing.STAGE not in f)


def _rows(spark, path):
    return sorted((r.id, r.t, str(r.date)) for r in spark.read.parquet(path).collect())


def test_files_of_batches_are_packed_by_date(spark, tmp_path):
    path = str(tmp_path / "landed")
    _landed(spark, path)
    before, n = _rows(spark, path), len(_files(path))
    done = packing.pack_files(spark, path, batch_col="batch_id").collect()
    assert n == 16 and len(_files(path)) == 4 and len(done) == 4
    assert _rows(spark, path) == before
    assert sum(r.n_files for r in done) == n
    assert len([d for d in glob.glob(f"{path}/*/*") if os.path.isdir(d)]) == 4  # emptied batch folders are gone
    assert packing.pack_files(spark, path, batch_col="batch_id").count() == 0  # nothing left to do
    assert _rows(spark, path) == before


def test_without_batches_and_last_batch_left_alone(spark, tmp_path):
    path = str(tmp_path / "landed")
    _landed(spark, path, batches=3)
    assert packing.pack_files(spark, path).count() == 0  # one file in each folder
    before = _rows(spark, path)
    packing.pack_files(spark, path, batch_col="batch_id", before_batch=2)
    assert len([f for f in _files(path) if "batch_id=2" in f]) == 4
    assert len(_files(path)) == 8 and _rows(spark, path) == before


def test_no_bin_above_the_target(spark, tmp_path):
    path = str(tmp_path / "landed")
    for i in range(30):
        spark.range(i * 30 + 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"), F.lit("d").alias("date")) \
            .coalesce(1).write.mode("append").partitionBy("date").parquet(path)
    before = _rows(spark, path)
    sizes = [os.path.getsize(f) for f in _files(path)]
    target = 2 * max(sizes) // 3 * 2
    done = packing.pack_files(spark, path, target_bytes=target).collect()
    assert done and all(r.n_files > 1 and r.bytes <= target for r in done)
    assert len(_files(path)) <= 2 * sum(sizes) / target + 1 and len(_files(path)) < 30
    assert _rows(spark, path) == before


def test_large_files_stay(spark, tmp_path):
    path = str(tmp_path / "landed")
    _landed(spark, path, batches=2)
    names = _files(path)
    assert packing.pack_files(spark, path, target_bytes=200, batch_col="batch_id").count() == 0
    assert _files(path) == names


def test_files_of_other_columns_meet(spark, tmp_path):
    path = str(tmp_path / "landed")
    spark.createDataFrame([(1, "d")], "id long, date string").write.partitionBy("date").parquet(path)
    spark.createDataFrame([(2, "d", "new")], "id long, date string, extra string").write.mode("append").partitionBy("date").parquet(path)
    packing.pack_files(spark, path)
    assert len(_files(path)) == 1
    assert sorted((r.id, r.extra) for r in spark.read.parquet(path).collect()) == [(1, None), (2, "new")]


@pytest.mark.parametrize("stop", ["ready", "move", "delete"])
def test_stopped_runs_are_repaired(spark, tmp_path, stop):
    path = str(tmp_path / "landed")
    _landed(spark, path)
    before = _rows(spark, path)
    packing.pack_files(spark, path, batch_col="batch_id", stop_before=stop)
    assert os.path.exists(f"{path}/{packing.STAGE}")
    if stop != "delete":  # nothing is visible before the packed files move
        assert _rows(spark, path) == before
    packing.finish_pack(spark, path)
    assert not os.path.exists(f"{path}/{packing.STAGE}")
    assert _rows(spark, path) == before
    assert len(_files(path)) == (16 if stop == "ready" else 4)
    packing.finish_pack(spark, path)  # nothing to do
