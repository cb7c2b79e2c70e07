"""Small files of a written table packed into files near a target size.

Streams that flush often leave many small files.  ``pack_files`` lists them with their
sizes (a scan of file metadata, no content is read), fills bins folder by folder and
rewrites each bin of two or more files as one file, in one Spark job with one task for
each bin.  A file is small below half the target; a bin takes the small files whose
running size starts within one half of the target, so no bin holds more than the target
and a folder of B bytes ends with at most 2 * B / target + 1 files.

A run that stops is repaired: packed files first stand in ``_pack_stage`` (hidden from
readers) with the plan; a marker says that they are whole.  Without it the stage is
dropped and nothing has happened; with it ``finish_pack`` moves each packed file that is
still there and deletes the files it replaces, as often as needed.  A reader between a
move and its deletes sees the rows of that bin twice (no table format is installed), and
nothing else may write to the folders meanwhile.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.plans import tables
from freightlake.session import scratch_path

STAGE = "_pack_stage"
TARGET_BYTES = 128 * 1024 * 1024


def list_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """(file, bytes, folder) of every data file below ``path``; hidden folders are left out."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", f"*{suffix}").load(path))
    return (files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
            .withColumn("folder", F.regexp_replace("file", "/[^/]*$", "")))


def plan_bins(files: DataFrame, target_bytes: int = TARGET_BYTES, batch_col: str | None = None,
              before_batch: int | None = None) -> DataFrame:
    """(file, bytes, folder, group, slot): the small files that share a bin with another one.

    ``batch_col`` names the last partition level of folders that a stream writes by batch:
    files of several batches below one parent are packed together, into the folder of one
    of them.  ``before_batch`` leaves out that batch and later ones, which a restarted
    stream may still write again."""
    half = max(1, target_bytes // 2)
    small = files.filter(F.col("bytes") < half)
    group = F.col("folder")
    if batch_col:
        if before_batch is not None:
            small = small.filter(F.regexp_extract("folder", f"/{batch_col}=(\\d+)$", 1).try_cast("long") < before_batch)
        group = F.regexp_replace("folder", f"/{batch_col}=[^/]*$", "")
    small = small.withColumn("group", group)
    before = F.sum("bytes").over(Window.partitionBy("group").orderBy("file")
                                 .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    binned = small.withColumn("slot", F.floor(before / F.lit(half)).cast("long"))
    alone = F.count(F.lit(1)).over(Window.partitionBy("group", "slot"))
    return binned.withColumn("_n", alone).filter("_n > 1").drop("_n")


def pack_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, batch_col: str | None = None,
               before_batch: int | None = None, schema: T.StructType | None = None, stop_before: str | None = None) -> DataFrame:
    """Pack the small files below ``path``; returns a row (folder, n_files, bytes) for each
    packed file.  ``schema`` is that of the files without partition columns (None: merged
    from their footers).  ``stop_before`` ("ready", "move" or "delete") ends the run
    there, for tests of the repair."""
    path = path.rstrip("/")
    finish_pack(spark, path)
    stage = f"{path}/{STAGE}"
    plan = plan_bins(list_files(spark, path), target_bytes, batch_col, before_batch)
    bins = plan.groupBy("group", "slot").agg(F.min("folder").alias("target"), F.count(F.lit(1)).alias("n_files"),
                                             F.sum("bytes").alias("bytes"))
    # dense bin numbers: numbered within the folder, shifted by the folders before (a row each)
    folders = bins.groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
    folders = folders.withColumn("_first", F.sum("_n").over(Window.orderBy("group")) - F.col("_n")).drop("_n")
    bins = (bins.withColumn("_at", F.row_number().over(Window.partitionBy("group").orderBy("slot")) - 1)
            .join(folders, "group").withColumn("bin", (F.col("_first") + F.col("_at")).cast("int")).drop("_first", "_at"))
    bins.write.mode("overwrite").parquet(f"{stage}/bins")
    bins = spark.read.parquet(f"{stage}/bins")
    plan.join(bins.select("group", "slot", "bin"), ["group", "slot"]).select("file", "bin").write.mode("overwrite").parquet(f"{stage}/files")
    n = bins.count()
    if n:
        files = spark.read.parquet(f"{stage}/files")
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        data = (reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)).parquet(path)
        mark = f"_bin_{uuid.uuid4().hex[:8]}"
        small = (data.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"))
                 .filter(F.col("_size") < max(1, target_bytes // 2)))
        rows = small.join(files.select(F.col("file").alias("_file"), F.col("bin").alias(mark)), "_file").drop("_file", "_size")
        rows.repartitionById(n, F.col(mark).cast("int")).write.mode("overwrite").partitionBy(mark).parquet(f"{stage}/data")
    kept = scratch_path(spark, "pack-report")  # the stage goes with the end of the run
    bins.select(F.col("target").alias("folder"), "n_files", "bytes").write.parquet(kept)
    report = spark.read.parquet(kept)
    if stop_before == "ready":
        return report
    tables.touch(spark, f"{stage}/READY")
    finish_pack(spark, path, stop_before)
    return report


def _uri(spark: SparkSession, uri: str):
    """File system and path of a file URI as Spark's file metadata gives it (escaped)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(uri))
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def finish_pack(spark: SparkSession, path: str, stop_before: str | None = None) -> None:
    """Finish or drop what a stopped run left; nothing to do without a stage.  The bins and
    their files are read as a stream of rows, never whole."""
    stage = f"{path.rstrip('/')}/{STAGE}"
    if not tables.path_exists(spark, stage):
        return
    if tables.path_exists(spark, f"{stage}/READY") and stop_before != "move":
        jvm = spark.sparkContext._jvm
        targets = spark.read.parquet(f"{stage}/bins").select("bin", "target")
        if tables.path_exists(spark, f"{stage}/data"):
            moved = list_files(spark, f"{stage}/data").withColumn("bin", F.regexp_extract("folder", r"=(\d+)$", 1).cast("int"))
            for r in moved.join(targets, "bin").select("file", "target").toLocalIterator():
                fs, source = _uri(spark, r["file"])
                _, folder = _uri(spark, r["target"])
                if fs.exists(source) and not fs.rename(source, jvm.org.apache.hadoop.fs.Path(folder, f"packed-{source.getName()}")):
                    raise OSError(f"packed file not moved: {r['file']}")
        if stop_before == "delete":
            return
        for r in spark.read.parquet(f"{stage}/files").select("file").toLocalIterator():
            fs, old = _uri(spark, r["file"])
            fs.delete(old, False)
            if fs.exists(old.getParent()) and not fs.listStatus(old.getParent()):
                fs.delete(old.getParent(), False)
    elif stop_before == "move":
        return
    tables.delete_path(spark, stage)
