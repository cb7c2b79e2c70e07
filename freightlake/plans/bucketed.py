"""Keyed tables in the session catalog, bucketed by key: merges without a
shuffle of the target.

A path-based table must shuffle both sides of the merge join.  A catalog table
written with ``bucketBy(keys)`` keeps every key in a known bucket file, so the
join reads the touched target partitions bucket by bucket and only the (small)
batch is shuffled into the same buckets.

The merged partitions are first written completely to a stage (in the shared
folder, named after the table) and inserted from there with Spark's dynamic
partition overwrite; the stage goes last, so a run that stopped in between is
finished from it by the next merge, as in ``plans.tables``.  Rows are clustered
by partition and bucket before both writes, so a bucket is one file.

The catalog must be shared by the cluster (a metastore); the warehouse folder
must be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlake.operators.upsert import AmbiguousMergeError, merge_upsert
from freightlake.plans.tables import (
    batch_profile,
    delete_path,
    effective_rows,
    in_partitions,
    partition_dir,
    path_exists,
    touched_values,
)
from freightlake.session import scratch_path, shared_dir


def _by_bucket(df: DataFrame, keys: list[str], part_col: str, buckets: int) -> DataFrame:
    """Rows of one partition and bucket in one task (bucket files are hashed the same way)."""
    return df.repartition(buckets, *keys).sortWithinPartitions(part_col, *keys)


def create_keyed_table(df: DataFrame, table: str, keys: list[str], part_col: str,
                       buckets: int, path: str | None = None) -> None:
    """A partitioned table bucketed and sorted by ``keys``; ``path`` makes it an
    external table at that location (else it lives in the warehouse folder)."""
    w = (_by_bucket(df, keys, part_col, buckets).write.mode("errorifexists")
         .bucketBy(buckets, *keys).sortBy(*keys).partitionBy(part_col))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def _describe(spark: SparkSession, table: str) -> dict:
    return {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _table_buckets(info: dict, table: str) -> int:
    if "Num Buckets" not in info:
        raise ValueError(f"{table} is not bucketed")
    return int(info["Num Buckets"])


def _stage_of(spark: SparkSession, table: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/merge-stage-{table.replace('.', '-')}"


def finish_merge(spark: SparkSession, table: str, keys: list[str], part_col: str) -> bool:
    """Insert a complete stage, drop the partitions it leaves empty, then remove
    the stage; an incomplete one is only removed."""
    stage = _stage_of(spark, table)
    complete = path_exists(spark, f"{stage}/touched/_SUCCESS")
    if complete:
        info = _describe(spark, table)
        touched = [r[0] for r in spark.read.parquet(f"{stage}/touched").collect()]
        merged = spark.read.parquet(f"{stage}/data")
        have = set(spark.table(table).columns)
        for f in merged.schema.fields:
            if f.name not in have:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{f.name}` {f.dataType.simpleString()})")
        # insertInto is positional: the table's order (partition column last)
        rows = _by_bucket(merged.select(*spark.table(table).columns), keys, part_col, _table_buckets(info, table))
        rows.write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)
        present = {r[0] for r in merged.select(F.col(part_col).cast("string")).distinct().collect()}
        for value in touched:
            if value not in present:
                literal = "null" if value is None else f"'{value}'"
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({part_col} = {literal})")
                if info.get("Type") == "EXTERNAL":  # an external table keeps dropped files
                    delete_path(spark, partition_dir(info["Location"], part_col, value))
    delete_path(spark, f"{stage}/touched")  # first: a stage without it counts as incomplete
    delete_path(spark, stage)
    return complete


def merge_into_table(spark: SparkSession, source: DataFrame, table: str, keys: list[str] | str,
                     newer: str | None, part_col: str, buckets: int = 64) -> dict:
    """M1/M3/M4 + K2 on a bucketed catalog table; creates it on the first run.
    New source columns are added to the table (V3)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    snap = scratch_path(spark, "merge-source")
    source.write.parquet(snap)
    batch = spark.read.schema(source.schema).parquet(snap)
    most, key_range = batch_profile(batch, keys)
    if most > 1:
        raise AmbiguousMergeError(f"a source key repeats ({most} rows for one key)")
    if not spark.catalog.tableExists(table):
        create_keyed_table(batch, table, keys, part_col, buckets)
        delete_path(spark, snap)
        return {"touched": -1, "emptied": 0}
    finish_merge(spark, table, keys, part_col)
    n = _table_buckets(_describe(spark, table), table)
    target = spark.table(table)
    changed = scratch_path(spark, "merge-changes")
    effective_rows(target, batch.repartition(n, *keys), keys, newer, part_col, key_range).write.parquet(changed)
    effective = spark.read.parquet(changed)
    touched = touched_values(effective, part_col)
    emptied = 0
    if touched:
        rows = effective.drop("_old", "_hit").repartition(n, *keys)  # into the table's buckets
        merged = merge_upsert(target.filter(in_partitions(part_col, touched)), rows, keys, salt_null_keys=False)
        stage = _stage_of(spark, table)
        merged.write.mode("overwrite").parquet(f"{stage}/data")
        present = {r[0] for r in spark.read.parquet(f"{stage}/data").select(F.col(part_col).cast("string")).distinct().collect()}
        names = [None if v is None else str(v) for v in touched]
        emptied = sum(v not in present for v in names)
        spark.createDataFrame([(v,) for v in names], "part string").coalesce(1).write.parquet(f"{stage}/touched")
        finish_merge(spark, table, keys, part_col)
    delete_path(spark, changed)
    delete_path(spark, snap)
    return {"touched": len(touched), "emptied": emptied}
