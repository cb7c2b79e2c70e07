"""Structured Streaming operators: T1-T9, J8, J9, A11.

Sources are file streams (no socket or broker is opened); sinks are Parquet
folders or ``foreachBatch`` writers whose output is keyed by batch id or merged
by key, so a replayed batch after a restart gives the same table (T9).
Checkpoints live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from freightlake.functions.expressions import status_norm
from freightlake.operators.dedup import latest_per_key
from freightlake.plans import tables
from freightlake.sources.driver_tables import STATUS_BY_EVENT_TYPE, case_map
from freightlake.sources.raw import CORRUPT


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                file_glob: str | None = None, max_files_per_trigger: int | None = None,
                corrupt_column: str | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream with an explicit schema.  ``max_bytes_per_trigger`` (say, 128 MiB)
    bounds a micro-batch by size (T1): it takes files until the next one would pass it, one
    at least; together with a processing-time trigger it flushes by size or time."""
    r = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if corrupt_column:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    return r.load(path)


def event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (with session zone, UTC); driver data is NTZ."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def run_available_now(writer) -> StreamingQuery:
    """Process everything available, then stop (tests, backfills, batch-like runs)."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def to_parquet_sink(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                    partition_by: list[str] | None = None, processing_time: str | None = None):
    """T1 sink: Parquet files with exactly-once file commit log.

    ``processing_time`` (e.g. "5 minutes") runs continuously; None runs
    ``availableNow`` and returns when done.
    """
    w = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    return run_available_now(w)


def windowed_counts(stream: DataFrame, ts_col: str, window: str, delay: str,
                    by: list[str], value_col: str | None = None) -> DataFrame:
    """Tumbling event-time windows closed by the watermark.

    In append mode a window is emitted once the watermark (max event time seen
    minus ``delay``) passes its end; rows later than that are dropped.  Windows
    still open when the input ends are not in the output: that is what append
    mode means, the next rows of the stream close them.
    """
    aggs = [F.count(F.lit(1)).alias("n_events")]
    if value_col:
        aggs.append(F.sum(F.col(value_col).try_cast("decimal(18,2)")).cast("double").alias("value_sum"))
    w = (stream.withWatermark(ts_col, delay)
         .groupBy(F.window(ts_col, window).alias("w"), *by).agg(*aggs))
    return w.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *by, *[a for a in ("n_events", "value_sum") if a in w.columns])


def window_partials_writer(path: str, ts_col: str, window: str, delay: str, by: list[str], value_col: str | None = None):
    """T8 ``foreachBatch``: partial window aggregates of every batch, its late rows apart.

    The watermark of a batch is the highest event time of all batches before it minus
    ``delay``, as in ``windowed_counts``; a row is late if its window ended by then.  A
    batch writes one row for each window and group, on time or late, below its own id, and
    then its watermark: a replay writes the same folders again.  ``merged_windows`` adds
    the partials up, ``late_row_metrics`` counts late rows by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if tables.path_exists(spark, f"{path}/watermark"):
            marks = spark.read.parquet(f"{path}/watermark").filter(F.col("batch_id") < batch_id)
            before = marks.agg(F.max("newest")).first()[0]
        w = F.window(ts_col, window)
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        aggs = [F.count(F.lit(1)).alias("n_events")]
        if value_col:
            aggs.append(F.sum(F.col(value_col).try_cast("decimal(18,2)")).alias("value_sum"))
        parts = (batch.filter(F.col(ts_col).isNotNull()).groupBy(w.alias("w"), *by).agg(*aggs, F.max(ts_col).alias("_newest"))
                 .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                         *[c for c in ("n_events", "value_sum") if c == "n_events" or value_col], "_newest",
                         F.coalesce(F.col("w.end") <= mark, F.lit(False)).alias("late"), F.lit(batch_id).alias("batch_id")))
        seen = Observation(f"newest-{uuid.uuid4().hex[:8]}")
        (parts.observe(seen, F.max("_newest").alias("newest")).drop("_newest").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{path}/partials"))
        newest = seen.get["newest"]
        newest = max([x for x in (newest, before) if x is not None], default=None)
        (spark.createDataFrame([(newest, batch_id)], "newest timestamp, batch_id long").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{path}/watermark"))

    return write


def merged_windows(spark: SparkSession, path: str, delay: str) -> DataFrame:
    """T8 read: windows that the last watermark has closed, late rows added, with their number."""
    parts = spark.read.parquet(f"{path}/partials")
    newest = spark.read.parquet(f"{path}/watermark").agg(F.max("newest").alias("_newest"))
    by = [c for c in parts.columns if c not in ("n_events", "value_sum", "late", "batch_id")]
    aggs = [F.sum("n_events").alias("n_events")]
    if "value_sum" in parts.columns:
        aggs.append(F.sum("value_sum").cast("double").alias("value_sum"))
    aggs.append(F.sum(F.when(F.col("late"), F.col("n_events")).otherwise(0)).alias("n_late"))
    closed = F.col("window_end") <= F.col("_newest") - F.expr(f"INTERVAL {delay}")
    return parts.groupBy(*by).agg(*aggs).join(F.broadcast(newest), closed).drop("_newest")  # one row


def late_row_metrics(spark: SparkSession, path: str, domain: str, now) -> DataFrame:
    """A10: LateRows of each batch as metric rows."""
    from freightlake.operators.metrics import NAMESPACE
    parts = spark.read.parquet(f"{path}/partials")
    n = parts.groupBy("batch_id").agg(F.sum(F.when(F.col("late"), F.col("n_events")).otherwise(0)).cast("double").alias("value"))
    return n.select(F.lit(NAMESPACE).alias("namespace"), F.lit("LateRows").alias("metric"), F.lit(domain).alias("domain"), "value",
                    F.lit("Count").alias("unit"), F.lit(str(now)).cast("timestamp").alias("ts"), "batch_id")


def durable_state(spark: SparkSession) -> None:
    """Stateful operators keep their state in RocksDB, with changelog checkpoints: each
    batch writes the changes only, and a restart loads the last snapshot and replays them."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def dedup_stream(stream: DataFrame, keys: list[str], ts_col: str, delay: str) -> DataFrame:
    """T6 (stateful form): drop repeats of a key seen within the watermark delay."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(keys)


def enrich_stream(stream: DataFrame, wagons: DataFrame, contracts: DataFrame) -> DataFrame:
    """Stream-static left joins with the current dimensions."""
    out = stream.join(wagons.select("vagao_id", "tipo_vagao"), "vagao_id", "left")
    return out.join(contracts.select("contrato_id", "cliente_nome", "segmento", "sla_horas"),
                    "contrato_id", "left")


def interval_join(starts: DataFrame, ends: DataFrame, key: str, start_ts: str, end_ts: str,
                  max_gap: str, delay: str, how: str = "inner") -> DataFrame:
    """Stream-stream join of start and end events of a key with
    ``start <= end <= start + gap``.

    ``how="left_outer"`` also emits starts without an end, once the watermark (the
    smaller of both sides) has passed their gap and their state expires; starts whose
    gap is still open when the input ends stay in the state.

    Both sides carry watermarks, so join state older than the bound is dropped.
    A key's events within one gap are paired with each other.
    """
    s = starts.withWatermark(start_ts, delay).alias("s")
    e = ends.withColumnRenamed(key, f"_e_{key}").withWatermark(end_ts, delay).alias("e")
    cond = ((F.col(f"s.{key}") == F.col(f"e._e_{key}"))
            & (F.col(f"e.{end_ts}") >= F.col(f"s.{start_ts}"))
            & (F.col(f"e.{end_ts}") <= F.col(f"s.{start_ts}") + F.expr(f"INTERVAL {max_gap}")))
    return s.join(e, cond, how).drop(f"_e_{key}")


def batch_lag_metrics(batch: DataFrame, ts_col: str, domain: str, now=None) -> DataFrame:
    """Per micro-batch, how far the newest event lags the processing
    instant (``IteratorAgeMilliseconds``) and how many records it held, as
    metric rows (one aggregate over the batch).  ``now=None`` uses the batch's
    processing time."""
    from freightlake.operators.metrics import NAMESPACE
    now_ts = F.current_timestamp() if now is None else F.lit(str(now)).cast("timestamp")
    agg = batch.agg(F.max(F.col(ts_col).cast("timestamp")).alias("_newest"),
                    F.count(F.lit(1)).alias("_n"))
    lag_ms = (F.unix_micros(now_ts) - F.unix_micros("_newest")) / F.lit(1000.0)
    rows = F.array(
        F.struct(F.lit("IteratorAgeMilliseconds").alias("metric"), lag_ms.alias("value"),
                 F.lit("Milliseconds").alias("unit")),
        F.struct(F.lit("RecordsProcessed").alias("metric"), F.col("_n").cast("double").alias("value"),
                 F.lit("Count").alias("unit")))
    return agg.filter(F.col("_n") > 0).select(F.explode(rows).alias("m")).select(
        F.lit(NAMESPACE).alias("namespace"), "m.metric", F.lit(domain).alias("domain"),
        "m.value", "m.unit", now_ts.alias("ts"))


def landing_batch_writer(good_path: str, error_path: str, date_col: str, ts_col: str | None,
                         metrics_path: str | None = None, domain: str = "landing", now=None):
    """T1 + T2 ``foreachBatch``: parsed rows to ``good_path`` by date, malformed
    rows (raw text, error type, source file, landing date) to ``error_path`` by
    landing date and error type.  The layout is ``date=.../batch_id=...``: the
    date leads, and a batch overwrites only the folders of its own id, so a
    replay is idempotent.

    The date of good rows is the event date of ``ts_col``; ``ts_col=None`` uses
    the arrival date.  ``now`` fixes the landing instant (default: the batch's
    processing time).  The batch may carry ``_source_file``.  With
    ``metrics_path`` each batch also writes its lag metrics."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            landed = F.current_date() if now is None else F.to_date(F.lit(str(now)))
            day = landed if ts_col is None else F.to_date(F.col(ts_col))
            if "_source_file" not in batch.columns:
                batch = batch.withColumn("_source_file", F.lit(None).cast("string"))
            good = batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_source_file").withColumns(
                {date_col: day, "batch_id": F.lit(batch_id)})
            bad = batch.filter(F.col(CORRUPT).isNotNull()).select(
                F.col(CORRUPT).alias("_raw"), "_source_file", landed.alias(date_col),
                F.lit("malformed_record").alias("error_type"), F.lit(batch_id).alias("batch_id"))
            for rows, path, parts in ((good, good_path, [date_col, "batch_id"]),
                                      (bad, error_path, [date_col, "error_type", "batch_id"])):
                (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(*parts).parquet(path))
            if metrics_path and ts_col:
                (batch_lag_metrics(good, ts_col, domain, now).write.mode("overwrite")
                 .parquet(f"{metrics_path}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    return write


def upsert_batch_writer(spark: SparkSession, table_path: str, keys: list[str], watermark: str,
                        tie_breaks: list[str] | None = None, part_col: str = "_partition_date",
                        part_unit: str = "day", ledger: str | None = "upsert"):
    """T6 ``foreachBatch``: latest row per key within the batch (W1), then a
    touched-partition merge (M1/K2) into the bronze table, partitioned by the
    watermark's day (or month for tables spanning years).  ``ledger`` names the
    stream in the table's ledger (T9): a batch that is in the table is not merged again
    when it is replayed (rows with a NULL key would be inserted again).  A stream with a
    new checkpoint counts its batches anew and needs a new name; None keeps no ledger."""

    def write(batch: DataFrame, batch_id: int) -> None:
        commit = f"{ledger}/{batch_id}" if ledger else None
        if commit and tables.is_committed(spark, table_path, commit):
            return
        latest = latest_per_key(batch, keys, watermark, tie_breaks)
        part = (F.to_date(F.col(watermark)) if part_unit == "day"
                else F.trunc(F.col(watermark), part_unit))
        latest = latest.withColumn(part_col, part)
        tables.write_merged(spark, latest, table_path, keys, newer=watermark, part_col=part_col,
                            commit=commit)

    return write


def status_batch_writer(spark: SparkSession, table_path: str, ttl_hours: int = 24, ledger: str | None = "status"):
    """T7 ``foreachBatch``: hot status rows keyed (vagao_id, updated_at) with
    ``expires_at = updated_at + ttl``; merged by key, each batch once (``ledger``
    as in ``upsert_batch_writer``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        commit = f"{ledger}/{batch_id}" if ledger else None
        if commit and tables.is_committed(spark, table_path, commit):
            return
        rows = latest_per_key(batch, ["vagao_id", "updated_at"], "updated_at", ["evento_id"])
        rows = rows.withColumns({
            "expires_at": F.col("updated_at") + F.expr(f"INTERVAL {ttl_hours} HOURS"),
            "_partition_date": F.to_date("updated_at"),
        })
        tables.write_merged(spark, rows, table_path, ["vagao_id", "updated_at"], newer=None, commit=commit)

    return write


def current_status(status_table: DataFrame, as_of, ttl_hours: int = 24) -> DataFrame:
    """T7 read: rows seen by ``as_of`` and not expired, latest per wagon.

    Only the date partitions a live row can be in (as_of - ttl .. as_of) are
    scanned: the partition predicate prunes at planning time.
    """
    t = F.lit(str(as_of)).cast(status_table.schema["updated_at"].dataType)
    live = status_table.filter((F.col("updated_at") <= t) & (F.col("expires_at") > t))
    if "_partition_date" in status_table.columns:
        oldest = F.to_date(t - F.expr(f"INTERVAL {ttl_hours} HOURS"))
        live = live.filter((F.col("_partition_date") >= oldest) & (F.col("_partition_date") <= F.to_date(t)))
    return latest_per_key(live, ["vagao_id"], "updated_at", ["evento_id"])


def expire_status(spark: SparkSession, table_path: str, as_of, ttl_hours: int = 24) -> list[str]:
    """T7 TTL: delete whole date partitions whose rows have all expired at
    ``as_of`` (every row of day d expires by d + 1 day + ttl).  Listing only;
    no data is read.  Returns the removed partition folders."""
    import datetime as _dt
    cutoff = (_dt.datetime.fromisoformat(str(as_of)) - _dt.timedelta(hours=ttl_hours)).date()
    removed = []
    for p in tables.glob_paths(spark, f"{table_path.rstrip('/')}/_partition_date=*"):
        name = p.rstrip("/").rsplit("=", 1)[1]
        if name != tables.NULL_PARTITION and _dt.date.fromisoformat(name) < cutoff:
            tables.delete_path(spark, p)
            removed.append(p)
    return removed


def run_foreach_batch(df: DataFrame, fn, checkpoint: str) -> StreamingQuery:
    return run_available_now(df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint))


EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def normalised_event_stream(spark: SparkSession, path: str, file_glob: str | None = "events.parquet",
                            max_files_per_trigger: int | None = None,
                            max_bytes_per_trigger: int | None = None) -> DataFrame:
    """The driver's events table (or folder of its rows) as a file stream, in domain columns."""
    s = file_stream(spark, path, EVENT_SCHEMA, file_glob=file_glob, max_files_per_trigger=max_files_per_trigger,
                    max_bytes_per_trigger=max_bytes_per_trigger)
    status = case_map("event_type", STATUS_BY_EVENT_TYPE, keep_other=True)
    return s.select(
        F.col("event_id").alias("evento_id"), F.col("user_id").alias("vagao_id"),
        F.col("user_id").alias("contrato_id"), status_norm(status).alias("status_norm"),
        F.col("ts").cast("timestamp").alias("updated_at"), "value")
