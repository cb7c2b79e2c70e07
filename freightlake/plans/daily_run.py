"""One processing day end to end: raw drop -> bronze -> silver -> gate -> gold.

Each layer is a partitioned Parquet table under ``Layout.root``; every write
touches only the partitions of the run (K2), the gate runs on the stored rows of
the run before anything reaches gold (Q8), alert rows are written before it
raises (Q9), and the mart is rebuilt from the fact table (K7).  The drop is read
once and the joins run once: bronze and silver rows of the run are written and
read back by everything after them.  Clock, date and run id are parameters.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.operators import dims, gold, metrics, quality
from freightlake.operators.dedup import latest_per_key
from freightlake.operators.enrich import transform_silver
from freightlake.operators.schema_ops import (
    SchemaValidationError,
    add_audit,
    require_columns,
    schema_drift,
)
from freightlake.operators.upsert import assert_unique_source
from freightlake.plans import key_index, tables
from freightlake.session import scratch_path
from freightlake.sources import dead_letter
from freightlake.sources.raw import CORRUPT, complete_day_dirs, format_for_path, read_raw

PK, WATERMARK = "evento_id", "updated_at"


@dataclass(frozen=True)
class Layout:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self): return self.path("bronze/eventos_ferroviarios")  # noqa: E704
    @property
    def silver(self): return self.path("silver/fato_eventos_ferroviarios")  # noqa: E704
    @property
    def fact(self): return self.path("gold/fct_eventos_ferroviarios")  # noqa: E704
    @property
    def mart(self): return self.path("gold/mart_sla_violations")  # noqa: E704
    @property
    def control(self): return self.path("control/pipeline_control")  # noqa: E704
    @property
    def metrics(self): return self.path("control/metrics")  # noqa: E704
    @property
    def alerts(self): return self.path("control/alerts")  # noqa: E704
    @property
    def quarantine(self): return self.path("quarantine/eventos_ferroviarios")  # noqa: E704


def ingest(spark: SparkSession, raw_path: str, path: str, domain: str, pk: str, watermark: str, run_id: str, now: str,
           fmt: str | None = None, schema: T.StructType | None = None, require_success: bool = False,
           quarantine_path: str | None = None, dead_letter_path: str | None = None, index_buckets: int | None = key_index.BUCKETS) -> dict:
    """Raw -> bronze for any domain (events, wagons, contracts).

    Reads the drop once (with ``schema`` no types are inferred, and malformed
    JSON or CSV lines go to ``quarantine_path``; with ``dead_letter_path`` fields of JSON
    lines that the schema does not name or that have another type go, counted by path,
    there and into the rows' ``_rescued`` column; ``require_success`` reads complete
    ``date=`` folders only), keeps the latest row of each key (ties by all other
    columns, so every evaluation keeps the same row), adds the audit columns and
    writes the result once.  The merge (M1) and the caller read that copy.

    Returns its DataFrame (``rows``), path and counters.
    """
    given = fmt or format_for_path(raw_path)
    if schema is not None and dead_letter_path is not None and given == "json":
        paths = complete_day_dirs(spark, raw_path) if require_success else [raw_path]
        raw, bad = dead_letter.read_rescued(spark, paths, schema, raw_path if require_success else None)
        stamp = [F.lit(run_id).alias("_job_run_id"), F.to_date(F.lit(str(now))).alias("_partition_date")]
        dead_letter.dead_letters(raw).select("*", *stamp).write.mode("append").parquet(dead_letter_path)
        if quarantine_path is not None:
            bad.select("_raw", "_error", "_source_file", *stamp).write.mode("append").parquet(quarantine_path)
        raw = raw.drop("_unfit")
    elif schema is not None and quarantine_path is not None and given in ("json", "csv"):
        full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        parsed = read_raw(spark, raw_path, given, full, require_success=require_success, corrupt_column=CORRUPT)
        kept_parse = scratch_path(spark, f"{domain}-parsed")
        parsed.withColumn("_source_file", F.input_file_name()).write.parquet(kept_parse)
        parsed = spark.read.parquet(kept_parse)
        (parsed.filter(F.col(CORRUPT).isNotNull())
         .select(F.col(CORRUPT).alias("_raw"), F.lit("malformed_record").alias("_error"), "_source_file",
                 F.lit(run_id).alias("_job_run_id"), F.to_date(F.lit(str(now))).alias("_partition_date"))
         .write.mode("append").parquet(quarantine_path))
        raw = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_source_file")
    else:
        raw = read_raw(spark, raw_path, fmt, schema, require_success=require_success)
    raw = require_columns(raw, [pk, watermark])
    ties = [f.name for f in raw.schema.fields if f.name not in (pk, watermark) and not isinstance(f.dataType, T.MapType)]
    raw, raw_obs = metrics.observed(raw, "raw")
    rows, kept_obs = metrics.observed(
        add_audit(latest_per_key(raw, pk, watermark, ties), domain, watermark, run_id, now), "bronze")
    staged = scratch_path(spark, f"{domain}-bronze")
    rows.write.parquet(staged)
    n_raw, n_kept = raw_obs.get["rows"], kept_obs.get["rows"]
    stored = spark.read.schema(rows.schema).parquet(staged)
    tables.write_merged(spark, stored, path, pk, newer=watermark, snapshot=False, index_buckets=index_buckets)
    return {"rows": stored, "path": staged, "schema": raw.schema,
            "counters": {"RawRecordsRead": n_raw, "DuplicatesRemoved": n_raw - n_kept, "BronzeRecordsWritten": n_kept}}


def run_day(spark: SparkSession, raw_path: str, wagons: DataFrame, contracts: DataFrame,
            layout: Layout, processing_date: str | _dt.date, now: str, run_id: str,
            fmt: str | None = None, min_rows: int | None = quality.MIN_ROWS,
            fail_on_error: bool = True, lookback_days: int = 3,
            mart_lookback_days: int = 90, contract: T.StructType | None = None,
            schema: T.StructType | None = None, require_success: bool = False,
            index_buckets: int | None = key_index.BUCKETS) -> dict:
    """Process one raw drop; returns the run's gate failures and schema drift.

    ``min_rows=None`` takes the volume threshold from the history in the
    metrics table (0.7 x the average of earlier runs).  ``schema`` is read with
    explicitly; ``contract`` (a schema) adds a drift report; a drift never stops
    the run, a missing key or watermark column does (and is counted as
    SchemaValidationFailure).  Repeated wagon or contract keys stop it, too.
    ``index_buckets`` sizes the key indexes of the three merged tables (None: none).
    Alert rows are written before a failed gate raises.  JobSuccess / JobFailure
    rows are appended to the metrics table.
    """
    domain = "eventos_ferroviarios"
    try:
        out = _run_day(spark, raw_path, wagons, contracts, layout, processing_date, now, run_id,
                       fmt, min_rows, fail_on_error, lookback_days, mart_lookback_days, contract,
                       schema, require_success, index_buckets)
    except Exception as e:
        counters = {"JobFailure": 1}
        if isinstance(e, SchemaValidationError):
            counters["SchemaValidationFailure"] = 1
        metrics.metric_rows(spark, counters, domain, now).write.mode("append").parquet(layout.metrics)
        raise
    metrics.metric_rows(spark, {"JobSuccess": 1}, domain, now).write.mode("append").parquet(layout.metrics)
    return out


def _run_day(spark, raw_path, wagons, contracts, layout, processing_date, now, run_id, fmt,
             min_rows, fail_on_error, lookback_days, mart_lookback_days, contract, schema, require_success,
             index_buckets) -> dict:
    domain = "eventos_ferroviarios"
    assert_unique_source(wagons, ["vagao_id"])
    assert_unique_source(contracts, ["contrato_id"])
    if min_rows is None:
        min_rows = (quality.min_rows_from_history(spark.read.parquet(layout.metrics), domain)
                    if tables.path_exists(spark, layout.metrics) else quality.MIN_ROWS)
    bronze = ingest(spark, raw_path, layout.bronze, domain, PK, WATERMARK, run_id, now, fmt, schema,
                    require_success, layout.quarantine, index_buckets=index_buckets)
    drift = []
    if contract is not None:
        empty = spark.createDataFrame([], bronze["schema"])
        drift = [r.asDict() for r in schema_drift(spark, empty, contract).collect()]
    # silver: the run's rows, enriched and written once; a re-run always wins (its
    # rows replace what an earlier run left, whatever its instant was)
    silver_path = scratch_path(spark, "silver-run")
    transform_silver(bronze["rows"], wagons, contracts, now).write.parquet(silver_path)
    silver_rows = spark.read.parquet(silver_path)
    tables.write_merged(spark, silver_rows, layout.silver, PK, snapshot=False, index_buckets=index_buckets)
    # gate on the stored rows of this run (one aggregate), before gold; alerts first
    failures = quality.gate_failures(quality.gate_counts(silver_rows), min_rows=min_rows)
    found = quality.gate(failures, fail_on_error=False)
    if found:
        stored = spark.createDataFrame([(f["rule"], f["severity"], f["message"], f["threshold"], f["actual"]) for f in found],
                                       "rule string, severity string, message string, threshold string, actual string")
        (quality.alert_payload(stored, "silver.fato_eventos_ferroviarios", processing_date, now)
         .select(F.lit(run_id).alias("run_id"), F.to_date(F.lit(str(processing_date))).alias("processing_date"), "payload")
         .write.mode("append").parquet(layout.alerts))
    quality.raise_on_blocking(found, fail_on_error)
    # gold: rebuild the lookback window of the fact and merge it (K9/M3)
    # (the first run, with no fact table yet, is a full build)
    stg = gold.stg_events(tables.read_table(spark, layout.silver))
    if tables.path_exists(spark, layout.fact):
        stg = stg.filter(F.col("data_particao")
                         >= F.date_sub(F.lit(str(processing_date)).cast("date"), lookback_days))
    wagon_dim = dims.wagon_dim(gold.stg_wagons(wagons))
    contract_dim = dims.contract_dim(contracts)
    fact_rows = gold.build_fact(stg, wagon_dim, contract_dim, now)
    tables.write_merged(spark, fact_rows, layout.fact, PK, newer=None, part_col="data_particao",
                        sort_cols=gold.FACT_SORT, index_buckets=index_buckets)
    # mart: full refresh from the fact table (K7), ranked
    daily = gold.sla_daily(tables.read_table(spark, layout.fact), as_of=processing_date,
                           lookback_days=mart_lookback_days)
    tables.write_table(gold.sla_mart(daily), layout.mart, part_col="data_particao")
    # control row (K4) and run metrics (A10)
    days = spark.createDataFrame([(str(processing_date),)], "processing_date string")
    tables.append_load_control(tables.load_control_rows(days, domain, now), layout.control)
    counters = bronze["counters"]
    metrics.metric_rows(spark, counters, domain, now).write.mode("append").parquet(layout.metrics)
    for path in (bronze["path"], silver_path):
        tables.delete_path(spark, path)
    return {"failures": found, "schema_drift": drift, "min_rows": min_rows, "counters": counters}
