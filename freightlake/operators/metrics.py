"""Per-run counters as a table (A10) and metric alarms (Q16)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from freightlake.operators.dedup import distinct_keys

NAMESPACE = "freightlake/pipeline"

# Fixed alarm rules of the platform: metric, comparison, threshold.
ALARM_RULES = [
    ("JobFailure", ">", 0.0),
    ("DuplicatesRemoved", ">", 50000.0),
    ("SchemaValidationFailure", ">", 0.0),
    ("IteratorAgeMilliseconds", ">", 300000.0),
]


def ingest_metrics(raw: DataFrame, keys: list[str], domain: str, ts) -> DataFrame:
    """A10 for an ingest run, from one aggregate over the raw batch:
    RawRecordsRead, DuplicatesRemoved, BronzeRecordsWritten."""
    counts = raw.agg(F.count(F.lit(1)).alias("raw"), distinct_keys(keys).alias("kept"))
    rows = F.array(
        F.struct(F.lit("RawRecordsRead").alias("metric"), F.col("raw").cast("double").alias("value")),
        F.struct(F.lit("DuplicatesRemoved").alias("metric"),
                 (F.col("raw") - F.col("kept")).cast("double").alias("value")),
        F.struct(F.lit("BronzeRecordsWritten").alias("metric"), F.col("kept").cast("double").alias("value")),
    )
    return counts.select(F.explode(rows).alias("m")).select(
        F.lit(NAMESPACE).alias("namespace"), "m.metric", F.lit(domain).alias("domain"),
        "m.value", F.lit("Count").alias("unit"), F.lit(str(ts)).cast("timestamp").alias("ts"))


def observed(df: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the first job that runs ``df`` (no extra scan)."""
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def metric_rows(spark: SparkSession, values: dict[str, float], domain: str, ts) -> DataFrame:
    """Counters known on the driver (job success/failure flags) as metric rows."""
    rows = [(NAMESPACE, k, domain, float(v), "Count") for k, v in values.items()]
    df = spark.createDataFrame(rows, "namespace string, metric string, domain string, value double, unit string")
    return df.withColumn("ts", F.lit(str(ts)).cast("timestamp"))


def alarm_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALARM_RULES, "metric string, comparison string, threshold double")


def alarms(metrics: DataFrame, rules: DataFrame, how: str = "inner") -> DataFrame:
    """Q16: metric rows joined to their rule, with ``alarm`` true when breached.

    The rule table is a handful of rows (broadcast, fixed size).  ``how="left"``
    keeps metrics without a rule (``alarm`` false)."""
    j = metrics.join(F.broadcast(rules), "metric", how)
    breach = (F.when(F.col("comparison") == ">", F.col("value") > F.col("threshold"))
              .when(F.col("comparison") == ">=", F.col("value") >= F.col("threshold"))
              .otherwise(F.lit(False)))
    return j.withColumn("alarm", F.coalesce(breach, F.lit(False)))
