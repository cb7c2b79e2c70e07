"""Schema and metadata operators: V1-V5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.functions.expressions import to_day, ts_literal


class SchemaValidationError(ValueError):
    """Raised when required columns are missing (V1)."""

    def __init__(self, missing: list[str]):
        self.missing = missing
        super().__init__(f"required columns missing: {missing}")


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """V1: analysis-time check (no job); raises ``SchemaValidationError``."""
    missing = missing_columns(df, required)
    if missing:
        raise SchemaValidationError(missing)
    return df


def schema_drift(spark: SparkSession, df: DataFrame, contract: T.StructType) -> DataFrame:
    """V2: one row per added, missing or retyped column against the contract.

    Built from the two schemas (metadata), so it costs no scan of the data.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    expected = {f.name: f.dataType.simpleString() for f in contract.fields}
    rows = []
    for name, typ in expected.items():
        if name not in actual:
            rows.append((name, "missing", typ, None))
        elif actual[name] != typ:
            rows.append((name, "retyped", typ, actual[name]))
    for name, typ in actual.items():
        if name not in expected:
            rows.append((name, "added", None, typ))
    schema = "column string, change string, expected_type string, actual_type string"
    return spark.createDataFrame(rows, schema)


def evolve_union(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """V3: append with new columns; rows lacking a column get NULL there."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def add_audit(df: DataFrame, domain: str, watermark: str, run_id: str, now) -> DataFrame:
    """V4: ingest instant, source domain, watermark date partition, run id."""
    return df.withColumns({
        "_ingested_at": ts_literal(now),
        "_source_domain": F.lit(domain),
        "_partition_date": to_day(watermark),
        "_job_run_id": F.lit(run_id),
    })
