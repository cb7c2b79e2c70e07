"""Raw and layer readers: S1-S11."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.session import scratch_path

from freightlake.plans.tables import glob_paths, read_table

CORRUPT = "_corrupt_record"


def format_for_path(path: str) -> str:
    """``csv`` anywhere in the lower-cased path -> CSV, else ``json`` -> JSON,
    else Parquet; the CSV test comes first."""
    low = path.lower()
    if "csv" in low:
        return "csv"
    if "json" in low:
        return "json"
    return "parquet"


def complete_day_dirs(spark: SparkSession, root: str, date_col: str = "date") -> list[str]:
    """``date=`` folders that hold a ``_SUCCESS`` marker."""
    markers = glob_paths(spark, f"{root.rstrip('/')}/{date_col}=*/_SUCCESS")
    return sorted(m.rsplit("/", 1)[0] for m in markers)


def read_raw(spark: SparkSession, path: str, fmt: str | None = None,
             schema: T.StructType | str | None = None, multiline: bool = False,
             require_success: bool = False, date_col: str = "date",
             corrupt_column: str | None = None) -> DataFrame:
    """S1-S4 (+S9): read a raw drop by format.

    CSV: header and, without a schema, type inference (S2).  JSON: line mode by
    default, ``multiline=True`` for one document per file (S3).  Parquet (S4).
    ``require_success`` keeps only complete ``date=`` folders; the partition
    column stays available through ``basePath``.
    """
    fmt = fmt or format_for_path(path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path]
    if require_success:
        paths = complete_day_dirs(spark, path, date_col)
        reader = reader.option("basePath", path)
        if not paths:
            if schema is None:
                raise ValueError(f"no complete {date_col}= folder under {path}")
            return spark.createDataFrame([], schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        if corrupt_column:
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
        return reader.csv(paths)
    if fmt == "json":
        reader = reader.option("multiLine", multiline)
        if corrupt_column:
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
        return reader.json(paths)
    return reader.parquet(*paths)


def read_with_quarantine(spark: SparkSession, path: str, schema: T.StructType,
                         fmt: str = "json", partition_date=None) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine rows) of one PERMISSIVE parse.

    The drop is parsed once, into a Parquet copy in the shared folder; both
    results read that copy.  The quarantine keeps the schema columns (NULL, or
    what was parsed), the raw text, an error label, the source file and the
    partition date.  ``partition_date`` is a literal (the landing day).
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    reader = (spark.read.schema(full).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT))
    raw = (reader.json(path) if fmt == "json" else reader.option("header", True).csv(path))
    parsed = scratch_path(spark, "parsed")
    raw.select("*", F.col("_metadata.file_path").alias("_source_file"),
               F.col("_metadata.file_modification_time").alias("_modified")).write.parquet(parsed)
    rows = spark.read.parquet(parsed)
    good = rows.filter(F.col(CORRUPT).isNull()).select(*[f.name for f in schema.fields])
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select(
        *[F.col(f.name) for f in schema.fields],
        F.col(CORRUPT).alias("_raw"),
        F.lit("malformed_record").alias("_error"),
        "_source_file",
        (F.lit(str(partition_date)).cast("date") if partition_date is not None
         else F.to_date("_modified")).alias("_partition_date"),
    )
    return good, bad


def read_layer(spark: SparkSession, path: str, partition_date=None,
               part_col: str = "_partition_date") -> DataFrame:
    """A layer table with its kept schema (columns that merges added
    included), optionally one partition (pruned at planning)."""
    df = read_table(spark, path)
    if partition_date is not None:
        df = df.filter(F.col(part_col) == F.lit(str(partition_date)).cast("date"))
    return df


def register_layers(spark: SparkSession, tables: dict[str, str]) -> list[str]:
    """Register layer tables (name -> path) as temp views for SQL, with all
    columns of their kept schemas."""
    for name, path in tables.items():
        read_table(spark, path).createOrReplaceTempView(name)
    return sorted(tables)
