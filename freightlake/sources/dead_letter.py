"""JSON drops against a contract, with what does not fit kept (VARIANT).

Each line is parsed once into a VARIANT.  Contract fields, those of nested structs
included, are taken out with their types.  Fields the contract does not name, at any of
its levels, and fields whose value has another type go to the row's ``_rescued`` column
(a JSON object from path to value; NULL if there are none) and, counted by path, type and
reason, to the dead letters.  Nothing is dropped: lines that are no JSON object are
quarantined as they stand.

A value fits if its JSON type can hold the contract's (a whole number fits a double, a
text that parses fits a date; a text never fits a number) and the cast succeeds.  JSON null
is NULL and fits everything.  No Python, no shuffle but the count by path and type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.session import scratch_path

# JSON types that a contract type accepts.
_NUMBER = ("BIGINT", "DOUBLE", "DECIMAL")
_ACCEPTS = {"byte": ("BIGINT",), "short": ("BIGINT",), "integer": ("BIGINT",), "long": ("BIGINT",), "float": _NUMBER,
            "double": _NUMBER, "decimal": _NUMBER, "boolean": ("BOOLEAN",), "string": ("STRING",), "date": ("STRING",),
            "timestamp": ("STRING",), "timestamp_ntz": ("STRING",), "array": ("ARRAY",), "map": ("OBJECT",), "struct": ("OBJECT",)}


def _kind(value: Column) -> Column:
    """JSON type of a variant; decimals without their digits."""
    return F.regexp_replace(F.schema_of_variant(value), r"DECIMAL\(\d+,\d+\)", "DECIMAL")


def _entry(path: Column, value: Column, reason: str) -> Column:
    return F.struct(path.alias("path"), _kind(value).alias("type"), F.lit(reason).alias("reason"), F.to_json(value).alias("value"))


def _fits(value: Column, kind: Column, field: T.StructField, at: str, v: Column) -> Column:
    wanted = [kind.startswith(k) for k in _ACCEPTS[field.dataType.typeName()]]
    shape = wanted[0]
    for w in wanted[1:]:
        shape = shape | w
    if isinstance(field.dataType, T.StructType):
        return shape
    return shape & F.try_variant_get(v, at, field.dataType.simpleString()).isNotNull()


def _level(v: Column, fields: T.StructType, at: str, name: str) -> tuple[list[Column], list[Column]]:
    """Columns of one level of the contract, and arrays of what does not fit there and below."""
    columns, rescued = [], []
    entries = F.map_entries(F.try_variant_get(v, at, "map<string,variant>"))
    known = [f.name for f in fields]
    other = F.filter(entries, lambda e: ~e["key"].isin(known))
    rescued.append(F.transform(other, lambda e: _entry(F.concat(F.lit(name), e["key"]), e["value"], "unknown_field")))
    for f in fields:
        path = f'{at}["{f.name}"]'
        value = F.try_variant_get(v, path, "variant")
        kind = _kind(value)
        present = value.isNotNull() & ~F.is_variant_null(value)
        fits = _fits(value, kind, f, path, v)
        entry = F.array(_entry(F.lit(name + f.name), value, "retyped"))
        rescued.append(F.when(present & ~fits, entry))
        if isinstance(f.dataType, T.StructType):
            inner, below = _level(v, f.dataType, path, f"{name}{f.name}.")
            columns.append(F.when(present & fits, F.struct(*inner)).alias(f.name))
            rescued += below
        else:
            columns.append(F.when(present & fits, F.try_variant_get(v, path, f.dataType.simpleString())).alias(f.name))
    return columns, rescued


def read_rescued(spark: SparkSession, path: str | list[str], contract: T.StructType,
                 base_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of JSON lines.

    ``rows`` has the contract's columns, partition columns of the folders, ``_rescued`` and
    ``_unfit`` (array of path, type, reason, value).  ``quarantine`` has ``_raw``, ``_error``
    and ``_source_file``.  Both read one parsed copy in the shared folder; blank lines
    are no records."""
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    lines = reader.text(path)
    folders = [c for c in lines.columns if c != "value"]
    v = F.col("_v")
    columns, rescued = _level(v, contract, "$", "")
    unfit = F.flatten(F.array(*[F.coalesce(r, F.array().cast("array<struct<path:string,type:string,reason:string,value:string>>"))
                                for r in rescued]))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    error = F.when(v.isNull(), "malformed_record").when(~is_object, "not_an_object")
    parsed = scratch_path(spark, "rescued")
    (lines.withColumns({"_v": F.try_parse_json("value"), "_source_file": F.col("_metadata.file_path")})
     .filter(F.trim("value") != "")
     .select(*columns, *folders, unfit.alias("_unfit"), F.when(error.isNotNull(), F.col("value")).alias("_raw"),
             error.alias("_error"), "_source_file").write.parquet(parsed))
    stored = spark.read.parquet(parsed)
    as_map = F.map_from_arrays(F.col("_unfit.path"), F.col("_unfit.value"))
    rows = (stored.filter("_error IS NULL").drop("_raw", "_error", "_source_file")
            .withColumn("_rescued", F.when(F.size("_unfit") > 0, F.to_json(as_map))))
    return rows, stored.filter("_error IS NOT NULL").select("_raw", "_error", "_source_file")


def dead_letters(rows: DataFrame) -> DataFrame:
    """path, type, reason, n: what did not fit, counted before the shuffle."""
    return (rows.select(F.inline("_unfit")).groupBy("path", "type", "reason")
            .agg(F.count(F.lit(1)).alias("n")))


def observed_schema(spark: SparkSession, path: str) -> str:
    """V2: the merged JSON type of all lines of a drop (one aggregate)."""
    return spark.read.text(path).agg(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
