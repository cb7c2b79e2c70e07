"""Declarative column tests (Q10-Q14), orphan keys (J7) and freshness (Q15).

A test result row is (model, column_name, test_name, failures).  ``failures``
follows the usual data-test meaning: the number of rows the failing-rows query
returns (NULLs pass every test except not_null; ``unique`` returns one row per
repeated value; ``accepted_values`` one row per distinct unexpected value).

The tests of one model are counted in one pass, any number of ``unique`` columns
and ``accepted_values`` lists included; ``relationships`` needs its own
anti join and is added to the same result with ``unionByName`` (one lazy plan).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLS = ["model", "column_name", "test_name", "failures"]


@dataclass
class ColumnTest:
    column: str
    kind: str  # not_null | unique | accepted_values | between | relationships
    values: list = field(default_factory=list)
    min_value: float | None = None
    max_value: float | None = None
    row_condition: str | None = None
    to: DataFrame | None = None
    to_field: str | None = None


def _bad(t: ColumnTest):
    """Rows that fail a row-level test."""
    c = F.col(t.column)
    if t.kind == "not_null":
        return c.isNull()
    if t.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(t.values)
    ok = F.lit(True)
    if t.min_value is not None:
        ok = ok & (c >= F.lit(t.min_value))
    if t.max_value is not None:
        ok = ok & (c <= F.lit(t.max_value))
    return F.expr(t.row_condition) & ~ok if t.row_condition else ~ok


def _unpivot(model: str, row: DataFrame, names: list[tuple[str, ColumnTest]]) -> DataFrame:
    stack = F.explode(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(t.column).alias("column_name"), F.lit(t.kind).alias("test_name"),
                 F.coalesce(F.col(name), F.lit(0)).cast("long").alias("failures")) for name, t in names]))
    return row.select(stack.alias("r")).select("r.*")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_field: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left anti join)."""
    keys = parent.select(F.col(parent_field).alias("_parent_key"))
    return child.filter(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("_parent_key"), "left_anti")


def _relationships(model: str, df: DataFrame, t: ColumnTest) -> DataFrame:
    return orphans(df, t.column, t.to, t.to_field).agg(
        F.count(F.lit(1)).cast("long").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(t.column).alias("column_name"),
        F.lit("relationships").alias("test_name"), "failures")


def run_column_tests(model: str, df: DataFrame, tests: list[ColumnTest]) -> DataFrame:
    """Q10-Q14 for one model; one result row per test.

    One scan of the model: each row is expanded (grouping sets) into one row for each
    ``unique`` column and each ``accepted_values`` test, holding that value only, and
    one that carries the row-level tests.  They are counted by (test, value), combined
    before the shuffle, so no value's rows and no test's values meet in one task; the
    counts are then added up.  Each ``relationships`` test counts the model's values of
    its column and is one more scan of that column.
    """
    names = [(f"t{i}", t) for i, t in enumerate(tests)]
    rowwise = [(n, t) for n, t in names if t.kind in ("not_null", "between")]
    valued = [(n, t) for n, t in names if t.kind in ("unique", "accepted_values")]
    flags = [F.when(_bad(t), 1).otherwise(0).cast("long").alias(n) for n, t in rowwise]
    # the value as text: NULL where the row cannot fail the test
    values = [F.when(_bad(t) if t.kind == "accepted_values" else F.lit(True), F.col(t.column)).cast("string").alias(n)
              for n, t in valued]
    sets = [F.struct(F.lit(n).alias("test"), F.col(f"v_{n}").alias("value"), *[F.lit(0).cast("long").alias(m) for m, _ in rowwise])
            for n, _ in valued]
    sets.append(F.struct(F.lit("").alias("test"), F.lit(None).cast("string").alias("value"), *[F.col(f"f_{m}").alias(m) for m, _ in rowwise]))
    narrow = df.select(*[c.alias(f"f_{n}") for c, (n, _) in zip(flags, rowwise, strict=True)],
                       *[c.alias(f"v_{n}") for c, (n, _) in zip(values, valued, strict=True)])
    per_value = (narrow.select(F.inline(F.array(*sets))).filter("test = '' OR value IS NOT NULL")
                 .groupBy("test", "value").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(m).alias(m) for m, _ in rowwise]))
    failed = {n: (F.col("test") == n) & (F.col("_n") > (1 if t.kind == "unique" else 0)) for n, t in valued}
    row = per_value.agg(*[F.sum(m).alias(m) for m, _ in rowwise], *[F.count_if(c).alias(n) for n, c in failed.items()])
    out = _unpivot(model, row, rowwise + valued)
    for _, t in names:
        if t.kind == "relationships":
            out = out.unionByName(_relationships(model, df, t))
    return out


def freshness(df: DataFrame, loaded_at_field: str, now, source: str,
              warn_hours: float = 12, error_hours: float = 25) -> DataFrame:
    """Q15: age of the newest row against ``now`` -> pass / warn / error."""
    now_ts = F.lit(str(now)).cast("timestamp_ntz")
    newest = df.agg(F.max(F.col(loaded_at_field).cast("timestamp_ntz")).alias("max_loaded_at"))
    age = (F.unix_timestamp(now_ts) - F.unix_timestamp("max_loaded_at")) / F.lit(3600.0)
    status = (F.when(F.col("age_hours").isNull(), "error")
              .when(F.col("age_hours") > error_hours, "error")
              .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))
    return (newest.select(F.lit(source).alias("source"), "max_loaded_at",
                          F.round(age, 4).alias("age_hours"))
            .withColumn("status", status))
