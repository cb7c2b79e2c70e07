"""A change journal of merged tables, their state at any instant, and row versions.

A merge that is given a ``Run`` writes one row for each row it inserts or updates, with
the images before and after, below ``_journal/changes/seq=<n>`` of the table, and the run
below ``_journal/runs/seq=<n>``.  The rows are staged with the merge's data: a merge that
stopped in between is finished from the stage, and a ``seq`` written again replaces itself.

``state_at`` goes back from the table as it is: of every key changed after the instant it
takes the image before the first such change.  It reads the changes after the instant
only and needs no copy of the table.  ``versions`` gives each row version with the
interval in which it held.

Results in the open cases: a merge that changes nothing leaves no run; runs of the same
instant count together; an instant before the table was created has no rows; one before
the journal of an older table began is refused, as its state is not known.  Rows with a
NULL in a key never match a batch, so they are only ever inserted; they are taken back by
their whole content (columns of a type that Spark cannot group are refused there).
Columns that later merges added are NULL in earlier states.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.operators.dedup import latest_per_key

_RUN_SCHEMA = "run_id string, at timestamp, keys array<string>, created boolean, seq int"


@dataclass(frozen=True)
class Run:
    """The name and instant (UTC) a journaled merge is entered under."""

    run_id: str
    at: str

    @property
    def instant(self) -> _dt.datetime:
        t = _dt.datetime.fromisoformat(self.at)
        return t if t.tzinfo else t.replace(tzinfo=_dt.timezone.utc)


class JournalError(ValueError):
    """A merge that would break the journal, or a state that it does not hold."""


def _root(path: str) -> str:
    return f"{path.rstrip('/')}/_journal"


def exists(spark: SparkSession, path: str) -> bool:
    from freightlake.plans.tables import path_exists
    return path_exists(spark, f"{_root(path)}/runs")


def runs(spark: SparkSession, path: str) -> DataFrame:
    """One row for each journaled run."""
    return spark.read.schema(_RUN_SCHEMA).parquet(f"{_root(path)}/runs")


def changes(spark: SparkSession, path: str) -> DataFrame:
    """The journal: op (insert or update), before and after images, seq.  Images have the
    columns that the table has now."""
    from freightlake.plans.tables import path_exists, read_table
    image = T.StructType([T.StructField(f.name, f.dataType) for f in read_table(spark, path).schema])
    schema = (T.StructType().add("op", T.StringType()).add("before", image).add("after", image)
              .add("seq", T.IntegerType()))
    if not path_exists(spark, f"{_root(path)}/changes"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{_root(path)}/changes")


def check_run(spark: SparkSession, path: str, keys: list[str], run: Run | None) -> None:
    """Raises where a merge would leave a gap or go back in time."""
    if not exists(spark, path):
        return
    if run is None:
        raise JournalError(f"{path} has a journal: every merge needs a run")
    last = runs(spark, path).orderBy(F.desc("seq")).first()
    if list(last["keys"]) != keys:
        raise JournalError(f"the journal of {path} is by {last['keys']}")
    if _instant(last["at"]) > run.instant:
        raise JournalError(f"run {run.run_id} is earlier than {last['run_id']}")


def _instant(value: _dt.datetime) -> _dt.datetime:
    """A collected timestamp (local time of the driver without zone) as an instant."""
    return value.astimezone(_dt.timezone.utc)


def stage(spark: SparkSession, path: str, stage_dir: str, keys: list[str], run: Run,
          before: DataFrame | None, effective: DataFrame | None, columns: list[str]) -> None:
    """Stages the rows of a merge: ``effective`` are the batch rows that change the table
    (with ``_hit``), ``before`` the partitions they come from, joined where ``effective`` does
    not have their rows as ``_before``; both None for a new table."""
    seq = 0
    created = before is None
    if exists(spark, path):
        seq = runs(spark, path).agg(F.max("seq")).first()[0] + 1
    if not created:
        width = [F.col(c) if c in effective.columns else F.lit(None).cast(before.schema[c].dataType).alias(c)
                 for c in columns]
        op = F.when(F.col("_hit"), "update").otherwise("insert").alias("op")
    if not created and "_before" in effective.columns:
        _write(effective.select(op, F.col("_before").alias("before"), F.struct(*width).alias("after"), F.lit(seq).alias("seq")),
               f"{stage_dir}/changes")
    elif not created:
        b = before.select(F.struct(*[F.col(c) for c in before.columns]).alias("before"),
                          *[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)])
        a = effective.select(F.struct(*width).alias("after"), "_hit", *[F.col(k).alias(f"_a{i}") for i, k in enumerate(keys)])
        same = reduce(lambda x, y: x & y, [F.col(f"_a{i}") == F.col(f"_b{i}") for i in range(len(keys))])
        joined = a.join(b, same, "left").select(
            op, "before", "after", F.lit(seq).alias("seq"))
        _write(joined, f"{stage_dir}/changes")
    entry = [(run.run_id, run.instant, keys, created and seq == 0, seq)]
    _write(spark.createDataFrame(entry, _RUN_SCHEMA).coalesce(1), f"{stage_dir}/runs")


def _write(rows: DataFrame, to: str, dynamic: bool = False) -> None:
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy("seq").parquet(to))


def apply_stage(spark: SparkSession, path: str, stage_dir: str) -> None:
    """Enters staged rows; a second time gives the same journal.  The run goes last: rows
    without a run belong to a merge that is not finished."""
    from freightlake.plans.tables import move_dirs, path_exists
    if path_exists(spark, f"{stage_dir}/changes/_SUCCESS"):
        move_dirs(spark, f"{stage_dir}/changes/seq=*", f"{_root(path)}/changes")
    _write(spark.read.schema(_RUN_SCHEMA).parquet(f"{stage_dir}/runs"), f"{_root(path)}/runs", dynamic=True)


def _image(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(f"{name}.*")


def _has_key(keys: list[str], prefix: str = ""):
    return reduce(lambda a, b: a & b, [F.col(prefix + k).isNotNull() for k in keys])


def _without_inserts(table: DataFrame, journal: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the table with a NULL in a key, less those the journal inserts."""
    loose = table.filter(~_has_key(keys))
    return loose.exceptAll(_image(journal.filter(~_has_key(keys, "after.")), "after").select(*table.columns))


def state_at(spark: SparkSession, path: str, at: str) -> DataFrame:
    """The table as it was at the instant ``at`` (runs of that instant included)."""
    from freightlake.plans.tables import read_table
    if not exists(spark, path):
        raise JournalError(f"{path} has no journal")
    known = runs(spark, path)
    limit = F.lit(Run("", at).instant)
    seen = known.agg(F.max(F.when(F.col("at") <= limit, F.col("seq"))).alias("last"), F.min("seq").alias("first"),
                     F.max("seq").alias("newest"), F.max(F.when(F.col("seq") == 0, F.col("created"))).alias("created"),
                     F.first("keys").alias("keys")).first()
    keys, table = list(seen["keys"]), read_table(spark, path)
    if seen["last"] is None:
        if not seen["created"]:
            raise JournalError(f"the journal of {path} begins after {at}")
        return table.limit(0)
    if seen["last"] == seen["newest"]:
        return table
    later = changes(spark, path).filter(F.col("seq") > seen["last"])
    keyed = later.filter(_has_key(keys, "after.")).select(
        *[F.col(f"after.{k}").alias(f"_k{i}") for i, k in enumerate(keys)], "op", "before", (-F.col("seq")).alias("_back"))
    first = latest_per_key(keyed, [f"_k{i}" for i in range(len(keys))], "_back")
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])
    kept = table.filter(_has_key(keys)).join(first, same, "left_anti")
    back = _image(first.filter("op = 'update'"), "before").select(*table.columns)
    return kept.unionByName(back).unionByName(_without_inserts(table, later, keys))


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Every version of every row with ``valid_from`` (first instant; NULL where the row is
    older than the journal) and ``valid_to`` (first instant without it; NULL: it holds).

    A key has at most one change a run, so the window over a key's changes is as long as
    there are runs; NULL keys, which may be many rows, are kept out of it."""
    from freightlake.plans.tables import read_table
    known = runs(spark, path).select("seq", "at", "keys", "created")
    start = known.filter("seq = 0").first()
    keys, table = list(start["keys"]), read_table(spark, path)
    begin = F.lit(_instant(start["at"])) if start["created"] else F.lit(None).cast("timestamp")
    journal = changes(spark, path).join(known.select("seq", "at"), "seq")
    keyed = journal.filter(_has_key(keys, "after."))
    of_key = Window.partitionBy(*[F.col(f"after.{k}") for k in keys]).orderBy("seq")
    ordered = keyed.select("op", "before", "after", "at", F.lead("at").over(of_key).alias("_next"),
                           F.row_number().over(of_key).alias("_n"))
    after = ordered.select("after.*", F.col("at").alias("valid_from"), F.col("_next").alias("valid_to"))
    before = (ordered.filter("_n = 1 AND op = 'update'")
              .select("before.*", begin.alias("valid_from"), F.col("at").alias("valid_to")))
    changed = keyed.select(*[F.col(f"after.{k}").alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])
    holds = F.lit(None).cast("timestamp").alias("valid_to")
    base = table.filter(_has_key(keys)).join(changed, same, "left_anti").unionByName(_without_inserts(table, journal, keys))
    loose = journal.filter(~_has_key(keys, "after.")).select("after.*", F.col("at").alias("valid_from"), holds)
    out = after.unionByName(before).unionByName(base.select("*", begin.alias("valid_from"), holds)).unionByName(loose)
    return out.select(*table.columns, "valid_from", "valid_to")
