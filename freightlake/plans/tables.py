"""Partitioned Parquet tables: create, merged write, day publish, control rows.

K1 create, K2 touched-partition merged write, K3/K5 idempotent day publish,
K4 load-control rows, K6 dated NDJSON landing, K7 full refresh, K8 statistics.

Writes go to the table path given by the caller (a shared filesystem).  A
merged write first puts the complete new content of the touched partitions into
a stage folder inside the table (``_merge_stage``, hidden from readers), then
the partition folders of that stage are moved in place of the table's, and
the stage is removed last.  A run that stopped in between is finished from its
stage by the next merged write (or by ``finish_merge``).  Concurrent writers to
one table are not supported, and a reader during the overwrite may see old and
new partitions side by side (no table format is installed).  The table's schema
is kept in ``_schema``, so columns that only some partitions have are read.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.operators.dedup import latest_per_key
from freightlake.operators.upsert import AmbiguousMergeError, merge_upsert
from freightlake.plans import journal, key_index
from freightlake.session import MERGE_CODEC, scratch_path, shared_dir

DEFAULT_PART = "_partition_date"


# -- filesystem helpers (Hadoop FileSystem of the session) -------------------

def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move_dirs(spark: SparkSession, pattern: str, to: str) -> None:
    """Moves the folders that ``pattern`` finds below ``to`` in place of those of the same
    name.  Again after a stop it moves those that are left."""
    for found in glob_paths(spark, pattern):
        at = f"{to}/{found.rstrip('/').rsplit('/', 1)[1]}"
        delete_path(spark, at)
        fs, p = _fs_path(spark, at)
        fs.mkdirs(p.getParent())
        if not fs.rename(_fs_path(spark, found)[1], p):
            raise OSError(f"{found} could not be moved to {at}")


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs_path(spark, pattern)
    found = fs.globStatus(p) or []
    return [str(s.getPath().toString()) for s in found]


def clean_scratch(spark: SparkSession, older_than_hours: float = 24.0, now_ms: int | None = None) -> list[str]:
    """Delete scratch folders (``scratch_path``: ``<name>-<12 hex>``) under the
    shared folder that were last modified more than ``older_than_hours`` ago.
    Run it between jobs: a folder still read by a live DataFrame must be
    younger than the threshold.  Spark's own checkpoint folders are left alone.
    """
    import re
    import time

    base = shared_dir(spark)
    fs, root = _fs_path(spark, base)
    if not fs.exists(root):
        return []
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    limit = now_ms - int(older_than_hours * 3600 * 1000)
    removed = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and re.fullmatch(r".+-[0-9a-f]{12}", name) and st.getModificationTime() < limit:
            fs.delete(st.getPath(), True)
            removed.append(str(st.getPath().toString()))
    return removed


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_dir(path: str, part_col: str, value) -> str:
    return f"{path.rstrip('/')}/{part_col}={NULL_PARTITION if value is None else value}"


# -- K1 / K7 -----------------------------------------------------------------

def write_table(df: DataFrame, path: str, part_col: str | None = DEFAULT_PART,
                sort_cols: list[str] | None = None, mode: str = "overwrite",
                dynamic: bool = False, cluster: bool = True, written: str | None = None) -> list | None:
    """K1 (create) / K7 (full refresh) / O2 (clustered files).

    ``dynamic=True`` replaces only the partitions present in ``df``.
    Rows are clustered by partition and sorted inside each file (O2);
    ``cluster=False`` skips that for input that is already clustered.
    ``written`` names the folder that a call of this function wrote ``df`` to: its
    partition folders are moved, no row is written again.
    Returns the partition values written, but for NULL (gathered by ``observe``
    during the write, no second pass), or None for an unpartitioned table.
    """
    if written is not None:
        move_dirs(df.sparkSession, f"{written}/{part_col}=*", path)
        return None
    out = df
    sort_cols = [c for c in (sort_cols or []) if c != part_col]
    if part_col and cluster:
        # REBALANCE by the partition column: a day's rows go to few tasks (few
        # files), AQE splits a day larger than the advisory size over several
        # tasks (no hot-day task) and merges tiny ones; unlike a range
        # repartition it needs no sampling pass over the upstream plan.
        out = out.hint("rebalance", part_col)
    if cluster and (sort_cols or part_col):
        out = out.sortWithinPartitions(*([part_col] if part_col else []), *sort_cols)
    obs = None
    if part_col:
        # One value per partition written: bounded by the table's partition count.
        obs = Observation(f"written-{uuid.uuid4().hex[:8]}")
        out = out.observe(obs, F.collect_set(F.col(part_col).cast("string")).alias("parts"))
    w = (out.write.mode(mode).option("compression", "snappy")
         .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    if part_col:
        w = w.partitionBy(part_col)
    w.parquet(path)
    return sorted(obs.get["parts"]) if obs is not None else None


def save_schema(spark: SparkSession, path: str, schema) -> None:
    """Keep the table's schema beside its files (one line of JSON)."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_schema")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table with its kept schema; a table without one is read with the
    merged schema of its files."""
    if path_exists(spark, f"{path}/_schema"):
        kept = spark.read.text(f"{path}/_schema").first()
        if kept is not None:
            return spark.read.schema(T.StructType.fromJson(json.loads(kept[0]))).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


# -- K2 ----------------------------------------------------------------------

def _counted_by_hash(source: DataFrame, keys: list[str]) -> bool:
    types = [source.schema[k].dataType for k in keys]
    wide = (T.StringType(), T.BinaryType())
    return any(t in wide for t in types) and all(t in wide or isinstance(t, (T.IntegralType, T.DateType)) for t in types)


def batch_profile(source: DataFrame, keys: list[str]):
    """Aggregates over the batch: the most rows any non-NULL key has (M4)
    and ``k BETWEEN min AND max`` for every key column, a necessary condition
    for a match that Parquet uses to skip row groups of the target.  Text keys are
    counted by their hash, so that they are not shuffled; only where one repeats, the
    keys themselves are."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if _counted_by_hash(source, keys):
        by_hash = source.filter(not_null).groupBy(F.xxhash64(*keys)).agg(F.count(F.lit(1)).alias("_n"))
        if (by_hash.agg(F.max("_n")).collect()[0][0] or 0) <= 1:
            per_key = source.filter(not_null).withColumn("_n", F.lit(1))
        else:
            per_key = source.filter(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    else:
        per_key = source.filter(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    row = per_key.agg(F.max("_n").alias("_most"),
                      *[F.min(k).alias(f"lo{i}") for i, k in enumerate(keys)],
                      *[F.max(k).alias(f"hi{i}") for i, k in enumerate(keys)]).collect()[0]
    if row["_most"] is None:
        return 0, F.lit(False)
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) >= F.lit(row[f"lo{i}"])) & (F.col(k) <= F.lit(row[f"hi{i}"]))
    return row["_most"], cond


def effective_rows(target: DataFrame, source: DataFrame, keys: list[str], newer: str | None,
                   part_col: str, key_range, images: bool = False, seen: Observation | None = None) -> DataFrame:
    """Source rows that change the target: inserts, and matches that win (M2),
    with ``_old`` (the matched target row's partition) and ``_hit``.  Only keys,
    watermark and partition of the target are read, behind the key range; with
    ``images`` its whole rows, which go into ``_before``.  ``seen`` counts the rows of
    the match: more than the source has where a key repeats in the target."""
    cols = list(dict.fromkeys([*keys, *([newer] if newer else []), part_col]))
    image = [F.struct(*target.columns).alias("_before")] if images else []
    found = target.filter(key_range).select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_hit"), *image)
    return _changes(source, found, keys, newer, part_col, seen)


def indexed_rows(spark: SparkSession, index: key_index.KeyIndex, source: DataFrame) -> DataFrame:
    """``effective_rows`` by the table's key index instead of the table."""
    keys, newer = list(index.keys), index.newer
    found = key_index.candidates(spark, index, source).select(
        *[F.col(k).alias(f"_t_{k}") for k in keys], F.col("_part").alias(f"_t_{index.part_col}"),
        *([F.col("_mark").alias(f"_t_{newer}")] if newer and newer not in keys else []), F.lit(True).alias("_hit"))
    return _changes(source, found, keys, newer, index.part_col)


def _changes(source: DataFrame, found: DataFrame, keys: list[str], newer: str | None, part_col: str,
             seen: Observation | None = None) -> DataFrame:
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_t_{k}") for k in keys])
    joined = source.join(found, cond, "left")
    if seen is not None:
        joined = joined.observe(seen, F.count(F.lit(1)).alias("rows"))
    if newer is not None:
        joined = joined.filter(F.col("_hit").isNull()
                               | F.coalesce(F.col(newer) > F.col(f"_t_{newer}"), F.lit(False)))
    return joined.select(*source.columns, F.col(f"_t_{part_col}").alias("_old"), F.col("_hit"),
                         *[c for c in found.columns if c == "_before"])


def replaced(affected: DataFrame, effective: DataFrame, keys: list[str], winners: DataFrame | None = None) -> DataFrame:
    """``merge_upsert`` of rows that all win, where no key repeats in the target: only the
    target's rows and the keys of the batch are shuffled, NULL keys are not.  ``winners`` are
    the whole rows where ``effective`` has their keys only."""
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    gone = effective.filter(F.col("_hit")).select(*[F.col(k).alias(f"_g_{k}") for k in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_g_{k}") for k in keys])
    kept = affected.filter(has_key).join(gone, cond, "left_anti").unionByName(affected.filter(~has_key))
    rows = effective.drop("_old", "_hit", "_before") if winners is None else winners
    return kept.unionByName(rows, allowMissingColumns=True)


def winning_rows(source: DataFrame, effective: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch, in which no key repeats, whose keys are in ``effective``; those with a
    NULL in a key always are.  Where all win, nothing is joined."""
    if effective.count() == source.count():
        return source
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    won = effective.filter(has_key).select(*[F.col(k).alias(f"_w_{k}") for k in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_w_{k}") for k in keys])
    return source.filter(has_key).join(won, cond, "left_semi").unionByName(source.filter(~has_key))


def partly_kept(affected: DataFrame, effective: DataFrame, part_col: str) -> list:
    """Partitions with a row that no matched row of the batch replaces, where no key repeats
    in the target: the others need not be read.  Two counts for each partition."""
    gone = {r[0]: r[1] for r in effective.filter(F.col("_hit")).groupBy("_old").count().collect()}
    return [r[0] for r in affected.groupBy(part_col).count().collect() if gone.get(r[0]) != r[1]]


def touched_values(effective: DataFrame, part_col: str) -> list:
    """Partitions a merge rewrites: those its rows go to and those that matched
    rows leave; NULL (None) is a partition like any other.  Bounded by the
    table's partition count."""
    new = effective.select(part_col)
    old = effective.filter(F.col("_hit")).select(F.col("_old").alias(part_col))
    return [r[0] for r in new.union(old).distinct().collect()]


def in_partitions(part_col: str, values: list):
    """Rows of these partitions, NULL included."""
    cond = F.col(part_col).isin([v for v in values if v is not None])
    return F.coalesce(cond, F.lit(False)) | F.col(part_col).isNull() if None in values else cond


def _stage_of(path: str) -> str:
    return f"{path.rstrip('/')}/_merge_stage"


def _entry(path: str, commit: str) -> str:
    return f"{path.rstrip('/')}/_ledger/{commit}"


def is_committed(spark: SparkSession, path: str, commit: str) -> bool:
    """Whether the write named ``commit`` (writer/number) is in the table; a write
    that stopped after its stage was complete is finished first."""
    finish_merge(spark, path, _part_of_stage(spark, path))
    return path_exists(spark, _entry(path, commit))


def _part_of_stage(spark: SparkSession, path: str) -> str:
    at = f"{_stage_of(path)}/part_col"
    return spark.read.text(at).first()[0] if path_exists(spark, f"{at}/_SUCCESS") else DEFAULT_PART


def record_commit(spark: SparkSession, path: str, commit: str) -> None:
    """Enter ``writer/number`` into the table's ledger; the writer's lower numbers go (a
    stream replays its last batch only)."""
    touch(spark, _entry(path, commit))
    writer, number = commit.rsplit("/", 1)
    for old in glob_paths(spark, _entry(path, f"{writer}/*")):
        name = old.rstrip("/").rsplit("/", 1)[1]
        if name.isdigit() and int(name) < int(number):
            delete_path(spark, old)


def finish_merge(spark: SparkSession, path: str, part_col: str = DEFAULT_PART) -> bool:
    """Move the partitions of a complete stage into the table, remove the partitions it
    leaves empty, then the stage.  A stage whose list of partitions was never written
    belongs to a merge that has changed nothing yet: it is dropped.  Running it
    again after a stop gives the same table.  Returns whether a stage was written."""
    stage = _stage_of(path)
    complete = path_exists(spark, f"{stage}/touched/_SUCCESS")
    if complete:
        touched = spark.read.schema("part string, emptied boolean").parquet(f"{stage}/touched").collect()
        staged = read_table(spark, f"{stage}/data")
        if any(r["emptied"] is None for r in touched):  # staged by an earlier version
            present = {r[0] for r in staged.select(F.col(part_col).cast("string")).distinct().collect()}
            emptied = [r["part"] for r in touched if r["part"] not in present]
            if present:
                write_table(staged, path, part_col, dynamic=True, cluster=False)
        else:  # what is moved is no longer staged: which partitions end empty is in the list
            emptied = [r["part"] for r in touched if r["emptied"]]
            write_table(staged, path, part_col, dynamic=True, written=f"{stage}/data")
        for value in emptied:
            delete_path(spark, partition_dir(path, part_col, value))
        save_schema(spark, path, staged.schema)
        if path_exists(spark, f"{stage}/index/_SUCCESS"):
            key_index.apply_changes(spark, path, f"{stage}/index")
        if path_exists(spark, f"{stage}/journal/runs/_SUCCESS"):
            journal.apply_stage(spark, path, f"{stage}/journal")
        if path_exists(spark, f"{stage}/commit"):
            for row in spark.read.text(f"{stage}/commit").collect():  # one entry
                record_commit(spark, path, row[0])
    delete_path(spark, f"{stage}/touched")  # first: a stage without it counts as incomplete
    delete_path(spark, stage)
    return complete


def write_merged(spark: SparkSession, source: DataFrame, path: str, keys: list[str] | str,
                 newer: str | None = None, part_col: str = DEFAULT_PART,
                 sort_cols: list[str] | None = None, snapshot: bool = True,
                 since=None, late_path: str | None = None, index_buckets: int | None = None,
                 commit: str | None = None, run: journal.Run | None = None) -> dict:
    """K2: merge ``source`` into the table at ``path`` rewriting touched partitions only.

    The batch is written as a snapshot first (``snapshot=False`` when it already
    is a written table), profiled once (repeated keys always raise, M4), and
    matched with the target's keys; rows that change nothing touch nothing, so a
    replayed batch rewrites no partition.  Source columns the table lacks are
    added (V3).

    ``since`` bounds the look-up: target partitions before it are not read.  The
    caller states with it that no key of the batch lies in them; source rows that
    belong before it go to ``late_path`` (appended) instead of the table.

    ``index_buckets`` gives the table a key index (``plans.key_index``) of so many
    buckets, built when it has none.  A table with an index is always looked up in
    and kept in step through it: the look-up reads the buckets of the batch's keys.

    ``commit`` (``writer/number``) enters the write into the table's ledger together with
    its data (T9): the entry stands in the stage, so a write that is seen is entered,
    after a stop too.  A write that is entered already changes nothing.

    ``run`` enters the rows that the merge changes into the table's journal (K10,
    ``plans.journal``); once a table has one, every merge needs a run.

    Returns ``{"touched": n, "emptied": n}`` (-1: the table is new).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    finish_merge(spark, path, part_col)
    if commit is not None and path_exists(spark, _entry(path, commit)):
        return {"touched": 0, "emptied": 0}
    journal.check_run(spark, path, keys, run)
    snap = None
    if snapshot:
        snap = scratch_path(spark, "merge-source")
        source.write.option("compression", MERGE_CODEC).parquet(snap)
        source = spark.read.schema(source.schema).parquet(snap)
    if since is not None:
        if late_path is None:
            raise ValueError("since needs a late_path")
        late = F.col(part_col) < F.lit(since)
        source.filter(late).write.mode("append").parquet(late_path)
        source = source.filter(F.coalesce(~late, F.lit(True)))
    most, key_range = batch_profile(source, keys)
    if most > 1:
        raise AmbiguousMergeError(f"a source key repeats ({most} rows for one key)")
    if not path_exists(spark, f"{path}/_schema") and not glob_paths(spark, f"{path}/{part_col}=*"):
        if commit is None and run is None:
            write_table(source, path, part_col, sort_cols)
            save_schema(spark, path, source.schema)
        else:  # staged like a merge, so that rows and entry appear together
            parts = [r[0] for r in source.select(part_col).distinct().collect()]
            if run is not None:
                journal.stage(spark, path, f"{_stage_of(path)}/journal", keys, run, None, None, source.columns)
            _stage_write(spark, source, path, part_col, sort_cols, parts, commit)
            finish_merge(spark, path, part_col)
        if index_buckets:
            key_index.create(spark, path, keys, newer, part_col, index_buckets)
        stats = {"touched": -1, "emptied": 0}
    else:
        index = key_index.load(spark, path)
        if index is None and index_buckets:
            index = key_index.create(spark, path, keys, newer, part_col, index_buckets)
        if index is not None and (list(index.keys), index.newer, index.part_col) != (keys, newer, part_col):
            raise ValueError(f"the key index of {path} is by {index.keys}, {index.newer}, {index.part_col}")
        stats = _merge_existing(spark, source, path, keys, newer, part_col, sort_cols, key_range, since, index, commit, run, most > 0)
        if commit is not None and not path_exists(spark, _entry(path, commit)):
            record_commit(spark, path, commit)  # nothing to change
    if snap:
        delete_path(spark, snap)
    return stats


def _stage_write(spark, rows, path, part_col, sort_cols, touched: list, commit: str | None,
                 expected: int | None = None, otherwise: DataFrame | None = None) -> int:
    """Stages the new content of the touched partitions, complete once its list of
    partitions is written; returns how many of them it leaves empty.  Where ``rows`` are not
    as many as ``expected``, ``otherwise`` is staged."""
    stage = _stage_of(path)
    present = set(write_table(rows, f"{stage}/data", part_col, sort_cols) or [])
    if path_exists(spark, partition_dir(f"{stage}/data", part_col, None)):
        present.add(None)
    save_schema(spark, f"{stage}/data", rows.schema)
    if expected is not None and read_table(spark, f"{stage}/data").count() != expected:
        return _stage_write(spark, otherwise, path, part_col, sort_cols, touched, commit)
    names = [None if v is None else str(v) for v in touched]
    for name, value in (("commit", commit), ("part_col", part_col)):
        if value is not None:
            spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(f"{stage}/{name}")
    spark.createDataFrame([(v, v not in present) for v in names], "part string, emptied boolean").coalesce(1).write.parquet(f"{stage}/touched")
    return sum(v not in present for v in names)


def _merge_existing(spark, source, path, keys, newer, part_col, sort_cols, key_range, since, index=None, commit=None,
                    run=None, keyed: bool = True) -> dict:
    if index is not None and key_index.next_seq(spark, index) > key_index.INCREMENTS:
        key_index.compact(spark, index)
    target = read_table(spark, path)
    if since is not None:
        target = target.filter(F.coalesce(F.col(part_col) >= F.lit(since), F.lit(True)))
    scratch = []

    def match(batch: DataFrame) -> tuple[DataFrame, bool]:
        seen = Observation(f"matched-{uuid.uuid4().hex[:8]}")
        found = (effective_rows(target, batch, keys, newer, part_col, key_range, run is not None, seen) if index is None
                 else indexed_rows(spark, index, batch))
        scratch.append(scratch_path(spark, "merge-changes"))
        found.write.option("compression", MERGE_CODEC).parquet(scratch[-1])
        # a key that repeats in the target: an index does not show it, the staged rows' number does
        twice = index is None and keyed and seen.get["rows"] != batch.count()  # no key: no match, Spark may drop the join
        return spark.read.schema(found.schema).parquet(scratch[-1]), twice

    # without a journal the keys are matched alone, the batch's other columns are not shuffled for it
    thin = run is None
    effective, repeated = match(source.select(*dict.fromkeys([*keys, *([newer] if newer else []), part_col])) if thin else source)
    if thin and repeated:  # each row of the batch counts once for each row it meets
        thin, (effective, _) = False, match(source)
    touched = touched_values(effective, part_col)
    emptied = 0
    if touched:
        affected = target.filter(in_partitions(part_col, touched))
        rows = winning_rows(source, effective, keys) if thin else effective.drop("_old", "_hit", "_before")
        whole = merge_upsert(affected, rows, keys)
        merged = whole if repeated else replaced(
            affected.filter(in_partitions(part_col, partly_kept(affected, effective, part_col))), effective, keys, rows)
        expected = None if index is None else (
            affected.count() - effective.filter(F.col("_hit")).count() + effective.count())
        if index is not None:
            key_index.stage_changes(spark, index, effective, f"{_stage_of(path)}/index")
        if run is not None:
            left = touched if index is None and not repeated else [
                r[0] for r in effective.filter(F.col("_hit")).select("_old").distinct().collect()]
            journal.stage(spark, path, f"{_stage_of(path)}/journal", keys, run, target.filter(in_partitions(part_col, left)),
                          effective.drop("_before") if repeated else effective, merged.columns)
        emptied = _stage_write(spark, merged, path, part_col, sort_cols, touched, commit, expected, whole)
        finish_merge(spark, path, part_col)
    for at in scratch:
        delete_path(spark, at)
    return {"touched": len(touched), "emptied": emptied}


# -- K3 / K5 / U1 --------------------------------------------------------------

def publish_days(spark: SparkSession, df: DataFrame, path: str, days: list | None = None,
                 part_col: str = DEFAULT_PART) -> list[str]:
    """K3/K5: replace exactly the listed days (idempotent; a re-run gives the
    same table).  A listed day without rows is removed from the target.
    ``days=None`` publishes every day present in ``df``.  One pass over ``df``;
    returns the days written."""
    day_rows = df if days is None else df.filter(F.col(part_col).isin([str(d) for d in days]))
    first = not path_exists(spark, path)
    written = write_table(day_rows, path, part_col, mode="overwrite", dynamic=not first)
    if days is not None and not first:
        for d in days:
            if str(d) not in set(written):
                delete_path(spark, partition_dir(path, part_col, d))
    return written


# -- K4 ----------------------------------------------------------------------

def load_control_rows(days: DataFrame, domain: str, loaded_at, status: str = "SUCCESS",
                      day_col: str = "processing_date") -> DataFrame:
    """K4: one control row per processed day (days come from the loaded data)."""
    return days.select(
        F.lit(domain).alias("domain"),
        F.col(day_col).cast("date").alias("processing_date"),
        F.lit(str(loaded_at)).cast("timestamp").alias("loaded_at"),
        F.lit(status).alias("status"),
    )


def append_load_control(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def latest_load_status(control: DataFrame) -> DataFrame:
    """Last control row per (domain, processing_date)."""
    return latest_per_key(control, ["domain", "processing_date"], "loaded_at", ["status"])


# -- K6 ----------------------------------------------------------------------

def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.create(p, True).close()


def write_landing(df: DataFrame, root: str, date_col: str = "date", days: list | None = None) -> dict:
    """K6: NDJSON files under ``root/<date_col>=<day>/`` for every day of the
    batch, in one job; then a ``_SUCCESS`` marker in each day folder, written
    last, which consumers wait for (S9).  ``days`` lists the days the batch
    covers, so a day without rows is still marked complete (empty folder).

    Other days already under ``root`` are left as they are (dynamic overwrite).
    Returns the days, the record count of the batch (both observed during the
    write, no second pass; the list is bounded by the days of one batch) and
    the markers written.
    """
    spark = df.sparkSession
    obs = Observation(f"landing-{uuid.uuid4().hex[:8]}")
    (df.observe(obs, F.collect_set(F.col(date_col).cast("string")).alias("days"),
                F.count(F.lit(1)).alias("rows"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(date_col).json(root))
    seen = obs.get
    if days is None:
        days = sorted(seen["days"])
    marked = []
    for d in days:
        marker = f"{partition_dir(root, date_col, d)}/_SUCCESS"
        touch(spark, marker)
        marked.append(marker)
    return {"days": [str(d) for d in days], "rows": seen["rows"], "markers": marked}


# -- K8 ----------------------------------------------------------------------

def analyze_table(spark: SparkSession, table_name: str) -> None:
    """K8: table statistics for a catalog table (used by the cost-based optimizer)."""
    spark.sql(f"ANALYZE TABLE {table_name} COMPUTE STATISTICS")
