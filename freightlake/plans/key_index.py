"""K2: a hash-bucketed index from key to partition, kept beside a merged table.

A merge must know for each key of its batch whether the table has it, in which
partition and with which watermark.  Text or random keys leave min/max pruning of
the table without effect, so that look-up would read the keys of the whole table.
The index holds (key, partition, watermark) in Parquet below ``_key_index``, by
``bucket`` (hash of the key): a look-up reads the buckets of the batch only.

Layout: ``_key_index/v=<n>/seq=<m>/bucket=<b>``.  ``seq=0`` is the index as it was
built; each merge adds the keys it changed as a new ``seq`` (of a key the row with the
highest ``seq`` counts).  A version is in force when it has its ``_SUCCESS``; the highest
one counts.  ``compact`` writes the current rows as the next version.  A merge stages its
index rows with its data, so a merge that stopped between the two is finished from
the stage: a ``seq`` written again replaces itself.

The index follows merges only: a table that is written otherwise needs ``create``.
NULL keys never match and are not in it.  A bucket should stay in the order of a million
keys: choose ``buckets`` for the table's final size.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.session import MERGE_CODEC

BUCKETS = 16
#: A look-up reads at most so many increments; the next merge after that compacts.
INCREMENTS = 8


@dataclass(frozen=True)
class KeyIndex:
    """What the index of a table holds; stored as ``_key_index/_meta``."""

    path: str
    keys: tuple[str, ...]
    newer: str | None
    part_col: str
    buckets: int
    schema: str

    @property
    def root(self) -> str:
        return f"{self.path}/_key_index"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def has_key(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])

    def entries(self, rows: DataFrame, seq: int) -> DataFrame:
        """Index rows of table rows."""
        mark = F.col(self.newer) if self.newer else F.lit(None).cast("int")
        return rows.filter(self.has_key()).select(*self.keys, F.col(self.part_col).alias("_part"), mark.alias("_mark"),
                                                  F.lit(seq).alias("seq"), self.bucket().alias("bucket"))


def _complete(spark: SparkSession, path: str) -> list[int]:
    from freightlake.plans.tables import glob_paths

    marks = glob_paths(spark, f"{path}/_key_index/v=*/_SUCCESS")
    return sorted(int(m.rsplit("/", 2)[1].removeprefix("v=")) for m in marks)


def load(spark: SparkSession, path: str) -> KeyIndex | None:
    """The index of the table at ``path`` if it has one in force."""
    path = path.rstrip("/")
    if not _complete(spark, path):
        return None
    kept = json.loads(spark.read.text(f"{path}/_key_index/_meta").first()[0])
    return KeyIndex(path, tuple(kept["keys"]), kept["newer"], kept["part_col"], kept["buckets"], kept["schema"])


def _write(rows: DataFrame, to: str, dynamic: bool) -> None:
    (rows.hint("rebalance", "seq", "bucket").write.mode("overwrite").option("compression", MERGE_CODEC)
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static").partitionBy("seq", "bucket").parquet(to))


def create(spark: SparkSession, path: str, keys: list[str], newer: str | None, part_col: str, buckets: int = BUCKETS) -> KeyIndex:
    """Builds the index of the table as it is, in one scan of its key columns."""
    from freightlake.plans.tables import read_table

    path = path.rstrip("/")
    table = read_table(spark, path)
    made = KeyIndex(path, tuple(keys), newer, part_col, buckets, "")
    rows = made.entries(table, 0)
    made = KeyIndex(path, tuple(keys), newer, part_col, buckets, rows.schema.json())
    meta = json.dumps({k: v for k, v in asdict(made).items() if k != "path"})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{made.root}/_meta")
    _write(rows, f"{made.root}/v={max(_complete(spark, path), default=-1) + 1}", dynamic=False)
    return made


def _version(spark: SparkSession, index: KeyIndex) -> str:
    return f"{index.root}/v={_complete(spark, index.path)[-1]}"


def rows(spark: SparkSession, index: KeyIndex, buckets: list[int] | None = None) -> DataFrame:
    """Stored index rows of these buckets (pruned at planning), old ones included."""
    found = spark.read.schema(T.StructType.fromJson(json.loads(index.schema))).parquet(_version(spark, index))
    return found if buckets is None else found.filter(F.col("bucket").isin(buckets))


#: A batch of at least this share of the index rows in its buckets meets all of them at once.
LARGE_SHARE = 0.25


def _latest(stored: DataFrame, index: KeyIndex) -> DataFrame:
    last = stored.groupBy(*index.keys).agg(F.max_by(F.struct("_part", "_mark"), "seq").alias("_last"))
    return last.select(*index.keys, "_last.*")


def look_up(spark: SparkSession, index: KeyIndex, batch: DataFrame) -> DataFrame:
    """keys, ``_part``, ``_mark`` of the batch's keys that the table has."""
    wanted = batch.filter(index.has_key()).select(*index.keys)
    stored, _ = _of_buckets(spark, index, wanted)
    return _latest(stored.join(wanted, list(index.keys), "left_semi"), index)


def _of_buckets(spark: SparkSession, index: KeyIndex, wanted: DataFrame) -> tuple[DataFrame, int]:
    """Index rows of the buckets that the wanted keys are in, and the number of wanted keys."""
    counts = wanted.groupBy(index.bucket().alias("bucket")).count().collect()  # at most ``buckets`` rows
    return rows(spark, index, [r["bucket"] for r in counts]), sum(r["count"] for r in counts)


def candidates(spark: SparkSession, index: KeyIndex, batch: DataFrame) -> DataFrame:
    """``look_up`` before a join with the batch, which drops other keys: where the batch is
    large its keys are not shuffled once more to drop them here."""
    wanted = batch.filter(index.has_key()).select(*index.keys)
    stored, n = _of_buckets(spark, index, wanted)
    if n < LARGE_SHARE * stored.count():
        return _latest(stored.join(wanted, list(index.keys), "left_semi"), index)
    return _latest(stored, index)


def next_seq(spark: SparkSession, index: KeyIndex) -> int:
    from freightlake.plans.tables import glob_paths

    found = glob_paths(spark, f"{_version(spark, index)}/seq=*")
    return max((int(p.rstrip("/").rsplit("=", 1)[1]) for p in found), default=-1) + 1


def compact(spark: SparkSession, index: KeyIndex) -> None:
    """The current rows as a new version; the old ones are removed when it is complete."""
    from freightlake.plans.tables import delete_path

    versions = _complete(spark, index.path)
    current = _latest(rows(spark, index), index).withColumns({"seq": F.lit(0), "bucket": index.bucket()})
    _write(current, f"{index.root}/v={versions[-1] + 1}", dynamic=False)
    for v in versions:
        delete_path(spark, f"{index.root}/v={v}/_SUCCESS")  # first: without it the version is out of force
        delete_path(spark, f"{index.root}/v={v}")


def stage_changes(spark: SparkSession, index: KeyIndex, changed: DataFrame, to: str) -> None:
    """The index rows of a merge's changed rows, written beside its staged data."""
    _write(index.entries(changed, next_seq(spark, index)), to, dynamic=False)


def apply_changes(spark: SparkSession, path: str, staged: str) -> None:
    """Staged index rows into the index; again after a stop gives the same index."""
    from freightlake.plans.tables import glob_paths, move_dirs

    index = load(spark, path)
    if index is not None and glob_paths(spark, f"{staged}/*.parquet"):  # staged without folders, by an earlier version
        schema = T.StructType.fromJson(json.loads(index.schema))
        _write(spark.read.schema(schema).parquet(staged), _version(spark, index), dynamic=True)
    elif index is not None:
        move_dirs(spark, f"{staged}/seq=*", _version(spark, index))
