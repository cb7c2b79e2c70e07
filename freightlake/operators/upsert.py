"""Key-based upsert without a table format: M1-M4 (and the J6 match join).

``merge_upsert`` returns the merged table as a DataFrame (pure); the
touched-partition writer in ``freightlake.plans.tables`` persists it.

Semantics (as ``MERGE ... WHEN MATCHED AND <newer> THEN UPDATE SET *
WHEN NOT MATCHED THEN INSERT *``):

* a key match whose source watermark is greater replaces the target row;
* a tie, an older source row or a NULL watermark keeps the target row;
* a source key absent from the target is inserted;
* a NULL key never matches: such source rows are inserted on every run;
* ``newer=None`` replaces every matched row (a plain key merge).

NULL-key rows all hash to one shuffle partition, and a full outer join cannot
be split by AQE's skew handling, so they get a row-hash salt that spreads them
over ``null_key_spread`` partitions; the salts of the two sides never meet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class AmbiguousMergeError(ValueError):
    """M4: the source holds the same non-NULL key more than once."""


def duplicate_source_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (non-NULL) that appear more than once in the source."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (source.filter(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def assert_unique_source(source: DataFrame, keys: list[str]) -> None:
    """M4: one small job; raises when a non-NULL key repeats."""
    dup = duplicate_source_keys(source, keys).limit(1).collect()
    if dup:
        raise AmbiguousMergeError(f"source key repeats: {dup[0].asDict()}")


def _salted(df: DataFrame, keys: list[str], side: int, spread: int, prefix: str) -> DataFrame:
    """Columns renamed ``<prefix>_<col>`` plus the join salt and a presence flag."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread)) + F.lit(1)
    return df.select(
        *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns],
        F.when(any_null, bucket * F.lit(side)).otherwise(F.lit(0)).alias(f"{prefix}__salt"),
        F.lit(True).alias(f"{prefix}__in_{prefix}"),
    )


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str] | str,
                 newer: str | None = None, check_unique: bool = False,
                 null_key_spread: int = 256, salt_null_keys: bool = True) -> DataFrame:
    """Upsert ``source`` into ``target`` by ``keys``; returns the merged table.

    Output columns: the target's, then any column only the source has (V3);
    a column missing on the chosen side is NULL.  ``salt_null_keys=False``
    joins on plain key equality and lets rows with a NULL key by-pass the join
    (same result), so that a target bucketed by the keys is joined without a
    shuffle (see ``freightlake.plans.bucketed``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if check_unique:
        assert_unique_source(source, keys)
    if not salt_null_keys:
        has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        joined = _merge_joined(target.filter(has_key), source.filter(has_key), keys, newer, null_key_spread, False)
        loose = target.filter(~has_key).unionByName(source.filter(~has_key), allowMissingColumns=True)
        return joined.unionByName(loose)
    return _merge_joined(target, source, keys, newer, null_key_spread, True)


def _merge_joined(target: DataFrame, source: DataFrame, keys: list[str], newer: str | None,
                  null_key_spread: int, salt_null_keys: bool) -> DataFrame:
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    t = _salted(target, keys, 1, null_key_spread, "t")
    s = _salted(source, keys, -1, null_key_spread, "s")
    if salt_null_keys:
        cond = reduce(lambda a, b: a & b,
                      [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in keys]
                      + [F.col("t__salt") == F.col("s__salt")])
    else:
        cond = reduce(lambda a, b: a & b, [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys])
    j = t.join(s, cond, "full_outer")
    matched = F.col("t__in_t").isNotNull() & F.col("s__in_s").isNotNull()
    if newer is None:
        replace = F.lit(True)
    else:
        replace = F.coalesce(F.col(f"s_{newer}") > F.col(f"t_{newer}"), F.lit(False))
    take_source = F.col("s__in_s").isNotNull() & (F.col("t__in_t").isNull() | (matched & replace))

    def pick(c: str):
        sv = F.col(f"s_{c}") if c in source.columns else F.lit(None)
        tv = F.col(f"t_{c}") if c in target.columns else F.lit(None)
        return F.when(take_source, sv).otherwise(tv).alias(c)

    return j.select(*[pick(c) for c in cols])


def merge_actions(target: DataFrame, source: DataFrame, keys: list[str] | str,
                  newer: str | None = None) -> DataFrame:
    """J6 as a report: per source row, ``insert``, ``update`` or ``keep_target``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    tk = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys],
                       *([F.col(newer).alias("_t_wm")] if newer else []))
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_t_{k}") for k in keys])
    j = source.join(tk, cond, "left")
    hit = F.col(f"_t_{keys[0]}").isNotNull()
    if newer is None:
        upd = hit
    else:
        upd = hit & F.coalesce(F.col(newer) > F.col("_t_wm"), F.lit(False))
    action = F.when(~hit, "insert").when(upd, "update").otherwise("keep_target")
    return j.select(*source.columns, action.alias("_merge_action"))
