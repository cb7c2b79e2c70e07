"""Point-in-time joins (D1/D2 with K10): facts with the dimension version of their instant.

A join on the key alone pairs each fact with every version of its key, and a sort by key
and time puts a hot key into one task.  Here both sides are cut into time slices: a
version stands once in each slice that it overlaps, a fact lies in one, and the join is
an equi-join on (key, slice) with the interval as residual.  A hot key is spread over its
slices, and Spark's skew join splits the fact side of a hot slice further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, ts: str, columns: list[str],
               valid_from: str = "valid_from", valid_to: str = "valid_to", slice_days: int = 7) -> DataFrame:
    """``facts`` with ``columns`` of the version of ``key`` that holds at ``ts``
    (``valid_from <= ts < valid_to``; NULL: open on that side); NULLs where none holds, and
    for a NULL key or time.  Versions of one key must not overlap; of empty or reversed
    intervals nothing is taken.

    Open sides end at the first and last fact, so a version has at most as many slices as
    the facts span (one aggregate over the facts finds it)."""
    micros = 86_400_000_000 * slice_days

    def slice_of(col):
        return F.floor(F.unix_micros(col.cast("timestamp")) / F.lit(micros)).cast("long")

    span = facts.agg(F.min(slice_of(F.col(ts))).alias("_lo"), F.max(slice_of(F.col(ts))).alias("_hi"))
    kept = versions.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_v_key"), F.col(valid_from).cast("timestamp").alias("_v_from"),
        F.col(valid_to).cast("timestamp").alias("_v_to"), *[F.col(c).alias(f"_v_{c}") for c in columns])
    held = F.coalesce(F.col("_v_from") < F.col("_v_to"), F.lit(True))
    lo = F.greatest(F.coalesce(slice_of(F.col("_v_from")), F.col("_lo")), F.col("_lo"))
    hi = F.least(F.coalesce(slice_of(F.col("_v_to")), F.col("_hi")), F.col("_hi"))
    sliced = (kept.filter(held).crossJoin(F.broadcast(span))  # one row
              .withColumns({"_s_lo": lo, "_s_hi": hi}).filter("_s_lo <= _s_hi")
              .withColumn("_v_slice", F.explode(F.sequence("_s_lo", "_s_hi"))).drop("_lo", "_hi", "_s_lo", "_s_hi"))
    at = F.col(ts).cast("timestamp")
    cond = ((F.col(key) == F.col("_v_key")) & (slice_of(F.col(ts)) == F.col("_v_slice"))
            & F.coalesce(at >= F.col("_v_from"), F.col("_v_from").isNull())
            & F.coalesce(at < F.col("_v_to"), F.col("_v_to").isNull()))
    return facts.join(sliced, cond, "left").select(*[facts[c] for c in facts.columns],
                                                   *[F.col(f"_v_{c}").alias(c) for c in columns])
