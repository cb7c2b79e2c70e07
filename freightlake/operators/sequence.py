"""Next event of the same key, by day slices.

``lead`` over all events of a key puts the whole key into one task.  Here the
window is a key's day, and the last event of a day takes the first event of the
key's next day that has any, from a table with one row for each key and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def next_by_day(df: DataFrame, key: str, ts: str, tie: str, name: str) -> DataFrame:
    """``df`` with ``name``: the ``ts`` of the key's next event in (ts, tie)
    order, NULL times last.  NULL keys are one key, as in a window."""
    day = F.to_date(ts)
    rows = df.withColumn("_day", day)
    in_day = Window.partitionBy(key, "_day").orderBy(F.col(ts).asc_nulls_last(), F.col(tie).asc_nulls_last())
    firsts = rows.groupBy(F.col(key).alias("_key"), F.col("_day").alias("_d")).agg(F.min(ts).alias("_first"))
    by_day = Window.partitionBy("_key").orderBy(F.col("_d").asc_nulls_last())
    following = firsts.select("_key", "_d", F.lead("_first").over(by_day).alias("_following"))
    out = rows.withColumn("_next", F.lead(ts).over(in_day))
    joined = out.join(following, F.col(key).eqNullSafe(F.col("_key")) & F.col("_day").eqNullSafe(F.col("_d")), "left")
    return joined.withColumn(name, F.coalesce("_next", "_following")).drop("_day", "_key", "_d", "_next", "_following")
