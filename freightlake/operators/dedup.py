"""Latest row per key (W1/O1) and duplicate statistics.

``row_number() ... = 1`` is planned by Spark as a ``WindowGroupLimit`` that
keeps one row per key inside every map task *before* the shuffle, so a hot key
(or the NULL key) reaches the exchange as one row per map task, not as a third
of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(watermark: str, tie_breaks: list[str]) -> list[Column]:
    cols = [F.col(watermark).desc_nulls_last()]
    cols += [F.col(c).desc_nulls_last() for c in tie_breaks]
    return cols


def latest_per_key(df: DataFrame, keys: list[str] | str, watermark: str,
                   tie_breaks: list[str] | None = None) -> DataFrame:
    """Keep the row with the greatest watermark per key.

    NULL watermarks sort last; NULL keys form one group (one NULL-key row
    survives), as with ``select distinct``.  ``tie_breaks`` (descending) make
    the choice deterministic among equal watermarks.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_order(watermark, tie_breaks or []))
    return (df.withColumn("_rank", F.row_number().over(w))
              .filter(F.col("_rank") == 1)
              .drop("_rank"))


def distinct_keys(keys: list[str]) -> Column:
    """Number of distinct keys with NULL counted as a value (``distinct().count()``)."""
    return F.count_distinct(F.struct(*[F.col(k) for k in keys]))


def dedup_stats(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """A8/A9 in one aggregate: rows read, distinct keys, duplicates removed."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.agg(
        F.count(F.lit(1)).alias("records_read"),
        distinct_keys(keys).alias("distinct_keys"),
    ).withColumn("duplicates_removed", F.col("records_read") - F.col("distinct_keys"))
