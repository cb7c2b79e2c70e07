"""As-of state of a keyed table (K10) and sensitive-column masking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.functions.expressions import mask_hash, mask_text
from freightlake.operators.dedup import latest_per_key


def as_of_state(history: DataFrame, keys: list[str], watermark: str, as_of,
                tie_breaks: list[str] | None = None) -> DataFrame:
    """The table as it was at ``as_of``: rows with watermark <= as_of,
    latest per key.  Works on the immutable raw history; the filter is pushed
    into the scan, the top-1 is reduced map-side (WindowGroupLimit)."""
    limit = F.lit(str(as_of)).cast(history.schema[watermark].dataType)
    return latest_per_key(history.filter(F.col(watermark) <= limit), keys, watermark, tie_breaks)


def mask_columns(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``{"col": "hash" | "mask" | "drop"}``; other columns unchanged."""
    unknown = {c: h for c, h in rules.items() if h not in ("hash", "mask", "drop")}
    if unknown:
        raise ValueError(f"unknown masking rules: {unknown}")
    changed = {c: (mask_hash(c) if h == "hash" else mask_text(c))
               for c, h in rules.items() if h != "drop"}
    return df.withColumns(changed).drop(*[c for c, h in rules.items() if h == "drop"])
