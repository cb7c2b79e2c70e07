"""Run-time quality gate: one aggregate for every rule.

All counts come from a single ``agg`` (one scan, one shuffle for the distinct
key count) instead of one job per rule.  The rules are evaluated on that one
row (or one row per group with ``by``), so the failure table is built by Spark
too; only the gate decision looks at the (at most eight) failure rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.functions.expressions import invalid_status, round_half_up
from freightlake.operators.dedup import distinct_keys
from freightlake.schemas import CRITICAL_COLUMNS

# Fixed values of the gate rules: names, severities, limits and threshold texts.
NULL_PCT_LIMIT = 1.0
INVALID_PCT_LIMIT = 0.5
MIN_ROWS = 500_000
RULE_EMPTY = ("NonEmptyTable", "CRITICAL", "> 0")
RULE_COMPLETENESS = ("Completeness_{col}", "ERROR", "< 1%")
RULE_UNIQUE = ("Uniqueness_{pk}", "ERROR", "0 duplicatas")
RULE_VALID = ("ValidValues_status_norm", "WARNING", "< 0.5%")
RULE_TEMPORAL = ("TemporalConsistency", "ERROR", "0")
RULE_VOLUME = ("MinimumVolumeCheck", "WARNING", ">= {min_rows:,}")
BLOCKING = ("ERROR", "CRITICAL")


class QualityGateError(RuntimeError):
    """Q8: blocking failures with ``fail_on_error``."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        super().__init__(f"{len(failures)} blocking quality failure(s): "
                         + ", ".join(f["rule"] for f in failures))


def gate_counts(df: DataFrame, pk: str = "evento_id", critical_cols: list[str] | None = None,
                status_col: str = "status_norm", start_col: str = "data_inicio",
                end_col: str = "data_fim", by: list[str] | None = None) -> DataFrame:
    """Total, NULLs per critical column, distinct keys (NULL = one key),
    invalid statuses (NULL not invalid), start after end (NULL end ignored)."""
    critical_cols = critical_cols or CRITICAL_COLUMNS
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in critical_cols]
    aggs += [
        distinct_keys([pk]).alias("distinct_pk"),
        F.count_if(invalid_status(status_col)).alias("invalid_status"),
        F.count_if(F.col(start_col) > F.col(end_col)).alias("temporal_violations"),
    ]
    return (df.groupBy(*by) if by else df).agg(*aggs)


def _pct(count: Column, total: Column) -> Column:
    return count.cast("double") / total.cast("double") * F.lit(100.0)


def _fmt_pct(v: Column) -> Column:
    return F.format_string("%.2f%%", round_half_up(v, 2))


def gate_failures(counts: DataFrame, pk: str = "evento_id", critical_cols: list[str] | None = None,
                  min_rows: int = MIN_ROWS, by: list[str] | None = None) -> DataFrame:
    """Q1-Q7: one row per failed rule (rule, severity, message, threshold, actual).

    Q1 (empty input) short-circuits the other rules, as the gate returns at once.
    With ``by`` only the groups present in the input are checked (a day with no
    rows has no group): check emptiness on the ungrouped counts.
    """
    critical_cols = critical_cols or CRITICAL_COLUMNS
    by = by or []
    total = F.col("total")
    rules = []

    def rule(name, sev, thr, cond, actual, message):
        rules.append(F.when(cond, F.struct(
            F.lit(name).alias("rule"), F.lit(sev).alias("severity"), message.alias("message"),
            F.lit(thr).alias("threshold"), actual.cast("string").alias("actual"))))

    empty = total == 0
    rule(*RULE_EMPTY, empty, F.lit(0), F.lit("table has no rows for the processing date"))
    for c in critical_cols:
        pct = _pct(F.col(f"nulls_{c}"), total)
        rule(RULE_COMPLETENESS[0].format(col=c), RULE_COMPLETENESS[1], RULE_COMPLETENESS[2],
             ~empty & (pct > NULL_PCT_LIMIT), _fmt_pct(pct),
             F.format_string(f"column '{c}': %s null (threshold 1%%)", _fmt_pct(pct)))
    dups = total - F.col("distinct_pk")
    rule(RULE_UNIQUE[0].format(pk=pk), RULE_UNIQUE[1], RULE_UNIQUE[2],
         ~empty & (dups != 0), dups,
         F.format_string(f"primary key '{pk}' has %d duplicates", dups))
    inv = _pct(F.col("invalid_status"), total)
    rule(*RULE_VALID, ~empty & (inv > INVALID_PCT_LIMIT), _fmt_pct(inv),
         F.format_string("%s of rows with an invalid status", _fmt_pct(inv)))
    tv = F.col("temporal_violations")
    rule(*RULE_TEMPORAL, ~empty & (tv > 0), tv,
         F.format_string("%d rows with data_inicio > data_fim", tv))
    rule(RULE_VOLUME[0], RULE_VOLUME[1], RULE_VOLUME[2].format(min_rows=min_rows),
         ~empty & (total < min_rows), total,
         F.format_string(f"volume %d below the expected minimum of {min_rows:,}", total))
    exploded = counts.select(*by, F.explode(F.array(*rules)).alias("f"))
    return exploded.filter(F.col("f").isNotNull()).select(*by, "f.*")


def gate_decisions(counts: DataFrame, by: list[str], **rules) -> DataFrame:
    """Q8 as rows: for each checked group its blocking and all failures, and
    whether the run is blocked or passed."""
    failures = gate_failures(counts, by=by, **rules).groupBy(*by).agg(
        F.count_if(F.col("severity").isin(*BLOCKING)).alias("blocking"), F.count(F.lit(1)).alias("failures"))
    groups = counts.select(*[F.col(c).alias(f"_g_{c}") for c in by])
    match = [F.col(f"_g_{c}").eqNullSafe(F.col(c)) for c in by]
    n = F.coalesce("blocking", F.lit(0))
    return groups.join(failures, match, "left").select(
        *[F.col(f"_g_{c}").alias(c) for c in by], n.alias("blocking"), F.coalesce("failures", F.lit(0)).alias("failures"),
        F.when(n > 0, "blocked").otherwise("passed").alias("decision"))


def min_rows_from_history(metrics: DataFrame, domain: str, factor: float = 0.7,
                          metric: str = "RawRecordsRead", default: int = MIN_ROWS) -> int:
    """Q6 variant: ``factor`` x the average of earlier runs' row counts of a
    domain (from the metrics table, one aggregate); ``default`` without history."""
    row = (metrics.filter((F.col("metric") == metric) & (F.col("domain") == domain))
           .agg(F.avg("value").alias("avg")).collect()[0])
    return default if row["avg"] is None else int(row["avg"] * factor)


def gate(failures: DataFrame, fail_on_error: bool = True) -> list[dict]:
    """Q8: raise ``QualityGateError`` on ERROR/CRITICAL failures when asked.

    Collects the failure rows: at most eight per checked input.
    """
    rows = [r.asDict() for r in failures.collect()]
    raise_on_blocking(rows, fail_on_error)
    return rows


def raise_on_blocking(rows: list[dict], fail_on_error: bool = True) -> None:
    blocking = [r for r in rows if r["severity"] in BLOCKING]
    if blocking and fail_on_error:
        raise QualityGateError(blocking)


def alert_payload(failures: DataFrame, table: str, processing_date, ts,
                  by: list[str] | None = None) -> DataFrame:
    """Q9: the alert message as JSON text, one row per checked input (group)."""
    by = by or []
    grouped = failures.groupBy(*by) if by else failures.groupBy()
    agg = grouped.agg(F.sort_array(F.collect_list(F.struct(
        "rule", "severity", "message", "threshold", "actual"))).alias("failures"))
    return agg.select(*by, F.to_json(F.struct(
        F.lit("DATA_QUALITY_FAILURE").alias("alert_type"),
        F.lit(table).alias("table"),
        F.lit(str(processing_date)).alias("processing_date"),
        F.lit(str(ts)).alias("timestamp"),
        F.col("failures"),
    )).alias("payload"))
