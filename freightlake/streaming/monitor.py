"""A10 and Q16 for running streams: counters from the progress events of their batches.

``counted`` attaches counters to a stream; Spark computes them as a side effect of each
micro-batch (``observe``, no further scan) and delivers them with the batch's progress
event.  ``StreamMonitor`` listens to the session's streams and turns each event into
metric rows: the counters, the iterator age (processing instant minus newest event time)
and, when a stream ends, JobSuccess or JobFailure and, if the failure is that of a schema
check, SchemaValidationFailure.  ``flush`` writes the rows gathered so far;
``stream_metrics`` adds them up by stream, a replayed batch counted once.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from freightlake.operators.dedup import latest_per_key
from freightlake.operators.metrics import NAMESPACE
from freightlake.operators.schema_ops import SchemaValidationError

#: Start of the names of observations that carry counters.
PREFIX = "counters"
#: Observed column that holds the newest event time, in microseconds.
NEWEST = "newest_us"
#: Metric names with a unit or an aggregate of their own.
AGE = "IteratorAgeMilliseconds"
ROW_SCHEMA = ("metric string, domain string, value double, unit string, query_id string, run_id string, "
              "batch_id long, seen timestamp")


def counted(stream: DataFrame, domain: str, ts_col: str | None = None, **counters: Column) -> DataFrame:
    """``stream`` with the aggregates ``counters`` (name = column, e.g. ``RawRecordsRead=
    F.count(F.lit(1))``) observed in each batch; ``ts_col`` also gives the iterator age.
    A domain may be counted at several points of one stream, each metric at one of them.
    A ``foreachBatch`` function that runs its batch more than once persists it first: every
    run of its tasks counts."""
    found = [c.cast("double").alias(name) for name, c in counters.items()]
    if ts_col:
        found.append(F.max(F.unix_micros(F.col(ts_col).cast("timestamp"))).alias(NEWEST))
    return stream.observe(f"{PREFIX}:{domain}:{uuid.uuid4().hex[:8]}", *found)


class StreamMonitor(StreamingQueryListener):
    """Listens to the streams of a session between ``with StreamMonitor(spark, path)`` and
    its end.  ``domain`` names the streams that end (by query name, else the whole
    session's); ``now`` fixes the processing instant (None: the event's own).

    Events arrive on a thread of the driver, a few rows each, which only buffers them.
    Long-running callers flush on a timer: what a lost driver had not flushed is lost for
    batches that it committed; batches that are run again report again."""

    def __init__(self, spark: SparkSession, path: str, domain: str = "streams", now=None):
        self.spark, self.path, self.domain, self.now = spark, path, domain, now
        self._rows: list[tuple] = []
        self._names: dict[str, str | None] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc):
        self.spark.streams.removeListener(self)
        self.flush()

    def _end(self, run_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def _add(self, metric, domain, value, unit, event, batch_id) -> None:
        with self._lock:
            self._rows.append((metric, domain, float(value), unit, str(event.id), str(event.runId), batch_id,
                               dt.datetime.now(dt.timezone.utc)))

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        instant = dt.datetime.fromisoformat((str(self.now) if self.now else p.timestamp).replace("Z", "+00:00"))
        instant = instant if instant.tzinfo else instant.replace(tzinfo=dt.timezone.utc)
        for name, row in (p.observedMetrics or {}).items():
            if not name.startswith(f"{PREFIX}:"):
                continue
            domain = name.split(":")[1]
            for metric, value in row.asDict().items():
                if value is None:  # a batch without rows has no newest event, a sum over none no value
                    continue
                if metric == NEWEST:
                    micros = (instant - dt.datetime.fromtimestamp(0, dt.timezone.utc)) // dt.timedelta(microseconds=1)
                    self._add(AGE, domain, (micros - value) / 1000, "Milliseconds", p, p.batchId)
                else:
                    self._add(metric, domain, value, "Count", p, p.batchId)

    def onQueryTerminated(self, event) -> None:
        name = self._names.pop(str(event.runId), None) or self.domain
        failed = event.exception is not None
        self._add("JobFailure" if failed else "JobSuccess", name, 1, "Count", event, None)
        if failed and SchemaValidationError.__name__ in event.exception:
            self._add("SchemaValidationFailure", name, 1, "Count", event, None)
        self._end(event.runId).set()

    def wait(self, query, seconds: float = 60.0) -> None:
        """Return when the end of ``query`` has been heard, which follows all its batches."""
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError(f"end of stream {query.runId} not heard within {seconds} s")

    def flush(self) -> int:
        """Append the buffered rows to the metrics folder; their number."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            try:
                self.spark.createDataFrame(rows, ROW_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            except Exception:
                with self._lock:  # kept for the next flush
                    self._rows = rows + self._rows
                raise
        return len(rows)


def run_monitored(writer, monitor: StreamMonitor, name: str, fails: bool = False):
    """Run ``writer`` over everything available as stream ``name`` and wait until the monitor
    has heard of its end.  A failure is raised, after it has been counted; with ``fails``
    it is only counted."""
    query = writer.queryName(name).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        if not fails:
            raise
    finally:
        monitor.wait(query)
    return query


def stream_metrics(spark: SparkSession, path: str, now) -> DataFrame:
    """A10: one row for each (metric, domain) over the flushed rows.  Of a batch that ran
    more than once the last run counts; runs' ends count each.  Counters add up, the
    iterator age is the highest of any batch.  Raw minus written rows of a domain that
    counts both give DuplicatesRemoved."""
    rows = spark.read.schema(ROW_SCHEMA).parquet(path)
    batches = latest_per_key(rows.filter("batch_id IS NOT NULL"), ["query_id", "batch_id", "domain", "metric"], "seen", ["run_id"])
    rows = batches.unionByName(rows.filter("batch_id IS NULL"))
    total = rows.groupBy("metric", "domain", "unit").agg(
        F.when(F.col("metric") == AGE, F.max("value")).otherwise(F.sum("value")).alias("value"))
    raw, kept = (F.max(F.when(F.col("metric") == m, F.col("value"))) for m in ("RawRecordsRead", "BronzeRecordsWritten"))
    removed = (total.groupBy("domain").agg((raw - kept).alias("value")).filter("value IS NOT NULL")
               .select(F.lit("DuplicatesRemoved").alias("metric"), "domain", F.lit("Count").alias("unit"), "value"))
    return total.unionByName(removed).select(
        F.lit(NAMESPACE).alias("namespace"), "metric", "domain", "value", "unit", F.lit(str(now)).cast("timestamp").alias("ts"))
