"""Registered streaming queries: each runs a file stream to completion
(``availableNow``) into a sink under ``spark.checkpoint.dir`` and returns the
sink read back as a batch DataFrame."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from freightlake.plans import domain as dm
from freightlake.plans import oracle as o
from freightlake.plans import tables
from freightlake.plans.catalog import _LI_COLS, _LI_KEYS, _LI_TIES, register
from freightlake.session import scratch_path
from freightlake.sources import driver_tables as dt
from freightlake.operators import metrics
from freightlake.operators.schema_ops import require_columns
from freightlake.plans import packing
from freightlake.sources.raw import CORRUPT
from freightlake.streaming import monitor as mon
from freightlake.streaming import streams as st

_WINDOW = "1 hour"
_DELAY = "2 hours"
_STATUS_AS_OF = "2024-01-30 12:00:00"

_STATUS_SQL = ("regexp_replace(upper(trim(CASE event_type WHEN 'click' THEN '  em  transito ' "
               "WHEN 'view' THEN 'parado' WHEN 'purchase' THEN 'Chegou' WHEN 'signup' THEN 'manutencao' "
               "ELSE event_type END)), '\\s+', '_', 'g')")


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# Three arrivals: the events up to _FIRST (without the late ones), up to _SECOND,
# and the rest together with late ones from the first stretch.  A micro-batch drops
# rows by the watermark that the batch before it closed windows with, so these
# meet the watermark of the first arrival.
_FIRST, _SECOND = "2024-01-11", "2024-01-21"
_LATE = 50


def _arrivals(spark, sf) -> list:
    """The events of each arrival, in order."""
    ev = dt.table(spark, sf, "events")
    day, late = F.to_date("ts"), (F.col("event_id") % _LATE == 7) & (F.to_date("ts") < F.lit(_FIRST).cast("date"))
    first, second = (F.lit(x).cast("date") for x in (_FIRST, _SECOND))
    return [ev.filter((day < first) & ~late), ev.filter((day >= first) & (day < second)),
            ev.filter(late | (day >= second) | day.isNull())]


def _run_arrivals(spark, arrivals, start, max_bytes=None) -> None:
    """Each arrival is written in parallel and processed as one micro-batch of one
    checkpoint (as several of at most ``max_bytes``, if given); ``start`` runs the stream
    over the folder until all is read."""
    path = scratch_path(spark, "arrivals")
    for part in arrivals:
        part.write.mode("append").parquet(path)
        start(st.normalised_event_stream(spark, path, None, max_bytes_per_trigger=max_bytes))


@register("stream_windows", "T3 T8 A11", f"""
WITH s AS (SELECT {_STATUS_SQL} AS status_norm, ts, value, event_id,
                  event_id % {_LATE} = 7 AND ts < TIMESTAMP '{_FIRST} 00:00:00' AS late FROM events),
wm1 AS (SELECT max(ts) - INTERVAL {_DELAY} AS wm FROM s WHERE ts < TIMESTAMP '{_FIRST} 00:00:00' AND NOT late),
wm AS (SELECT max(ts) - INTERVAL {_DELAY} AS wm FROM events)
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       status_norm, count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM s WHERE NOT late OR date_trunc('hour', ts) + INTERVAL 1 HOUR > (SELECT wm FROM wm1)
GROUP BY 1, 2, 3
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT wm FROM wm)""")
def q_stream_windows(spark, sf):
    # rows of the third arrival that belong to windows the first one's watermark has
    # closed are dropped
    out, ckpt = scratch_path(spark, "stream-windows"), scratch_path(spark, "ckpt-windows")
    _run_arrivals(spark, _arrivals(spark, sf), lambda stream: st.to_parquet_sink(
        st.windowed_counts(stream, "updated_at", _WINDOW, _DELAY, ["status_norm"], "value"), out, ckpt))
    return _ntz(spark.read.parquet(out), "window_start", "window_end")


@register("stream_late_windows", "T8 T3 A10", f"""
WITH s AS (SELECT {_STATUS_SQL} AS status_norm, ts, value,
                  event_id % {_LATE} = 7 AND ts < TIMESTAMP '{_FIRST} 00:00:00' AS late FROM events),
wm2 AS (SELECT max(ts) - INTERVAL {_DELAY} AS wm FROM s WHERE ts < TIMESTAMP '{_SECOND} 00:00:00' AND NOT late),
wm AS (SELECT max(ts) - INTERVAL {_DELAY} AS wm FROM events)
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       status_norm, count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum,
       count(*) FILTER (WHERE late AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT wm FROM wm2)) AS n_late
FROM s GROUP BY 1, 2, 3
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT wm FROM wm)""")
def q_stream_late_windows(spark, sf):
    # the same arrivals, late rows added to the windows they belong to: the batch result
    out, ckpt = scratch_path(spark, "stream-partials"), scratch_path(spark, "ckpt-partials")
    writer = st.window_partials_writer(out, "updated_at", _WINDOW, _DELAY, ["status_norm"], "value")
    _run_arrivals(spark, _arrivals(spark, sf), lambda stream: st.run_foreach_batch(stream, writer, ckpt))
    return _ntz(st.merged_windows(spark, out, _DELAY), "window_start", "window_end")


# Repeats: in the same arrival an hour later, in the next arrival within the delay (both
# dropped), and 25 days later, when the key has left the state (kept).
_REPEAT_SQL = f"event_id % 50 = 9 AND ts < TIMESTAMP '{_FIRST} 00:00:00' - INTERVAL 2 DAY"


@register("stream_dedup", "T6 T9", f"""
SELECT event_id AS evento_id, count(*) AS n FROM (
  SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE {_REPEAT_SQL}) GROUP BY 1""")
def q_stream_dedup(spark, sf):
    a, b, c = (x.filter("ts IS NOT NULL") for x in _split(spark, sf))
    newest = a.agg(F.max("ts").alias("newest"))
    inside = (a.filter("event_id % 4 = 1").withColumn("ts", F.expr("ts + INTERVAL 1 HOUR")))
    again = a.join(F.broadcast(newest), F.col("ts") > F.col("newest") - F.expr("INTERVAL 1 HOUR")).drop("newest")  # one row
    outside = a.filter(F.expr(_REPEAT_SQL)).withColumn("ts", F.expr("ts + INTERVAL 25 DAYS"))
    none = dt.table(spark, sf, "events").filter("ts IS NULL")
    out, ckpt = scratch_path(spark, "stream-dedup"), scratch_path(spark, "ckpt-dedup")
    with _durable(spark):
        _run_arrivals(spark, [a.unionByName(inside), b.unionByName(again), c.unionByName(outside)], lambda stream: st.to_parquet_sink(
            st.dedup_stream(stream.select("evento_id", "updated_at"), ["evento_id"], "updated_at", _DELAY), out, ckpt))
    kept = spark.read.parquet(out).select("evento_id").unionByName(none.select(F.col("event_id").alias("evento_id")))
    return kept.groupBy("evento_id").agg(F.count(F.lit(1)).alias("n"))


def _split(spark, sf) -> list:
    """The events in three stretches of time."""
    ev = dt.table(spark, sf, "events")
    first, second = (F.lit(x).cast("date") for x in (_FIRST, _SECOND))
    day = F.to_date("ts")
    return [ev.filter(day < first), ev.filter((day >= first) & (day < second)), ev.filter(day >= second)]


@contextmanager
def _durable(spark):
    """RocksDB state for the streams of a query; the session's settings come back."""
    names = ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")
    before = {n: spark.conf.get(n, None) for n in names}
    st.durable_state(spark)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


# Two arrivals; the run stops after the first batch is in the table and before the stream
# commits it, then starts again on the same checkpoint and replays the batch.  Every tenth
# id is missing: rows without a key never match, so a batch merged twice would show.
@register("stream_crash", "T9 T6 M1", f"""
WITH s AS (SELECT CASE WHEN event_id % 10 <> 3 THEN user_id END AS vagao_id, event_id AS evento_id, {_STATUS_SQL} AS status_norm,
                  ts AS updated_at, ts < TIMESTAMP '{_FIRST} 00:00:00' AS first FROM events),
latest AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY vagao_id, CASE WHEN vagao_id IS NULL THEN coalesce(first, false) END
                                                      ORDER BY updated_at DESC NULLS LAST, evento_id DESC) = 1)
SELECT vagao_id, evento_id, status_norm, updated_at, CAST(updated_at AS DATE) AS _partition_date FROM latest""")
def q_stream_crash(spark, sf):
    ev = dt.table(spark, sf, "events")
    first = F.coalesce(F.col("ts") < F.lit(_FIRST).cast("timestamp_ntz"), F.lit(False))
    path, table, ckpt = (scratch_path(spark, n) for n in ("crash-in", "crash-table", "ckpt-crash"))
    writer = st.upsert_batch_writer(spark, table, ["vagao_id"], "updated_at", ["evento_id"])

    def run(write):
        stream = st.normalised_event_stream(spark, path, None).select(
            F.when(F.col("evento_id") % 10 != 3, F.col("vagao_id")).alias("vagao_id"), "evento_id", "status_norm", "updated_at")
        st.run_foreach_batch(stream, write, ckpt)

    def stops_after_the_sink(batch, batch_id):
        writer(batch, batch_id)
        raise RuntimeError("stopped before the commit")

    ev.filter(first).write.mode("append").parquet(path)
    try:
        run(stops_after_the_sink)
    except StreamingQueryException:
        pass
    run(writer)
    ev.filter(~first).write.mode("append").parquet(path)
    run(writer)
    return _ntz(tables.read_table(spark, table), "updated_at")


@register("stream_restart", "T9 T1", f"""
SELECT event_id AS evento_id, user_id AS vagao_id, {_STATUS_SQL} AS status_norm, ts AS updated_at FROM events""")
def q_stream_restart(spark, sf):
    # two runs on one checkpoint: the second reads only the files that came after the first
    ev = dt.table(spark, sf, "events")
    first = F.to_date("ts") < F.lit(_FIRST).cast("date")
    path, out, ckpt = (scratch_path(spark, n) for n in ("restart-in", "restart-out", "ckpt-restart"))
    for part in (ev.filter(first), ev.filter(F.coalesce(~first, F.lit(True)))):
        part.write.mode("append").parquet(path)
        stream = st.normalised_event_stream(spark, path, None).drop("value", "contrato_id")
        st.to_parquet_sink(stream, out, ckpt)
    return _ntz(spark.read.parquet(out), "updated_at")


_LANDING_SCHEMA = "evento_id long, vagao_id long, status string, dia date"


def _landing_json(spark, sf) -> str:
    """A folder of the events as JSON lines; those of status ``error`` lack their last brace."""
    landing = scratch_path(spark, "landing-events-json")
    ev = dt.raw_events(spark, sf)
    j = F.to_json(F.struct("evento_id", "vagao_id", "status",
                           F.date_format("data_inicio", "yyyy-MM-dd").alias("dia")))
    bad = F.expr("substring(_j, 1, length(_j) - 1)")
    (ev.withColumn("_j", j)
       .select(F.when(F.col("status") == "error", bad).otherwise(F.col("_j")).alias("value"))
       .write.text(landing))
    return landing


@register("stream_landing", "T1 T2 S8 S10", o.with_ctes() + """
SELECT CASE WHEN status = 'error' THEN NULL ELSE evento_id END AS evento_id,
       CASE WHEN status = 'error' THEN NULL ELSE vagao_id END AS vagao_id,
       CASE WHEN status = 'error' THEN NULL ELSE status END AS status,
       CASE WHEN status = 'error' THEN NULL ELSE CAST(data_inicio AS DATE) END AS date,
       CASE WHEN status = 'error' THEN '{"evento_id":' || evento_id || ',"vagao_id":' || vagao_id
            || ',"status":"' || status || '","dia":"' || strftime(CAST(data_inicio AS DATE), '%Y-%m-%d') || '"' END AS _raw,
       CASE WHEN status = 'error' THEN 'malformed_record' END AS error_type,
       CASE WHEN status = 'error' THEN DATE '2024-01-31' END AS landed_on,
       coalesce(status = 'error', false) AS has_source
FROM ev""")
def q_stream_landing(spark, sf):
    landing = _landing_json(spark, sf)
    schema = _LANDING_SCHEMA + f", {CORRUPT} string"
    stream = st.file_stream(spark, landing, schema, fmt="json", corrupt_column=CORRUPT).withColumn(
        "_source_file", F.col("_metadata.file_path"))
    good_p, err_p = scratch_path(spark, "landed"), scratch_path(spark, "landing-errors")
    st.run_foreach_batch(stream, st.landing_batch_writer(good_p, err_p, "date", "dia", now=dm.NOW),
                         scratch_path(spark, "ckpt-landing"))
    good = spark.read.parquet(good_p).select(
        "evento_id", "vagao_id", "status", "date", F.lit(None).cast("string").alias("_raw"),
        F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("date").alias("landed_on"),
        F.lit(False).alias("has_source"))
    errors = spark.read.parquet(err_p).select(
        F.lit(None).cast("long").alias("evento_id"), F.lit(None).cast("long").alias("vagao_id"),
        F.lit(None).cast("string").alias("status"), F.lit(None).cast("date").alias("date"), "_raw",
        "error_type", F.col("date").alias("landed_on"), F.col("_source_file").isNotNull().alias("has_source"))
    return good.unionByName(errors)


@register("stream_upsert", "T6 M1 K2", f"""
SELECT {_LI_COLS}, CAST(date_trunc('month', l_shipdate) AS DATE) AS _partition_month FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_stream_upsert(spark, sf):
    schema = dt.table(spark, sf, "lineitem").schema
    stream = st.file_stream(spark, sf, schema, file_glob="lineitem.parquet")
    path = scratch_path(spark, "bronze-lineitem")
    writer = st.upsert_batch_writer(spark, path, _LI_KEYS, "l_shipdate", _LI_TIES,
                                    part_col="_partition_month", part_unit="month")
    st.run_foreach_batch(stream, writer,
                         scratch_path(spark, "ckpt-upsert"))
    return tables.read_table(spark, path)


@register("stream_enriched", "T4 J8", o.with_ctes() + f"""
SELECT e.event_id AS evento_id, e.user_id AS vagao_id, e.user_id AS contrato_id,
       {_STATUS_SQL} AS status_norm, e.ts AS updated_at,
       w.tipo_vagao, c.cliente_nome, c.segmento, c.sla_horas
FROM events e
LEFT JOIN wagons w ON e.user_id = w.vagao_id
LEFT JOIN contracts c ON e.user_id = c.contrato_id""")
def q_stream_enriched(spark, sf):
    stream = st.normalised_event_stream(spark, sf).drop("value")
    enriched = st.enrich_stream(stream, dt.raw_wagons(spark, sf), dt.raw_contracts(spark, sf))
    out = scratch_path(spark, "stream-enriched")
    st.to_parquet_sink(enriched, out, scratch_path(spark, "ckpt-enriched"))
    return _ntz(spark.read.parquet(out), "updated_at")


@register("stream_pairs", "T5 J9", """
SELECT s.event_id AS partida_id, e.event_id AS chegada_id, s.user_id AS vagao_id, s.ts AS partida, e.ts AS chegada
FROM events s JOIN events e ON e.user_id = s.user_id AND e.ts >= s.ts AND e.ts <= s.ts + INTERVAL 24 HOUR
WHERE s.event_type = 'click' AND e.event_type = 'purchase'""")
def q_stream_pairs(spark, sf):
    return _pairs(spark, sf, "inner")


# Departures without an arrival within a day come out when the watermark (the older side's
# last event less an hour) has passed that day; those whose day is open yet are withheld.
@register("stream_open_departures", "T5 J9 T8", """
WITH w AS (SELECT least(max(ts) FILTER (WHERE event_type = 'click'), max(ts) FILTER (WHERE event_type = 'purchase'))
                  - INTERVAL 1 HOUR AS mark FROM events)
SELECT s.event_id AS partida_id, e.event_id AS chegada_id, s.user_id AS vagao_id, s.ts AS partida, e.ts AS chegada
FROM events s CROSS JOIN w
LEFT JOIN events e ON e.event_type = 'purchase' AND e.user_id = s.user_id AND e.ts >= s.ts AND e.ts <= s.ts + INTERVAL 24 HOUR
WHERE s.event_type = 'click' AND (e.event_id IS NOT NULL OR s.ts + INTERVAL 24 HOUR < w.mark)""")
def q_stream_open_departures(spark, sf):
    return _pairs(spark, sf, "left_outer")


def _pairs(spark, sf, how):
    # departures (EM_TRANSITO) with the arrivals (CHEGOU) of the same wagon within a day
    departures = st.normalised_event_stream(spark, sf).filter("status_norm = 'EM_TRANSITO'").select(
        F.col("evento_id").alias("partida_id"), "vagao_id", F.col("updated_at").alias("partida"))
    arrivals = st.normalised_event_stream(spark, sf).filter("status_norm = 'CHEGOU'").select(
        F.col("evento_id").alias("chegada_id"), "vagao_id", F.col("updated_at").alias("chegada"))
    pairs = st.interval_join(departures, arrivals, "vagao_id", "partida", "chegada", "24 HOURS", "1 hour", how)
    out = scratch_path(spark, "stream-pairs")
    st.to_parquet_sink(pairs, out, scratch_path(spark, "ckpt-pairs"))
    return _ntz(spark.read.parquet(out), "partida", "chegada")


@register("hot_status", "T7", f"""
WITH s AS (SELECT event_id AS evento_id, user_id AS vagao_id, {_STATUS_SQL} AS status_norm, ts AS updated_at
           FROM events)
SELECT vagao_id, evento_id, status_norm, updated_at, updated_at + INTERVAL 24 HOUR AS expires_at FROM (
  SELECT *, row_number() OVER (PARTITION BY vagao_id ORDER BY updated_at DESC, evento_id DESC) AS rn
  FROM s WHERE updated_at <= TIMESTAMP '{_STATUS_AS_OF}'
           AND updated_at + INTERVAL 24 HOUR > TIMESTAMP '{_STATUS_AS_OF}') WHERE rn = 1""")
def q_hot_status(spark, sf):
    stream = st.normalised_event_stream(spark, sf)
    path = scratch_path(spark, "hot-status")
    st.run_foreach_batch(stream, st.status_batch_writer(spark, path, 24), scratch_path(spark, "ckpt-status"))
    cur = st.current_status(tables.read_table(spark, path), _STATUS_AS_OF)
    return _ntz(cur.select("vagao_id", "evento_id", "status_norm", "updated_at", "expires_at"),
                "updated_at", "expires_at")


# Three streams: landing of JSON lines with malformed ones, an ingest whose every fourth
# event comes twice, and one whose files lack a required column, which fails.
@register("stream_counters", "A10 Q16 T9 V1", o.with_ctes() + f"""
, raw AS (SELECT event_id, ts FROM events WHERE ts IS NOT NULL
          UNION ALL SELECT event_id, ts + INTERVAL 1 HOUR FROM events WHERE ts IS NOT NULL AND event_id % 4 = 1),
c AS (SELECT count(*) AS n, count(DISTINCT event_id) AS kept,
             (epoch_us(TIMESTAMP '{dm.NOW}') - epoch_us(max(ts))) / 1000.0 AS age FROM raw),
l AS (SELECT count(*) FILTER (WHERE status IS DISTINCT FROM 'error') AS good, count(*) FILTER (WHERE status = 'error') AS bad FROM ev),
m(metric, domain, value, unit) AS (
  SELECT 'RawRecordsRead', 'eventos', n, 'Count' FROM c
  UNION ALL SELECT 'BronzeRecordsWritten', 'eventos', kept, 'Count' FROM c
  UNION ALL SELECT 'DuplicatesRemoved', 'eventos', n - kept, 'Count' FROM c
  UNION ALL SELECT 'IteratorAgeMilliseconds', 'eventos', age, 'Milliseconds' FROM c
  UNION ALL SELECT 'ApiRecordsIngested', 'api', good, 'Count' FROM l
  UNION ALL SELECT 'ApiIngestionError', 'api', bad, 'Count' FROM l
  UNION ALL VALUES ('JobSuccess', 'api', 1, 'Count'), ('JobSuccess', 'eventos', 1, 'Count'),
                   ('JobFailure', 'drift', 1, 'Count'), ('SchemaValidationFailure', 'drift', 1, 'Count')),
r(metric, threshold) AS (VALUES ('JobFailure', 0), ('DuplicatesRemoved', 50000), ('SchemaValidationFailure', 0),
                                ('IteratorAgeMilliseconds', 300000))
SELECT m.metric, 'freightlake/pipeline' AS namespace, m.domain, CAST(m.value AS DOUBLE) AS value, m.unit,
       TIMESTAMP '{dm.NOW}' AS ts, CASE WHEN r.metric IS NOT NULL THEN '>' END AS comparison,
       CAST(r.threshold AS DOUBLE) AS threshold, coalesce(m.value > r.threshold, false) AS alarm
FROM m LEFT JOIN r ON m.metric = r.metric""")
def q_stream_counters(spark, sf):
    found, arrived = scratch_path(spark, "stream-counters"), scratch_path(spark, "counters-in")
    ev = dt.table(spark, sf, "events").filter("ts IS NOT NULL")
    ev.unionByName(ev.filter("event_id % 4 = 1").withColumn("ts", F.expr("ts + INTERVAL 1 HOUR"))).write.parquet(arrived)

    def sink(stream, name):
        return (stream.writeStream.format("parquet").option("path", scratch_path(spark, f"counters-{name}"))
                .option("checkpointLocation", scratch_path(spark, f"ckpt-counters-{name}")))

    api = mon.counted(st.file_stream(spark, _landing_json(spark, sf), f"{_LANDING_SCHEMA}, {CORRUPT} string", fmt="json", corrupt_column=CORRUPT),
                      "api", ApiRecordsIngested=F.count_if(F.col(CORRUPT).isNull()), ApiIngestionError=F.count_if(F.col(CORRUPT).isNotNull()))
    rows = F.count(F.lit(1))
    events = st.normalised_event_stream(spark, arrived, None).select("evento_id", "updated_at")
    raw = mon.counted(events, "eventos", "updated_at", RawRecordsRead=rows)
    kept = mon.counted(st.dedup_stream(raw, ["evento_id"], "updated_at", _DELAY), "eventos", BronzeRecordsWritten=rows)
    drift = (events.drop("updated_at").writeStream.option("checkpointLocation", scratch_path(spark, "ckpt-counters-drift"))
             .foreachBatch(lambda batch, batch_id: require_columns(batch, ["evento_id", "updated_at"])))
    with mon.StreamMonitor(spark, found, now=dm.NOW) as monitor, _durable(spark):
        mon.run_monitored(sink(api, "api"), monitor, "api")
        mon.run_monitored(sink(kept, "eventos"), monitor, "eventos")
        mon.run_monitored(drift, monitor, "drift", fails=True)
    out = metrics.alarms(mon.stream_metrics(spark, found, dm.NOW), metrics.alarm_rules(spark), how="left")
    return _ntz(out, "ts")


# Batches bounded by size land below date and batch; the files of each date are packed.
_PACKED = 64 * 1024 * 1024


@register("landing_packed", "T1 T9", """
SELECT CAST(ts AS DATE) AS date, count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum,
       true AS few_files, true AS within_bound FROM events GROUP BY 1""")
def q_landing_packed(spark, sf):
    landed, ckpt = scratch_path(spark, "packed"), scratch_path(spark, "ckpt-packed")
    writer = st.landing_batch_writer(landed, scratch_path(spark, "packed-errors"), "date", "updated_at", now=dm.NOW)
    _run_arrivals(spark, _arrivals(spark, sf), lambda stream: st.run_foreach_batch(
        stream.withColumn(CORRUPT, F.lit(None).cast("string")), writer, ckpt), max_bytes=128 << 20)
    date = F.regexp_extract("folder", "/date=([^/]*)", 1)

    def by_date(files, *aggs):
        return files.groupBy(F.when(date != tables.NULL_PARTITION, date).cast("date").alias("date")).agg(*aggs)

    listed = scratch_path(spark, "packed-listing")  # of the files before they are packed
    by_date(packing.list_files(spark, landed), F.sum("bytes").alias("bytes")).write.parquet(listed)
    before = spark.read.parquet(listed)
    done = by_date(packing.pack_files(spark, landed, _PACKED, batch_col="batch_id"), F.max("bytes").alias("largest"))
    after = by_date(packing.list_files(spark, landed), F.count(F.lit(1)).alias("n"))
    files = before.join(after, before["date"].eqNullSafe(after["date"])).drop(after["date"])
    files = files.join(done.withColumnRenamed("date", "_d"), F.col("date").eqNullSafe(F.col("_d")), "left").select(
        F.col("date").alias("_d"), (F.col("n") <= 2 * F.col("bytes") / _PACKED + 1).alias("few_files"),
        F.coalesce(F.col("largest") <= _PACKED, F.lit(True)).alias("within_bound"))
    rows = spark.read.parquet(landed).groupBy("date").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").try_cast("decimal(18,2)")).cast("double").alias("value_sum"))
    return rows.join(files, F.col("date").eqNullSafe(F.col("_d")), "left").drop("_d")
