"""freightlake: a PySpark-native medallion pipeline for freight-event data.

Layers are plain DataFrame functions; I/O sits at the edges:

* ``freightlake.sources``    raw drops by format, completeness markers, quarantine, layer reads
* ``freightlake.functions``  column expressions (status, duration, SLA, keys, rounding, masking)
* ``freightlake.operators``  dedup, audit, enrichment, upsert, quality gate, column tests,
                             metrics, dimensions, gold fact and marts, global order
* ``freightlake.plans``      table sinks, the day run, bucketed merges, registered queries
* ``freightlake.streaming``  file-stream landing, windows, joins, upserts, hot status

Clocks, as-of dates and run ids are always parameters.
"""

__version__ = "0.1.0"
