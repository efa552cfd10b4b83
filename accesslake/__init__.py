"""accesslake: web / FTP / CDN access-log analytics as Spark DataFrame functions.

Every public function takes and returns DataFrames (or Columns) so the same
code runs in batch and in Structured Streaming.  Sub-packages:

* ``sources``    – raw line scans, source descriptors, the CDN JSON reader,
                   loaders for the shipped tables and event-to-line replay.
* ``functions``  – Column builders (time parsing, URL splitting, IPv4 maths).
* ``operators``  – layouts, normalisation, enrichment joins, ordered rules,
                   roll-ups and sinks.
* ``plans``      – end-to-end transforms and the registered query catalogue.
* ``streaming``  – incremental ingest with an idempotent month-partitioned sink.
"""

__version__ = "0.1.0"
