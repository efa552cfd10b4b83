"""Incremental ingest (T1–T5, T7) with Structured Streaming.

``start_ingest`` reads new log files as they arrive, applies the same
``plans.ingest.transform`` as batch, and writes each micro-batch with
``foreachBatch``:

* T3 – the batch is de-duplicated and anti-joined against the store's touched
  months before appending, so replays (a restarted query re-running its last
  epoch, a file delivered twice, a source replayed from scratch with a new
  checkpoint) add nothing;
* T5 – rows land in their own ``event_month`` however late they arrive; no
  event-time watermark sits in front of the store;
* T7 – quarantined rows go to a side output from the same micro-batch;
* T4 (optional) – ``dropDuplicatesWithinWatermark`` on the arrival time keeps
  re-delivered lines out of the batch before the sink, with bounded state.

The checkpoint lives under the session's ``spark.checkpoint.dir`` unless one
is given, so a lost driver or executor resumes from the last committed epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import sinks
from ..operators.bucketstore import BucketStore
from ..operators.normalise import is_quarantined
from ..plans.ingest import Dimensions, enrich_events, transform
from ..session import scratch_path
from ..sources.text import stream_lines


def micro_batch_writer(store_path: str, quarantine_path: str | None, dims: Dimensions | None = None, writer: str | None = None):
    """T3/T7 writer.  With ``writer`` the store is a ``BucketStore``: the epoch is
    the batch of its record, and several ingest queries with names of their own
    can share the store.  Dimension joins that first take distinct values of the
    batch (registered domains, agents) run here, on the micro-batch as an
    ordinary DataFrame; on the stream itself they would be stream-stream joins."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            kept = batch.where(F.col("drop_reason").isNull())
            if dims is not None:
                kept = enrich_events(kept, dims, stored=True)  # the batch is persisted
            good = kept.where(~is_quarantined(F.col("tags")))
            if writer is None:
                sinks.write_store(good, store_path, stored=True)  # the batch is persisted
            else:
                BucketStore(batch.sparkSession, store_path).append(good, writer, epoch_id)
            if quarantine_path:
                sinks.write_quarantine(kept, quarantine_path, batch_id=epoch_id)
        finally:
            batch.unpersist()
    return write


def ingest_stream(lines: DataFrame, dims: Dimensions | None = None,
                  dedupe_watermark: str | None = None, sources: DataFrame | None = None) -> DataFrame:
    """T2 (+T4): streaming lines → events, same transform as batch.

    Only the stateless per-row part runs on the stream; ``dims`` are applied
    per micro-batch by ``micro_batch_writer``."""
    ev = transform(lines.withColumn("ingested_at", F.current_timestamp()), None, keep_dropped=True, sources=sources)
    if dedupe_watermark:
        ev = ev.withWatermark("ingested_at", dedupe_watermark).dropDuplicatesWithinWatermark(["event_hash"])
    return ev


def start_ingest(spark: SparkSession, source_path: str, store_path: str,
                 quarantine_path: str | None = None, checkpoint: str | None = None,
                 dims: Dimensions | None = None, available_now: bool = True,
                 processing_time: str = "2 hours", dedupe_watermark: str | None = None,
                 max_files_per_trigger: int | None = 1000, sources: DataFrame | None = None,
                 writer: str | None = None) -> StreamingQuery:
    """Start the incremental ingest query.

    A back-fill is read ``max_files_per_trigger`` files a micro-batch (all files
    are read, in as many batches as that takes), so a batch stays bounded.
    ``sources`` (S2) gives every line the constants of its source.  ``writer``
    names this query in a bucketed store that it shares with others.
    """
    lines = stream_lines(spark, source_path, max_files_per_trigger=max_files_per_trigger)
    ev = ingest_stream(lines, None, dedupe_watermark, sources)
    w = (ev.writeStream.foreachBatch(micro_batch_writer(store_path, quarantine_path, dims, writer))
           .option("checkpointLocation", checkpoint or scratch_path(spark, "ingest-checkpoint")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
