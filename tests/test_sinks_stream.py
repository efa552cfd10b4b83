import datetime as dt
import os

from pyspark.sql import functions as F

from accesslake.operators import rollups, sinks
from accesslake.plans.ingest import transform
from accesslake.session import scratch_path
from accesslake.streaming.ingest import start_ingest

from .fixtures import HTTPS


N_CORRUPT = sum(1 for _, route, _ in HTTPS if route == "corrupt")


def lines_df(spark):
    return spark.createDataFrame([(line,) for line, _, _ in HTTPS], "value string")


def test_store_is_idempotent(spark):
    ev = transform(lines_df(spark))
    clean = ev.where(~F.arrays_overlap("tags", F.array(F.lit("_datetimeparsefailure"))))
    store = scratch_path(spark, "test-store")
    sinks.write_store(clean, store)
    n1 = spark.read.parquet(store).count()
    sinks.write_store(clean, store)
    sinks.write_store(clean.limit(3), store)
    n2 = spark.read.parquet(store).count()
    assert n1 == n2 == clean.dropDuplicates(["event_hash"]).count()
    assert n1 == clean.count() - 1          # the identical line twice collapses


def test_rows_without_a_repeat_are_not_shuffled_whole(spark):
    rows = [("2024-01", "a", 1), ("2024-01", "a", 2), ("2024-02", "a", 3), (None, "a", 4), (None, "a", 5), (None, None, 6), ("2024-01", "b", 7)]
    ev = spark.createDataFrame(rows, "event_month string, event_hash string, n int")
    key = lambda d: sorted(d.select("event_month", "event_hash").collect(), key=str)
    assert key(sinks.dedupe_stored(ev)) == key(sinks.dedupe_by_hash(ev))
    single = ev.where("n in (1, 3, 4, 6, 7)")
    assert sinks.dedupe_stored(single) is single


def test_quarantine_lines(spark):
    q = sinks.quarantine_lines(transform(lines_df(spark))).collect()
    assert len(q) == N_CORRUPT
    assert all(r.value.startswith("[") and "| Message: " in r.value for r in q)


def test_stream_equals_batch(spark):
    src = scratch_path(spark, "test-stream-src")
    lines_df(spark).coalesce(1).write.text(src)
    store = scratch_path(spark, "test-stream-store")
    qpath = scratch_path(spark, "test-stream-q")
    q = start_ingest(spark, src, store, quarantine_path=qpath, checkpoint=scratch_path(spark, "ck"))
    q.awaitTermination()
    streamed = sorted(r.event_hash for r in spark.read.parquet(store).select("event_hash").collect())
    batch = transform(lines_df(spark))
    kept = batch.where(~F.arrays_overlap("tags", F.array(F.lit("_datetimeparsefailure"),
                                                         F.lit("_grok_filter_initial_parse_failure"))))
    assert streamed == sorted(r.event_hash for r in sinks.dedupe_by_hash(kept).select("event_hash").collect())
    assert spark.read.text(qpath).count() == N_CORRUPT
    # a second run over the same files adds nothing
    q = start_ingest(spark, src, store, checkpoint=scratch_path(spark, "ck2"))
    q.awaitTermination()
    assert spark.read.parquet(store).count() == len(streamed)


def test_egress_report_empty_window(spark):
    ev = transform(lines_df(spark)).withColumn("source_domain", F.col("source_address")) \
        .withColumn("source_registered_domain", F.lit(None).cast("string"))
    r = rollups.egress_report(ev, dt.datetime(2000, 1, 1), 24).collect()
    assert len(r) == 1 and r[0].section == "total" and r[0].bytes == 0


def test_egress_report_sections(spark):
    ev = transform(lines_df(spark)).withColumn("source_domain", F.col("source_address")) \
        .withColumn("source_registered_domain", F.lit("example.org"))
    r = rollups.egress_report(ev, dt.datetime(2023, 10, 11), 48, k=3).collect()
    sections = [x.section for x in r]
    assert sections.count("total") == 1 and sections.count("domain") == 1 and sections.count("user") == 3
    total = [x for x in r if x.section == "total"][0]
    assert total.bytes == sum(x.bytes for x in r if x.section == "domain")


def test_ecs_shape_and_source_defaults(spark):
    from accesslake.sources.text import attach_source
    lines = spark.createDataFrame([("s3://b/logs/web/a.log", HTTPS[1][0])], "file_path string, value string")
    src = spark.createDataFrame([("logs/", "Org", "www.example.org", "https", "web.http", "text")],
                                "prefix string, organization string, url_domain string, url_scheme string, "
                                "dataset string, cdn_format string")
    ev = transform(attach_source(lines, src))
    doc = sinks.to_ecs(ev).first()
    assert doc.event.kind == "event" and doc.event.dataset == "web.http" and doc.event.category == ["web", "network"]
    assert doc.url.domain == "www.example.org" and doc.url.scheme == "https"
    assert doc.http.response.status_code == 200 and doc.organization.name == "Org"
    assert doc.event.ingested is not None


def test_stream_dedupe_within_watermark(spark):
    from accesslake.sources.text import stream_lines
    from accesslake.streaming.ingest import ingest_stream
    src = scratch_path(spark, "test-stream-wm")
    doubled = [(line,) for line, _, _ in HTTPS[:3]] * 2
    spark.createDataFrame(doubled, "value string").coalesce(1).write.text(src)
    ev = ingest_stream(stream_lines(spark, src), dedupe_watermark="10 minutes")
    q = (ev.writeStream.format("memory").queryName("wm_dedupe").trigger(availableNow=True)
           .option("checkpointLocation", scratch_path(spark, "ck-wm")).start())
    q.awaitTermination()
    assert spark.table("wm_dedupe").count() == 3


def test_stream_with_dimensions(spark):
    from accesslake.plans.ingest import Dimensions
    from accesslake.plans import dims as D
    src = scratch_path(spark, "test-stream-dims")
    lines_df(spark).coalesce(1).write.text(src)
    dns = spark.createDataFrame([("192.0.2.10", "web-1.example.org")], "address string, name string")
    store = scratch_path(spark, "test-stream-dims-store")
    q = start_ingest(spark, src, store, checkpoint=scratch_path(spark, "ck-dims"),
                     dims=Dimensions(dns=dns, public_suffix=D.public_suffix(spark), agent_rules=D.agent_rules(spark)))
    q.awaitTermination()
    from accesslake.operators.enrich import AGENT_FIELDS
    from accesslake.plans.ingest import enrich_events
    batch = enrich_events(sinks.dedupe_by_hash(transform(lines_df(spark))), Dimensions(agent_rules=D.agent_rules(spark)))
    want = {r.event_hash: [r[c] for c in AGENT_FIELDS] for r in batch.collect()}
    rows = spark.read.parquet(store).collect()
    assert rows and all([r[c] for c in AGENT_FIELDS] == want[r.event_hash] for r in rows)
    got = spark.read.parquet(store).where("source_address = '192.0.2.10'").first()
    assert got.source_domain == "web-1.example.org" and got.source_registered_domain == "web-1.example.org"


def test_ftp_egress_option_and_key_counts(spark):
    from .fixtures import FTP
    df = spark.createDataFrame([("s3://b/logs/ftp/x.log", line) for line, _, _ in FTP], "file_path string, value string")
    ev = transform(df)
    base = rollups.egress_total(ev).first()
    with_ftp = rollups.egress_total(ev, include_ftp=True).first()
    # response bytes: IIS FTP RETR 1024, Apache-format RETR 10, BOTZETR 0; xferlog rows only network bytes
    assert base.bytes == 1024 + 10 + 0
    assert with_ftp.bytes == base.bytes + 1048576 + 999999999999
    by_key = rollups.count_by_key(ev, "/logs/ftp/").collect()
    assert sum(r.events for r in by_key) == ev.count()


def counted(spark, events):
    """``events`` and an accumulator of its rows, however often they are evaluated."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return events.mapInArrow(run, events.schema), seen


def test_a_replay_is_evaluated_once(spark):
    """A batch that meets a store is read once, adds its new lines once and keeps rows without a month or hash."""
    rows = [(1, "2024-01", "a"), (2, "2024-01", "a"), (3, "2024-02", "a"), (4, None, "b"), (5, "2024-01", None)]
    ev = spark.createDataFrame(rows, "event_id long, event_month string, event_hash string")
    store = scratch_path(spark, "replay-store")
    sinks.write_store(ev.where("event_id < 3"), store)
    batch, seen = counted(spark, ev)
    sinks.write_store(batch, store)
    assert seen.value == 5
    got = spark.read.parquet(store).select(F.col("event_month").cast("string"), "event_hash").collect()
    assert sorted((str(r[0]), str(r[1])) for r in got) == [("2024-01", "None"), ("2024-01", "a"), ("2024-02", "a"), ("None", "b")]
    batch, seen = counted(spark, ev.where("event_id < 5"))
    sinks.write_store(batch, store)
    assert seen.value == 4 and spark.read.parquet(store).count() == 4


def test_ordered_store_reads_its_events_once(spark):
    rows = [(i, f"2024-0{1 + i % 2}", dt.datetime(2024, 1 + i % 2, 1 + i % 28), f"h{i}") for i in range(200)]
    ev, seen = counted(spark, spark.createDataFrame(rows, "event_id long, event_month string, event_start timestamp, event_hash string"))
    path = scratch_path(spark, "ordered-once")
    sinks.write_ordered_store(ev, path, 4)
    assert seen.value == 200
    assert sorted(r.event_id for r in spark.read.parquet(path).select("event_id").collect()) == list(range(200))
