"""Ordered store and summaries, label chains, reachable labels, error details, two streams into one store."""

import datetime as dt
import re
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from accesslake.operators import rules as R
from accesslake.operators import sinks, sqlchain
from accesslake.operators.bucketstore import BucketStore
from accesslake.operators.rules import Cond, Rule
from accesslake.operators.summaries import KeptSummary
from accesslake.plans import catalog
from accesslake.plans import dims as D
from accesslake.plans.ingest import transform
from accesslake.session import scratch_path
from accesslake.sources import replay
from accesslake.sources.tables import load
from accesslake.streaming.ingest import start_ingest

SF = "/root/testdata/sf0.001"


def spans(path):
    """First and last event_start of every row group."""
    out = []
    for f in Path(re.sub("^file:/*", "/", path)).rglob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("event_start")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            if s is not None and s.has_min_max:
                out.append((s.min, s.max))
    return out


def test_an_hour_reads_few_row_groups(spark):
    events = catalog.combined_events(spark, SF)
    ordered, plain = scratch_path(spark, "ordered"), scratch_path(spark, "plain")
    sinks.write_ordered_store(events, ordered, 16)
    events.repartition(16, "event_hash").write.partitionBy("event_month").parquet(plain)
    zone = spans(ordered)[0][0].tzinfo
    a = dt.datetime(2024, 1, 15, 3, tzinfo=zone)
    touched = [sum(lo <= a + dt.timedelta(hours=1) and hi >= a for lo, hi in spans(p)) for p in (ordered, plain)]
    assert touched[0] <= 2 < len(spans(ordered)) // 2 and touched[1] >= 8
    hour = (F.col("event_start") >= F.lit(a.replace(tzinfo=None))) & (F.col("event_start") < F.lit(a.replace(tzinfo=None) + dt.timedelta(hours=1)))
    read = spark.read.parquet(ordered).where((F.col("event_month") == "2024-01") & hour)
    assert read.count() == events.where(hour).count()
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_start" in plan


def test_summaries_in_order(spark):
    detail = catalog.detail(spark, SF)
    dates = [r.date for r in sqlchain.ordered_summary(sqlchain.node_summary(detail)).collect()]
    assert dates == sorted(dates) and len(set(dates)) > 5
    keys = [(r.node, r.date, r.user_type, r.request_type, r.status)
            for r in sqlchain.ordered_rollup(sqlchain.all_node_rollup(sqlchain.node_summary(detail))).collect()]
    assert keys == sorted(keys)
    days = [r.date for r in sqlchain.ordered_detail(sqlchain.detail_view(detail)).collect()]
    assert days == sorted(days)


def test_label_chain_equals_two_joins(spark):
    rows = [("small ring",), ("red widget x",), ("nothing",), (None,), ("",)] * 3
    df = spark.createDataFrame(rows, "v string")
    mission = D.mission_rules() + [Rule(99, "rest", (Cond("regex", "^oth"),))]
    two = R.classify_distinct(R.classify_distinct(df, "v", D.bundle_rules(), "b", "other"), "b", mission, "m", "none")
    one = R.classify_chain(df, "v", [(D.bundle_rules(), "b", "other"), (mission, "m", "none")])
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert ("rest" in {r.m for r in one.where("v is null").collect()})


def test_every_reachable_label_occurs(spark):
    got = {(r.node, r.request_type) for r in catalog.q_request_type_labels(spark, SF).collect()}
    for node, rules in R.REQUEST_TYPE_RULES.items():
        reached = {label for n, label in got if n == node}
        want = {r.label for r in rules}
        hidden = want - reached
        # a rule that is never first repeats the conditions of an earlier one
        for r in rules:
            if r.label in hidden:
                assert any(set(e.conds) <= set(r.conds) for e in rules if e.priority < r.priority), r
    assert ("en", "archive") in got and len(got) > 50


def test_error_details(spark):
    lines = spark.createDataFrame([('192.0.2.1 - - [31/Feb/2024:10:00:00 +0000] "GET / HTTP/1.1" 200 5 "-" "ua"',),
                                   ('192.0.2.1 - - [01/Feb/2024:10:00:00 +0000] "GET / HTTP/1.1" 200 5 "-" "ua"',)], "value string")
    got = sorted((r.error_details for r in transform(lines).collect()), key=str)
    assert got[0] is None or got[1] is None
    bad = next(g for g in got if g is not None)
    assert (bad.timestamp, bad.pattern) == ("31/Feb/2024:10:00:00 +0000", "dd/MMM/yyyy:HH:mm:ss Z") and bad.message.startswith("192.0.2.1")
    doc = sinks.to_ecs(transform(lines)).where("error.details is not null").select("error.details.timestamp").first()
    assert doc[0] == "31/Feb/2024:10:00:00 +0000"


def test_two_streams_share_a_store(spark):
    src = scratch_path(spark, "shared-src")
    replay.lines(load(spark, SF, "events"), load(spark, SF, "pages"), "apache_combined").select("value").write.text(src)
    store = scratch_path(spark, "shared-store")
    queries = [start_ingest(spark, src, store, checkpoint=scratch_path(spark, f"shared-{w}"), writer=w) for w in ("east", "west")]
    for q in queries:
        q.awaitTermination()
    want = sinks.dedupe_by_hash(transform(spark.read.text(src))).count()
    shared = BucketStore(spark, store)
    assert shared.read().count() == want
    assert {r.writer for r in shared.committed().collect()} == {"east", "west"}


def test_kept_summary_equals_one_over_all_lines(spark):
    detail = sinks.materialize(catalog.detail(spark, SF), "detail-test", None)
    third = F.pmod(F.xxhash64("client_ip", "datetime", "client_request"), F.lit(3))
    kept = KeptSummary(spark, scratch_path(spark, "kept"))
    assert kept.read().count() == 0 and kept.compacted() == -1
    for batch in (0, 1, 0, 2):
        kept.append(detail.where(third == batch), batch)
    want = sorted(map(str, sqlchain.node_summary(detail).select(*kept.read().columns).collect()))
    assert sorted(map(str, kept.read().collect())) == want
    kept.compact(1)
    kept.append(detail.where(third == 1), 1)  # final: nothing is added
    kept.compact(1)
    assert kept.compacted() == 1 and sorted(map(str, kept.read().collect())) == want
    kept.compact(2)
    assert sorted(map(str, kept.read().collect())) == want
    roll = [c for c in kept.rollup().columns]
    assert sorted(map(str, kept.rollup().collect())) == sorted(map(str, sqlchain.all_node_rollup(sqlchain.node_summary(detail)).select(*roll).collect()))
