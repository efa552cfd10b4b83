"""Plan-shape guards: the join-heavy queries must stay equi-joins without
row-at-a-time Python, and report scans must prune partitions and columns."""

import __spark_entry__ as E
from accesslake.plans import catalog

SF = "/root/testdata/sf0.001"


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loop_or_python_rows(spark):
    qs = E.queries()
    for name in ("geo_range_join", "source_attach", "registered_domain", "bundle_then_mission",
                 "node_summary", "dns_left_join"):
        plan = executed(qs[name](spark, SF))
        for bad in ("NestedLoop", "Cartesian", "BatchEvalPython"):
            assert bad not in plan, (name, bad)


def test_report_scan_prunes(spark):
    df = E.queries()["egress_total"](spark, SF)
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(event_month" in formatted
    assert "GreaterThanOrEqual(event_start" in formatted
    assert "ReadSchema: struct<event_start:timestamp,response_bytes:bigint" in formatted  # unused lookups are not joined at all


def test_reports_store_the_columns_they_read(spark):
    columns = catalog.enriched_events(spark, SF).columns
    assert [c for c in columns if not c.startswith("source_")] == ["event_start", "response_bytes", "tags", "event_month"]
