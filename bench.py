"""Benchmark the headline queries; prints ONE JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (timed runs per query, default 3; one warm-up run
precedes them).  Each run executes the whole plan into Spark's ``noop`` sink
(no driver collect), and the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from accesslake.operators import sqlchain  # noqa: E402
from accesslake.plans import catalog  # noqa: E402
from accesslake.plans import dims as D  # noqa: E402
from accesslake.session import get_spark  # noqa: E402


def q_bundle_then_mission_268(spark, sf):
    m = sqlchain.mission_downloads(catalog.detail(spark, sf), D.bundle_rules(268), D.mission_rules(),
                                   catalog.MISSION_YEAR)
    return m.groupBy("mission", "url_bundle", "user_type").agg(F.count(F.lit(1)).alias("downloads"))


HEADLINE = {
    "parse_combined_roundtrip": catalog.q_parse_combined_roundtrip,
    "parse_mixed_layouts": catalog.q_parse_mixed_layouts,
    "node_summary": catalog.q_node_summary,
    "path_prefix_egress": catalog.q_path_prefix_egress,
    "top_domains": catalog.q_top_domains,
    "egress_report": catalog.q_egress_report,
    "bundle_then_mission_268": q_bundle_then_mission_268,
    "geo_range_join": catalog.q_geo_range_join,
    "url_query_params": catalog.q_url_query_params,
}


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [a for a in sys.argv[1:]]
    spark = get_spark("bench", cpus=cpus, shuffle_partitions=max(8, cpus))
    results = {}
    for name, fn in HEADLINE.items():
        if only and name not in only:
            continue
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                times.append(dt)
        results[name] = round(statistics.median(times), 3)
    print(json.dumps({"metric": "median_query_seconds_total", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": os.path.basename(sf.rstrip("/")),
                      "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
