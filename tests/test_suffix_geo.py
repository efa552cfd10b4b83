"""Public-suffix rules, overlapping address ranges, heavy values and long host names."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from accesslake.operators import enrich, geo
from accesslake.operators.layouts import parse_lines
from accesslake.operators.partitioning import heavy_values, join_back

SF = "/root/testdata/sf0.001"
RANGE = "ip_start long, ip_end long, country string, region string, city string, lat double, lon double"


def domains(spark, hosts, rules, **how):
    h = spark.createDataFrame([(x,) for x in hosts], "host string")
    s = spark.createDataFrame([(x,) for x in rules], "suffix string")
    return {r.host: (r.registered_domain, r.top_level_domain, r.second_level_domain, r.sub_domain)
            for r in enrich.resolve_domains(h, s, **how).collect()}


def brute_domain(host, rules, unlisted=False):
    """The published algorithm: all matching rules, the exception or else the longest."""
    labels, best = host.split("."), None
    for rule in rules:
        want = rule.lstrip("!").split(".")
        if len(want) <= len(labels) and all(w in ("*", x) for w, x in zip(want[::-1], labels[::-1])):
            size = len(want) - 1 if rule.startswith("!") else len(want)
            if best is None or (rule.startswith("!"), size) > best:
                best = (rule.startswith("!"), size)
    size = best[1] if best else 1 if unlisted else None
    if size is None or size >= len(labels):
        return None
    suffix = labels[len(labels) - size:]
    return (".".join(labels[-size - 1:]), ".".join(suffix), labels[-size - 1], ".".join(labels[:-size - 1]) or None)


def test_wildcards_and_exceptions(spark):
    rules = ["com", "uk", "co.uk", "*.ck", "!www.ck", "*.kawasaki.jp", "jp", "!city.kawasaki.jp", "*.compute.example.com"]
    hosts = ["a.b.ck", "www.ck", "x.www.ck", "b.ck", "ck", "a.com", "com", "a.b.co.uk", "co.uk", "x.uk", "a.city.kawasaki.jp", "city.kawasaki.jp",
             "q.r.kawasaki.jp", "r.kawasaki.jp", "kawasaki.jp", "z.eu.compute.example.com", "eu.compute.example.com", "compute.example.com", "x.unlisted"]
    for unlisted in (False, True):
        want = {h: d for h in hosts if (d := brute_domain(h, rules, unlisted))}
        assert domains(spark, hosts, rules, unlisted=unlisted) == want


def test_suffix_rules_against_the_published_algorithm(spark):
    rnd = random.Random(5)
    label = lambda: rnd.choice("abcd")
    rules = sorted({rnd.choice(["", "", "*.", "!"]) + ".".join(label() for _ in range(rnd.randint(1, 3))) for _ in range(25)})
    rules = [r for r in rules if not (r.startswith("!") and "." not in r)]
    hosts = sorted({".".join(label() for _ in range(rnd.randint(1, 6))) for _ in range(300)})
    assert domains(spark, hosts, rules) == {h: d for h in hosts if (d := brute_domain(h, rules))}


def test_odd_hosts_and_rules(spark):
    got = domains(spark, ["A.Example.COM.", "", None, ".", "a..com", ".com", "10.0.0.1", "x.com", "x.com"], [" COM ", ".com", None, "", "com"])
    assert got == {"a.example.com": ("example.com", "com", "example", "a"), "x.com": ("x.com", "com", "x", None)}
    assert domains(spark, ["x.com"], []) == {}


def brute_place(ip, ranges):
    met = [r for r in ranges if r[0] is not None and r[1] is not None and r[0] <= ip <= r[1]]
    return min(met, key=lambda r: (r[1] - r[0], r[0], *((v is not None, v) for v in r[2:])))[2:] if met else None


@pytest.mark.parametrize("cells", [1, 5, None])
def test_flatten_and_locate(spark, cells):
    rnd = random.Random(7)
    ranges = [(a, a + rnd.choice([0, 3, 60, 2000, 90_000]), rnd.choice(["A", "B", None]), f"r{i % 5}", None, float(i), None)
              for i in range(120) for a in [rnd.randrange(100_000)]]
    ranges += [(0, 200_000, "all", "x", "y", 0.0, 0.0), (50, 40, "none", "x", "y", 0.0, 0.0), (None, 5, "none", "x", "y", 0.0, 0.0), ranges[0]]
    segments = geo.flatten_ranges(spark.createDataFrame(ranges, RANGE), cells)
    rows = sorted(tuple(r) for r in segments.select("seg_start", "seg_end").collect())
    assert all(a <= b for a, b in rows) and all(x[1] < y[0] for x, y in zip(rows, rows[1:]))
    ips = [rnd.randrange(-5, 210_000) for _ in range(500)] + [None] * 40 + [77] * 300
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id long, ip long")
    for size in (40, geo.BUCKET_SEGMENTS):
        got = {r.id: tuple(r["__place"]) if r["__place"] else None for r in geo.locate(df, "ip", segments, size).collect()}
        assert got == {i: None if ip is None else brute_place(ip, ranges) for i, ip in enumerate(ips)}


def test_no_ranges(spark):
    df = spark.createDataFrame([("10.0.0.1",), (None,)], "source_address string")
    out = enrich.geo_lookup(df, spark.createDataFrame([], RANGE))
    assert sorted(tuple(r) for r in out.select("source_address", "geo_country").collect() if r.source_address) == [("10.0.0.1", None)]
    assert out.count() == 2


def test_bad_dates_keep_names(spark):
    df = spark.createDataFrame([("10.0.0.1", ["_datetimeparsefailure"]), ("10.0.0.1", ["_grok_filter_initial_parse_failure"])],
                               "source_address string, tags array<string>")
    dns = spark.createDataFrame([("10.0.0.1", "a.example.com")], "address string, name string")
    assert sorted(str(r.source_domain) for r in enrich.dns_lookup(df, dns).collect()) == ["None", "a.example.com"]


def test_heavy_values_are_split_by_their_share(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("v"), F.col("id"))).alias("k"), "id")
    heavy = heavy_values(rows, "k", 30)
    assert set(heavy) == {"hot"} and 10 <= heavy["hot"] <= 12  # a third of the rows and some: as many of 30 shares
    labels = rows.where("k is not null").select(F.col("k").alias("l"), F.upper("k").alias("u")).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_back(rows, labels, "k", "l", 30)
        got = [(r.id, r.u) for r in out.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(got) == sorted((r.id, r.k and r.k.upper()) for r in rows.collect())


@pytest.mark.parametrize("name", ["geo_range_join", "geo_overlaps", "agent_parse", "source_attach", "registered_domain"])
def test_events_are_parsed_once(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_type#") <= 2 or plan.count("Relation [event_id") <= 1, name


def test_names_of_many_labels(spark):
    host = "a." * 32_000 + "a"
    lines = spark.createDataFrame([(1, f'{host} - - [10/Oct/2023:13:55:36 +0000] "GET / HTTP/1.1" 200 5 "-" "ua"'), (2, "a." * 5000 + " - - [..]"),
                                   (3, 'x.example.org - - [10/Oct/2023:13:55:36 +0000] "GET / HTTP/1.1" 200 5 "-" "ua"')], "id int, value string")
    got = {r.id: (r.log_format, r.source_address) for r in parse_lines(lines).collect()}
    assert got[1] == ("apache_combined", host) and got[3] == ("apache_combined", "x.example.org")
