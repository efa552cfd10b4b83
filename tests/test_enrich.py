from pyspark.sql import functions as F

from accesslake.operators import enrich
from accesslake.plans import dims as D


def test_geo_range_join_multi_block(spark):
    ev = spark.createDataFrame([(1, "10.0.5.9"), (2, "10.3.0.1"), (3, "10.9.9.9"), (4, None), (5, "2001:db8::1")],
                               "id int, source_address string")
    # one range spanning four /16 blocks, one narrow range
    ranges = spark.createDataFrame([
        (10 * 16777216, 10 * 16777216 + 4 * 65536 - 1, "AA", "r1", "c1", 1.0, 2.0),
        (10 * 16777216 + 9 * 65536 + 9 * 256, 10 * 16777216 + 9 * 65536 + 9 * 256 + 255, "BB", "r2", "c2", 3.0, 4.0),
    ], "ip_start long, ip_end long, country string, region string, city string, lat double, lon double")
    got = {r.id: r.geo_country for r in enrich.geo_lookup(ev, ranges).collect()}
    assert got == {1: "AA", 2: "AA", 3: "BB", 4: None, 5: None}


def test_geo_prefers_cdn_country(spark):
    ev = spark.createDataFrame([("10.0.0.1", "JP")], "source_address string, cdn_country string")
    ranges = spark.createDataFrame([(10 * 16777216, 10 * 16777216 + 255, "AA", "r", "c", 0.0, 0.0)],
                                   "ip_start long, ip_end long, country string, region string, city string, lat double, lon double")
    assert enrich.geo_lookup(ev, ranges, prefer_col="cdn_country").first().geo_country == "JP"


def test_dns_default_and_gate(spark):
    ev = spark.createDataFrame([("10.0.0.1", []), ("10.0.0.2", []), ("10.0.0.1", ["_datetimeparsefailure"]),
                                ("10.0.0.1", ["_grok_filter_initial_parse_failure"])],
                               "source_address string, tags array<string>")
    dns = spark.createDataFrame([("10.0.0.1", "a.example.com")], "address string, name string")
    got = [r.source_domain for r in enrich.dns_lookup(ev, dns).collect()]
    assert sorted(got, key=str) == sorted(["a.example.com", "a.example.com", "10.0.0.2", None], key=str)  # a bad date keeps its name


def test_registered_domain_longest_suffix(spark):
    hosts = spark.createDataFrame([("a.b.example.com",), ("x.co.uk",), ("co.uk",), ("10.1.2.3",), ("Host.EXAMPLE.org",)],
                                  "host string")
    got = {r.host: r for r in enrich.resolve_domains(hosts, D.public_suffix(spark)).collect()}
    assert got["a.b.example.com"].registered_domain == "b.example.com"
    assert got["a.b.example.com"].sub_domain == "a" and got["a.b.example.com"].top_level_domain == "example.com"
    assert got["x.co.uk"].registered_domain == "x.co.uk" and got["x.co.uk"].sub_domain is None
    assert "co.uk" not in got and "10.1.2.3" not in got
    assert got["host.example.org"].registered_domain == "host.example.org"


def test_parse_agents(spark):
    df = spark.createDataFrame([("Mozilla/5.0 (compatible; Googlebot/2.1)",), ("curl/8.4.0",), (None,),
                                ("python-requests/2.31.0",), ("something",)], "user_agent string")
    got = {r.user_agent: r for r in enrich.parse_agents(df, D.agent_rules(spark)).collect()}
    g = got["Mozilla/5.0 (compatible; Googlebot/2.1)"]
    assert (g.ua_name, g.ua_version, g.ua_device) == ("Googlebot", "2.1", "Spider")
    assert (got["curl/8.4.0"].ua_name, got["curl/8.4.0"].ua_version) == ("curl", "8.4.0")
    assert (got["python-requests/2.31.0"].ua_name, got["python-requests/2.31.0"].ua_version) == ("Python Requests", "2.31")
    assert got["something"].ua_name == "Other" and got[None].ua_name is None


def test_url_host_domain_and_ip_hosts(spark):
    from accesslake.plans.ingest import Dimensions, enrich_events, transform
    lines = spark.createDataFrame([
        ('192.0.2.80 - - [10/Oct/2023:13:55:36 +0000] "GET http://files.data.example.org:8080/a/b?x=1 HTTP/1.1" 200 5 "-" "ua"',),
        ('192.0.2.81 - - [10/Oct/2023:13:55:36 +0000] "GET http://198.51.100.9:8080/a HTTP/1.1" 200 5 "-" "ua"',),
    ], "value string")
    ev = enrich_events(transform(lines), Dimensions(public_suffix=D.public_suffix(spark)))
    got = {r.source_address: r for r in ev.collect()}
    a = got["192.0.2.80"]
    assert (a.url_domain, a.url_port, a.url_path, a.url_query) == ("files.data.example.org", "8080", "/a/b", "x=1")
    assert a.url_registered_domain == "data.example.org" and a.url_sub_domain == "files"
    assert got["192.0.2.81"].url_domain is None and got["192.0.2.81"].url_registered_domain is None
