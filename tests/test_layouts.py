"""Fixture suites: every layout, every drop reason, every routing outcome."""

import pytest
from pyspark.sql import functions as F

from accesslake.operators.layouts import COMPILED, LAYOUTS, parse_lines
from accesslake.operators.normalise import to_events
from accesslake.plans.ingest import parse_any, transform

from .fixtures import CDN_JSON, CDN_TEXT, FTP, HTTPS


def run(spark, suite, json=False):
    df = spark.createDataFrame([(i, line) for i, (line, _, _) in enumerate(suite)], "event_id long, value string")
    parsed = parse_any(df) if json else parse_lines(df)
    return {r.event_id: r for r in to_events(parsed).collect()}


@pytest.mark.parametrize("suite,json", [(HTTPS, False), (FTP, False), (CDN_TEXT, False), (CDN_JSON, True)])
def test_routes_and_drops(spark, suite, json):
    got = run(spark, suite, json)
    for i, (line, route, reason) in enumerate(suite):
        r = got[i]
        assert (r.route, r.drop_reason) == (route, reason), (line, r.route, r.drop_reason, r.tags)


def test_suite_totals(spark):
    # events (not files): processed / corrupt / empty agent / dropped per suite
    def totals(suite, json=False):
        rows = run(spark, suite, json).values()
        return {k: sum(1 for r in rows if r.route == k) for k in ("processed", "corrupt", "empty_agent", "dropped")}
    assert totals(CDN_TEXT) == {"processed": 2, "corrupt": 0, "empty_agent": 1, "dropped": 2}
    assert totals(CDN_JSON, True) == {"processed": 2, "corrupt": 0, "empty_agent": 1, "dropped": 0}


def test_layout_names(spark):
    got = run(spark, HTTPS)
    assert got[1].log_format == "apache_combined"
    assert got[22].log_format == "w3c_extended"
    assert got[24].log_format == "iis_minimal"
    assert got[25].log_format == "iis_site"
    assert got[26].log_format == "apache_common"
    assert got[11].log_format == "apache_odd_user"
    ftp = run(spark, FTP)
    assert ftp[0].log_format == "ftp_transfer"
    assert ftp[5].log_format == "iis_ftp"
    cdn = run(spark, CDN_TEXT)
    assert cdn[2].log_format == "cdn_w3c"


def test_combined_fields(spark):
    r = run(spark, HTTPS)[1]
    assert r.source_address == "192.0.2.10"
    assert r.http_method == "GET" and r.http_version == "1.1"
    assert r.url_path == "/data/mgs/vol1/file.img"
    assert r.url_path_parts == ["data", "mgs", "vol1", "file.img"]
    assert r.url_path_depth == ["/data", "/data/mgs", "/data/mgs/vol1", "/data/mgs/vol1/file.img"]
    assert r.url_query is None and r.url_query_params is None and r.url_query_parts is None
    assert r.status_code == 200 and r.response_bytes == 2326
    assert r.referrer is None
    assert r.event_outcome == "success"
    assert str(r.event_start) == "2023-10-10 13:55:36"
    assert r.event_month == "2023-10"
    assert len(r.event_hash) == 64


def test_quoted_dash_agent(spark):
    got = run(spark, HTTPS)
    assert got[10].user_agent is None and "_empty_user_agent" not in got[10].tags
    assert got[11].user_agent == "Unknown" and got[11].tags == ["_empty_user_agent"]


def test_query_multimap(spark):
    got = run(spark, HTTPS)
    m = got[12].url_query_params
    assert m == {"fq": ["a", "b"], "facet_field": ["x"]}
    assert got[12].url_query_parts == ["fq=a", "fq=b", "facet_field=x"]
    assert got[12].url_path == "/solr/select"
    assert got[13].url_query_params == {"nls_file_foo_nasl_1": ["v"], "x": ["1"]}
    assert got[14].url_query_params == {"q": ["%zz"]}


def test_big_bytes_ipv6_and_tags(spark):
    got = run(spark, HTTPS)
    assert got[16].response_bytes == 999999999999
    assert got[18].source_address == "2001:db8::1"
    assert "_suspicious_query" in got[21].tags
    assert got[23].url_path is None and "_missing_url_path" in got[23].tags
    assert got[27].source_address == "crawler.example.org"


def test_corrupt_details(spark):
    got = run(spark, HTTPS)
    bad_date = got[6]
    assert bad_date.tags == ["_datetimeparsefailure"] and bad_date.error_type == "datetime_parse_error"
    assert bad_date.error_message == "Failed to parse datetime from 31/Feb/2023:13:55:36 +0000"
    junk = got[28]
    assert junk.tags == ["_grok_filter_initial_parse_failure", "_datetimeparsefailure", "_missing_source_address"]


def test_ftp_fields(spark):
    got = run(spark, FTP)
    x = got[0]
    assert x.network_bytes == 1048576 and x.response_bytes is None
    assert x.ftp_flags == ["b", "_", "o", "r"] and x.user_id == 1001 and x.network_protocol == "ftp"
    assert x.event_action == "c" and x.status_code == 0
    assert str(x.event_start) == "2023-10-10 13:55:36"
    assert got[1].network_bytes == 999999999999 and str(got[1].event_start) == "2023-10-03 01:02:03"
    retr = got[4]
    assert retr.ftp_command == "RETR" and retr.http_method is None
    assert retr.status_code is None and retr.event_outcome == "failure" and retr.event_action == "RETR"
    iis = got[5]
    assert iis.event_outcome == "success" and iis.event_action == "RETR" and iis.error_code == "0"
    bot = got[7]
    assert bot.ftp_command == "BOTZETR" and bot.event_outcome == "failure" and bot.error_type == "http_error"


def test_cdn_text_and_json(spark):
    t = run(spark, CDN_TEXT)[2]
    assert t.url_domain == "www.example.org" and t.url_scheme == "https"
    assert t.request_bytes == 300 and t.duration == 0.002 and t.response_bytes == 1234
    j = run(spark, CDN_JSON, json=True)
    assert j[0].user_agent == "Mozilla/5.0 (X11)" and j[0].url_query is None
    assert j[1].url_query_params == {"x": ["1", "2"]} and j[1].event_outcome == "failure"
    assert j[1].referrer == "https://ref.example/" and j[1].cdn_country == "DE"


def test_transform_keeps_only_events(spark):
    df = spark.createDataFrame([(line,) for line, _, _ in HTTPS], "value string")
    ev = transform(df)
    assert ev.where(F.col("drop_reason").isNotNull()).count() == 0
    assert ev.count() == sum(1 for _, route, _ in HTTPS if route != "dropped")


EXTRA = [
    ('192.0.2.60 - - [10/Oct/2023:13:55:36 +0000] "GET /min/path HTTP/1.1"', "apache_minimal"),
    ("2023-10-10 13:55:36 192.0.2.1 GET /p.htm q=1 443 - 198.51.100.11 Mozilla/5.0 200 0 0 100 20 7", "iis"),
    ('192.0.2.61 - John Smith [10/Oct/2023:13:55:36 +0000] "GET /a?x=1 HTTP/1.1" 200 10 "-" "ua/1"', "apache_bad_user"),
    ('192.0.2.62 - - [10/Oct/2023:13:55:36 +0000] "GET /café\u0001 HTTP/1.1" 200 10 "-" "ua/1"', "apache_combined"),
]


def test_more_layouts_and_cleanup(spark):
    got = run(spark, [(line, None, None) for line, _ in EXTRA])
    for i, (_, fmt) in enumerate(EXTRA):
        assert got[i].log_format == fmt, (i, got[i].log_format)
    minimal = got[0]
    assert minimal.url_path == "/min/path" and minimal.status_code is None and minimal.event_outcome is None
    iis = got[1]
    assert (iis.url_path, iis.url_query, iis.server_ip, iis.source_address) == ("/p.htm", "q=1", "192.0.2.1", "198.51.100.11")
    bad_user = got[2]
    assert bad_user.user_name == "John Smith" and bad_user.url_path is None and bad_user.request_body == "/a?x=1"
    assert got[3].url_original == "/caf" and got[3].url_path == "/caf"   # N3: non-printable removed


def test_domain_equal_to_client_is_dropped(spark):
    df = spark.createDataFrame([(
        "2026-06-25\t00:01:02\tSEA73-P1\t1\t192.0.2.70\tGET\td1.cdn.example\t/a\t200\t-\tua\t-\t-\tHit\tr\t"
        "192.0.2.70\thttps\t1\t0.1\t-",)], "value string")
    r = to_events(parse_lines(df)).first()
    assert r.log_format == "cdn_w3c" and r.url_domain is None


def test_queries_are_decoded_in_every_layout(spark):
    lines = spark.createDataFrame([
        (1, '192.0.2.1 - - [10/Oct/2023:13:55:36 +0000] "GET /a?q=caf%25C3%25A9 HTTP/1.1" 200 5 "-" "ua"'),
        (2, "2023-10-10 13:55:36 W3SVC1 192.0.2.10 GET /p q=a%26b&r=%C3%A9 443 - 198.51.100.11 agent 200 0 0 1 15"),
        (3, "2023-10-10 13:55:36 W3SVC1 192.0.2.10 GET /p q=%zz 443 - 198.51.100.11 agent 200 0 0 1 15"),
    ], "id int, value string")
    got = {r.id: r for r in to_events(parse_lines(lines)).collect()}
    assert got[1].url_query == "q=caf\u00e9"
    assert got[2].url_query == "q=a&b&r=\u00e9" and got[2].url_query_params == {"q": ["a&b"], "r": ["\u00e9"]}
    assert got[3].url_query == "q=%zz" and got[3].url_query_params == {"q": ["%zz"]}


def test_one_array_element_a_field():
    """The groups of a field are written side by side: the array of a line does not grow with the layouts' groups."""
    used = [i for i in COMPILED.fields.values() if i is not None]
    assert COMPILED.size == len(LAYOUTS) + len(used)
    assert sorted([*COMPILED.marker.values(), *used]) == list(range(COMPILED.size))
