from pyspark.sql import functions as F

from accesslake.functions import urls
from accesslake.functions.net import ipv4_to_long, is_ipv4, long_to_ipv4
from accesslake.functions.time import bracket_day, bracket_day_text, first_year, parse_event_time


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("o")).first().o


def test_split_url_shapes(spark):
    u = one(spark, urls.split_url, "https://user:secret@www.example.org:8443/a/b.html?x=1&y=2#frag")
    assert (u.scheme, u.username, u.address, u.port, u.path, u.query, u.fragment, u.parsed) == (
        "https", "user", "www.example.org", "8443", "/a/b.html", "x=1&y=2", "frag", True)
    assert "secret" not in str(u)
    u = one(spark, urls.split_url, "http://example.org")
    assert u.address == "example.org" and u.path is None
    u = one(spark, urls.split_url, "/p/q?k=v")
    assert u.scheme is None and u.path == "/p/q" and u.query == "k=v"
    u = one(spark, urls.split_url, "*")
    assert u.parsed is False and u.path == "*"


def test_multimap_and_parts(spark):
    m = one(spark, urls.query_multimap, "a=1&b=2&a=3&noeq&=x&c.d[e]=%41")
    assert m == {"a": ["1", "3"], "b": ["2"], "c_d_e": ["A"]}
    df = spark.createDataFrame([("a=1&b=2&a=3",)], "v string")
    parts = df.select(urls.query_parts(urls.query_multimap(F.col("v"))).alias("o")).first().o
    assert parts == ["a=1", "a=3", "b=2"]
    assert one(spark, urls.query_multimap, "") is None
    assert one(spark, urls.path_parts, "//a//b/") == ["a", "b"]
    assert one(spark, lambda c: urls.path_depth(urls.path_parts(c)), "/a/b/c") == ["/a", "/a/b", "/a/b/c"]
    assert one(spark, urls.path_parts, "/") is None


def test_event_time_formats(spark):
    cases = {
        "2024-01-02T03:04:05Z": "2024-01-02 03:04:05",
        "2024-01-02 03:04:05": "2024-01-02 03:04:05",
        "2024-01-02\t03:04:05": "2024-01-02 03:04:05",
        "Tue Jan  2 03:04:05 2024": "2024-01-02 03:04:05",
        "02/Jan/2024:03:04:05 +0100": "2024-01-02 02:04:05",
        "02/Jan/2024:03:04:05": "2024-01-02 03:04:05",
        "31/Feb/2024:03:04:05 +0000": None,
    }
    for text, want in cases.items():
        got = one(spark, lambda c: F.date_format(parse_event_time(c), "yyyy-MM-dd HH:mm:ss"), text)
        assert got == want, text


def test_bracket_days(spark):
    assert str(one(spark, bracket_day, "[02/Jan/2024:03:04:05 +0000]")) == "2024-01-02"
    assert one(spark, bracket_day, "-") is None
    assert one(spark, bracket_day_text, "[02/Jan/2024:03:04:05 +0000]") == "02/Jan/2024"
    assert one(spark, bracket_day_text, "2024-01-02") is None
    assert one(spark, first_year, "[02/Jan/2024:03:04:05 +0000]") == 2024
    assert one(spark, first_year, "-") == 0


def test_ipv4(spark):
    assert one(spark, ipv4_to_long, "10.1.2.3") == 10 * 16777216 + 1 * 65536 + 2 * 256 + 3
    assert one(spark, ipv4_to_long, "10.1.2.300") is None
    assert one(spark, is_ipv4, "2001:db8::1") is False
    assert one(spark, long_to_ipv4, 167838211, "v long") == "10.1.2.3"
