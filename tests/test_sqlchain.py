from pyspark.sql import functions as F

from accesslake.operators import sqlchain

LINES = [
    ('192.0.2.1 - - [01/Jan/2024:00:00:01 +0000] "GET /search/a HTTP/1.1" 200 100 "-" "Googlebot/2.1"', "img"),
    ('192.0.2.1 - - [01/Jan/2024:00:00:02 +0000] "GET /search/b HTTP/1.1" 200 - "-" "Mozilla/5.0"', "img"),
    ('192.0.2.2 - user1 [01/Jan/2024:00:00:03 +0000] "GET /x HTTP/1.1" 200 10 20 "-" "Mozilla/5.0"', "atm"),
    ('host.example.org - - - "HEAD nopath" 304 5 "-" "-"', "sbn"),
    ('192.0.2.3 - - [01/Jan/2024:00:00:04 +0000] "GET /datasearch/keyword-search/search.jsp?q=Red+Rover%20x HTTP/1.1" 200 7 "-" "curl/8"', "en"),
]


def detail(spark):
    df = spark.createDataFrame(LINES, "value string, node string")
    return sqlchain.detail_table(df)


def test_detail_table_fields(spark):
    rows = detail(spark).collect()
    assert len(rows) == 5
    r = rows[2]
    assert (r.client_ip, r.user_id, r.status, r.size) == ("192.0.2.2", "user1", "200", "10 20")
    assert r.datetime == "[01/Jan/2024:00:00:03 +0000]" and r.client_request == "GET /x HTTP/1.1"
    assert rows[3].datetime == "-" and rows[3].client_ip == "host.example.org"


def test_summary_and_rollup(spark):
    s = sqlchain.node_summary(detail(spark))
    got = {(r.node, r.client_request): r for r in s.collect()}
    assert ("atm", "GET /x HTTP/1.1") not in got            # two-token size is filtered (F7)
    a = got[("img", "GET /search/a HTTP/1.1")]
    assert (a.user_type, a.request_type, a.bytes, a.transactions, str(a.date)) == (
        "robot", "Planetary Image Atlas III", 100, 1, "2024-01-01")
    assert got[("img", "GET /search/b HTTP/1.1")].bytes == 0   # "-" counts as 0 (N19)
    assert got[("sbn", "HEAD nopath")].http_method == "HEAD" and got[("sbn", "HEAD nopath")].date is None
    r = sqlchain.all_node_rollup(s).where(F.col("node") == "img").collect()
    assert len(r) == 2 and all(x.summary_rows == 1 for x in r)
    assert sqlchain.all_node_rollup(s).where(F.col("node") == "en").count() == 0


def test_search_terms(spark):
    t = sqlchain.search_terms(detail(spark)).collect()
    assert [x.query_text for x in t] == ["red rover x"]


def test_ordering_helpers(spark):
    s = sqlchain.node_summary(detail(spark))
    dates = [r.date for r in sqlchain.ordered_summary(s).collect()]
    assert dates == sorted(dates, key=lambda d: (d is not None, d))
    r = sqlchain.ordered_rollup(sqlchain.all_node_rollup(s)).collect()
    assert [x.node for x in r] == sorted(x.node for x in r)
    v = sqlchain.ordered_detail(sqlchain.detail_view(detail(spark))).collect()
    assert len(v) == 4
    u = sqlchain.union_summaries(s, s)
    assert u.count() == 2 * s.count()
