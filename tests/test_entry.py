import __spark_entry__ as E
from accesslake.plans import catalog, oracle


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"section", "rank", "key", "bytes", "requests", "gb"}
    rows = df.collect()
    assert any(r.section == "total" for r in rows)


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(oracle.ORACLE_SQL)
    assert set(catalog.QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_small_queries_run(spark):
    qs = E.queries()
    for name in ("url_split", "registered_domain", "request_type_rules", "egress_yoy", "route_counts"):
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0
