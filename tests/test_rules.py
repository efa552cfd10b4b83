from pyspark.sql import functions as F

from accesslake.operators import rules as R
from accesslake.plans import dims as D


def test_first_match_and_default(spark):
    rules = [R.Rule(1, "a", (R.Cond("contains", "x"),)),
             R.Rule(2, "b", (R.Cond("regex", "^x"), R.Cond("like", "%z"))),
             R.Rule(3, "c", (R.Cond("segment", "p", 2),))]
    df = spark.createDataFrame([("xz",), ("yz",), ("q/p/r",), (None,)], "v string")
    got = [r.o for r in df.select(R.classify_expr(F.col("v"), rules, "none").alias("o")).collect()]
    assert got == ["a", "none", "c", "none"]


def test_chunking_keeps_order(spark):
    rules = [R.Rule(i, f"r{i}", (R.Cond("regex", f"^{i % 7}"),)) for i in range(1, 130)]
    df = spark.createDataFrame([(str(d),) for d in range(7)], "v string")
    got = {r.v: r.o for r in df.select("v", R.classify_expr(F.col("v"), rules).alias("o")).collect()}
    # the first rule whose number mod 7 equals the digit wins
    assert got == {str(d): f"r{d if d else 7}" for d in range(7)}


def test_classify_distinct_matches_direct(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    t = part.select("p_partkey", F.concat_ws("/", "p_type", "p_name", "p_brand").alias("text"))
    a = R.classify_distinct(t, "text", D.bundle_rules(), "b", "other").select("p_partkey", "b")
    b = t.select("p_partkey", R.classify_expr(F.col("text"), D.bundle_rules(), "other").alias("b"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_lint_reports_shadowed_rule(spark):
    df = spark.createDataFrame([("red_widget",), ("red_gear",), ("small_ring",)], "bundle string")
    got = {r.label: r for r in R.rule_lint(df, "bundle", D.mission_rules()).collect()}
    assert got["Red Widget Mission"].shadowed and got["Red Widget Mission"].any_match_rows == 1
    assert got["Ring Mission"].first_match_rows == 1
    assert got["Gear Mission"].first_match_rows == 1


def test_robot_and_bot_classifiers(spark):
    df = spark.createDataFrame([("Googlebot/2.1",), ("Mozilla/5.0 Safari",), ("curl/8",), (None,), ("x/i",)], "a string")
    got = [(r.r, r.b) for r in df.select(R.robot_or_human(F.col("a")).alias("r"),
                                          R.bot_human_unknown(F.col("a")).alias("b")).collect()]
    assert got == [("robot", "bot"), ("human", "human"), ("human", "bot"), ("human", "unknown"), ("human", "unknown")]


def test_node_request_type(spark):
    df = spark.createDataFrame([("img", "GET /search/x HTTP/1.1"), ("sbn", "GET /x/pds-ceres/y"),
                                ("naif", "GET /pub/naif/utilities/z"), ("ppi", "GET /software/a"),
                                ("geo", "GET /mro/crism/cat"), ("atm", "GET /other")], "node string, req string")
    got = [r.t for r in df.select(R.node_request_type(F.col("node"), F.col("req")).alias("t")).collect()]
    assert got == ["Planetary Image Atlas III", "Dawn Mission to Ceres", "Data Server Area",
                   "PDS3 Software Pkgs", "CRISM Spectral Library", "archive"]


def test_rules_from_table(spark):
    t = spark.createDataFrame([("s", 1, "v", "contains", None, "x", "has x"),
                               ("s", 1, "v", "like", None, "%y", "has x"),
                               ("s", 2, "v", "regex", None, "^q", "q first")],
                              "rule_set string, priority int, field string, op string, arg int, pattern string, label string")
    sets = R.rules_from_df(t)
    assert [r.label for r in sets["s"]] == ["has x", "q first"] and len(sets["s"][0].conds) == 2


def test_sql_and_column_compilers_agree(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    t = part.select(F.concat_ws("/", "p_type", "p_name", "p_brand").alias("text"))
    for rules in (D.PART_RULES, D.bundle_rules(), D.bundle_rules(268)):
        a = t.select(R.classify_expr("text", rules, "other").alias("a"),
                     R.classify_expr(F.col("text"), rules, "other").alias("b"),
                     R.first_match_index("text", rules).alias("i"),
                     R.first_match_index(F.col("text"), rules).alias("j"))
        assert a.where("a <> b OR NOT (i <=> j)").count() == 0
    reqs = spark.createDataFrame([("img", "GET /search/x"), ("naif", "GET /pub/naif/misc/a"), ("sbn", "X /wiki/y"),
                                  ("geo", "GET /speclib/q'uote\\\\")], "node string, req string")
    got = reqs.select(R.node_request_type("node", "req").alias("a"),
                      R.node_request_type(F.col("node"), F.col("req")).alias("b"))
    assert got.where("a <> b").count() == 0
    assert [r.a for r in got.collect()] == ["Planetary Image Atlas III", "Misc", "Wiki", "Spectral Library"]
