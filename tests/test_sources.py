import os

from pyspark.sql import functions as F

from accesslake.session import scratch_path
from accesslake.sources.text import node_from_path, read_lines, register_node_table


def write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_read_lines_glob_and_node(spark):
    root = scratch_path(spark, "logs-src")
    if root.startswith("file:"):
        root = root[5:]
    write(f"{root}/logs/atm", "access_log.1", ["a", "b"])
    write(f"{root}/logs/geo", "access_log.2", ["c"])
    write(f"{root}/logs/geo", "notes.txt", ["skip"])
    df = read_lines(spark, root, glob="access_log*")
    got = sorted((r.node, r.value) for r in df.select(node_from_path().alias("node"), "value").collect())
    assert got == [("atm", "a"), ("atm", "b"), ("geo", "c")]


def test_node_partitioned_table(spark):
    root = scratch_path(spark, "node-table")
    if root.startswith("file:"):
        root = root[5:]
    write(f"{root}/node=atm", "x.log", ["1", "2"])
    write(f"{root}/node=sbn", "y.log", ["3"])
    df = register_node_table(spark, "raw_lines_test", root)
    assert {r.node: r.n for r in df.groupBy("node").agg(F.count("*").alias("n")).collect()} == {"atm": 2, "sbn": 1}
    assert spark.sql("SELECT count(*) AS n FROM raw_lines_test WHERE node = 'atm'").first().n == 2


def test_gzip_lines(spark):
    import gzip
    root = scratch_path(spark, "gz-src")
    if root.startswith("file:"):
        root = root[5:]
    os.makedirs(f"{root}/logs/sbn", exist_ok=True)
    with gzip.open(f"{root}/logs/sbn/access.log.gz", "wt") as fh:
        fh.write("x\ny\nz\n")
    df = read_lines(spark, root, glob="*.gz", repartition=4)
    assert sorted(r.value for r in df.collect()) == ["x", "y", "z"]
    assert df.rdd.getNumPartitions() == 4


def test_json_lines_meet_no_layout(spark):
    """A long JSON line is mapped at once: no text layout searches it, nor finds a line that it quotes."""
    import json
    import time

    from accesslake.plans.ingest import parse_any
    quoted = '10.0.0.1 - - [01/Jan/2024:00:00:00 +0000] "GET /a HTTP/1.1" 200 1 "-" "x"'
    agent = "a." * 40000
    rows = [(i, json.dumps({"date": "2024-01-02", "time": "03:04:05", "c-ip": "10.0.0.9", "cs-method": "GET", "cs-uri-stem": "/s",
                            "cs(User-Agent)": agent, "cs(Referer)": "no"})) for i in range(8)]
    rows += [(100, json.dumps({"c-ip": "10.0.0.8", "cs(Referer)": quoted})), (101, "{" + quoted), (102, quoted), (103, None)]
    start = time.time()
    got = {r.i: r for r in parse_any(spark.createDataFrame(rows, "i long, value string")).collect()}
    assert time.time() - start < 30
    assert all(got[i].log_format == "cdn_json" and got[i].user_agent == agent and got[i].source_address == "10.0.0.9" for i in range(8))
    assert (got[100].log_format, got[100].source_address, got[100].referrer) == ("cdn_json", "10.0.0.8", quoted)
    assert got[101].source_address is None and got[102].log_format == "apache_combined" and got[102].source_address == "10.0.0.1"
    assert got[103].log_format is None and not got[103]._json_line
