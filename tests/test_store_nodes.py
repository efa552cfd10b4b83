"""The bucketed store and the node table."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from accesslake.operators.bucketstore import BucketStore
from accesslake.session import scratch_path
from accesslake.sources.nodetable import add_node, create_node_table, node_lines, recover_nodes

SF = "/root/testdata/sf0.001"
EVENTS = "event_month string, event_hash string, body string"


def events(spark, rows):
    return spark.createDataFrame([(m, h, f"line {h}") for m, h in rows], EVENTS)


def held(store):
    return sorted((str(r.event_month), r.event_hash) for r in store.read().collect())


def test_replays_and_two_writers(spark):
    store = BucketStore(spark, scratch_path(spark, "bucket-store"), 4)
    a = [("2024-01", "x"), ("2024-01", "y"), ("2024-02", "x"), (None, "z"), ("2024-01", "x")]
    assert store.append(events(spark, a), "one", 0)
    assert not store.append(events(spark, a), "one", 0)  # the record says that it is there
    assert store.append(events(spark, a + [("2024-03", "w")]), "one", 1)
    assert held(store) == [("2024-01", "x"), ("2024-01", "y"), ("2024-02", "x"), ("2024-03", "w"), ("None", "z")]
    assert spark.table(store.table).count() == 5  # known rows were not written again
    with pytest.raises(ValueError):
        store.append(events(spark, a), "no/such", 0)


def test_writers_at_the_same_time(spark):
    """Both look before either has written: the rows are there twice, readers see them once."""
    path = scratch_path(spark, "bucket-race")
    one, two = BucketStore(spark, path, 4), BucketStore(spark, path, 4)
    batch = events(spark, [("2024-01", f"h{i}") for i in range(20)] + [(None, "bad")])
    fresh = two.new_rows(batch).persist()
    assert fresh.count() == 21
    one.append(batch, "one", 0)
    two.new_rows = lambda _: fresh
    two.append(batch, "two", 0)
    assert held(one) == sorted([("2024-01", f"h{i}") for i in range(20)] + [("None", "bad")])
    assert spark.table(one.table).count() == 42


def test_a_batch_without_record_is_not_read(spark):
    store = BucketStore(spark, scratch_path(spark, "bucket-dead"), 4)
    store.append(events(spark, [("2024-01", "a")]), "one", 0)
    own = next(t.name for t in spark.catalog.listTables() if t.name.startswith(store.table + "_"))
    dead = events(spark, [("2024-01", "b"), ("2024-01", "a")]).withColumn("store_batch", F.lit(1).cast("long"))
    dead.select(*spark.table(own).columns).write.mode("append").insertInto(own)  # the writer died before its record
    assert held(store) == [("2024-01", "a")]
    assert store.append(events(spark, [("2024-01", "b"), ("2024-01", "a")]), "one", 1)  # it repeats the batch
    assert held(store) == [("2024-01", "a"), ("2024-01", "b")]


def test_the_stored_side_is_not_shuffled(spark):
    store = BucketStore(spark, scratch_path(spark, "bucket-plan"), 8)
    store.append(events(spark, [("2024-01", f"h{i}") for i in range(50)]), "one", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.new_rows(events(spark, [("2024-01", "h1"), ("2024-01", "n")]))
        rows = sorted(r.event_hash for r in plan.collect())
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == ["n"]
    scan = next(line for line in text.split("\n") if "FileScan parquet spark_catalog" in line)
    assert "Bucketed: true" in scan and "event_month" in scan[scan.index("PartitionFilters"):]
    # no exchange between the anti-join and the scan: the only shuffles are the batch's
    assert "LeftAnti" in text and not re.findall(r"Exchange hashpartitioning\(_h", text)


def test_whole_rows_are_shuffled_once(spark):
    """Join, de-duplication and write take the rows as the one shuffle by hash left them; a batch of known rows is not shuffled whole."""
    store = BucketStore(spark, scratch_path(spark, "bucket-once"), 8)
    exchanges = lambda df: set(re.findall(r"Exchange (hashpartitioning\(.*?\))", df._jdf.queryExecution().executedPlan().toString()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = events(spark, [("2024-01", f"h{i}") for i in range(50)] * 2 + [(None, "h1")])
        assert len(exchanges(store.new_rows(a))) == 1
        store.append(a, "one", 0, stored=True)
        assert len(held(store)) == 51
        files = {f.rsplit("/", 1)[1] for f in spark.table(store.table).inputFiles()}
        assert len(files) <= 16  # a file a bucket and month
        plan = store.new_rows(events(spark, [("2024-01", "h1"), ("2024-01", "n"), ("2024-01", "n"), ("2024-02", "h1")]))
        assert sorted((r.event_month, r.event_hash) for r in plan.collect()) == [("2024-01", "n"), ("2024-02", "h1")]
        assert len(exchanges(plan)) == 1
        known = store.new_rows(events(spark, [("2024-01", "h1"), (None, "h1")]))
        assert known.count() == 0 and not exchanges(known)
        assert store.append(a, "two", 0, stored=True) and not store.append(a, "two", 0, stored=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.table(store.table).count() == 51


def test_empty_batch_and_empty_store(spark):
    store = BucketStore(spark, scratch_path(spark, "bucket-empty"), 4)
    with pytest.raises(FileNotFoundError):
        store.read()
    store.append(events(spark, []), "one", 0)
    with pytest.raises(FileNotFoundError):
        store.read()
    store.append(events(spark, [("2024-01", "a")]), "one", 1)
    assert held(store) == [("2024-01", "a")]


def write(path, *lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/x.log", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_node_table(spark):
    root = re.sub("^file:/*", "/", scratch_path(spark, "nodes"))
    write(f"{root}/plain/atm", "1", "2")
    write(f"{root}/other/geo's", "3")
    write(f"{root}/table/node=sbn", "4")
    name = "nodes_" + root.rsplit("-", 1)[1]
    create_node_table(spark, name, f"{root}/table", {"atm": f"{root}/plain/atm", "geo": f"{root}/other/geo's"})
    count = lambda *n: {r.node: r.n for r in node_lines(spark, name, *n).groupBy("node").agg(F.count("*").alias("n")).collect()}
    assert count() == {"atm": 2, "geo": 1, "sbn": 1}
    write(f"{root}/table/node=en", "5", "6", "7")
    assert "en" not in count()
    recover_nodes(spark, name)
    assert count("en", "geo") == {"en": 3, "geo": 1}
    write(f"{root}/moved", "8")
    add_node(spark, name, "atm", f"{root}/moved")
    assert count("atm") == {"atm": 1}
    with pytest.raises(ValueError):
        node_lines(spark, "x; drop")


def test_node_filter_prunes(spark):
    plan = E.queries()["added_node"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*node", plan) and "BatchEvalPython" not in plan
