"""Connected components of an edge table by alternating stars (large-star, small-star).

Every round is a groupBy and a join on the edge table, written to the shared
folder; no links or components reach the driver, only two numbers a round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free, stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges``: columns a, b of one orderable type.  Returns (node, root): root is the smallest node.

    Nodes without an edge do not occur; self-loops and nulls are ignored; no
    edges give an empty table.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = stored(e, name), None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before, old = now, e
        e = stored(_small_star(_large_star(e)), name)
        free(old)


def merged(roots: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
    """``roots`` (node, root) after ``links`` (a, b): of what is joined already only the roots take part."""
    if roots is None:
        return stored(components(links, name), name)

    def top(side: str) -> DataFrame:
        return roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))

    ends = links.join(top("a"), "a", "left").join(top("b"), "b", "left")
    over = stored(components(ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")), name), name)
    moved = roots.join(over.select(F.col("node").alias("root"), F.col("root").alias("now")), "root", "left").select(
        "node", F.coalesce("now", "root").alias("root"))
    out = stored(moved.union(over.join(roots, "node", "left_anti").select("node", "root")), name)
    free(over)
    free(roots)
    return out


def _apart(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The rows of ``pairs`` (key, hub) whose ends are not in one component."""
    if roots is None:
        return pairs
    ends = pairs
    for side in ("key", "hub"):
        ends = ends.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    return ends.where(F.coalesce("root_key", "key") != F.coalesce("root_hub", "hub")).select(*pairs.columns)


def bucketed(rows: DataFrame, confirm: Callable[[DataFrame], DataFrame], name: str, info: DataFrame | None = None,
             near: str = "true") -> DataFrame:
    """(node, root) of the keys that confirmed links join, from ``rows`` (bucket, key): buckets with two keys or more.

    In each round every open bucket compares its members of other components
    with its hubs, which then leave.  A bucket closes when all its members are
    connected, so every pair that could join two components is tested, and
    pairs inside a component are never listed.  The first round has one hub a
    bucket; each later one eight times as many, so that a bucket of members
    that are not alike closes after a few rounds too.  A key that meets several
    hubs is confirmed with the best of them first, then with four, sixteen, all
    (when the pairs are many): those it is connected with by then are left out, so a group of copies is
    not tested once for each of its hubs.  Few new links (under
    one in a hundred open members) are kept for a later join of components:
    until then some pairs of one component are tested in vain.  Hubs are the members
    that meet the most others over all their buckets: the centre of a group of
    copies, and the same one in each bucket.  ``info`` (key, info) is what
    ``near``, a condition on ``info`` and ``hub_info``, needs to leave out
    pairs that cannot link; it is part of the join, so they are never written.
    ``confirm`` gets distinct pairs (a, b) and returns those that link.
    """
    met = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    weight = rows.join(met, "bucket").groupBy("key").agg((-F.sum("n")).alias("w"))
    weight = weight.withColumn("info", F.lit(0)) if info is None else weight.join(info, "key")
    columns = ["bucket", "key", "w", "info"]
    members, roots, hubs = stored(rows.join(weight, "key").select(*columns), f"{name}-members"), None, 1
    held, waiting, kept, most_open = None, 0, members, 0  # links not joined yet, their number; the table that members are read from
    while True:
        now = members.select(*columns, F.col("key").alias("root")) if roots is None else members.join(
            roots.withColumnRenamed("node", "key"), "key", "left").select(*columns, F.coalesce("root", "key").alias("root"))
        first = F.min(F.struct("w", "key", "root", "info"))
        ends = now.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), first.alias("first")).where("lo <> hi")
        if hubs == 1:
            ends = ends.select("bucket", F.col("first.key").alias("hub"), F.col("first.root").alias("hub_root"),
                               F.col("first.w").alias("hub_w"), F.col("first.info").alias("hub_info"))
            left = stored(now.join(ends, "bucket").where("key <> hub"), f"{name}-open")
            pairs = left.where("root <> hub_root").where(near)
            rest = left
        else:
            turn = F.row_number().over(Window.partitionBy("bucket").orderBy("w", "key"))
            left = stored(now.join(ends.select("bucket"), "bucket").withColumn("turn", turn), f"{name}-open")
            chosen = left.where(F.col("turn") <= hubs).select("bucket", F.col("key").alias("hub"), F.col("root").alias("hub_root"),
                                                              F.col("turn").alias("hub_turn"), F.col("w").alias("hub_w"),
                                                              F.col("info").alias("hub_info"))
            pairs = left.join(chosen, "bucket").where("turn > hub_turn and root <> hub_root").where(near)
            rest = left.where(F.col("turn") > hubs)
        free(kept)
        kept = left
        place = F.row_number().over(Window.partitionBy("key").orderBy("hub_w", "hub")).alias("place")
        todo = stored(pairs.select("key", "hub", "hub_w").distinct().select("key", "hub", place), f"{name}-pairs")
        still, most = rest.count(), 1
        most_open = max(most_open, still)
        while True:
            n, keys = todo.agg(F.count(F.lit(1)), F.count_distinct("key")).first()
            several = n > 2 * keys and n * 4 > most_open and most < 64  # few pairs are confirmed at once
            turns = todo.where(F.col("place") <= most) if several else todo
            found = stored(confirm(turns.select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()), f"{name}-links")
            waiting += found.count()
            held = found if held is None else held.union(found)
            if roots is None or waiting * 100 > still or several and waiting:
                roots, held, waiting = merged(roots, held, f"{name}-roots"), None, 0
            if not several:
                break
            old, most = todo, most * 4
            todo = stored(_apart(todo.where(F.col("place") > most // 4), roots), f"{name}-pairs")
            free(old)
        free(todo)
        if not still:
            return roots
        members, hubs = rest.select(*columns), hubs * 8
