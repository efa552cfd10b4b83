"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, *keys: str, target: int | None = None) -> DataFrame:
    """Hash-spread rows over the cluster when a scan yields too few partitions.

    Row-heavy text work (regex parsing, URL splitting) is CPU-bound per row,
    so a small compressed file that plans as one task would serialise it.
    The partition count of the planned scan is checked first (planning only,
    no job); large inputs that already span the cluster are left untouched,
    so no extra shuffle is added at scale.
    """
    try:
        want = target or df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= want:
            return df
    except Exception:  # no RDD view of this session: leave the layout to AQE
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)


#: Most values that the counting sketch follows at once.
SKETCH_ITEMS = 10_000


def heavy_values(df: DataFrame, key: str, parts: int) -> dict:
    """Value to the number of shares it fills: the values of ``key`` that hold more than one of ``parts`` shares of the rows.

    One aggregate with a bounded counting sketch a task finds them; fewer than
    ``parts`` values can hold that much, so the result is small whatever the
    data.
    """
    k = max(1, min(parts, SKETCH_ITEMS // 8))
    found = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {k}, {max(256, 8 * k)})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    pieces = {x["item"]: -(-x["count"] * parts // found["n"]) for x in found["top"] or []}
    return {value: n for value, n in pieces.items() if n > 1}


def join_back(rows: DataFrame, labels: DataFrame, key: str, label_key: str, parts: int | None = None) -> DataFrame:
    """Left-join a table with one row for each distinct value back onto the rows.

    One value may carry a third of all rows (a bot's agent, a hot URL, one
    host).  Such values are found first (``heavy_values``) and only they are
    split, each into as many pieces as its share of the rows asks: its label
    row is copied for every piece and its rows are dealt over them.  The
    result does not depend on which piece a row gets.  ``rows`` is read twice
    (its key column alone for the counts), so it should be a stored table.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_values(rows, key, parts)
    if not heavy:
        return rows.join(labels, rows[key] == labels[label_key], "left")
    heavy = spark.createDataFrame(sorted(heavy.items()), f"__heavy {rows.schema[key].dataType.simpleString()}, __pieces int")
    h = F.broadcast(heavy)  # fewer than ``parts`` rows
    lab = labels.join(h, labels[label_key] == heavy["__heavy"], "left").drop("__heavy")
    lab = lab.withColumn("__piece_l", F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1))).drop("__pieces")
    big = rows.join(h, rows[key] == heavy["__heavy"], "left").drop("__heavy")
    big = big.withColumn("__piece_b", F.pmod(F.monotonically_increasing_id(), F.coalesce("__pieces", F.lit(1))).cast("int")).drop("__pieces")
    return big.join(lab, (F.col(key) == F.col(label_key)) & (F.col("__piece_b") == F.col("__piece_l")), "left").drop("__piece_b", "__piece_l")
