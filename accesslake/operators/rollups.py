"""Aggregations and reports over the event table.

All of these are plain ``groupBy().agg()`` plans: Spark runs them as a
partial (map-side) aggregate, one shuffle on the grouping keys, and a final
aggregate, so a hot key (one client, one bot, one node holding a third of the
rows) is pre-combined inside every map task and never lands in one task.
Top-k uses ``orderBy().limit(k)`` which plans as ``TakeOrderedAndProject``:
each task keeps its own k best rows and only those reach the final merge.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BYTES_PER_GB = 1_000_000_000.0  # fixed value: decimal gigabytes


def months_between_inclusive(start: dt.datetime, end: dt.datetime) -> list[str]:
    out, y, m = [], start.year, start.month
    while (y, m) <= (end.year, end.month):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def trailing_window(df: DataFrame, as_of: dt.datetime, hours: int, ts_col: str = "event_start",
                    month_col: str | None = "event_month") -> DataFrame:
    """``as_of - hours <= ts <= as_of`` (both ends inclusive).

    ``as_of`` is an argument, so a report can be re-run for any day.  When the
    table carries the ``event_month`` partition column, the matching months
    are added as a literal predicate so only those partitions are listed and
    read.
    """
    start = as_of - dt.timedelta(hours=hours)
    cond = F.col(ts_col).between(_ts_lit(start), _ts_lit(as_of))
    if month_col and month_col in df.columns:
        cond = F.col(month_col).isin(months_between_inclusive(start, as_of)) & cond
    return df.filter(cond)


def _egress_bytes(include_ftp: bool) -> Column:
    b = F.col("response_bytes")
    return F.coalesce(b, F.col("network_bytes")) if include_ftp else b


def egress_total(df: DataFrame, include_ftp: bool = False) -> DataFrame:
    """A4: total bytes (0 when empty) and request count."""
    return df.agg(F.coalesce(F.sum(_egress_bytes(include_ftp)), F.lit(0)).cast("bigint").alias("bytes"),
                  F.count(F.lit(1)).alias("requests"))


def top_by_bytes(df: DataFrame, key: str, k: int = 20, include_ftp: bool = False) -> DataFrame:
    """Top ``k`` keys by bytes (ties by key), null keys left out."""
    agg = (df.where(F.col(key).isNotNull())
             .groupBy(F.col(key).alias("key"))
             .agg(F.coalesce(F.sum(_egress_bytes(include_ftp)), F.lit(0)).cast("bigint").alias("bytes"),
                  F.count(F.lit(1)).alias("requests")))
    return agg.orderBy(F.col("bytes").desc(), F.col("key").asc()).limit(k)


def _ts_lit(t: dt.datetime) -> Column:
    # Literal read in the session zone (pinned to UTC), independent of the driver's zone.
    return F.to_timestamp(F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")))


def egress_report(df: DataFrame, as_of: dt.datetime, hours: int = 24, k: int = 20,
                  include_ftp: bool = False, domain_col: str = "source_registered_domain",
                  user_col: str = "source_domain") -> DataFrame:
    """Total, top-k registered domains, top-k client names (≤ 2k+1 rows).

    One scan: a grouping-sets aggregate ``((), (domain), (user))`` computes the
    three sections together; the three top-k branches read the same shuffle
    (Spark reuses the identical exchange), each keeping only its k best rows.
    """
    win = trailing_window(df, as_of, hours)
    b = _egress_bytes(include_ftp)
    agg = (win.select(b.alias("__b"), F.col(domain_col).alias("__d"), F.col(user_col).alias("__u"))
              .groupingSets([[], ["__d"], ["__u"]], "__d", "__u")
              .agg(F.coalesce(F.sum("__b"), F.lit(0)).cast("bigint").alias("bytes"),
                   F.count(F.lit(1)).alias("requests"),
                   F.grouping_id().alias("__gid")))
    total_gid, domain_gid, user_gid = 3, 1, 2   # grouping_id bits: (__d, __u)
    total = agg.where(F.col("__gid") == total_gid).select(
        F.lit("total").alias("section"), F.lit(1).alias("rank"), F.lit(None).cast("string").alias("key"),
        "bytes", "requests")
    # A window with no data at all still reports a total of 0 bytes.
    empty_total = win.sparkSession.range(1).select(
        F.lit("total").alias("section"), F.lit(1).alias("rank"), F.lit(None).cast("string").alias("key"),
        F.lit(0).cast("bigint").alias("bytes"), F.lit(0).cast("bigint").alias("requests"))
    total = total.unionByName(empty_total).groupBy("section", "rank", "key").agg(
        F.max("bytes").alias("bytes"), F.max("requests").alias("requests"))

    def section(gid: int, key_col: str, name: str) -> DataFrame:
        top = (agg.where((F.col("__gid") == gid) & F.col(key_col).isNotNull())
                  .select(F.col(key_col).alias("key"), "bytes", "requests")
                  .orderBy(F.col("bytes").desc(), F.col("key").asc()).limit(k))
        # at most k rows here, so a single ordered window is cheap
        w = Window.orderBy(F.col("bytes").desc(), F.col("key").asc())
        return top.select(F.lit(name).alias("section"), F.row_number().over(w).alias("rank"),
                          "key", "bytes", "requests")

    out = (total.unionByName(section(domain_gid, "__d", "domain"))
                .unionByName(section(user_gid, "__u", "user")))
    return out.withColumn("gb", F.round(F.col("bytes") / F.lit(BYTES_PER_GB), 2))


def path_prefix_egress(df: DataFrame, include_ftp: bool = False) -> DataFrame:
    """Bytes and requests per cumulative path prefix."""
    e = df.select(_egress_bytes(include_ftp).alias("b"),
                  F.posexplode("url_path_depth").alias("pos", "prefix"))
    return (e.groupBy("prefix", (F.col("pos") + 1).alias("depth"))
             .agg(F.coalesce(F.sum("b"), F.lit(0)).cast("bigint").alias("bytes"),
                  F.count(F.lit(1)).alias("requests")))


def route_counts(events: DataFrame) -> DataFrame:
    """Rows per quality route and drop reason."""
    return events.groupBy("route", "drop_reason").agg(F.count(F.lit(1)).alias("events"))


def tag_counts(events: DataFrame) -> DataFrame:
    """Rows per tag."""
    return events.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("events"))


def requests_per_period(df: DataFrame, unit: str = "day", key: str | None = None,
                        ts_col: str = "event_start") -> DataFrame:
    """Requests and bytes per time bucket (and key)."""
    keys = [F.date_trunc(unit, F.col(ts_col)).alias("period")] + ([F.col(key)] if key else [])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("requests"),
                                 F.coalesce(F.sum("response_bytes"), F.lit(0)).cast("bigint").alias("bytes"))


def artifact_frequency(df: DataFrame, ts_col: str = "event_start") -> DataFrame:
    """R2: access count, bytes and last access per path."""
    return (df.where(F.col("url_path").isNotNull()).groupBy("url_path")
              .agg(F.count(F.lit(1)).alias("requests"),
                   F.coalesce(F.sum("response_bytes"), F.lit(0)).cast("bigint").alias("bytes"),
                   F.max(ts_col).alias("last_access")))


def domain_subset(df: DataFrame, tlds: list[str], tld_col: str = "source_top_level_domain",
                  key: str = "source_registered_domain") -> DataFrame:
    """Metrics for clients whose suffix is in ``tlds`` (a short literal list)."""
    return (df.where(F.col(tld_col).isin(list(tlds))).groupBy(tld_col, key)
              .agg(F.count(F.lit(1)).alias("requests"),
                   F.coalesce(F.sum("response_bytes"), F.lit(0)).cast("bigint").alias("bytes")))


def yearly_yoy(df: DataFrame, ts_col: str, bytes_col: str) -> DataFrame:
    """Bytes per year with the previous year and the change.

    The window runs over the yearly aggregate (one row per year), not over
    events, so the single ordered window partition holds a handful of rows.
    """
    yearly = df.groupBy(F.year(ts_col).alias("year")).agg(F.sum(bytes_col).cast("bigint").alias("bytes"))
    w = Window.orderBy("year")
    prev = F.lag("bytes").over(w)
    return yearly.select("year", "bytes", prev.alias("prev_bytes"), (F.col("bytes") - prev).alias("delta_bytes"))


def count_by_month(events: DataFrame) -> DataFrame:
    """Stored events per month."""
    return events.groupBy("event_month").agg(F.count(F.lit(1)).alias("events"))


def count_by_key(events: DataFrame, fragment: str, key_col: str = "file_path") -> DataFrame:
    """Stored events whose object key contains ``fragment``, per month."""
    return (events.where(F.col(key_col).contains(fragment))
                  .groupBy("event_month").agg(F.count(F.lit(1)).alias("events")))
