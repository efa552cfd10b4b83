"""Sinks: idempotent month-partitioned event store, quarantine, routing (K1–K4).

The store is Parquet partitioned by ``event_month``.  Writes are idempotent
by content hash: a batch is de-duplicated on ``(event_month, event_hash)`` and
anti-joined against the rows already stored in the same months, so
re-delivered files and re-run batches add nothing (first write wins).  The
anti-join's month equality lets Spark prune the stored side to the touched
partitions.  Output goes through Spark's commit protocol, so a lost executor
re-runs its tasks without leaving partial files behind.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from .normalise import is_quarantined

STORE_KEYS = ("event_month", "event_hash")


def dedupe_by_hash(events: DataFrame) -> DataFrame:
    """A10: identical raw lines in one month collapse to one event."""
    return events.dropDuplicates(list(STORE_KEYS))


def dedupe_stored(events: DataFrame) -> DataFrame:
    """``dedupe_by_hash`` of a table that is cheap to read again: only rows whose key repeats are shuffled whole.

    The keys alone are counted; rows of the others pass as they are.
    """
    keys = [F.col(k).alias(f"_again_{k}") for k in STORE_KEYS]
    again = materialize(events.groupBy(*STORE_KEYS).count().where("count > 1").select(*keys), "again-keys", partition_by=None)
    if again.isEmpty():
        return events
    same = functools.reduce(lambda x, y: x & y, [events[k].eqNullSafe(again[f"_again_{k}"]) for k in STORE_KEYS])
    return events.join(again, same, "left_anti").unionByName(dedupe_by_hash(events.join(again, same, "left_semi")))


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """Keys of the stored rows; None only when the store does not exist yet."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return found.select(F.col("event_month").cast("string").alias("_month"), F.col("event_hash").alias("_hash"))


def batch_months(batch: DataFrame) -> list:
    """The months of a batch, as text (null: rows without one)."""
    return [r[0] for r in batch.select(F.col("event_month").cast("string")).distinct().collect()]


def new_rows(batch: DataFrame, store_path: str, stored: bool = False) -> DataFrame:
    """Rows of ``batch`` not yet in the store, each once.

    The stored rows meet the keys of the batch alone, and whole rows are
    de-duplicated only if some key is new: a replay costs a pass over its keys.
    ``stored`` says that ``batch`` is cheap to read again (a stored table, or
    persisted); else it is written once first, as months, keys and rows each
    read it.
    """
    existing = _existing(batch.sparkSession, store_path)
    if existing is None:
        return dedupe_stored(batch) if stored else dedupe_by_hash(batch)
    if not stored:
        batch = materialize(batch, "batch", partition_by=None)
    # the batch's few months, as literals: only their folders of the store are read
    months = batch_months(batch)
    known = F.col("_month").isin([m for m in months if m is not None])
    existing = existing.where(F.coalesce(known, F.lit(False)) | F.col("_month").isNull() if None in months else known)
    keys = batch.select(F.col("event_month").cast("string").alias("_new_month"), F.col("event_hash").alias("_new_hash")).distinct()
    same = keys["_new_month"].eqNullSafe(existing["_month"]) & (keys["_new_hash"] == existing["_hash"])
    keys = materialize(keys.join(existing, same, "left_anti"), "new-keys", partition_by=None)
    if keys.isEmpty():
        return batch.limit(0)
    fresh = dedupe_stored(batch)
    new = fresh["event_month"].cast("string").eqNullSafe(keys["_new_month"]) & fresh["event_hash"].eqNullSafe(keys["_new_hash"])
    return fresh.join(keys, new, "left_semi")


def write_store(batch: DataFrame, store_path: str, stored: bool = False) -> None:
    """K1: append the rows the store does not hold yet, one folder per month (``stored``: see ``new_rows``)."""
    (new_rows(batch, store_path, stored).write.mode("append").option("compression", "zstd")
        .partitionBy("event_month").parquet(store_path))


def materialize(df: DataFrame, name: str, partition_by: str | None = "event_month") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (an executor lost later re-reads files instead of
    re-parsing raw text), lets later plans prune columns and ``event_month``
    partitions, and lets several branches of one report share one parse.
    """
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_ordered_store(events: DataFrame, path: str, partitions: int | None = None) -> None:
    """The store laid out by time: rows in order of event_start in every file, files of a month in ranges that do not overlap.

    Row groups then hold short spans of time, so a filter on event_start skips
    most of a month by their statistics, and a read in time order sorts runs
    that lie nearly in order.  The ranges are cut by month, time and hash:
    many events of one second do not meet in one task.  The events are written
    once first: finding the ranges reads their order alone, not the lines again.
    """
    events = materialize(events, "unordered", partition_by=None)
    order = ["event_month", "event_start", "event_hash"]
    n = partitions or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (events.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .write.mode("append").option("compression", "zstd").partitionBy("event_month").parquet(path))


def quarantine_lines(events: DataFrame) -> DataFrame:
    """K2: quarantined rows as formatted text lines with their month."""
    q = events.where(is_quarantined(F.col("tags")))
    stamp = F.coalesce(F.col("event_start"), F.col("ingested_at")) if "ingested_at" in events.columns \
        else F.col("event_start")
    line = F.format_string("[%s] [%s] File: %s | Message: %s | Error: %s",
                           F.coalesce(F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"), F.lit("-")),
                           F.array_join(F.col("tags"), ","),
                           F.coalesce(F.col("file_path"), F.lit("-")) if "file_path" in events.columns else F.lit("-"),
                           F.col("message"), F.coalesce(F.col("error_message"), F.lit("-")))
    month = F.coalesce(F.date_format(stamp, "yyyy-MM"), F.lit("unknown"))
    return q.select(month.alias("quarantine_month"), line.alias("value"))


def write_quarantine(events: DataFrame, path: str, batch_id: int | None = None) -> None:
    """K2/T7 writer.  With ``batch_id`` (a streaming epoch) the lines go to their
    own ``batch=<id>`` folder in overwrite mode, so a replayed epoch replaces
    its output instead of appending it twice."""
    lines = quarantine_lines(events).write.partitionBy("quarantine_month")
    if batch_id is None:
        lines.mode("append").text(path)
    else:
        lines.mode("overwrite").text(f"{path.rstrip('/')}/batch={int(batch_id)}")


def write_routed(events: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K3: one folder per quality route."""
    events.write.mode("append").format(fmt).partitionBy("route").save(path)


def materialise(df: DataFrame, name: str, as_table: bool = False) -> DataFrame:
    """K4: a query as a temp view (re-planned on read) or a managed table."""
    if as_table:
        df.write.mode("overwrite").saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# --- fixed values: constants carried by every event (N1) ------------------
EVENT_KIND = "event"
EVENT_CATEGORY = ("web", "network")
EVENT_TYPE = ("access", "info")
EVENT_DATASET = "web.analytics"
EVENT_MODULE = "web"
EVENT_SEQUENCE = 0
ERROR_DETAILS = "struct<timestamp: string, message: string, pattern: string>"
# ---------------------------------------------------------------------------


def _opt(df: DataFrame, name: str, dtype: str = "string") -> F.Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def to_ecs(events: DataFrame, provider: str = "web-archive") -> DataFrame:
    """N1 + the nested document shape, built once at the sink.

    Work inside the library stays on flat columns; this projection nests them
    under ``event``, ``source``, ``http``, ``url``, ``user_agent``, ``error``
    and ``ftp`` and adds the per-event constants.  FTP retrievals are filed
    under the ``file``/``network`` categories.
    """
    e = events
    ftp = F.col("event_action").isin("RETR", "BOTZETR")
    category = F.when(ftp, F.array(F.lit("file"), F.lit("network"))).otherwise(
        F.array(*[F.lit(x) for x in EVENT_CATEGORY]))
    return e.select(
        F.struct(
            F.lit(EVENT_KIND).alias("kind"), category.alias("category"),
            F.array(*[F.lit(x) for x in EVENT_TYPE]).alias("type"),
            F.coalesce(_opt(e, "src_dataset"), F.lit(EVENT_DATASET)).alias("dataset"),
            F.lit(EVENT_MODULE).alias("module"), F.lit(provider).alias("provider"),
            F.col("event_action").alias("action"), F.col("event_outcome").alias("outcome"),
            F.col("event_start").alias("start"), _opt(e, "ingested_at", "timestamp").alias("ingested"),
            F.col("event_hash").alias("hash"), F.lit(EVENT_SEQUENCE).alias("sequence"),
            F.col("duration").alias("duration"),
        ).alias("event"),
        F.struct(
            F.col("source_address").alias("address"), _opt(e, "source_domain").alias("domain"),
            _opt(e, "source_registered_domain").alias("registered_domain"),
            _opt(e, "source_top_level_domain").alias("top_level_domain"),
            _opt(e, "source_sub_domain").alias("subdomain"),
            F.struct(_opt(e, "geo_country").alias("country_iso_code"), _opt(e, "geo_region").alias("region_name"),
                     _opt(e, "geo_city").alias("city_name"), _opt(e, "geo_lat", "double").alias("lat"),
                     _opt(e, "geo_lon", "double").alias("lon")).alias("geo"),
        ).alias("source"),
        F.struct(
            F.struct(F.col("http_method").alias("method"), F.col("referrer").alias("referrer"),
                     F.struct(F.col("request_bytes").alias("bytes"),
                              F.col("request_body").alias("content")).alias("body")).alias("request"),
            F.struct(F.col("status_code").alias("status_code"),
                     F.struct(F.col("response_bytes").alias("bytes")).alias("body")).alias("response"),
            F.col("http_version").alias("version"),
        ).alias("http"),
        F.struct(
            F.col("url_original").alias("original"), F.col("url_path").alias("path"),
            F.col("url_query").alias("query"), F.col("url_fragment").alias("fragment"),
            F.col("url_scheme").alias("scheme"), F.col("url_domain").alias("domain"),
            F.col("url_port").alias("port"), F.col("url_username").alias("username"),
            F.col("url_query_params").alias("query_params"), F.col("url_query_parts").alias("query_parts"),
            F.col("url_path_parts").alias("path_parts"), F.col("url_path_depth").alias("path_depth"),
        ).alias("url"),
        F.struct(F.col("user_agent").alias("original"), _opt(e, "ua_name").alias("name"),
                 _opt(e, "ua_version").alias("version"),
                 F.struct(_opt(e, "ua_os").alias("name"), _opt(e, "ua_os_version").alias("version")).alias("os"),
                 F.struct(_opt(e, "ua_device").alias("name"), _opt(e, "ua_device_brand").alias("brand"),
                          _opt(e, "ua_device_model").alias("model")).alias("device")).alias("user_agent"),
        F.struct(F.col("error_type").alias("type"), F.col("error_message").alias("message"),
                 F.col("error_code").alias("code"), _opt(e, "error_details", ERROR_DETAILS).alias("details")).alias("error"),
        F.struct(F.col("ftp_command").alias("command"), F.col("ftp_flags").alias("flags")).alias("ftp"),
        F.struct(F.col("network_bytes").alias("bytes"), F.col("network_protocol").alias("protocol")).alias("network"),
        F.struct(F.col("server_ip").alias("ip"), F.col("server_port").alias("port"),
                 F.col("server_site").alias("site"), F.col("server_domain").alias("domain")).alias("server"),
        F.struct(F.col("user_name").alias("name"), F.col("user_ident").alias("ident"),
                 F.col("user_id").alias("id")).alias("user"),
        F.struct(_opt(e, "src_organization").alias("name")).alias("organization"),
        F.struct(_opt(e, "file_path").alias("path")).alias("file"),
        F.col("tags"), F.col("message"), F.col("event_month"),
    )
