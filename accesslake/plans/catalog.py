"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the shipped tables (or data Spark derives from them) in
full.  Output columns are flat, typed and named exactly as in
``plans.oracle.ORACLE_SQL``; timestamps are rendered as
``yyyy-MM-dd HH:mm:ss`` text and arrays / maps as delimited text, so results
compare across engines.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import enrich, rollups, sinks, sqlchain
from ..operators import rules as R
from ..operators.bucketstore import BucketStore
from ..operators.layouts import parse_lines
from ..operators.normalise import keep_events, to_events
from ..operators.summaries import KeptSummary
from ..session import scratch_path
from ..sources import replay
from ..sources.nodetable import create_node_table, node_lines, recover_nodes
from ..sources.tables import load
from ..sources.text import attach_source, read_lines
from . import dims as D
from .ingest import Dimensions, enrich_events, parse_any, transform

# --- fixed parameters of the catalogue ---------------------------------------
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
WINDOW_HOURS = 168
TOP_K = 20
SUBSET_TLDS = ("example.com", "example.org")
MISSION_YEAR = 2024
LARGE_RULE_SET = 1270
LATE_NODE = "en"
EGRESS_COLUMNS = ("event_start", "event_month", "source_address", "response_bytes", "tags")
DAY_START = dt.datetime(2024, 1, 15)
DAY_MONTHS = ("2024-01",)
# ------------------------------------------------------------------------------


def ts_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load(spark, sf, name)


def _events_pages(spark, sf):
    return _t(spark, sf, "events"), _t(spark, sf, "pages")


def combined_events(spark: SparkSession, sf: str) -> DataFrame:
    ev, pg = _events_pages(spark, sf)
    return keep_events(to_events(parse_lines(replay.lines(ev, pg, "apache_combined"))))


def enriched_events(spark: SparkSession, sf: str, windowed: bool = False) -> DataFrame:
    """Parsed events (the columns that traffic reports read) written once to a
    month-partitioned store, read back, (optionally) cut to the report window, then enriched: the window's month
    predicate prunes partitions and only the window's hosts are resolved."""
    cust = _t(spark, sf, "customer")
    d = Dimensions(dns=D.dns_from_customer(cust), public_suffix=D.public_suffix(spark))
    stored = sinks.materialize(combined_events(spark, sf).select(*EGRESS_COLUMNS), "events")
    if windowed:
        stored = rollups.trailing_window(stored, AS_OF, WINDOW_HOURS)
    return enrich_events(stored, d, url_domains=False, stored=True)


def noisy_events(spark: SparkSession, sf: str) -> DataFrame:
    ev, pg = _events_pages(spark, sf)
    return to_events(parse_any(replay.noisy_lines(ev, pg)))


def detail(spark: SparkSession, sf: str) -> DataFrame:
    ev, pg = _events_pages(spark, sf)
    return sqlchain.detail_table(replay.detail_lines(ev, pg, _t(spark, sf, "part")))


# ---- parsing -----------------------------------------------------------------

def q_parse_combined_roundtrip(spark, sf):
    e = combined_events(spark, sf)
    return e.select("event_id", "source_address", ts_text(F.col("event_start")).alias("event_start"),
                    "http_method", "url_path", "url_query", "status_code", "response_bytes",
                    "referrer", "user_agent", "event_outcome")


def q_parse_mixed_layouts(spark, sf):
    ev, pg = _events_pages(spark, sf)
    e = keep_events(to_events(parse_lines(replay.mixed_lines(ev, pg))))
    return e.select("event_id", "log_format", "source_address", ts_text(F.col("event_start")).alias("event_start"),
                    "http_method", "url_path", "url_query", "status_code", "response_bytes",
                    "network_bytes", "user_agent")


def q_time_formats(spark, sf):
    ev, pg = _events_pages(spark, sf)
    req = replay.event_requests(ev, pg)
    k = F.pmod(F.col("event_id"), F.lit(6))
    local = F.col("ts") + F.expr("INTERVAL 90 MINUTES")
    variants = {
        0: F.format_string('%s - - [%s +0000] "GET / HTTP/1.1" 200 1', "client", F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")),
        1: F.format_string('%s - - [%s +0130] "GET / HTTP/1.1" 200 1', "client", F.date_format(local, "dd/MMM/yyyy:HH:mm:ss")),
        2: F.format_string("%s W3SVC1 192.0.2.10 GET / - 443 - %s agent 200 0 0 1 15",
                           F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "client"),
        3: F.format_string("%s W3SVC1 192.0.2.10 GET / - 443 - %s agent 200 0 0 1 15",
                           F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "client"),
        4: F.format_string("%s %s %s %s %s 1 %s 1 /f b _ o r 1001 ftp 0 * c",
                           F.date_format("ts", "EEE"), F.date_format("ts", "MMM"), F.date_format("ts", "d"),
                           F.date_format("ts", "HH:mm:ss"), F.date_format("ts", "yyyy"), "client"),
        5: F.format_string('%s - - [%s +0000] "GET / HTTP/1.1" 200 1', "client",
                           F.regexp_replace(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), "^[0-9]{2}/[A-Za-z]{3}", "31/Feb")),
    }
    expr = None
    for i, v in variants.items():
        expr = F.when(k == i, v) if expr is None else expr.when(k == i, v)
    e = to_events(parse_lines(req.select("event_id", expr.alias("value"))))
    return e.select("event_id", "log_format", ts_text(F.col("event_start")).alias("event_start"),
                    F.array_contains("tags", "_datetimeparsefailure").alias("datetime_failure"))


def q_route_counts(spark, sf):
    return rollups.route_counts(noisy_events(spark, sf)).select(
        "route", "drop_reason", F.col("events").cast("bigint").alias("events"))


def q_tag_counts(spark, sf):
    kept = keep_events(noisy_events(spark, sf))
    return rollups.tag_counts(kept).select("tag", F.col("events").cast("bigint").alias("events"))


def q_outcome_by_status(spark, sf):
    e = keep_events(noisy_events(spark, sf))
    return (e.groupBy("status_code", "event_action", "event_outcome", "error_type")
             .agg(F.count(F.lit(1)).alias("events")))


def q_empty_agent_tags(spark, sf):
    e = keep_events(noisy_events(spark, sf))
    return e.select("event_id", "route", F.array_join("tags", ",").alias("tags"), "user_agent", "url_path")


def q_quarantine_lines(spark, sf):
    e = keep_events(noisy_events(spark, sf))
    q = e.where(F.array_contains("tags", "_datetimeparsefailure")
                | F.array_contains("tags", "_grok_filter_initial_parse_failure"))
    return q.select("event_id", F.array_join("tags", ",").alias("tags"), "error_type", "error_message")


def q_source_attach(spark, sf):
    ev, pg = _events_pages(spark, sf)
    nation = _t(spark, sf, "nation")
    req = replay.event_requests(ev, pg).withColumn("_nk", F.pmod(F.col("user_id"), F.lit(25)))
    n = nation.select(F.col("n_nationkey"), D.nation_slug(F.col("n_name")).alias("_slug"))
    req = req.join(n, req["_nk"] == n["n_nationkey"], "left")
    kind = F.when(F.pmod(F.col("user_id"), F.lit(2)) == 0, F.lit("web")).otherwise(F.lit("ftp"))
    path = F.concat(F.lit("s3://archive-logs/"), F.col("_slug"), F.lit("/"), kind, F.lit("/access-"),
                    F.pmod(F.col("event_id"), F.lit(7)).cast("string"), F.lit(".log"))
    ln = req.select("event_id", path.alias("file_path"), replay.combined_line().alias("value"))
    out = attach_source(ln, D.sources_from_nation(nation))
    return out.select("event_id", "file_path", F.col("src_organization").alias("organization"),
                      F.col("src_dataset").alias("dataset"), F.col("src_url_domain").alias("url_domain"))


def q_cdn_json_parse(spark, sf):
    ev, pg = _events_pages(spark, sf)
    req = replay.event_requests(ev, pg)
    country = F.element_at(F.array(*[F.lit(c) for c in D.CDN_COUNTRIES]),
                           (F.pmod(F.col("user_id"), F.lit(len(D.CDN_COUNTRIES))) + 1).cast("int"))
    path = F.regexp_replace("target", r"\?.*$", "")
    q = F.regexp_extract("target", r"\?(.*)$", 1)
    obj = F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "HH:mm:ss").alias("time"),
        F.col("client").alias("c-ip"), F.col("method").alias("cs-method"), path.alias("cs-uri-stem"),
        F.when(q == "", F.lit("-")).otherwise(q).alias("cs-uri-query"),
        F.col("status").cast("string").alias("sc-status"), F.col("bytes").cast("string").alias("sc-bytes"),
        F.lit("377").alias("cs-bytes"),
        F.when(F.col("agent") == "-", F.lit("-")).otherwise(F.regexp_replace("agent", " ", "%20")).alias("cs(User-Agent)"),
        F.col("referrer").alias("cs(Referer)"), country.alias("c-country"),
        F.col("page_host").alias("x-host-header"),
    )
    lines = req.select("event_id", F.to_json(obj).alias("value"))
    e = keep_events(to_events(parse_any(lines)))
    return e.select("event_id", "log_format", "source_address", ts_text(F.col("event_start")).alias("event_start"),
                    "http_method", "url_path", "url_query", "status_code", "response_bytes", "request_bytes",
                    "user_agent", "referrer", "url_domain", F.col("cdn_country").alias("geo_country"),
                    F.array_join("tags", ",").alias("tags"))


# ---- URL analytics over pages.url ---------------------------------------------

def _pages_urls(spark, sf):
    pg = _t(spark, sf, "pages").select("page_id", "url")
    pg = pg.select("page_id", "url", urls.url_parts(F.col("url")).alias("_p"))
    return pg.select("page_id", urls.url_fields(F.col("_p"), F.col("url")).alias("u"))


def q_url_split(spark, sf):
    u = _pages_urls(spark, sf)
    return u.select("page_id", F.col("u.scheme").alias("scheme"), F.col("u.address").alias("address"),
                    F.col("u.port").alias("port"), F.col("u.path").alias("path"),
                    F.col("u.query").alias("query"), F.col("u.fragment").alias("fragment"))


def q_url_path_parts(spark, sf):
    u = _pages_urls(spark, sf).select("page_id", urls.path_parts(F.col("u.path")).alias("p"))
    return u.select("page_id", F.coalesce(F.size("p"), F.lit(0)).alias("n_parts"),
                    F.array_join("p", "|").alias("path_parts"))


def q_url_path_depth(spark, sf):
    u = _pages_urls(spark, sf).select("page_id", urls.path_depth(urls.path_parts(F.col("u.path"))).alias("d"))
    return u.select("page_id", F.array_join("d", "|").alias("path_depth"))


def q_url_query_params(spark, sf):
    u = _pages_urls(spark, sf).select("page_id", urls.query_multimap(F.col("u.query")).alias("m"))
    return u.select("page_id", urls.render_multimap(F.col("m")).alias("query_params"))


def q_url_query_parts(spark, sf):
    u = _pages_urls(spark, sf).select("page_id", urls.query_parts(urls.query_multimap(F.col("u.query"))).alias("q"))
    return u.select("page_id", F.array_join("q", "|").alias("query_parts"))


def q_path_prefix_egress(spark, sf):
    return rollups.path_prefix_egress(combined_events(spark, sf)).select(
        "prefix", "depth", "bytes", F.col("requests").cast("bigint").alias("requests"))


# ---- enrichment ----------------------------------------------------------------

def q_registered_domain(spark, sf):
    pg = _t(spark, sf, "pages")
    hosts = pg.select(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:]+)", 1).alias("host"))
    return enrich.resolve_domains(hosts, D.public_suffix(spark))


def q_geo_range_join(spark, sf):
    e = combined_events(spark, sf)
    g = D.geo_from_customer(_t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "region"))
    out = enrich.geo_lookup(e, g)
    return out.select("event_id", "source_address", "geo_country", "geo_region", "geo_city", "geo_lat", "geo_lon")


def q_suffix_rule_kinds(spark, sf):
    pg = _t(spark, sf, "pages")
    hosts = pg.select(D.page_host(F.col("url")).alias("host"))
    return enrich.resolve_domains(hosts, D.suffix_rules_from_pages(spark, pg))


def q_geo_overlaps(spark, sf):
    e = combined_events(spark, sf).select("event_id", "source_address")
    k = F.pmod(F.col("event_id"), F.lit(9))
    e = e.withColumn("source_address", F.when(k == 0, F.lit(None).cast("string"))
                     .when(k == 1, F.concat(F.lit("2001:db8::"), F.pmod(F.col("event_id"), F.lit(1000)).cast("string")))
                     .otherwise(F.col("source_address")))
    out = enrich.geo_lookup(e, D.overlapping_geo(_t(spark, sf, "customer"), _t(spark, sf, "nation")))
    return out.select("event_id", "source_address", "geo_country", "geo_region", "geo_city")


def q_long_fields(spark, sf):
    """Host names, URLs and agents of 64 KB among ordinary lines."""
    ev, pg = _events_pages(spark, sf)
    k = F.pmod(F.col("event_id"), F.lit(1000))
    req = replay.event_requests(ev, pg)
    req = req.withColumns({
        "client": F.when(k == 0, F.concat(F.repeat(F.lit("a."), 32768), F.lit("example"))).otherwise(F.col("client")),
        "target": F.when(k == 1, F.repeat(F.lit("/%41b"), 13108)).otherwise(F.col("target")),
        "agent": F.when(k == 2, F.repeat(F.lit("agent (x) "), 6554)).otherwise(F.col("agent"))})
    e = to_events(parse_lines(req.select("event_id", replay.combined_line().alias("value"))))
    return e.select("event_id", "log_format", F.length("source_address").alias("address_length"), F.length("url_path").alias("path_length"),
                    F.length(F.rtrim("user_agent")).alias("agent_length"), "status_code")


def q_dns_left_join(spark, sf):
    e = combined_events(spark, sf)
    out = enrich.dns_lookup(e, D.dns_from_customer(_t(spark, sf, "customer")))
    return out.select("event_id", "source_address", "source_domain")


def q_agent_classify(spark, sf):
    e = combined_events(spark, sf)
    return e.select("event_id", "user_agent", R.robot_or_human(F.col("user_agent")).alias("robot_or_human"),
                    R.bot_human_unknown(F.col("user_agent")).alias("bot_human_unknown"))


def q_agent_parse(spark, sf):
    e = combined_events(spark, sf).select("event_id", "user_agent")
    out = enrich.parse_agents(e, D.agent_rules(spark))
    return out.select("event_id", "user_agent", "ua_name", "ua_version", "ua_os", "ua_device")


def q_agent_details(spark, sf):
    e = combined_events(spark, sf).select("event_id", "user_agent")
    out = enrich.parse_agents(e, D.agent_rules(spark))
    return out.select("event_id", "ua_os", "ua_os_version", "ua_device", "ua_device_brand", "ua_device_model")


# ---- rules ---------------------------------------------------------------------

def _part_text(spark, sf):
    part = _t(spark, sf, "part")
    return part.select("p_partkey", F.concat_ws("/", "p_type", "p_name", "p_brand").alias("text"))


def q_request_type_rules(spark, sf):
    t = _part_text(spark, sf)
    return t.select("p_partkey", R.classify_expr("text", D.PART_RULES, "other").alias("label"))


def q_bundle_then_mission(spark, sf):
    t = _part_text(spark, sf)
    b = R.classify_distinct(t, "text", D.bundle_rules(), "bundle", "other")
    m = R.classify_distinct(b, "bundle", D.mission_rules(), "mission", "other")
    return m.groupBy("mission", "bundle").agg(F.count(F.lit(1)).alias("parts"))


def q_large_rule_set(spark, sf):
    t = _part_text(spark, sf)
    return R.classify_distinct(t, "text", D.bundle_rules(LARGE_RULE_SET), "label", "other", indexed=True).select("p_partkey", "label")


def q_rule_lint(spark, sf):
    t = _part_text(spark, sf)
    b = R.classify_distinct(t, "text", D.bundle_rules(), "bundle", "other")
    return R.rule_lint(b, "bundle", D.mission_rules())


# ---- summary chain ---------------------------------------------------------------

def q_node_summary(spark, sf):
    s = sqlchain.node_summary(detail(spark, sf))
    return s.select(F.col("date").cast("string").alias("date"), "node", "http_method", "status", "user_type",
                    "request_type", "client_request", "user_agent", "client_ip", "bytes", "transactions")


def q_all_node_rollup(spark, sf):
    r = sqlchain.all_node_rollup(sqlchain.node_summary(detail(spark, sf)))
    return r.select(F.col("date").cast("string").alias("date"), "node", "client_ip", "request_type", "user_type",
                    "http_method", "status", "bytes", "summary_rows", "transactions")


def q_detail_view(spark, sf):
    v = sqlchain.detail_view(detail(spark, sf))
    return v.select(F.col("date").cast("string").alias("date"), "datetime", "node", "client_ip", "req_type",
                    "client_request", "status", "user_agent", "user_type", "bytes")


def q_search_terms(spark, sf):
    t = sqlchain.search_terms(detail(spark, sf))
    return t.select(F.col("date").cast("string").alias("date"), "query_text", "client_request", "client_ip",
                    "datetime", "status", "bytes", "referer", "user_agent")


def q_search_terms_daily(spark, sf):
    t = sqlchain.search_terms(detail(spark, sf))
    return sqlchain.search_terms_daily(t).select(F.col("date").cast("string").alias("date"), "query_text",
                                                 F.col("searches").cast("bigint").alias("searches"))


def q_top_search_terms(spark, sf):
    t = sqlchain.search_terms(detail(spark, sf))
    return sqlchain.top_search_terms(t, TOP_K).select("query_text", F.col("searches").cast("bigint").alias("searches"))


def q_mission_downloads(spark, sf):
    m = sqlchain.mission_downloads(detail(spark, sf), D.bundle_rules(), D.mission_rules(), MISSION_YEAR)
    return (m.groupBy("mission", "url_bundle", "user_type")
             .agg(F.count(F.lit(1)).alias("downloads"),
                  F.coalesce(F.sum(sqlchain.summary_bytes(F.col("size"))), F.lit(0)).cast("bigint").alias("bytes")))


# ---- egress report and metrics -----------------------------------------------------

def q_egress_total(spark, sf):
    w = rollups.trailing_window(enriched_events(spark, sf, windowed=True), AS_OF, WINDOW_HOURS)
    return rollups.egress_total(w).select("bytes", F.col("requests").cast("bigint").alias("requests"))


def q_top_domains(spark, sf):
    w = rollups.trailing_window(enriched_events(spark, sf, windowed=True), AS_OF, WINDOW_HOURS)
    return rollups.top_by_bytes(w, "source_registered_domain", TOP_K).select(
        "key", "bytes", F.col("requests").cast("bigint").alias("requests"))


def q_top_users(spark, sf):
    w = rollups.trailing_window(enriched_events(spark, sf, windowed=True), AS_OF, WINDOW_HOURS)
    return rollups.top_by_bytes(w, "source_domain", TOP_K).select(
        "key", "bytes", F.col("requests").cast("bigint").alias("requests"))


def q_egress_report(spark, sf):
    r = rollups.egress_report(enriched_events(spark, sf, windowed=True), AS_OF, WINDOW_HOURS, TOP_K)
    return r.select("section", F.col("rank").cast("int").alias("rank"), "key", "bytes",
                    F.col("requests").cast("bigint").alias("requests"), "gb")


def q_artifact_frequency(spark, sf):
    a = rollups.artifact_frequency(combined_events(spark, sf))
    return a.select("url_path", F.col("requests").cast("bigint").alias("requests"), "bytes",
                    ts_text(F.col("last_access")).alias("last_access"))


def q_requests_per_period(spark, sf):
    r = rollups.requests_per_period(combined_events(spark, sf), "day", "http_method")
    return r.select(ts_text(F.col("period")).alias("period"), "http_method",
                    F.col("requests").cast("bigint").alias("requests"), "bytes")


def q_domain_subset(spark, sf):
    d = rollups.domain_subset(enriched_events(spark, sf), list(SUBSET_TLDS))
    return d.select(F.col("source_top_level_domain").alias("tld"), F.col("source_registered_domain").alias("domain"),
                    F.col("requests").cast("bigint").alias("requests"), "bytes")


def q_egress_yoy(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_shipdate", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("b"))
    return rollups.yearly_yoy(li, "l_shipdate", "b")


# ---- store, dedupe, streaming --------------------------------------------------------

def q_dedupe_by_hash(spark, sf):
    ev, pg = _events_pages(spark, sf)
    first = replay.lines(ev, pg, "apache_combined")
    again = replay.lines(ev.where(F.col("event_type") == "click"), pg, "apache_combined")
    store = scratch_path(spark, "store")
    for batch in (first, again, first):      # a re-delivered subset, then a full replay
        sinks.write_store(keep_events(to_events(parse_lines(batch))), store)
    stored = spark.read.parquet(store)
    return rollups.count_by_month(stored).select("event_month", F.col("events").cast("bigint").alias("events"))


def q_stream_equals_batch(spark, sf):
    from ..streaming.ingest import start_ingest
    ev, pg = _events_pages(spark, sf)
    src = scratch_path(spark, "stream-src")
    replay.lines(ev, pg, "apache_combined").select("value").write.text(src)
    store = scratch_path(spark, "stream-store")
    q = start_ingest(spark, src, store, quarantine_path=scratch_path(spark, "stream-quarantine"),
                     checkpoint=scratch_path(spark, "stream-ckpt"), available_now=True)
    q.awaitTermination()
    streamed = rollups.count_by_month(spark.read.parquet(store)).withColumnRenamed("events", "stream_events")
    batch = rollups.count_by_month(sinks.dedupe_by_hash(transform(replay.lines(ev, pg, "apache_combined")))) \
        .withColumnRenamed("events", "batch_events")
    return streamed.join(batch, "event_month", "full").select(
        "event_month", F.col("stream_events").cast("bigint").alias("stream_events"),
        F.col("batch_events").cast("bigint").alias("batch_events"))


def q_stream_source_constants(spark, sf):
    """Compressed log files by source, read as a stream and as a batch, both with their source's constants."""
    from ..streaming.ingest import start_ingest
    ev, pg = _events_pages(spark, sf)
    nation = _t(spark, sf, "nation")
    src = scratch_path(spark, "source-files")
    req = replay.event_requests(ev, pg).withColumn("_nk", F.pmod(F.col("user_id"), F.lit(25)))
    n = nation.select("n_nationkey", D.nation_slug(F.col("n_name")).alias("org"))
    req = req.join(n, req["_nk"] == n["n_nationkey"], "left")
    kind = F.when(F.pmod(F.col("user_id"), F.lit(2)) == 0, F.lit("web")).otherwise(F.lit("ftp"))
    (req.select("org", kind.alias("kind"), replay.combined_line().alias("value"))
        .write.partitionBy("org", "kind").option("compression", "gzip").text(src))
    # the prefixes of the given sources, below the folder of these files
    root = re.sub(r"^[A-Za-z0-9+.\-]+:(?://[^/]*)?/", "", src).lstrip("/")
    below = F.regexp_replace(F.regexp_replace("prefix", "^", f"{root}/org="), "/web/$", "/kind=web/")
    sources = D.sources_from_nation(nation).withColumn("prefix", below)
    store = scratch_path(spark, "source-store")
    q = start_ingest(spark, src, store, checkpoint=scratch_path(spark, "source-ckpt"), available_now=True, sources=sources)
    q.awaitTermination()
    lines = read_lines(spark, src, glob="*.gz")

    def count(events, name):
        return events.groupBy(F.col("src_organization").alias("organization"), F.col("src_dataset").alias("dataset")).agg(
            F.count(F.lit(1)).alias(name))

    streamed = count(spark.read.parquet(store), "stream_events")
    batch = count(sinks.dedupe_by_hash(transform(lines, sources=sources)), "batch_events")
    same = streamed["organization"].eqNullSafe(batch["organization"]) & streamed["dataset"].eqNullSafe(batch["dataset"])
    return streamed.join(batch, same, "full").select(
        F.coalesce(streamed["organization"], batch["organization"]).alias("organization"),
        F.coalesce(streamed["dataset"], batch["dataset"]).alias("dataset"), "stream_events", "batch_events")


def q_error_details(spark, sf):
    e = keep_events(noisy_events(spark, sf))
    d = F.col("error_details")
    return e.where(d.isNotNull()).select("event_id", "error_type", d["timestamp"].alias("detail_timestamp"),
                                         d["message"].alias("detail_message"), d["pattern"].alias("detail_pattern"))


def q_quarantine_side_output(spark, sf):
    """Lines that the stream put aside against those of the batch, by message and error."""
    from ..streaming.ingest import start_ingest
    ev, pg = _events_pages(spark, sf)
    src, side = scratch_path(spark, "noisy-lines"), scratch_path(spark, "noisy-quarantine")
    replay.noisy_lines(ev, pg).select("value").write.text(src)
    q = start_ingest(spark, src, scratch_path(spark, "noisy-store"), quarantine_path=side, checkpoint=scratch_path(spark, "noisy-ckpt"))
    q.awaitTermination()

    def count(lines, name):
        part = F.regexp_extract("value", r"\| Message: (.*) \| Error: (.*)$", 1), F.regexp_extract("value", r"\| Error: (.*)$", 1)
        return lines.select(part[0].alias("message"), part[1].alias("error")).groupBy("message", "error").agg(F.count(F.lit(1)).alias(name))

    streamed = count(spark.read.option("recursiveFileLookup", "true").text(side), "stream_lines")
    batch = count(sinks.quarantine_lines(transform(read_lines(spark, src))), "batch_lines")
    return streamed.join(batch, ["message", "error"], "full")


def q_request_type_labels(spark, sf):
    """Requests made for every rule of every node, classified: all labels that can be reached occur."""
    ev = _t(spark, sf, "events").select("event_id")
    examples = [(node, i, len(rules), R.example_request(r)) for node, rules in R.REQUEST_TYPE_RULES.items() for i, r in enumerate(rules)]
    examples += [("en", 0, 1, "GET /any HTTP/1.1")]
    table = F.broadcast(spark.createDataFrame(examples, "node string, rule int, rules int, client_request string"))  # as many rows as rules
    nodes = F.explode(F.array(*[F.lit(n) for n in replay.NODES])).alias("asked")
    asked = ev.select("event_id", nodes)
    sizes = F.create_map(*[x for n in replay.NODES for x in (F.lit(n), F.lit(len(R.REQUEST_TYPE_RULES.get(n, [0]))))])
    asked = asked.withColumn("pick", F.pmod(F.col("event_id"), sizes[F.col("asked")]).cast("int"))
    j = asked.join(table, (asked["asked"] == table["node"]) & (asked["pick"] == table["rule"]))
    return (j.select("node", R.node_request_type("node", "client_request").alias("request_type"))
             .groupBy("node", "request_type").agg(F.count(F.lit(1)).alias("requests")))


def q_ordered_hour(spark, sf):
    """One day of the store laid out by time, and the summaries in their orders with places counted in them."""
    path = scratch_path(spark, "ordered-store")
    sinks.write_ordered_store(combined_events(spark, sf), path)
    day = spark.read.parquet(path).where(F.col("event_month").isin(*DAY_MONTHS) & (F.col("event_start") >= F.lit(DAY_START))
                                         & (F.col("event_start") < F.lit(DAY_START + dt.timedelta(days=1))))
    return (day.groupBy(F.date_format("event_start", "yyyy-MM-dd HH").alias("hour"), "http_method")
               .agg(F.count(F.lit(1)).alias("events"), F.sum("response_bytes").alias("bytes")))


def q_ordered_rollup(spark, sf):
    r = sqlchain.ordered_rollup(sqlchain.all_node_rollup(sqlchain.ordered_summary(sqlchain.node_summary(detail(spark, sf)))))
    return r.select("node", F.col("date").cast("string").alias("date"), "user_type", "request_type", "status", "http_method", "client_ip",
                    "bytes", "transactions")


def q_ordered_detail(spark, sf):
    v = sqlchain.ordered_detail(sqlchain.detail_view(detail(spark, sf)))
    return v.select(F.col("date").cast("string").alias("date"), "datetime", "node", "client_ip", "status", "bytes")


def q_kept_summaries(spark, sf):
    """The roll-up kept batch by batch, with a replay and a compaction between."""
    kept = KeptSummary(spark, scratch_path(spark, "kept-summary"))
    lines = sinks.materialize(detail(spark, sf).withColumn("_batch", F.pmod(F.xxhash64("client_ip", "client_request"), F.lit(3))), "detail", None)
    for batch in (0, 1, 1):
        kept.append(lines.where(F.col("_batch") == batch), batch)
    kept.compact(0)
    kept.append(lines.where(F.col("_batch") == 2), 2)
    kept.append(lines.where(F.col("_batch") == 0), 0)  # a replay of a batch that is final
    kept.compact(1)
    r = kept.rollup()
    return r.select(F.col("date").cast("string").alias("date"), "node", "client_ip", "request_type", "user_type",
                    "http_method", "status", "bytes", "summary_rows", "transactions")


def q_added_node(spark, sf):
    """A node's folder added to the table of all nodes, read back alone."""
    ev, pg = _events_pages(spark, sf)
    root = scratch_path(spark, "node-lines")
    req = replay.event_requests(ev, pg).select("node", replay.combined_line().alias("value"))
    late = F.col("node") == LATE_NODE
    req.where(~late).withColumn("folder", F.col("node")).select("folder", "value").write.partitionBy("folder").text(f"{root}/delivered")
    table = f"node_lines_{root.rsplit('-', 1)[1]}"
    create_node_table(spark, table, f"{root}/table", {n: f"{root}/delivered/folder={n}" for n in replay.NODES if n != LATE_NODE})
    req.where(late).select("node", "value").write.mode("append").partitionBy("node").text(f"{root}/table")
    recover_nodes(spark, table)
    e = keep_events(to_events(parse_lines(node_lines(spark, table, LATE_NODE))))
    return e.groupBy("node", "http_method", "status_code").agg(
        F.count(F.lit(1)).alias("events"), F.sum("response_bytes").alias("bytes"))


def q_two_writers(spark, sf):
    """Two writers with the same lines of several months, some with a bad date, at the same time; then a replay."""
    ev, pg = _events_pages(spark, sf)
    req = replay.event_requests(ev, pg)
    k = F.pmod(F.col("event_id"), F.lit(3)).cast("int")
    req = req.withColumn("ts", F.col("ts") + F.make_interval(months=k))
    line = replay.combined_line()
    bad = F.pmod(F.col("event_id"), F.lit(50)) == 7
    line = F.when(bad, F.regexp_replace(line, r"\[[0-9]{2}/[A-Za-z]{3}", "[31/Feb")).otherwise(line)
    batch = sinks.materialize(transform(req.select(line.alias("value"))), "two-writers")
    path = scratch_path(spark, "two-writers-store")
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda w: BucketStore(spark, path).append(batch, w, 0, stored=True), ("one", "two")))
    store = BucketStore(spark, path)
    store.append(batch, "one", 0, stored=True)      # a replay of a batch that counts
    store.append(batch, "three", 0, stored=True)    # a late writer finds every line there
    return store.read().groupBy("event_month").agg(F.count(F.lit(1)).alias("events"), F.sum("response_bytes").alias("bytes"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_combined_roundtrip": q_parse_combined_roundtrip,
    "parse_mixed_layouts": q_parse_mixed_layouts,
    "time_formats": q_time_formats,
    "route_counts": q_route_counts,
    "tag_counts": q_tag_counts,
    "outcome_by_status": q_outcome_by_status,
    "empty_agent_tags": q_empty_agent_tags,
    "quarantine_lines": q_quarantine_lines,
    "source_attach": q_source_attach,
    "cdn_json_parse": q_cdn_json_parse,
    "url_split": q_url_split,
    "url_path_parts": q_url_path_parts,
    "url_path_depth": q_url_path_depth,
    "url_query_params": q_url_query_params,
    "url_query_parts": q_url_query_parts,
    "path_prefix_egress": q_path_prefix_egress,
    "registered_domain": q_registered_domain,
    "geo_range_join": q_geo_range_join,
    "dns_left_join": q_dns_left_join,
    "agent_classify": q_agent_classify,
    "agent_parse": q_agent_parse,
    "request_type_rules": q_request_type_rules,
    "bundle_then_mission": q_bundle_then_mission,
    "rule_lint": q_rule_lint,
    "node_summary": q_node_summary,
    "all_node_rollup": q_all_node_rollup,
    "detail_view": q_detail_view,
    "search_terms": q_search_terms,
    "search_terms_daily": q_search_terms_daily,
    "top_search_terms": q_top_search_terms,
    "mission_downloads": q_mission_downloads,
    "egress_total": q_egress_total,
    "top_domains": q_top_domains,
    "top_users": q_top_users,
    "egress_report": q_egress_report,
    "artifact_frequency": q_artifact_frequency,
    "requests_per_period": q_requests_per_period,
    "domain_subset": q_domain_subset,
    "egress_yoy": q_egress_yoy,
    "dedupe_by_hash": q_dedupe_by_hash,
    "stream_equals_batch": q_stream_equals_batch,
    "kept_summaries": q_kept_summaries,
    "error_details": q_error_details,
    "quarantine_side_output": q_quarantine_side_output,
    "request_type_labels": q_request_type_labels,
    "ordered_hour": q_ordered_hour,
    "ordered_rollup": q_ordered_rollup,
    "ordered_detail": q_ordered_detail,
    "added_node": q_added_node,
    "two_writers": q_two_writers,
    "agent_details": q_agent_details,
    "large_rule_set": q_large_rule_set,
    "suffix_rule_kinds": q_suffix_rule_kinds,
    "geo_overlaps": q_geo_overlaps,
    "long_fields": q_long_fields,
    "stream_source_constants": q_stream_source_constants,
}
