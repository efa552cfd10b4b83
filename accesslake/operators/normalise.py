"""Typed event table from parsed captures: drops, defaults, tags, outcome.

``to_events`` takes the output of ``layouts.parse_lines`` (or of the CDN JSON
reader) and returns one row per input line with

* ``drop_reason`` – why the line is noise (F1–F5); null for kept lines;
* typed columns of the event schema (``schema.EVENT_COLUMNS``);
* ``tags`` – quality findings, de-duplicated in order (N14);
* ``route`` – first-match quality routing (K3).

Filtering on ``drop_reason`` is left to the caller (``keep_events``) so route
counts can report what was dropped and why.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import net, urls
from ..functions.time import parse_event_time, parse_ftp_time

# --- fixed values ---------------------------------------------------------
VALID_METHODS = ("GET", "POST", "PUT", "DELETE", "HEAD", "OPTIONS", "PATCH")
FTP_VERBS = (
    "ABOR", "ACCT", "ALLO", "APPE", "AUTH", "CDUP", "CWD", "DELE", "FEAT", "HELP",
    "LIST", "MODE", "MKD", "NLST", "NOOP", "OPTS", "PASS", "PASV", "PBSZ", "PORT",
    "PROT", "PWD", "QUIT", "REIN", "REST", "RETR", "RMD", "RNFR", "RNTO", "SITE",
    "SIZE", "STAT", "STOR", "STOU", "STRU", "SYST", "TYPE", "USER",
    "DATACHANNELOPENED", "DATACHANNELCLOSED", "CONTROLCHANNELOPENED",
    "CONTROLCHANNELCLOSED",
)
KNOWN_BAD_METHODS = ("SSTP_DUPLEX_POST", "SSTP_DUPLEX_GET")
FTP_RETRIEVAL = ("RETR", "BOTZETR")
LOOPBACK = ("::1", "127.0.0.1")
DUMMY_AGENT_TEXT = "internal dummy connection"
ESCAPED_CONTROL_RX = r"\\u00[0-9a-fA-F]{2}"
SUSPICIOUS_QUERY_KEYS = ("allow_url_include", "auto_prepend_file")

TAG_PARSE_FAILURE = "_grok_filter_initial_parse_failure"
TAG_JSON_FAILURE = "_cf_json_parse_failure"
TAG_DATETIME = "_datetimeparsefailure"
TAG_NO_SOURCE = "_missing_source_address"
TAG_BAD_METHOD = "_invalid_http_method"
TAG_NO_PATH = "_missing_url_path"
TAG_EMPTY_AGENT = "_empty_user_agent"
TAG_URL_SKIP = "_url_query_parse_skip"
TAG_SUSPICIOUS = "_suspicious_query"

# Quarantine list (K2): the sink's list plus the tag the parser really emits.
EXPECTED_DATE_PATTERN = "dd/MMM/yyyy:HH:mm:ss Z"  # fixed value, reported with bad dates
QUARANTINE_TAGS = (
    "bad_log", "_grok_parse_failure", TAG_PARSE_FAILURE, TAG_DATETIME,
    TAG_BAD_METHOD, "_template_variable", "_missing_url_original",
)

# Routing (K3): ordered (route, tags that select it); first match wins.
ROUTES = (
    ("corrupt", (TAG_DATETIME,)),
    ("parse_failure", ("_grokparsefailure", TAG_PARSE_FAILURE)),
    ("bad", ("_missing_url_original",)),
    ("invalid_method", (TAG_BAD_METHOD,)),
    ("template_error", ("_template_variable",)),
    ("empty_agent", (TAG_EMPTY_AGENT,)),
    ("duplicate_source", ("_duplicate_source_address",)),
)
DEFAULT_ROUTE = "processed"
# ---------------------------------------------------------------------------


def drop_comments(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``#`` header / comment lines never reach the parser."""
    return lines.filter(~F.col(value_col).startswith("#"))


def _barrier(df: DataFrame) -> DataFrame:
    """Re-emit every column through a one-row ``Generate``.

    Keeps each stage's generated code in its own method (the JVM caps one
    method at 64 KB) and stops the optimizer from inlining a stage's
    expressions into the next one or into pushed-down filters.
    """
    return df.selectExpr("inline(array(struct(*)))")


def _tag(cond: Column, tag: str) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(tag))


def route_of(tags: Column) -> Column:
    """K3: ordered routing by tags; first match wins."""
    expr = None
    for route, tag_set in ROUTES:
        cond = F.arrays_overlap(tags, F.array(*[F.lit(t) for t in tag_set]))
        expr = F.when(cond, F.lit(route)) if expr is None else expr.when(cond, F.lit(route))
    return expr.otherwise(F.lit(DEFAULT_ROUTE))


def is_quarantined(tags: Column | str) -> Column:
    """K2 predicate: the row carries one of the quarantine tags."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(F.arrays_overlap(tags, F.array(*[F.lit(t) for t in QUARANTINE_TAGS])), F.lit(False))


_DAY_PREFIX = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\s+"

# Internal columns of stage A that stage B consumes and drops.
_STAGE_A_INTERNAL = ("_ts_text", "_agent", "_layout_path", "_layout_query", "_layout_domain",
                     "_layout_scheme", "_ftp_action", "_ctl", "_url_parts")


@functools.lru_cache(maxsize=32)
def _stage_exprs(app_id: str, message_col: str, has_json: bool, has_src_domain: bool,
                 has_src_scheme: bool) -> tuple:
    """Column expressions of the three stages, built once per session.

    Building a Column is a JVM round-trip; the stages need ~1,000 of them, so
    they are built once and reused by every plan (they refer to columns by
    name only).
    """
    c = F.col
    msg = c(message_col)
    json_line = c("_json_line") if has_json else F.lit(False)

    # ---- stage A: time, method, status, URL split ----------------------------
    ts_text = F.replace(c("ts_text"), F.lit("\t"), F.lit(" "))
    whole_line = F.regexp_replace(F.regexp_replace(msg, _DAY_PREFIX, ""), r"\s+", " ")
    event_start = (F.when(c("ftp_month").isNotNull(),
                          parse_ftp_time(c("ftp_month"), c("ftp_day"), c("ftp_year"), c("ftp_time")))
                   .when(ts_text.isNotNull(), parse_event_time(ts_text))
                   .otherwise(F.try_to_timestamp(whole_line, F.lit("MMM d HH:mm:ss yyyy"))))
    method_up = F.upper(F.nullif(c("http_method"), F.lit("")))
    is_ftp_verb = F.coalesce(method_up.isin(*FTP_VERBS), F.lit(False))
    url_original = urls.decode(F.regexp_replace(c("url_original"), r"[^\x20-\x7E]", ""))
    stage_a = [
        msg.alias("message"), c("log_format"), json_line.alias("_json"),
        event_start.alias("event_start"),
        ts_text.alias("_ts_text"),
        F.when(~is_ftp_verb, method_up).alias("http_method"),
        F.coalesce(c("ftp_command"), F.when(is_ftp_verb, method_up)).alias("ftp_command"),
        F.when(c("status_text").isNotNull(),
               F.coalesce(c("status_text").try_cast("int"), F.lit(0))).alias("status_code"),
        F.coalesce(c("url_original").rlike(ESCAPED_CONTROL_RX), F.lit(False)).alias("_ctl"),
        url_original.alias("url_original"),
        F.when(c("url_original").isNotNull(), urls.url_parts(url_original)).alias("_url_parts"),
        F.nullif(c("source_address"), F.lit("")).alias("source_address"),
        F.nullif(c("user_ident"), F.lit("-")).alias("user_ident"),
        F.nullif(c("user_name"), F.lit("-")).alias("user_name"),
        c("http_version"),
        F.nullif(c("referrer"), F.lit("-")).alias("referrer"),
        c("user_agent").alias("_agent"),
        c("url_path").alias("_layout_path"),
        F.regexp_replace(F.nullif(c("url_query"), F.lit("-")), r"^\?", "").alias("_layout_query"),
        c("url_domain").alias("_layout_domain"),
        c("url_scheme").alias("_layout_scheme"),
        c("iis_substatus"),
        c("win32_status").alias("error_code"),
        c("bytes_text").try_cast("bigint").alias("response_bytes"),
        c("request_bytes_text").try_cast("bigint").alias("request_bytes"),
        c("duration_text").try_cast("double").alias("duration"),
        c("server_ip"), c("server_port"), c("server_site"), c("server_domain"),
        F.when(c("ftp_flag_1").isNotNull(),
               F.array(c("ftp_flag_1"), c("ftp_flag_2"), c("ftp_flag_3"), c("ftp_flag_4"))).alias("ftp_flags"),
        c("network_bytes_text").try_cast("bigint").alias("network_bytes"),
        c("network_protocol"),
        c("ftp_uid_text").try_cast("int").alias("user_id"),
        c("ftp_action").alias("_ftp_action"),
        c("body_content").alias("request_body"),
    ]

    # ---- stage B: URL pieces, drops, outcome, errors -------------------------
    url = urls.url_fields(c("_url_parts"), c("url_original"))
    lq = c("_layout_query")
    query = F.coalesce(url["query"], F.when(lq.contains("#"), F.substring_index(lq, "#", 1)).otherwise(lq))
    fragment = F.coalesce(url["fragment"], F.when(lq.contains("#"), F.substring_index(lq, "#", -1)))
    src_domain = c("src_url_domain") if has_src_domain else F.lit(None).cast("string")
    src_scheme = c("src_url_scheme") if has_src_scheme else F.lit(None).cast("string")
    # host header / URL host first, the source descriptor's domain as default
    domain = F.coalesce(c("_layout_domain"), url["address"], src_domain)
    domain = F.when(~net.is_ipv4(domain) & (domain != F.coalesce(c("source_address"), F.lit(""))), domain)
    method = c("http_method")
    bad_method = F.coalesce(method.isin(*KNOWN_BAD_METHODS) | ~method.isin(*VALID_METHODS), F.lit(False))
    retrieval = F.coalesce(c("ftp_command").isin(*FTP_RETRIEVAL), F.lit(False))
    status = c("status_code")
    date_fail = c("event_start").isNull()
    no_source = c("source_address").isNull()
    empty_agent = F.coalesce(c("_agent") == "-", F.lit(False))
    drop_reason = (
        F.when(c("message").startswith("#"), F.lit("comment"))
        .when(c("_ctl"), F.lit("escaped_control"))
        .when(F.coalesce(c("source_address").isin(*LOOPBACK), F.lit(False)), F.lit("loopback"))
        .when(F.coalesce(c("_agent").contains(DUMMY_AGENT_TEXT), F.lit(False)), F.lit("dummy_connection"))
        .when(bad_method, F.lit("invalid_method"))
        .when(c("ftp_command").isNotNull() & ~retrieval, F.lit("ftp_non_retrieval"))
    )
    outcome = (F.when(retrieval, F.when(F.coalesce(status < 400, F.lit(False)), F.lit("success"))
                      .otherwise(F.lit("failure")))
               .when(status.isNotNull(), F.when(status < 400, F.lit("success")).otherwise(F.lit("failure"))))
    error_type = (F.when(date_fail, F.lit("datetime_parse_error"))
                  .when(no_source, F.lit("missing_source_address"))
                  .when(status >= 400, F.lit("http_error")))
    error_message = (
        F.when(date_fail, F.concat(F.lit("Failed to parse datetime from "), F.coalesce(c("_ts_text"), F.lit("-"))))
        .when(no_source, F.lit("Missing source address in log message"))
        .when(status >= 400, F.concat(F.lit("HTTP "), status.cast("string"))))
    stage_b = [
        drop_reason.alias("drop_reason"),
        F.coalesce(url["path"], F.when(c("_layout_path") != "-", c("_layout_path"))).alias("url_path"),
        F.nullif(query, F.lit("")).alias("_query"),
        fragment.alias("url_fragment"),
        F.coalesce(c("_layout_scheme"), url["scheme"], src_scheme).alias("url_scheme"),
        url["username"].alias("url_username"),
        url["port"].alias("url_port"),
        domain.alias("url_domain"),
        F.when(empty_agent, F.lit("Unknown")).otherwise(c("_agent")).alias("user_agent"),
        F.coalesce(F.when(retrieval, c("ftp_command")), c("_ftp_action"), F.lit("access")).alias("event_action"),
        outcome.alias("event_outcome"),
        error_type.alias("error_type"),
        error_message.alias("error_message"),
        F.when(date_fail, F.struct(F.coalesce(c("_ts_text"), F.lit("-")).alias("timestamp"), c("message").alias("message"),
                                   F.lit(EXPECTED_DATE_PATTERN).alias("pattern"))).alias("error_details"),
        F.array(
            _tag(c("log_format").isNull() & ~c("_json"), TAG_PARSE_FAILURE),
            _tag(c("log_format").isNull() & c("_json"), TAG_JSON_FAILURE),
            _tag(date_fail, TAG_DATETIME),
            _tag(no_source, TAG_NO_SOURCE),
            _tag(bad_method, TAG_BAD_METHOD),
            _tag(c("_layout_path") == "-", TAG_NO_PATH),
            _tag(empty_agent, TAG_EMPTY_AGENT),
            _tag(c("_url_parts").isNotNull() & ~url["parsed"], TAG_URL_SKIP),
            _tag(functools.reduce(lambda x, y: x | y, [query.contains(k) for k in SUSPICIOUS_QUERY_KEYS]),
                 TAG_SUSPICIOUS),
        ).alias("_raw_tags"),
    ]

    # ---- stage C: query map, path arrays, tags, route, identity --------------
    stage_c1 = [
        F.array_distinct(F.filter(c("_raw_tags"), lambda t: t.isNotNull())).alias("tags"),
        urls.path_parts(c("url_path")).alias("url_path_parts"),
        # the pairs are cut before the text is decoded: an escaped "&" or "=" is no separator
        urls.decode(c("_query")).alias("url_query"),
        urls.query_multimap(c("_query")).alias("url_query_params"),
    ]
    stage_c2 = [
        urls.path_depth(c("url_path_parts")).alias("url_path_depth"),
        urls.query_parts(c("url_query_params")).alias("url_query_parts"),
        F.when(c("drop_reason").isNotNull(), F.lit("dropped")).otherwise(route_of(c("tags"))).alias("route"),
        F.sha2(c("message"), 256).alias("event_hash"),
        F.date_format(c("event_start"), "yyyy-MM").alias("event_month"),
    ]
    return stage_a, stage_b, stage_c1, stage_c2


def to_events(parsed: DataFrame, message_col: str = "value") -> DataFrame:
    """Typed, tagged, routed events from parse captures (one row per line).

    Columns other than the capture fields pass through unchanged (file path,
    node, source descriptor, replay ids …).
    """
    from .layouts import CAPTURE_FIELDS
    cols = parsed.columns
    passthrough = [x for x in cols if x not in CAPTURE_FIELDS and x not in ("log_format", message_col, "_json_line")]
    try:
        app_id = parsed.sparkSession.sparkContext.applicationId
    except Exception:  # sessions without a local SparkContext handle
        app_id = "session"
    stage_a, stage_b, stage_c1, stage_c2 = _stage_exprs(
        app_id, message_col, "_json_line" in cols,
        "src_url_domain" in cols, "src_url_scheme" in cols)
    a = _barrier(parsed.select(*passthrough, *stage_a))
    b = _barrier(a.select("*", *stage_b).drop(*_STAGE_A_INTERNAL))
    # Stage C stays an ordinary projection: columns a query does not use (query
    # maps, path arrays, hash) are pruned; filters stop at the stage-B barrier.
    cee = b.select("*", *stage_c1).drop("_raw_tags", "_json", "_query")
    return cee.select("*", *stage_c2)


def keep_events(events: DataFrame) -> DataFrame:
    """F1–F5 applied: rows whose ``drop_reason`` is null."""
    return events.filter(F.col("drop_reason").isNull())
