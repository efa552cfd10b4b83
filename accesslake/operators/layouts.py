"""Ordered multi-layout parsing of raw access-log lines (one regex pass).

All layouts are compiled into **one** Java regular expression of the form
``(?s)^(?:.*?(L1)|.*?(L2)|...).*$``.  Each branch carries its own lazy
``.*?`` prefix, so branch 1 is tried at every offset before branch 2 is tried
at all: that is the ordered, unanchored, first-match-wins semantics of the
classic multi-pattern log matchers.  ``regexp_replace`` rewrites a matching
line into its fields joined by ``\\x01`` and ``split`` turns that into an
array, so the regex runs once per line, inside the JVM, with whole-stage
codegen, however many fields are read afterwards.  Only groups of the branch
that matched hold text, so the groups of one field are written side by side:
the array has one element a field, not one a group.  A line that matches no
layout comes back unchanged (array of size 1).

Captured text stays text here; typing, defaults and tags are applied in
``operators.normalise``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p

SEP = "\u0001"

# Every text field a layout can fill.  Missing fields are null.
CAPTURE_FIELDS = (
    "ts_text", "source_address", "user_ident", "user_name", "http_method",
    "url_original", "url_path", "url_query", "http_version", "status_text",
    "bytes_text", "request_bytes_text", "duration_text", "referrer", "user_agent",
    "server_ip", "server_port", "server_site", "iis_substatus", "win32_status",
    "ftp_command", "network_bytes_text", "ftp_flag_1", "ftp_flag_2", "ftp_flag_3",
    "ftp_flag_4", "ftp_uid_text", "network_protocol", "server_domain", "ftp_action",
    "ftp_transfer_text", "url_domain", "url_scheme", "cdn_edge", "cdn_request_id",
    "cdn_result", "cdn_cookie", "body_content",
    "ftp_day_name", "ftp_month", "ftp_day", "ftp_time", "ftp_year",
)

S = "[ \\t]"  # CDN W3C separator: tab or space


def _c(field: str, rx: str) -> tuple[str, str]:
    return (field, rx)


@dataclass(frozen=True)
class Layout:
    name: str
    parts: tuple  # raw regex strings and (field, regex) captures, in order


def _combined_head(client: str) -> list:
    return [
        _c("source_address", client), " ",
        "(?:-|", _c("user_ident", p.HTTPDUSER), ") ",
        "(?:-|", _c("user_name", p.HTTPDUSER), ") ",
        r"\[", _c("ts_text", p.HTTPDATE), r"\] ",
        '"(?:', _c("http_method", p.WORD), " ", _c("url_original", p.NOTSPACE),
        "(?: HTTP/", _c("http_version", p.NUMBER), ")?|", p.DATA, ')" ',
        "(?:-|", _c("status_text", p.INT), ") ",
        "(?:-|", _c("bytes_text", p.INT), ")",
    ]


# Layout order is the matching order (first match wins).
LAYOUTS: tuple[Layout, ...] = (
    Layout("cdn_w3c", tuple([
        _c("ts_text", f"\\d{{4}}-{p.MONTHNUM2}-{p.MONTHDAY}{S}{p.TIME}"), S,
        _c("cdn_edge", p.NOTSPACE), S, _c("bytes_text", p.NUMBER), S,
        _c("source_address", p.IPORHOST), S, _c("http_method", p.WORD), S,
        p.HOSTNAME, S, _c("url_path", p.NOTSPACE), S, _c("status_text", p.NUMBER), S,
        _c("referrer", p.NOTSPACE), S, _c("user_agent", p.NOTSPACE), S,
        _c("url_query", p.NOTSPACE), S, _c("cdn_cookie", p.NOTSPACE), S,
        _c("cdn_result", p.NOTSPACE), S, _c("cdn_request_id", p.NOTSPACE), S,
        _c("url_domain", p.NOTSPACE), S, _c("url_scheme", p.NOTSPACE), S,
        _c("request_bytes_text", p.NUMBER), S, _c("duration_text", p.NUMBER),
    ])),
    Layout("apache_combined", tuple(_combined_head(p.IPORHOST) + [
        ' "(?:-|', _c("referrer", p.DATA), ')" "(?:-|', _c("user_agent", p.DATA), ')"',
    ])),
    Layout("apache_common", tuple(_combined_head(p.IPORHOST))),
    Layout("apache_minimal", (
        _c("source_address", p.IP), r" - - \[", _c("ts_text", p.HTTPDATE), r'\] "',
        _c("http_method", p.WORD), " ", _c("url_path", p.URIPATH), " HTTP/",
        _c("http_version", p.NUMBER), '"',
    )),
    Layout("iis_site", (
        _c("ts_text", p.TIMESTAMP_ISO8601), " ", _c("server_site", p.NOTSPACE), " ",
        _c("server_ip", p.IP), " ", _c("http_method", p.WORD), " ",
        _c("url_path", p.DATA), "(?:", _c("url_query", p.URIPARAM), ")? ",
        _c("server_port", p.NOTSPACE), " ", _c("user_name", p.NOTSPACE), " ",
        _c("source_address", p.IP), " ", _c("user_agent", p.DATA), " ",
        _c("status_text", p.NUMBER), " ", _c("iis_substatus", p.NUMBER), " ",
        _c("win32_status", p.NUMBER), " ", _c("bytes_text", p.NUMBER), " ",
        _c("request_bytes_text", p.NUMBER), " ", _c("duration_text", p.NUMBER),
    )),
    Layout("iis", (
        _c("ts_text", p.TIMESTAMP_ISO8601), " ", _c("server_ip", p.IP), " ",
        _c("http_method", p.WORD), " ", _c("url_path", p.DATA), " ",
        _c("url_query", p.NOTSPACE), " ", _c("server_port", p.NOTSPACE), " ",
        _c("user_name", p.NOTSPACE), " ", _c("source_address", p.IP), " ",
        _c("user_agent", p.DATA), " ", _c("status_text", p.NUMBER), " ",
        _c("iis_substatus", p.NUMBER), " ", _c("win32_status", p.NUMBER), " ",
        _c("bytes_text", p.NUMBER), " ", _c("request_bytes_text", p.NUMBER), " ",
        _c("duration_text", p.NUMBER),
    )),
    Layout("w3c_extended", (
        _c("ts_text", p.TIMESTAMP_ISO8601), " ", _c("server_site", p.WORD), " ",
        _c("server_ip", p.IP), " ", _c("http_method", p.WORD), " ",
        _c("url_path", p.NOTSPACE), " ", _c("url_query", p.NOTSPACE), " ",
        _c("server_port", p.NUMBER), " ", _c("user_name", p.NOTSPACE), " ",
        _c("source_address", p.IP), " ", _c("user_agent", p.DATA), " ",
        _c("status_text", p.NUMBER), " ", _c("iis_substatus", p.NUMBER), " ",
        _c("win32_status", p.NUMBER), " ", _c("bytes_text", p.NUMBER), " ",
        _c("duration_text", p.NUMBER),
    )),
    Layout("w3c_missing_uri", (
        _c("ts_text", p.TIMESTAMP_ISO8601), " ", _c("server_site", p.WORD), " ",
        _c("server_ip", p.IP), " ", _c("http_method", p.WORD), " ",
        _c("url_path", p.NOTSPACE), " ", _c("server_port", p.NUMBER), " ",
        _c("user_name", p.NOTSPACE), " ", _c("source_address", p.IP), " ",
        _c("user_agent", p.DATA), " ", _c("status_text", p.NUMBER), " ",
        _c("iis_substatus", p.NUMBER), " ", _c("win32_status", p.NUMBER), " ",
        _c("bytes_text", p.NUMBER), " ", _c("duration_text", p.NUMBER),
    )),
    Layout("iis_minimal", (
        _c("ts_text", p.TIMESTAMP_ISO8601), " ", _c("server_ip", p.IP), " ",
        _c("http_method", p.WORD), " ", _c("url_path", p.DATA), " ",
        _c("url_query", p.NOTSPACE), " ", _c("server_port", p.NOTSPACE), " ",
        _c("user_name", p.NOTSPACE), " ", _c("source_address", p.IP), " ",
        _c("user_agent", p.DATA), " ", _c("status_text", p.NUMBER), " ",
        _c("iis_substatus", p.NUMBER), " ", _c("win32_status", p.NUMBER),
    )),
    Layout("iis_ftp", (
        _c("ts_text", p.TIMESTAMP_ISO8601), " ", _c("source_address", p.IP), " ",
        _c("user_name", p.NOTSPACE), " ", _c("server_site", p.NOTSPACE), " ",
        _c("server_ip", p.IP), " ", _c("server_port", p.NUMBER), " ",
        _c("ftp_command", p.WORD), " ", _c("url_path", p.DATA), " ",
        _c("status_text", p.NUMBER), " ", _c("win32_status", p.NUMBER), " ",
        _c("bytes_text", p.NUMBER), " ", _c("request_bytes_text", p.NUMBER), " ",
        _c("duration_text", p.NUMBER),
    )),
    Layout("ftp_transfer", (
        _c("ftp_day_name", p.DAY), " ", _c("ftp_month", p.MONTH), r"\s+",
        _c("ftp_day", p.MONTHDAY), " ", _c("ftp_time", p.TIME), " ",
        _c("ftp_year", p.YEAR), " ", _c("ftp_transfer_text", p.NUMBER), " ",
        _c("source_address", p.IP), " ", _c("network_bytes_text", p.NUMBER), " ",
        _c("url_path", p.DATA), " ", _c("ftp_flag_1", p.WORD), " ",
        _c("ftp_flag_2", p.WORD), " ", _c("ftp_flag_3", p.WORD), " ",
        _c("ftp_flag_4", p.WORD), " ", _c("ftp_uid_text", p.NUMBER), " ",
        _c("network_protocol", p.WORD), " ", _c("status_text", p.NUMBER), " ",
        _c("server_domain", p.DATA), " ", _c("ftp_action", p.WORD),
    )),
    Layout("apache_host_client", (
        _c("source_address", p.HOSTNAME), r" - - \[", _c("ts_text", p.HTTPDATE), r'\] "',
        _c("http_method", p.WORD), " ", _c("url_original", p.DATA), " HTTP/",
        _c("http_version", p.NUMBER), '" ', _c("status_text", p.NUMBER), " ",
        _c("bytes_text", p.NUMBER),
    )),
    Layout("apache_odd_user", (
        _c("source_address", p.IP), " ", _c("user_ident", p.NOTSPACE), " ",
        _c("user_name", p.NOTSPACE), r" \[", _c("ts_text", p.HTTPDATE), r'\] "',
        _c("http_method", p.WORD), " ", _c("url_original", p.URIPATH),
        "(?: HTTP/", _c("http_version", p.NUMBER), ')?" ', _c("status_text", p.NUMBER),
        " ", _c("bytes_text", p.NUMBER), ' "', _c("referrer", p.DATA), '" "',
        _c("user_agent", p.DATA), '"',
    )),
    Layout("apache_any_path", (
        _c("source_address", p.IP), r" - - \[", _c("ts_text", p.HTTPDATE), r'\] "',
        _c("http_method", p.WORD), " ", _c("url_path", p.DATA), " HTTP/",
        _c("http_version", p.NUMBER), '" ', _c("status_text", p.NUMBER), " ",
        _c("bytes_text", p.NUMBER), ' "', _c("referrer", p.DATA), '" "',
        _c("user_agent", p.DATA), '"',
    )),
    Layout("apache_bad_user", (
        _c("source_address", p.IP), " - ", _c("user_name", p.DATA), r" \[",
        _c("ts_text", p.HTTPDATE), r'\] "', _c("http_method", p.WORD), " ",
        _c("body_content", p.URIPATHPARAM), " HTTP/", _c("http_version", p.NUMBER),
        '" ', _c("status_text", p.INT), " ", _c("bytes_text", p.INT), ' "',
        _c("referrer", p.DATA), '" "', _c("user_agent", p.DATA), '"',
    )),
)


def one_row_barrier(expr: Column) -> Column:
    """Evaluate ``expr`` exactly once per row, behind a plan barrier.

    ``explode`` of a one-element array is a ``Generate`` node: it yields the
    row once, and the optimizer can neither collapse later projections into
    it nor push a filter on its output below it.  Without it, a filter on any
    parsed field would be rewritten in terms of the raw line and re-run the
    whole regex (once per referenced field).
    """
    return F.explode(F.array(expr))


@dataclass(frozen=True)
class CompiledLayouts:
    regex: str
    replacement: str
    size: int             # elements of a matching line's array
    marker: dict          # layout name -> element that is filled when the layout matched
    fields: dict          # field -> its element, None when no layout captures it


def compile_layouts(layouts=LAYOUTS) -> CompiledLayouts:
    branches, marks, groups = [], [], {f: [] for f in CAPTURE_FIELDS}
    g = 0
    for lay in layouts:
        body, names = [], [part[0] for part in lay.parts if isinstance(part, tuple)]
        if len(names) != len(set(names)):
            raise ValueError(f"layout {lay.name} captures a field twice")
        for part in lay.parts:
            if isinstance(part, tuple):
                g += 1
                groups[part[0]].append(g)
                body.append(f"({part[1]})")
            else:
                body.append(part)
        # the mark of a branch is the last character that it matched
        g += 1
        marks.append(g)
        branches.append(".*?(?:" + "".join(body) + ")(?<=(.))")
    regex = "(?s)^(?:" + "|".join(branches) + ").*$"
    used = [f for f in CAPTURE_FIELDS if groups[f]]
    replacement = SEP.join([f"${i}" for i in marks] + ["".join(f"${i}" for i in groups[f]) for f in used])
    fields = {f: len(marks) + used.index(f) if f in used else None for f in CAPTURE_FIELDS}
    return CompiledLayouts(regex, replacement, len(marks) + len(used), {lay.name: i for i, lay in enumerate(layouts)}, fields)


COMPILED = compile_layouts()


def _field_sql(layouts: CompiledLayouts) -> list[str]:
    """SQL text of the field extraction (one py4j call for all fields)."""
    fmt = " ".join(f"WHEN __caps[{i}] <> '' THEN '{name}'" for name, i in layouts.marker.items())
    return [f"CASE {fmt} END AS log_format"] + [
        f"CAST(NULL AS STRING) AS {field}" if i is None else f"nullif(__caps[{i}], '') AS {field}" for field, i in layouts.fields.items()]


def parse_lines(df: DataFrame, value_col: str = "value", layouts: CompiledLayouts = COMPILED) -> DataFrame:
    """Add ``log_format`` and every capture field (text) to ``df``.

    ``log_format`` is null when no layout matched (the parse-failure case).
    """
    line = F.replace(F.col(value_col), F.lit(SEP), F.lit(""))
    parts = F.split(F.regexp_replace(line, layouts.regex, layouts.replacement), SEP)
    raw = df.select("*", one_row_barrier(parts).alias("__raw"))
    staged = raw.selectExpr("*", f"CASE WHEN size(__raw) = {layouts.size} THEN __raw END AS __caps")
    out = staged.selectExpr("*", *_field_sql(layouts)).drop("__raw", "__caps")
    # second barrier: field extraction keeps its own generated method (the
    # JVM caps one method at 64 KB; fused with the next stage it overflows)
    return barrier(out)


def barrier(df: DataFrame) -> DataFrame:
    """Re-emit every column through a one-row ``Generate`` (see ``one_row_barrier``)."""
    return df.selectExpr("inline(array(struct(*)))")
