"""CDN JSON lines (S5 + P16): one JSON object per line → parse captures.

The JSON is read with an explicit schema (``from_json``; never inferred) and
mapped onto the same capture fields as the text layouts, so
``operators.normalise.to_events`` applies unchanged.  The host header
overrides the source's static domain; ``-`` means absent for query and
referrer; the agent is percent-decoded unless it is ``-``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import decode
from ..operators.layouts import CAPTURE_FIELDS

# --- fixed values: CDN JSON field names (all values are strings) ----------
CDN_JSON_FIELDS = (
    "timestamp", "timestamp(ms)", "date", "time", "c-ip", "cs-method", "cs-uri-stem",
    "cs-uri-query", "sc-status", "sc-bytes", "cs-bytes", "cs(User-Agent)", "cs(Referer)",
    "cs(Host)", "cs(Cookie)", "c-country", "x-host-header", "x-edge-location",
    "x-edge-result-type", "x-edge-request-id", "cs-protocol", "time-taken",
)
# ---------------------------------------------------------------------------
CDN_JSON_SCHEMA = "struct<" + ",".join(f"`{f}`:string" for f in CDN_JSON_FIELDS) + ">"


def parse_cdn_json(lines: DataFrame, value_col: str = "value", base: bool = False) -> DataFrame:
    """Capture-shaped rows (``log_format = 'cdn_json'``; null when the line is not JSON).

    With ``base=True`` the input already carries text-layout captures and only
    lines starting with ``{`` are replaced by their JSON mapping (one pass).
    """
    staged = lines.withColumn("__j", F.from_json(F.col(value_col), CDN_JSON_SCHEMA))

    def g(name: str):
        return F.col("__j").getField(name)

    agent = g("cs(User-Agent)")
    mapped = {
        "ts_text": F.when(g("date").isNotNull() & g("time").isNotNull(), F.concat_ws(" ", g("date"), g("time"))),
        "source_address": g("c-ip"),
        "http_method": g("cs-method"),
        "url_path": g("cs-uri-stem"),
        "url_query": F.when(g("cs-uri-query") != "-", g("cs-uri-query")),
        "status_text": g("sc-status"),
        "bytes_text": g("sc-bytes"),
        "request_bytes_text": g("cs-bytes"),
        "user_agent": F.when(agent == "-", agent).otherwise(decode(agent)),
        "referrer": F.when(g("cs(Referer)") != "-", g("cs(Referer)")),
        "url_domain": g("x-host-header"),
    }
    is_json = F.coalesce(F.col(value_col).startswith("{"), F.lit(False))
    ok = F.col("__j").isNotNull() & is_json
    if base:
        caps = [F.when(is_json, F.when(ok, mapped[f]) if f in mapped else F.lit(None).cast("string"))
                .otherwise(F.col(f)).alias(f) for f in CAPTURE_FIELDS]
        fmt = F.when(is_json, F.when(ok, F.lit("cdn_json"))).otherwise(F.col("log_format"))
        keep = [c for c in lines.columns if c not in CAPTURE_FIELDS and c != "log_format"]
        staged = staged.withColumn("__j", F.when(is_json, F.from_json(F.col(value_col), CDN_JSON_SCHEMA)))
    else:
        caps = [(F.when(ok, mapped[f]) if f in mapped else F.lit(None).cast("string")).alias(f) for f in CAPTURE_FIELDS]
        fmt = F.when(ok, F.lit("cdn_json"))
        keep = list(lines.columns)
    return staged.select(*keep, fmt.alias("log_format"), *caps,
                         F.when(ok, g("c-country")).alias("cdn_country"),
                         is_json.alias("_json_line"))
