"""The batch summary chain over the raw 9-field detail table (P17, A1–A3, …).

``detail_table`` scans raw lines into the STRING detail table
``client_ip, client_id, user_id, datetime, client_request, status, size,
referer, user_agent`` (+ ``node``).  On top of it:

* A1 ``node_summary``      – one ``groupBy`` over **all** nodes with each
  node's own request-type rules (no per-node scans, no union);
* A2 ``all_node_rollup``   – the 7-key roll-up of the summary;
* A3 ``detail_view``       – cleaned detail rows;
* R3/R4 ``search_terms``   – search text from keyword-search requests;
* R7 ``mission_downloads`` – two-stage rule classification of archive URLs.

Quoted fields are captured without their quotes; the bracketed time keeps its
``[`` prefix (the day parser expects it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions.time import bracket_day, bracket_day_text, first_year
from . import rules as R
from .layouts import one_row_barrier

DETAIL_COLUMNS = ("client_ip", "client_id", "user_id", "datetime", "client_request",
                  "status", "size", "referer", "user_agent")
_SEP = "\u0001"
_DETAIL_RX = (
    "(?s)^(" + p.IPORHOST + ") (.*?) (" + p.USERNAME + ") (.*) \"(" + p.QUOTED_BODY + ")\" (.*?) (.*?) "
    "\"(" + p.QUOTED_BODY + ")\" \"(" + p.QUOTED_BODY + ")\"$"
)

# --- fixed values ---------------------------------------------------------
SUMMARY_METHODS = ("GET", "HEAD", "POST", "PUT", "DELETE", "CONNECT", "OPTIONS", "TRACE", "PATCH")
SEARCH_RX = r"GET /datasearch/keyword-search/search.jsp\?q=([\w+\-%]+)"
SEARCH_LIKE = "%GET /datasearch/keyword-search/search.jsp?q=%"
ARCHIVE_ID_RX = r"(?i)urn.?(nasa|jaxa|isro|kari|psa|ros|vespa|esa).?(darts|isda|kpds|esa|rssa|epn|psa|pds).*"
SUCCESS_STATUS_RX = "^2.+$"
# ---------------------------------------------------------------------------


def detail_table(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw lines → STRING detail columns; non-matching lines are dropped
    (a schema-on-read table yields no row for them)."""
    parts = F.split(F.regexp_replace(F.translate(F.col(value_col), _SEP, ""), _DETAIL_RX,
                                     _SEP.join(f"${i}" for i in range(1, 10))), _SEP)
    staged = lines.select("*", one_row_barrier(parts).alias("__p")).where(F.size("__p") == 9)
    keep = [c for c in lines.columns if c != value_col]
    return staged.select(*keep, *[F.col("__p")[i].alias(n) for i, n in enumerate(DETAIL_COLUMNS)])


def summary_method(request: Column) -> Column:
    """First request token if it is one of nine verbs, else ``UNK``."""
    tok = F.split(request, " ")[0]
    return F.when(tok.isin(*SUMMARY_METHODS), tok).otherwise(F.lit("UNK"))


def summary_bytes(size: Column) -> Column:
    """Every ``-`` replaced by ``0``, then BIGINT (null when not numeric)."""
    return F.replace(size, F.lit("-"), F.lit("0")).try_cast("bigint")


def single_token(size: Column) -> Column:
    """F7."""
    return F.size(F.split(size, " ")) == 1


def node_summary(detail: DataFrame, rule_sets: dict | None = None) -> DataFrame:
    """A1: 9 keys → bytes, transactions, over all nodes in one aggregate."""
    d = detail.where(single_token(F.col("size")))
    keyed = d.select(
        bracket_day(F.col("datetime")).alias("date"),
        F.col("node"),
        summary_method(F.col("client_request")).alias("http_method"),
        F.col("status"),
        R.robot_or_human(F.col("user_agent")).alias("user_type"),
        R.node_request_type("node", "client_request", rule_sets).alias("request_type"),
        "client_request", "user_agent", "client_ip",
        summary_bytes(F.col("size")).alias("__bytes"),
    )
    keys = ["date", "node", "http_method", "status", "user_type", "request_type",
            "client_request", "user_agent", "client_ip"]
    return keyed.groupBy(*keys).agg(F.sum("__bytes").alias("bytes"),
                                    F.count("client_ip").alias("transactions"))


ROLLUP_NODES = ("atm", "geo", "img", "rings", "naif", "ppi", "sbn")  # fixed: ``en`` is not rolled up


def all_node_rollup(summary: DataFrame) -> DataFrame:
    """A2 + X1: 7-key roll-up; ``summary_rows`` keeps the count-of-rows meaning."""
    keys = ["date", "node", "client_ip", "request_type", "user_type", "http_method", "status"]
    return (summary.where(F.col("node").isin(*ROLLUP_NODES)).groupBy(*keys)
                   .agg(F.sum("bytes").alias("bytes"),
                        F.count("transactions").alias("summary_rows"),
                        F.sum("transactions").alias("transactions")))


def detail_view(detail: DataFrame) -> DataFrame:
    """A3: cleaned detail rows (no aggregate)."""
    return detail.where(single_token(F.col("size"))).select(
        bracket_day(F.col("datetime")).alias("date"), "datetime", "node", "client_ip",
        F.split(F.col("client_request"), " ")[0].alias("req_type"), "client_request", "status",
        "user_agent", R.robot_or_human(F.col("user_agent")).alias("user_type"),
        summary_bytes(F.col("size")).alias("bytes"),
    )


def search_terms(detail: DataFrame, node: str = "en") -> DataFrame:
    """Keyword-search requests with their search text."""
    d = detail.where((F.col("node") == node)
                     & F.col("client_request").like(SEARCH_LIKE)
                     & (F.split(F.col("datetime"), " ")[0] != "-"))
    q = F.regexp_extract(F.col("client_request"), SEARCH_RX, 1)
    return d.select(bracket_day(F.col("datetime")).alias("date"),
                    F.lower(F.regexp_replace(q, r"(\+|(%20))", " ")).alias("query_text"),
                    "client_request", "client_ip", "datetime", "status",
                    summary_bytes(F.col("size")).alias("bytes"), "referer", "user_agent")


def search_terms_daily(terms: DataFrame) -> DataFrame:
    """R3."""
    return terms.groupBy("date", "query_text").agg(F.count(F.lit(1)).alias("searches"))


def top_search_terms(terms: DataFrame, k: int = 20) -> DataFrame:
    """R4."""
    return (terms.groupBy("query_text").agg(F.count(F.lit(1)).alias("searches"))
                 .orderBy(F.col("searches").desc(), F.col("query_text").asc()).limit(k))


def mission_downloads(detail: DataFrame, bundle_rules: list, mission_rules: list, year: int,
                      url_filter: str = ARCHIVE_ID_RX) -> DataFrame:
    """Two-stage classification of downloads.

    Stage one labels each distinct request with a bundle, stage two each bundle
    with a mission; both run on one set of distinct requests, joined back once.
    """
    d = detail.where(F.col("client_request").rlike(url_filter)
                     & F.coalesce(F.col("status").rlike(SUCCESS_STATUS_RX), F.lit(False))
                     & (first_year(F.col("datetime")) == year))
    d = d.withColumn("date", bracket_day_text(F.col("datetime"))) \
         .withColumn("user_type", R.bot_human_unknown(F.col("user_agent")))
    return R.classify_chain(d, "client_request", [(bundle_rules, "url_bundle", "other"), (mission_rules, "mission", "other")])


def union_summaries(*summaries: DataFrame) -> DataFrame:
    """Per-node summary tables stacked by column name (when kept separately)."""
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    return out


def ordered_summary(summary: DataFrame) -> DataFrame:
    """O1: a summary read back in day order (sort at read time, not before writing)."""
    return summary.orderBy("date")


def ordered_rollup(rollup: DataFrame) -> DataFrame:
    """O3: the roll-up in node, date, user type, request type, status order."""
    return rollup.orderBy("node", "date", "user_type", "request_type", "status")


def ordered_detail(view: DataFrame) -> DataFrame:
    """O2: detail rows ordered by the parsed day expression."""
    return view.orderBy(bracket_day(F.col("datetime")))


def write_summary(summary: DataFrame, path: str) -> None:
    """K4 for the chain: the summary as a table partitioned by node."""
    summary.write.mode("overwrite").partitionBy("node").parquet(path)
