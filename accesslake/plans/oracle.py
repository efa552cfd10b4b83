"""DuckDB oracle SQL for every registered query (same column names).

The oracle recomputes expected values straight from the shipped tables:
log lines are never generated and re-parsed here, so a parser bug cannot
hide behind a matching regex.  Rule sets are rendered to SQL ``CASE`` by a
small compiler of their own (``rules_sql``).
"""

from __future__ import annotations

import datetime as dt

from ..operators import rules as R
from ..operators import sqlchain
from ..sources import replay
from . import dims as D
from .catalog import AS_OF, DAY_START, LARGE_RULE_SET, LATE_NODE, MISSION_YEAR, SUBSET_TLDS, TOP_K, WINDOW_HOURS


def lit(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def case_map(expr: str, mapping: dict) -> str:
    body = " ".join(f"WHEN {lit(k)} THEN {lit(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    return f"CASE {expr} {body} END"


def pick(expr_idx: str, values) -> str:
    body = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values))
    return f"CASE {expr_idx} {body} END"


def cond_sql(c: R.Cond, v: str) -> str:
    if c.op == "regex":
        return f"regexp_matches({v}, {lit(c.pattern)})"
    if c.op == "like":
        return f"({v} LIKE {lit(c.pattern)})"
    if c.op == "ilike":
        return f"(lower({v}) LIKE {lit(c.pattern)})"
    if c.op == "contains":
        return f"(strpos({v}, {lit(c.pattern)}) > 0)"
    if c.op == "segment":
        return f"(string_split({v}, '/')[{int(c.arg)}] = {lit(c.pattern)})"
    if c.op == "segment_like":
        return f"(string_split({v}, '/')[{int(c.arg)}] LIKE {lit(c.pattern)})"
    raise ValueError(c.op)


def rules_sql(v: str, rules, default: str | None) -> str:
    whens = " ".join(
        "WHEN " + " AND ".join(f"coalesce({cond_sql(c, v)}, false)" for c in r.conds) + f" THEN {lit(r.label)}"
        for r in sorted(rules, key=lambda r: r.priority))
    return f"CASE {whens} ELSE {lit(default) if default is not None else 'NULL'} END"


# ---- shared CTEs -----------------------------------------------------------------
REQ = f"""
pg AS (
  SELECT page_id, url AS page_url,
         regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1) AS page_host,
         regexp_extract(url, '^([A-Za-z]+)://', 1) AS page_scheme,
         regexp_replace(regexp_replace(url, '^[A-Za-z]+://[^/?#]*', ''), '#.*$', '') AS target
  FROM pages),
req AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type,
         date_trunc('second', e.ts) AS ts_s,
         '10.' || CAST(e.user_id // 250 AS VARCHAR) || '.' || CAST(e.user_id % 250 AS VARCHAR) || '.'
               || CAST(e.event_id % 4 AS VARCHAR) AS client,
         {case_map('e.event_type', replay.METHOD_BY_TYPE)} AS method,
         {case_map('e.event_type', replay.STATUS_BY_TYPE)} AS status,
         CAST(round(e.value * 1000) AS BIGINT) AS bytes,
         coalesce(pg.target, '/') AS target,
         coalesce(pg.page_url, '-') AS page_url,
         coalesce(pg.page_host, '-') AS page_host,
         {pick('e.user_id % 6', replay.AGENTS)} AS agent,
         CASE WHEN e.user_id % 3 = 0 THEN '-' ELSE coalesce(pg.page_url, '-') END AS referrer,
         {pick('e.user_id % 8', replay.NODES)} AS node
  FROM events e LEFT JOIN pg ON pg.page_id = e.event_id % (SELECT count(*) FROM pages)),
rq AS (
  SELECT *, regexp_replace(target, '[?].*$', '') AS path,
         nullif(regexp_extract(target, '[?](.*)$', 1), '') AS query,
         CASE WHEN agent = '-' THEN NULL ELSE agent END AS agent_or_null,
         CASE WHEN referrer = '-' THEN NULL ELSE referrer END AS referrer_or_null,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text
  FROM req)
"""

DNS = f"""
dns AS (
  SELECT '10.' || CAST(c_custkey // 250 AS VARCHAR) || '.' || CAST(c_custkey % 250 AS VARCHAR) || '.'
               || CAST(c_custkey % 4 AS VARCHAR) AS address,
         'host-' || CAST(c_custkey AS VARCHAR) || '.' || lower(c_mktsegment) || '.example.'
               || {pick('c_nationkey % 3', D.DNS_TLDS)} AS name
  FROM customer),
sfx AS (SELECT unnest([{', '.join(lit(s) for s in D.PUBLIC_SUFFIXES)}]) AS suffix),
ev AS (
  SELECT rq.*, coalesce(dns.name, rq.client) AS source_domain
  FROM rq LEFT JOIN dns ON dns.address = rq.client),
dom AS (
  SELECT host, suffix FROM (
    SELECT h.host, s.suffix, row_number() OVER (PARTITION BY h.host ORDER BY length(s.suffix) DESC) AS rn
    FROM (SELECT DISTINCT lower(source_domain) AS host FROM ev) h
    JOIN sfx s ON h.host LIKE '%.' || s.suffix
    WHERE NOT regexp_matches(h.host, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$')) WHERE rn = 1),
evd AS (
  SELECT ev.*,
         regexp_extract(left(dom.host, length(dom.host) - length(dom.suffix) - 1), '([^.]+)$', 1) || '.' || dom.suffix
             AS source_registered_domain,
         dom.suffix AS source_top_level_domain
  FROM ev LEFT JOIN dom ON dom.host = lower(ev.source_domain))
"""

_WINDOW_START = AS_OF - dt.timedelta(hours=WINDOW_HOURS)
WINDOW = (f"ts_s BETWEEN TIMESTAMP '{_WINDOW_START:%Y-%m-%d %H:%M:%S}'"
          f" AND TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'")

NOISE = """
nz AS (SELECT *, event_id % 12 AS k FROM rq)
"""

DETAIL = f"""
np AS (SELECT count(*) AS n FROM part),
dt AS (
  SELECT rq.*, p.p_name,
         CASE WHEN node = 'en' THEN '{replay.SEARCH_PATH}?q=' || replace(coalesce(p.p_name, 'unknown'), ' ',
                                     CASE WHEN event_id % 2 = 0 THEN '+' ELSE '%20' END)
              WHEN event_type = 'purchase' THEN '/archive/urn:esa:psa:' || replace(coalesce(p.p_name, 'unknown'), ' ', '_') || '::1.0'
              ELSE target END AS target9,
         CASE WHEN event_type = 'error' THEN '-'
              WHEN event_type = 'signup' AND user_id % 5 = 0 THEN CAST(bytes AS VARCHAR) || ' ' || CAST(bytes AS VARCHAR)
              ELSE CAST(bytes AS VARCHAR) END AS size
  FROM rq LEFT JOIN part p ON p.p_partkey = rq.event_id % (SELECT n FROM np)),
det AS (
  SELECT event_id, ts, node, p_name, event_type, user_id,
         client AS client_ip,
         '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000]' AS datetime,
         method || ' ' || target9 || ' HTTP/1.1' AS client_request,
         CAST(status AS VARCHAR) AS status, size, referrer AS referer, agent AS user_agent,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS date
  FROM dt)
"""


def _robot(v: str) -> str:
    return f"CASE WHEN coalesce(regexp_matches({v}, {lit(R.ROBOT_AGENT_RX)}), false) THEN 'robot' ELSE 'human' END"


def _bot3(v: str) -> str:
    return (f"CASE WHEN coalesce(regexp_matches({v}, {lit(R.BOT_AGENT_RX)}), false) THEN 'bot' "
            f"WHEN coalesce(regexp_matches({v}, {lit(R.HUMAN_AGENT_RX)}), false) THEN 'human' ELSE 'unknown' END")


def _node_rules(node: str, v: str) -> str:
    whens = " ".join(f"WHEN {node} = {lit(n)} THEN {rules_sql(v, rs, R.REQUEST_TYPE_DEFAULT)}"
                     for n, rs in R.REQUEST_TYPE_RULES.items())
    return f"CASE {whens} ELSE {lit(R.REQUEST_TYPE_DEFAULT)} END"


def _summary() -> str:
    return f"""
summ AS (
  SELECT date, node,
         CASE WHEN split_part(client_request, ' ', 1) IN ({', '.join(lit(m) for m in sqlchain.SUMMARY_METHODS)})
              THEN split_part(client_request, ' ', 1) ELSE 'UNK' END AS http_method,
         status, {_robot('user_agent')} AS user_type,
         {_node_rules('node', 'client_request')} AS request_type,
         client_request, user_agent, client_ip,
         CAST(sum(TRY_CAST(replace(size, '-', '0') AS BIGINT)) AS BIGINT) AS bytes,
         CAST(count(client_ip) AS BIGINT) AS transactions
  FROM det WHERE len(string_split(size, ' ')) = 1
  GROUP BY ALL)
"""


_PART_TEXT = "part_text AS (SELECT p_partkey, concat_ws('/', p_type, p_name, p_brand) AS text FROM part)"

_PATH_PARTS = "list_filter(string_split({p}, '/'), lambda x: x <> '')"


def _url_cte() -> str:
    s = "'^[A-Za-z][A-Za-z0-9+.-]*://'"
    return f"""
u AS (
  SELECT page_id, url,
         nullif(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1), '') AS scheme,
         CASE WHEN regexp_matches(url, {s}) THEN nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1), '') END AS address,
         nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#:]*:([0-9]+)', 1), '') AS port,
         nullif(regexp_extract(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '^([^?#]*)', 1), '') AS path,
         nullif(regexp_extract(url, '[?]([^#]*)', 1), '') AS query,
         nullif(regexp_extract(url, '#(.*)$', 1), '') AS fragment
  FROM pages),
up AS (SELECT page_id, path, query, {_PATH_PARTS.format(p='path')} AS parts FROM u),
kv AS (
  SELECT page_id, pos, pair,
         regexp_replace(regexp_replace(regexp_replace(split_part(pair, '=', 1), '[.\\[\\]]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g') AS k,
         url_decode(substr(pair, strpos(pair, '=') + 1)) AS v
  FROM (SELECT page_id, unnest(string_split(query, '&')) AS pair,
               unnest(generate_series(1, len(string_split(query, '&')))) AS pos
        FROM up WHERE query IS NOT NULL)
  WHERE strpos(pair, '=') > 1),
kg AS (SELECT page_id, k, min(pos) AS first_pos, string_agg(v, ',' ORDER BY pos) AS vals FROM kv GROUP BY page_id, k)
"""


def _kept_noise_cols() -> str:
    # route / tags / agent / path of the kept noise variants (6..11)
    return """
kept AS (
  SELECT event_id, k, status, method, user_id, target, path, agent,
         CASE WHEN k = 7 THEN 'corrupt'
              WHEN k = 8 AND strpos(target, '?') > 0 THEN 'corrupt'
              WHEN k = 8 THEN 'empty_agent'
              WHEN k = 10 AND agent = '-' THEN 'empty_agent'
              ELSE 'processed' END AS route,
         CASE WHEN k = 7 THEN '_datetimeparsefailure'
              WHEN k = 8 AND strpos(target, '?') > 0 THEN '_grok_filter_initial_parse_failure,_datetimeparsefailure,_missing_source_address'
              WHEN k = 8 THEN '_empty_user_agent'
              WHEN k = 10 AND agent = '-' THEN '_missing_url_path,_empty_user_agent'
              WHEN k = 10 THEN '_missing_url_path'
              WHEN k = 11 THEN '_suspicious_query'
              ELSE '' END AS tags,
         CASE WHEN k = 8 AND strpos(target, '?') > 0 THEN NULL
              WHEN k = 8 THEN 'Unknown'
              WHEN k = 10 THEN CASE WHEN agent = '-' THEN 'Unknown' ELSE replace(agent, ' ', '+') END
              ELSE agent_or_null END AS user_agent,
         CASE WHEN k = 8 AND strpos(target, '?') > 0 THEN NULL
              WHEN k = 10 THEN NULL
              ELSE path END AS url_path,
         CASE WHEN k = 6 OR (k = 8 AND strpos(target, '?') > 0) THEN NULL ELSE status END AS status_code,
         CASE WHEN k = 6 THEN 'RETR' ELSE 'access' END AS event_action,
         strftime(ts, '%d/%b/%Y:%H:%M:%S') AS http_time
  FROM nz WHERE k >= 6)
"""


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["parse_combined_roundtrip"] = f"""
WITH {REQ}
SELECT event_id, client AS source_address, ts_text AS event_start, method AS http_method,
       nullif(path, '') AS url_path, query AS url_query, status AS status_code, bytes AS response_bytes,
       referrer_or_null AS referrer, agent_or_null AS user_agent,
       CASE WHEN status < 400 THEN 'success' ELSE 'failure' END AS event_outcome
FROM rq
"""

ORACLE_SQL["parse_mixed_layouts"] = f"""
WITH {REQ}
SELECT event_id,
       {pick('event_id % 5', replay.MIXED_ORDER)} AS log_format,
       client AS source_address, ts_text AS event_start,
       CASE WHEN event_id % 5 = 4 THEN NULL ELSE method END AS http_method,
       nullif(path, '') AS url_path,
       CASE WHEN event_id % 5 = 4 THEN NULL ELSE query END AS url_query,
       CASE WHEN event_id % 5 = 4 THEN 0 ELSE status END AS status_code,
       CASE WHEN event_id % 5 = 4 THEN NULL ELSE bytes END AS response_bytes,
       CASE WHEN event_id % 5 = 4 THEN bytes END AS network_bytes,
       CASE event_id % 5
         WHEN 0 THEN agent_or_null
         WHEN 1 THEN CASE WHEN agent = '-' THEN 'Unknown' ELSE replace(agent, ' ', '%20') END
         WHEN 3 THEN CASE WHEN agent = '-' THEN 'Unknown' ELSE replace(agent, ' ', '+') END
       END AS user_agent
FROM rq
"""

ORACLE_SQL["time_formats"] = f"""
WITH {REQ}
SELECT event_id,
       CASE event_id % 6 WHEN 0 THEN 'apache_common' WHEN 1 THEN 'apache_common' WHEN 2 THEN 'w3c_extended'
                         WHEN 3 THEN 'w3c_extended' WHEN 4 THEN 'ftp_transfer' ELSE 'apache_common' END AS log_format,
       CASE WHEN event_id % 6 = 5 THEN NULL ELSE ts_text END AS event_start,
       (event_id % 6 = 5) AS datetime_failure
FROM rq
"""

ORACLE_SQL["route_counts"] = f"""
WITH {REQ}, {NOISE.strip()}
SELECT route, drop_reason, CAST(count(*) AS BIGINT) AS events FROM (
  SELECT CASE WHEN k <= 5 THEN 'dropped'
              WHEN k = 7 THEN 'corrupt'
              WHEN k = 8 AND strpos(target, '?') > 0 THEN 'corrupt'
              WHEN k = 8 THEN 'empty_agent'
              WHEN k = 10 AND agent = '-' THEN 'empty_agent'
              ELSE 'processed' END AS route,
         CASE k WHEN 0 THEN 'comment' WHEN 1 THEN 'loopback' WHEN 2 THEN 'dummy_connection'
                WHEN 3 THEN 'escaped_control' WHEN 4 THEN 'invalid_method' WHEN 5 THEN 'ftp_non_retrieval' END AS drop_reason
  FROM nz)
GROUP BY route, drop_reason
"""

ORACLE_SQL["tag_counts"] = f"""
WITH {REQ}, {NOISE.strip()}, {_kept_noise_cols().strip()}
SELECT tag, CAST(count(*) AS BIGINT) AS events
FROM (SELECT unnest(string_split(tags, ',')) AS tag FROM kept WHERE tags <> '')
GROUP BY tag
"""

ORACLE_SQL["outcome_by_status"] = f"""
WITH {REQ}, {NOISE.strip()}, {_kept_noise_cols().strip()}
SELECT status_code, event_action,
       CASE WHEN k = 6 THEN 'failure' WHEN status_code IS NULL THEN NULL
            WHEN status_code < 400 THEN 'success' ELSE 'failure' END AS event_outcome,
       CASE WHEN k = 7 OR (k = 8 AND strpos(target, '?') > 0) THEN 'datetime_parse_error'
            WHEN status_code >= 400 THEN 'http_error' END AS error_type,
       CAST(count(*) AS BIGINT) AS events
FROM kept GROUP BY ALL
"""

ORACLE_SQL["empty_agent_tags"] = f"""
WITH {REQ}, {NOISE.strip()}, {_kept_noise_cols().strip()}
SELECT event_id, route, tags, user_agent, url_path FROM kept
"""

ORACLE_SQL["quarantine_lines"] = f"""
WITH {REQ}, {NOISE.strip()}, {_kept_noise_cols().strip()}
SELECT event_id, tags, 'datetime_parse_error' AS error_type,
       'Failed to parse datetime from ' || CASE WHEN k = 7 THEN '31/Feb' || substr(http_time, 7) || ' +0000' ELSE '-' END
           AS error_message
FROM kept WHERE k = 7 OR (k = 8 AND strpos(target, '?') > 0)
"""

ORACLE_SQL["source_attach"] = f"""
WITH {REQ},
n AS (SELECT n_nationkey, n_name, regexp_replace(lower(n_name), '[^a-z0-9]+', '_', 'g') AS slug FROM nation)
SELECT rq.event_id,
       's3://archive-logs/' || n.slug || '/' || CASE WHEN rq.user_id % 2 = 0 THEN 'web' ELSE 'ftp' END
           || '/access-' || CAST(rq.event_id % 7 AS VARCHAR) || '.log' AS file_path,
       CASE WHEN n.slug IS NULL THEN NULL WHEN rq.user_id % 2 = 0 THEN n.n_name || ' web' ELSE n.n_name END AS organization,
       CASE WHEN n.slug IS NULL THEN NULL WHEN rq.user_id % 2 = 0 THEN 'web.http' ELSE 'web.analytics' END AS dataset,
       CASE WHEN n.slug IS NULL THEN NULL WHEN rq.user_id % 2 = 0 THEN 'www.' || n.slug || '.example.org'
            ELSE n.slug || '.example.org' END AS url_domain
FROM rq LEFT JOIN n ON n.n_nationkey = rq.user_id % 25
"""

ORACLE_SQL["cdn_json_parse"] = f"""
WITH {REQ}
SELECT event_id, 'cdn_json' AS log_format, client AS source_address, ts_text AS event_start, method AS http_method,
       nullif(path, '') AS url_path, query AS url_query, status AS status_code, bytes AS response_bytes,
       CAST(377 AS BIGINT) AS request_bytes,
       CASE WHEN agent = '-' THEN 'Unknown' ELSE replace(agent, '+', ' ') END AS user_agent,
       referrer_or_null AS referrer, page_host AS url_domain,
       {pick('user_id % 4', D.CDN_COUNTRIES)} AS geo_country,
       CASE WHEN agent = '-' THEN '_empty_user_agent' ELSE '' END AS tags
FROM rq
"""

ORACLE_SQL["url_split"] = f"""
WITH {_url_cte().strip()}
SELECT page_id, scheme, address, port, path, query, fragment FROM u
"""

ORACLE_SQL["url_path_parts"] = f"""
WITH {_url_cte().strip()}
SELECT page_id, CAST(len(parts) AS INTEGER) AS n_parts,
       CASE WHEN len(parts) = 0 THEN NULL ELSE array_to_string(parts, '|') END AS path_parts
FROM up
"""

ORACLE_SQL["url_path_depth"] = f"""
WITH {_url_cte().strip()}
SELECT page_id,
       CASE WHEN len(parts) = 0 THEN NULL ELSE array_to_string(
         list_transform(generate_series(1, len(parts)), lambda i: '/' || array_to_string(parts[1:i], '/')), '|') END
         AS path_depth
FROM up
"""

ORACLE_SQL["url_query_params"] = f"""
WITH {_url_cte().strip()},
agg AS (SELECT page_id, string_agg(k || '=' || vals, '&' ORDER BY k || '=' || vals) AS query_params FROM kg GROUP BY page_id)
SELECT up.page_id, agg.query_params FROM up LEFT JOIN agg USING (page_id)
"""

ORACLE_SQL["url_query_parts"] = f"""
WITH {_url_cte().strip()},
flat AS (SELECT kv.page_id, kv.k, kv.v, kv.pos, kg.first_pos FROM kv JOIN kg USING (page_id, k)),
agg AS (SELECT page_id, string_agg(k || '=' || v, '|' ORDER BY first_pos, pos) AS query_parts FROM flat GROUP BY page_id)
SELECT up.page_id, agg.query_parts FROM up LEFT JOIN agg USING (page_id)
"""

ORACLE_SQL["path_prefix_egress"] = f"""
WITH {REQ},
pp AS (SELECT bytes, {_PATH_PARTS.format(p='path')} AS parts FROM rq),
ex AS (SELECT bytes, parts, unnest(generate_series(1, len(parts))) AS depth FROM pp WHERE len(parts) > 0)
SELECT '/' || array_to_string(parts[1:depth], '/') AS prefix, CAST(depth AS INTEGER) AS depth,
       CAST(sum(bytes) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS requests
FROM ex GROUP BY 1, 2
"""

ORACLE_SQL["registered_domain"] = f"""
WITH h AS (SELECT DISTINCT lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) AS host FROM pages),
sfx AS (SELECT unnest([{', '.join(lit(s) for s in D.PUBLIC_SUFFIXES)}]) AS suffix),
best AS (
  SELECT host, suffix FROM (
    SELECT h.host, s.suffix, row_number() OVER (PARTITION BY h.host ORDER BY length(s.suffix) DESC) AS rn
    FROM h JOIN sfx s ON h.host LIKE '%.' || s.suffix
    WHERE NOT regexp_matches(h.host, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$')) WHERE rn = 1),
parts AS (SELECT host, suffix, left(host, length(host) - length(suffix) - 1) AS head FROM best)
SELECT host,
       regexp_extract(head, '([^.]+)$', 1) || '.' || suffix AS registered_domain,
       suffix AS top_level_domain,
       regexp_extract(head, '([^.]+)$', 1) AS second_level_domain,
       nullif(regexp_replace(head, '[.]?[^.]+$', ''), '') AS sub_domain
FROM parts
"""

ORACLE_SQL["geo_range_join"] = f"""
WITH {REQ}
SELECT rq.event_id, rq.client AS source_address, n.n_name AS geo_country, r.r_name AS geo_region,
       CASE WHEN c.c_custkey IS NULL THEN NULL ELSE 'city-' || CAST(rq.user_id % 10 AS VARCHAR) END AS geo_city,
       CAST(n.n_nationkey * 3.5 - 40.0 AS DOUBLE) AS geo_lat, CAST(n.n_regionkey * 30.0 - 60.0 AS DOUBLE) AS geo_lon
FROM rq LEFT JOIN customer c ON c.c_custkey = rq.user_id
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
"""

ORACLE_SQL["dns_left_join"] = f"""
WITH {REQ}, {DNS.strip()}
SELECT event_id, client AS source_address, source_domain FROM ev
"""

ORACLE_SQL["agent_classify"] = f"""
WITH {REQ}
SELECT event_id, agent_or_null AS user_agent, {_robot('agent_or_null')} AS robot_or_human,
       {_bot3('agent_or_null')} AS bot_human_unknown
FROM rq
"""

ORACLE_SQL["agent_parse"] = f"""
WITH {REQ}
SELECT event_id, a AS user_agent,
  CASE WHEN a IS NULL THEN NULL
       WHEN regexp_matches(a, 'Googlebot/(\\d+)\\.(\\d+)') THEN 'Googlebot'
       WHEN regexp_matches(a, 'Firefox/(\\d+)\\.(\\d+)') THEN 'Firefox'
       WHEN regexp_matches(a, 'curl/(\\d+)\\.(\\d+)\\.(\\d+)') THEN 'curl'
       WHEN regexp_matches(a, 'python-requests/(\\d+)\\.(\\d+)') THEN 'Python Requests'
       WHEN regexp_matches(a, 'Version/(\\d+)\\.(\\d+).*Safari/') THEN 'Safari' ELSE 'Other' END AS ua_name,
  CASE WHEN a IS NULL THEN NULL
       WHEN regexp_matches(a, 'Googlebot/(\\d+)\\.(\\d+)') THEN regexp_extract(a, 'Googlebot/(\\d+)\\.(\\d+)', 1) || '.' || regexp_extract(a, 'Googlebot/(\\d+)\\.(\\d+)', 2)
       WHEN regexp_matches(a, 'Firefox/(\\d+)\\.(\\d+)') THEN regexp_extract(a, 'Firefox/(\\d+)\\.(\\d+)', 1) || '.' || regexp_extract(a, 'Firefox/(\\d+)\\.(\\d+)', 2)
       WHEN regexp_matches(a, 'curl/(\\d+)\\.(\\d+)\\.(\\d+)') THEN regexp_extract(a, 'curl/(\\d+\\.\\d+\\.\\d+)', 1)
       WHEN regexp_matches(a, 'python-requests/(\\d+)\\.(\\d+)') THEN regexp_extract(a, 'python-requests/(\\d+\\.\\d+)', 1)
       WHEN regexp_matches(a, 'Version/(\\d+)\\.(\\d+).*Safari/') THEN regexp_extract(a, 'Version/(\\d+\\.\\d+)', 1) END AS ua_version,
  CASE WHEN a IS NULL THEN NULL WHEN regexp_matches(a, 'Mac OS X (\\d+)_(\\d+)') THEN 'Mac OS X'
       WHEN regexp_matches(a, 'Linux') THEN 'Linux' ELSE 'Other' END AS ua_os,
  CASE WHEN a IS NULL THEN NULL WHEN regexp_matches(a, '(?i)bot|crawl|spider') THEN 'Spider'
       WHEN regexp_matches(a, 'Macintosh') THEN 'Mac' ELSE 'Other' END AS ua_device
FROM (SELECT event_id, agent_or_null AS a FROM rq)
"""

ORACLE_SQL["request_type_rules"] = f"""
WITH {_PART_TEXT}
SELECT p_partkey, {rules_sql('text', D.PART_RULES, 'other')} AS label FROM part_text
"""

_BUNDLES = f"""
{_PART_TEXT},
b AS (SELECT p_partkey, text, {rules_sql('text', D.bundle_rules(), 'other')} AS bundle FROM part_text),
m AS (SELECT *, {rules_sql('bundle', D.mission_rules(), 'other')} AS mission FROM b)
"""

ORACLE_SQL["bundle_then_mission"] = f"""
WITH {_BUNDLES.strip()}
SELECT mission, bundle, CAST(count(*) AS BIGINT) AS parts FROM m GROUP BY mission, bundle
"""


def _first_priority(v: str, rules) -> str:
    whens = " ".join("WHEN " + " AND ".join(f"coalesce({cond_sql(c, v)}, false)" for c in r.conds)
                     + f" THEN {r.priority}" for r in sorted(rules, key=lambda r: r.priority))
    return f"CASE {whens} END"


ORACLE_SQL["rule_lint"] = f"""
WITH {_BUNDLES.strip()},
f AS (SELECT bundle, {_first_priority('bundle', D.mission_rules())} AS first FROM b),
r AS (SELECT * FROM (VALUES {', '.join(f"({r.priority}, {lit(r.label)}, {lit(r.conds[0].pattern)})" for r in D.mission_rules())})
      t(priority, label, pattern)),
s AS (
  SELECT r.priority, r.label,
         CAST(sum(CASE WHEN f.first = r.priority THEN 1 ELSE 0 END) AS BIGINT) AS first_match_rows,
         CAST(sum(CASE WHEN regexp_matches(f.bundle, r.pattern) THEN 1 ELSE 0 END) AS BIGINT) AS any_match_rows
  FROM r CROSS JOIN f GROUP BY r.priority, r.label)
SELECT CAST(priority AS INTEGER) AS priority, label, first_match_rows, any_match_rows,
       (first_match_rows = 0 AND any_match_rows > 0) AS shadowed
FROM s
"""

ORACLE_SQL["node_summary"] = f"""
WITH {REQ}, {DETAIL.strip()}, {_summary().strip()}
SELECT * FROM summ
"""

ORACLE_SQL["all_node_rollup"] = f"""
WITH {REQ}, {DETAIL.strip()}, {_summary().strip()}
SELECT date, node, client_ip, request_type, user_type, http_method, status,
       CAST(sum(bytes) AS BIGINT) AS bytes, CAST(count(transactions) AS BIGINT) AS summary_rows,
       CAST(sum(transactions) AS BIGINT) AS transactions
FROM summ WHERE node IN ({', '.join(lit(n) for n in sqlchain.ROLLUP_NODES)})
GROUP BY ALL
"""

ORACLE_SQL["detail_view"] = f"""
WITH {REQ}, {DETAIL.strip()}
SELECT date, datetime, node, client_ip, split_part(client_request, ' ', 1) AS req_type, client_request, status,
       user_agent, {_robot('user_agent')} AS user_type, TRY_CAST(replace(size, '-', '0') AS BIGINT) AS bytes
FROM det WHERE len(string_split(size, ' ')) = 1
"""

_SEARCH = "node = 'en' AND method = 'GET'"

ORACLE_SQL["search_terms"] = f"""
WITH {REQ}, {DETAIL.strip()}
SELECT date, lower(coalesce(p_name, 'unknown')) AS query_text, client_request, client_ip, datetime, status,
       TRY_CAST(replace(size, '-', '0') AS BIGINT) AS bytes, referer, user_agent
FROM det JOIN (SELECT event_id, method FROM rq) USING (event_id)
WHERE {_SEARCH}
"""

ORACLE_SQL["search_terms_daily"] = f"""
WITH {REQ}, {DETAIL.strip()}
SELECT date, lower(coalesce(p_name, 'unknown')) AS query_text, CAST(count(*) AS BIGINT) AS searches
FROM det JOIN (SELECT event_id, method FROM rq) USING (event_id)
WHERE {_SEARCH}
GROUP BY ALL
"""

ORACLE_SQL["top_search_terms"] = f"""
WITH {REQ}, {DETAIL.strip()}
SELECT lower(coalesce(p_name, 'unknown')) AS query_text, CAST(count(*) AS BIGINT) AS searches
FROM det JOIN (SELECT event_id, method FROM rq) USING (event_id)
WHERE {_SEARCH}
GROUP BY 1 ORDER BY searches DESC, query_text ASC LIMIT {TOP_K}
"""

ORACLE_SQL["mission_downloads"] = f"""
WITH {REQ}, {DETAIL.strip()},
md AS (
  SELECT *, {rules_sql('client_request', D.bundle_rules(), 'other')} AS url_bundle, {_bot3('user_agent')} AS user_type
  FROM det
  WHERE event_type = 'purchase' AND node <> 'en' AND year(ts) = {MISSION_YEAR})
SELECT {rules_sql('url_bundle', D.mission_rules(), 'other')} AS mission, url_bundle, user_type,
       CAST(count(*) AS BIGINT) AS downloads, CAST(sum(TRY_CAST(size AS BIGINT)) AS BIGINT) AS bytes
FROM md GROUP BY ALL
"""

_EGRESS = f"WITH {REQ}, {DNS.strip()}"

ORACLE_SQL["egress_total"] = f"""
{_EGRESS}
SELECT CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS requests
FROM evd WHERE {WINDOW}
"""

ORACLE_SQL["top_domains"] = f"""
{_EGRESS}
SELECT source_registered_domain AS key, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS requests
FROM evd WHERE {WINDOW} AND source_registered_domain IS NOT NULL
GROUP BY 1 ORDER BY bytes DESC, key ASC LIMIT {TOP_K}
"""

ORACLE_SQL["top_users"] = f"""
{_EGRESS}
SELECT source_domain AS key, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS requests
FROM evd WHERE {WINDOW} AND source_domain IS NOT NULL
GROUP BY 1 ORDER BY bytes DESC, key ASC LIMIT {TOP_K}
"""

ORACLE_SQL["egress_report"] = f"""
{_EGRESS},
w AS (SELECT * FROM evd WHERE {WINDOW}),
tot AS (SELECT 'total' AS section, 1 AS rank, CAST(NULL AS VARCHAR) AS key,
               CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS requests FROM w),
d AS (SELECT source_registered_domain AS key, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS requests
      FROM w WHERE source_registered_domain IS NOT NULL GROUP BY 1 ORDER BY bytes DESC, key ASC LIMIT {TOP_K}),
u AS (SELECT source_domain AS key, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS requests
      FROM w WHERE source_domain IS NOT NULL GROUP BY 1 ORDER BY bytes DESC, key ASC LIMIT {TOP_K}),
allr AS (
  SELECT section, rank, key, bytes, requests FROM tot
  UNION ALL SELECT 'domain', row_number() OVER (ORDER BY bytes DESC, key ASC), key, bytes, requests FROM d
  UNION ALL SELECT 'user', row_number() OVER (ORDER BY bytes DESC, key ASC), key, bytes, requests FROM u)
SELECT section, CAST(rank AS INTEGER) AS rank, key, bytes, requests, round(bytes / 1e9, 2) AS gb FROM allr
"""

ORACLE_SQL["artifact_frequency"] = f"""
WITH {REQ}
SELECT nullif(path, '') AS url_path, CAST(count(*) AS BIGINT) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes,
       max(ts_text) AS last_access
FROM rq WHERE nullif(path, '') IS NOT NULL GROUP BY 1
"""

ORACLE_SQL["requests_per_period"] = f"""
WITH {REQ}
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS period, method AS http_method,
       CAST(count(*) AS BIGINT) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes
FROM rq GROUP BY 1, 2
"""

ORACLE_SQL["domain_subset"] = f"""
{_EGRESS}
SELECT source_top_level_domain AS tld, source_registered_domain AS domain,
       CAST(count(*) AS BIGINT) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes
FROM evd WHERE source_top_level_domain IN ({', '.join(lit(t) for t in SUBSET_TLDS)})
GROUP BY 1, 2
"""

ORACLE_SQL["egress_yoy"] = """
WITH y AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
                  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS bytes
           FROM lineitem GROUP BY 1)
SELECT year, bytes, lag(bytes) OVER (ORDER BY year) AS prev_bytes, bytes - lag(bytes) OVER (ORDER BY year) AS delta_bytes
FROM y
"""

_DISTINCT_LINES = f"""
WITH {REQ},
lines AS (SELECT DISTINCT strftime(ts, '%Y-%m') AS event_month, client, ts_s, method, target, status, bytes, referrer, agent
          FROM rq)
"""

ORACLE_SQL["dedupe_by_hash"] = f"""
{_DISTINCT_LINES.strip()}
SELECT event_month, CAST(count(*) AS BIGINT) AS events FROM lines GROUP BY 1
"""

ORACLE_SQL["stream_equals_batch"] = f"""
{_DISTINCT_LINES.strip()}
SELECT event_month, CAST(count(*) AS BIGINT) AS stream_events, CAST(count(*) AS BIGINT) AS batch_events
FROM lines GROUP BY 1
"""

ORACLE_SQL["suffix_rule_kinds"] = f"""
WITH h AS (SELECT DISTINCT lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) AS host FROM pages),
p AS (SELECT host, string_split(host, '.') AS parts, len(string_split(host, '.')) AS n FROM h),
s AS (
  SELECT host, parts, n,
         CASE WHEN host LIKE '%.com' THEN n
              WHEN host LIKE '%.example.net' THEN n - 2
              WHEN host LIKE '%.{D.EXCEPTED_DOMAIN}' AND length(parts[n - 2]) % 2 = 0 THEN n - 1
              WHEN host LIKE '%.{D.EXCEPTED_DOMAIN}' THEN n - 2
              WHEN host LIKE '%.org' THEN n END AS start
  FROM p)
SELECT host, array_to_string(parts[start - 1:], '.') AS registered_domain, array_to_string(parts[start:], '.') AS top_level_domain,
       parts[start - 1] AS second_level_domain,
       CASE WHEN start > 2 THEN array_to_string(parts[1:start - 2], '.') END AS sub_domain
FROM s WHERE start > 1
"""

ORACLE_SQL["geo_overlaps"] = f"""
WITH {REQ},
c AS (SELECT c_custkey AS k, n_name, 167772160 + (c_custkey // 250) * 65536 + (c_custkey % 250) * 256 AS base
      FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey),
r AS (
  SELECT base AS a, base + 255 AS b, n_name, 'net' AS kind, k FROM c WHERE k % 3 <> 0
  UNION ALL SELECT base, base + 1, n_name, 'half', k FROM c WHERE k % 5 = 0
  UNION ALL SELECT base + 2, base + 258, n_name, 'over', k FROM c WHERE k % 7 = 0
  UNION ALL SELECT base, base + 65535, n_name, 'block', k FROM c WHERE k % 250 = 0 AND (k // 250) % 2 = 1),
e AS (
  SELECT event_id, CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '2001:db8::' || CAST(event_id % 1000 AS VARCHAR) ELSE client END AS source_address,
         CASE WHEN event_id % 9 > 1 THEN 167772160 + (user_id // 250) * 65536 + (user_id % 250) * 256 + event_id % 4 END AS ip
  FROM rq),
ips AS (SELECT DISTINCT ip FROM e WHERE ip IS NOT NULL),
best AS (
  SELECT ip, n_name, kind, k FROM ips JOIN r ON ip >= a AND ip <= b
  QUALIFY row_number() OVER (PARTITION BY ip ORDER BY b - a, a, n_name, kind) = 1)
SELECT event_id, source_address, n_name AS geo_country, kind AS geo_region, 'city-' || CAST(k AS VARCHAR) AS geo_city
FROM e LEFT JOIN best USING (ip)
"""

ORACLE_SQL["long_fields"] = f"""
WITH {REQ}
SELECT event_id, 'apache_combined' AS log_format,
       CAST(CASE WHEN event_id % 1000 = 0 THEN 65543 ELSE length(client) END AS INTEGER) AS address_length,
       CAST(CASE WHEN event_id % 1000 = 1 THEN 39324 ELSE length(nullif(path, '')) END AS INTEGER) AS path_length,
       CAST(CASE WHEN event_id % 1000 = 2 THEN 65539 ELSE length(agent_or_null) END AS INTEGER) AS agent_length,
       status AS status_code
FROM rq
"""

ORACLE_SQL["stream_source_constants"] = f"""
WITH {REQ},
lines AS (SELECT DISTINCT user_id, client, ts_s, method, target, status, bytes, referrer, agent FROM rq),
n AS (SELECT n_nationkey, n_name FROM nation)
SELECT CASE WHEN user_id % 2 = 0 THEN n_name || ' web' ELSE n_name END AS organization,
       CASE WHEN n_name IS NULL THEN NULL WHEN user_id % 2 = 0 THEN 'web.http' ELSE 'web.analytics' END AS dataset,
       CAST(count(*) AS BIGINT) AS stream_events, CAST(count(*) AS BIGINT) AS batch_events
FROM lines LEFT JOIN n ON n_nationkey = user_id % 25 GROUP BY 1, 2
"""

ORACLE_SQL["agent_details"] = f"""
WITH {REQ}
SELECT event_id,
  CASE WHEN a IS NULL THEN NULL WHEN a LIKE '%Mac OS X 14_1%' THEN 'Mac OS X' WHEN a LIKE '%Linux%' THEN 'Linux' ELSE 'Other' END AS ua_os,
  CASE WHEN regexp_matches(a, 'Mac OS X (\\d+)_(\\d+)') THEN regexp_extract(a, 'Mac OS X (\\d+)_', 1) || '.' || regexp_extract(a, 'Mac OS X \\d+_(\\d+)', 1) END AS ua_os_version,
  CASE WHEN a IS NULL THEN NULL WHEN lower(a) LIKE '%bot%' THEN 'Spider' WHEN a LIKE '%Macintosh%' THEN 'Mac' ELSE 'Other' END AS ua_device,
  CASE WHEN lower(a) LIKE '%bot%' THEN 'Spider' WHEN a LIKE '%Macintosh%' THEN 'Apple' END AS ua_device_brand,
  CASE WHEN lower(a) LIKE '%bot%' THEN 'Desktop' WHEN a LIKE '%Macintosh%' THEN 'Mac' END AS ua_device_model
FROM (SELECT event_id, agent_or_null AS a FROM rq)
"""

ORACLE_SQL["large_rule_set"] = f"""
WITH {_PART_TEXT}
SELECT p_partkey, {rules_sql('text', D.bundle_rules(LARGE_RULE_SET), 'other')} AS label FROM part_text
"""

ORACLE_SQL["added_node"] = f"""
WITH {REQ}
SELECT node, method AS http_method, status AS status_code, CAST(count(*) AS BIGINT) AS events, CAST(sum(bytes) AS BIGINT) AS bytes
FROM rq WHERE node = {lit(LATE_NODE)} GROUP BY ALL
"""

ORACLE_SQL["two_writers"] = f"""
WITH {REQ},
lines AS (
  SELECT DISTINCT CASE WHEN event_id % 50 = 7 THEN NULL ELSE strftime(ts + to_months(CAST(event_id % 3 AS INTEGER)), '%Y-%m') END AS event_month,
         CASE WHEN event_id % 50 = 7 THEN strftime(ts + to_months(CAST(event_id % 3 AS INTEGER)), '%Y:%H:%M:%S')
              ELSE strftime(ts + to_months(CAST(event_id % 3 AS INTEGER)), '%Y-%m-%d %H:%M:%S') END AS stamp,
         client, method, target, status, bytes, referrer, agent FROM rq)
SELECT event_month, CAST(count(*) AS BIGINT) AS events, CAST(sum(bytes) AS BIGINT) AS bytes FROM lines GROUP BY 1
"""

_NOISY_LINE = """
       CASE k WHEN 7 THEN client || ' - - [31/Feb' || substr(http_time, 7) ELSE client || ' ? - [' || http_time END
       || ' +0000] "' || method || ' ' || target || ' HTTP/1.1" ' || CAST(status AS VARCHAR) || ' ' || CAST(bytes AS VARCHAR)
       || ' "' || referrer || '" "' || CASE k WHEN 7 THEN agent ELSE '-' END || '"'"""
_NOISY_BAD = """
bad AS (SELECT *, strftime(ts, '%d/%b/%Y:%H:%M:%S') AS http_time FROM nz WHERE k = 7 OR (k = 8 AND strpos(target, '?') > 0))"""

ORACLE_SQL["error_details"] = f"""
WITH {REQ}, {NOISE.strip()}, {_NOISY_BAD}
SELECT event_id, 'datetime_parse_error' AS error_type,
       CASE WHEN k = 7 THEN '31/Feb' || substr(http_time, 7) || ' +0000' ELSE '-' END AS detail_timestamp,
       {_NOISY_LINE} AS detail_message, 'dd/MMM/yyyy:HH:mm:ss Z' AS detail_pattern
FROM bad
"""

ORACLE_SQL["quarantine_side_output"] = f"""
WITH {REQ}, {NOISE.strip()}, {_NOISY_BAD}
SELECT {_NOISY_LINE} AS message,
       'Failed to parse datetime from ' || CASE WHEN k = 7 THEN '31/Feb' || substr(http_time, 7) || ' +0000' ELSE '-' END AS error,
       CAST(count(*) AS BIGINT) AS stream_lines, CAST(count(*) AS BIGINT) AS batch_lines
FROM bad GROUP BY ALL
"""

_EXAMPLES = ", ".join(f"({lit(n)}, {i}, {len(rules)}, {lit(R.example_request(r))})" for n, rules in [*R.REQUEST_TYPE_RULES.items()]
                      for i, r in enumerate(rules))
ORACLE_SQL["request_type_labels"] = f"""
WITH x AS (SELECT * FROM (VALUES {_EXAMPLES}, ('en', 0, 1, 'GET /any HTTP/1.1')) t(node, rule, rules, client_request))
SELECT node, {_node_rules('node', 'client_request')} AS request_type, CAST(count(*) AS BIGINT) AS requests
FROM events JOIN x ON events.event_id % x.rules = x.rule GROUP BY ALL
"""

ORACLE_SQL["ordered_hour"] = f"""
WITH {REQ}
SELECT strftime(ts_s, '%Y-%m-%d %H') AS hour, method AS http_method, CAST(count(*) AS BIGINT) AS events, CAST(sum(bytes) AS BIGINT) AS bytes
FROM rq WHERE CAST(ts_s AS DATE) = DATE '{DAY_START:%Y-%m-%d}' GROUP BY ALL
"""

ORACLE_SQL["ordered_rollup"] = f"""
WITH {REQ}, {DETAIL.strip()}, {_summary().strip()}
SELECT node, date, user_type, request_type, status, http_method, client_ip, CAST(sum(bytes) AS BIGINT) AS bytes,
       CAST(sum(transactions) AS BIGINT) AS transactions
FROM summ WHERE node IN ({', '.join(lit(n) for n in sqlchain.ROLLUP_NODES)})
GROUP BY ALL
"""

ORACLE_SQL["ordered_detail"] = f"""
WITH {REQ}, {DETAIL.strip()}
SELECT date, datetime, node, client_ip, status, TRY_CAST(replace(size, '-', '0') AS BIGINT) AS bytes
FROM det WHERE len(string_split(size, ' ')) = 1
"""

ORACLE_SQL["kept_summaries"] = ORACLE_SQL["all_node_rollup"]
