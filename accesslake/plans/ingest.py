"""The line-to-event transform shared by batch and streaming.

``read → attach_source → parse (text or CDN JSON) → normalise/tag/route →
enrich`` is one lazy DataFrame plan.  Everything here is stateless per row
except the optional dimension joins, so the same function serves
``spark.read`` and ``spark.readStream`` inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import enrich
from ..operators.layouts import parse_lines
from ..operators.normalise import keep_events, to_events
from ..operators.sinks import materialize
from ..sources.cdn_json import parse_cdn_json
from ..sources.text import attach_source


@dataclass
class Dimensions:
    """User-supplied lookup tables (any may be None)."""
    geo_ranges: DataFrame | None = None
    dns: DataFrame | None = None
    public_suffix: DataFrame | None = None
    agent_rules: DataFrame | None = None


def parse_any(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Text layouts and CDN JSON in one pass: JSON lines (``{…``) take the JSON mapping.

    No layout is tried on a JSON line: it would search the whole line for each
    of them, and the mapping replaces what it found.
    """
    text = F.when(~F.col(value_col).startswith("{"), F.col(value_col))
    parsed = parse_lines(lines.withColumn("__text", text), "__text").drop("__text")
    return parse_cdn_json(parsed, value_col, base=True)


def transform(lines: DataFrame, dims: Dimensions | None = None, value_col: str = "value",
              keep_dropped: bool = False, sources: DataFrame | None = None) -> DataFrame:
    """Raw lines → typed, tagged, routed (and optionally enriched) events.

    ``sources`` adds the constants of each line's source (S2) as ``src_*``
    columns, on a stream as in batch.
    """
    if sources is not None:
        lines = attach_source(lines, sources)
    if "ingested_at" not in lines.columns:
        lines = lines.withColumn("ingested_at", F.current_timestamp())
    ev = to_events(parse_any(lines, value_col), message_col=value_col)
    if not keep_dropped:
        ev = keep_events(ev)
    if dims is not None:
        ev = enrich_events(ev, dims)
    return ev


def enrich_events(ev: DataFrame, dims: Dimensions, url_domains: bool = True, stored: bool = False) -> DataFrame:
    """E1–E4 with whichever dimension tables are given.

    Unless ``ev`` is a stored table (or persisted) already it is written once,
    so that every lookup reads events and none parses the lines again.

    ``url_domains=False`` skips the registered domain of the URL host (one
    distinct-host resolution and join fewer) when a query needs only clients.
    """
    if not stored and (dims.public_suffix is not None or dims.agent_rules is not None):
        ev = materialize(ev, "enrich", partition_by=None)
    if dims.geo_ranges is not None:
        prefer = "cdn_country" if "cdn_country" in ev.columns else None
        ev = enrich.geo_lookup(ev, dims.geo_ranges, prefer_col=prefer)
    if dims.dns is not None:
        ev = enrich.dns_lookup(ev, dims.dns)
    elif "source_domain" not in ev.columns:
        ev = ev.withColumn("source_domain", F.col("source_address"))
    if dims.public_suffix is not None:
        ev = enrich.registered_domain(ev, dims.public_suffix, "source_domain", "source_", stored=True)
        if url_domains:
            ev = enrich.registered_domain(ev, dims.public_suffix, "url_domain", "url_", stored=True)
    if dims.agent_rules is not None:
        ev = enrich.parse_agents(ev, dims.agent_rules, stored=True)
    return ev
