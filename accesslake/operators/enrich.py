"""Enrichment by joins against user-supplied dimension tables.

* E2 ``geo_lookup``       – IPv4 range join: ranges become disjoint segments,
  then rows and segments meet in one sorted merge (``geo``).
* E3 ``dns_lookup``       – left equi-join ``address → name``; the default
  name is the address itself.
* E4 ``registered_domain`` – public-suffix rules (plain, wildcard, exception)
  by exploding the host's label suffixes and equi-joining the rule table, done
  on distinct hosts and joined back.
* E1 ``parse_agents``     – ordered agent rules on distinct agents, joined back:
  a literal index picks candidate rules, ``mapInPandas`` tests them.
* E6 – the eligibility gate: rows whose line could not be parsed or that have
  no address get a null join key, so they never join; a bad date does not
  matter.

No explicit broadcast hints on user tables: their size is unknown when the
plan is written, so the choice is left to AQE, which broadcasts a side only
after measuring it against ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import heapq
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import net
from . import geo, ruleindex
from .partitioning import join_back
from .sinks import materialize

#: Tags of rows whose address is not looked up.
UNRESOLVED_TAGS = ("bad_log", "_grokparsefailure", "_grok_filter_initial_parse_failure", "_missing_source_address")


def _eligible_address(df: DataFrame, addr_col: str) -> Column:
    addr = F.col(addr_col)
    if "tags" in df.columns:
        failed = F.arrays_overlap(F.col("tags"), F.array(*[F.lit(t) for t in UNRESOLVED_TAGS]))
        return F.when(~F.coalesce(failed, F.lit(False)), addr)
    return addr


def _stored(df: DataFrame, name: str, stored: bool) -> DataFrame:
    """``df`` written once, so that its distinct values and its rows come from one evaluation."""
    return df if stored else materialize(df, name, partition_by=None)


def geo_lookup(df: DataFrame, ranges: DataFrame, addr_col: str = "source_address", prefer_col: str | None = None) -> DataFrame:
    """Left range join of IPv4 addresses onto ``[ip_start, ip_end]`` ranges, which may overlap.

    Every row comes out once: of overlapping ranges the narrowest wins (ties:
    the lowest start, then the smallest names).  Missing, IPv6 and other
    addresses get nulls.  ``df`` is read once.  ``prefer_col`` (for example a
    CDN-supplied country) wins over the looked-up country.
    """
    located = geo.locate(df.withColumn("__ip", net.ipv4_to_long(_eligible_address(df, addr_col))), "__ip", geo.flatten_ranges(ranges))
    country = F.col("__place.country")
    if prefer_col:
        country = F.coalesce(F.col(prefer_col), country)
    return located.withColumns({"geo_country": country} | {f"geo_{c}": F.col(f"__place.{c}") for c in geo.PLACE[1:]}).drop("__ip", "__place")


def dns_lookup(df: DataFrame, dns: DataFrame, addr_col: str = "source_address") -> DataFrame:
    """E3 + E6: ``source_domain`` = looked-up name, else the address itself."""
    # one name an address (the smallest), so no row comes out twice
    d = dns.where("address is not null").groupBy(F.col("address").alias("__addr")).agg(F.min("name").alias("__name"))
    left = df.withColumn("__key", _eligible_address(df, addr_col))
    j = left.join(d, left["__key"] == d["__addr"], "left")
    return (j.withColumn("source_domain", F.when(F.col("__key").isNotNull(),
                                                  F.coalesce(F.col("__name"), F.col(addr_col))))
             .drop("__key", "__addr", "__name"))


def _suffix_candidates(host: Column) -> Column:
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n),
                       lambda i: F.struct(i.alias("pos"), F.array_join(F.slice(labels, i, n - i + 1), ".").alias("cand")))


def suffix_rules(suffixes: DataFrame) -> DataFrame:
    """``(key, shift, exception)`` of public-suffix rules in their usual notation.

    A plain rule is its own suffix.  ``*.key`` makes any one label more a
    suffix (``key`` itself is none by that rule).  ``!name.key`` excepts a name
    from a wildcard: its suffix starts one label later.  Case, blanks and
    leading or trailing dots do not matter; empty rows and repeated rules are
    ignored; a wildcard anywhere but first is not known and matches nothing.
    """
    rule = F.trim(F.regexp_replace(F.lower(F.trim("suffix")), r"^\.+|\.+$", ""))
    r = suffixes.select(rule.alias("rule")).where(F.length("rule") > 0)
    return r.select(
        F.regexp_replace("rule", r"^(?:!|\*\.)", "").alias("key"),
        F.when(F.col("rule").startswith("*."), -1).when(F.col("rule").startswith("!"), 1).otherwise(0).alias("shift"),
        F.col("rule").startswith("!").alias("exception")).distinct()


def resolve_domains(hosts: DataFrame, suffixes: DataFrame, host_col: str = "host", unlisted: bool = False) -> DataFrame:
    """E4 on a set of hosts: registered domain, TLD, second level, sub-domain.

    The prevailing rule is the exception if one matches, else the rule with
    most labels (see ``suffix_rules``).  A host that is itself a public suffix,
    an IPv4 text, or matches no rule does not come out; with ``unlisted`` the
    last label is the suffix of hosts that match none.  A trailing dot is
    dropped, hosts with empty labels match nothing.
    """
    name = F.regexp_replace(F.lower(F.col(host_col)), r"\.$", "")
    h = hosts.select(name.alias("__host")).where(
        F.col("__host").isNotNull() & ~net.is_ipv4(F.col("__host")) & ~F.col("__host").rlike(r"(?:^|\.)(?:\.|$)")).distinct()
    cands = h.select("__host", F.explode(_suffix_candidates(F.col("__host"))).alias("c"))
    rules = suffix_rules(suffixes)
    met = cands.join(rules, F.col("c.cand") == F.col("key"), "inner").select(
        "__host", "exception", (F.col("c.pos") + F.col("shift")).alias("start")).where("start >= 1")
    if unlisted:
        met = met.union(h.select("__host", F.lit(False), F.size(F.split("__host", r"\."))))
    # exceptions before all others, then the earliest start: the rule with most labels
    best = met.groupBy("__host").agg(F.min(F.struct((~F.col("exception")).alias("plain"), "start")).getField("start").alias("__pos"))
    labels = F.split(F.col("__host"), r"\.")
    pos = F.col("__pos")
    return best.where(pos > 1).select(
        F.col("__host").alias("host"),
        F.array_join(F.slice(labels, pos - 1, F.size(labels) - pos + 2), ".").alias("registered_domain"),
        F.array_join(F.slice(labels, pos, F.size(labels) - pos + 1), ".").alias("top_level_domain"),
        F.element_at(labels, pos - 1).alias("second_level_domain"),
        F.when(pos > 2, F.array_join(F.slice(labels, 1, pos - 2), ".")).alias("sub_domain"),
    )


def registered_domain(df: DataFrame, suffixes: DataFrame, host_col: str, prefix: str, stored: bool = False) -> DataFrame:
    """Add ``<prefix>registered_domain`` / ``top_level_domain`` / ``subdomain`` / ``second_level_domain``.

    ``stored`` says that ``df`` is cheap to read again (a stored table); else it is written once first.
    """
    df = _stored(df.withColumn("__lh", F.regexp_replace(F.lower(F.col(host_col)), r"\.$", "")), "domains", stored)
    res = resolve_domains(df.select(F.col("__lh").alias("host")), suffixes)
    res = res.select(F.col("host").alias("__h"), *[F.col(c).alias(prefix + c) for c in
                     ("registered_domain", "top_level_domain", "second_level_domain", "sub_domain")])
    return join_back(df, res, "__lh", "__h").drop("__h", "__lh")


# ---------------------------------------------------------------------------
# Ordered agent rules (family / version, OS, device) with capture groups.
# ---------------------------------------------------------------------------
AGENT_FIELDS = ("ua_name", "ua_version", "ua_os", "ua_os_version", "ua_device", "ua_device_brand", "ua_device_model")
AGENT_KINDS = ("agent", "os", "device")


class _AgentRules:
    """Rules of the three kinds in order; patterns are compiled when they are first tested."""

    def __init__(self, rows: list[dict], every: list[int]):
        self.rows, self.compiled = rows, {}
        self.every = {k: [i for i in every if rows[i]["kind"] == k] for k in AGENT_KINDS}

    def _search(self, i: int, agent: str) -> re.Match | None:
        if i not in self.compiled:
            flags = re.IGNORECASE if "i" in (self.rows[i].get("flags") or "").lower() else 0
            self.compiled[i] = re.compile(self.rows[i]["regex"], flags)
        return self.compiled[i].search(agent)

    def first(self, kind: str, agent: str, some: list[int]) -> tuple[dict, re.Match] | None:
        for i in heapq.merge((i for i in some if self.rows[i]["kind"] == kind), self.every[kind]):
            m = self._search(i, agent)
            if m:
                return self.rows[i], m
        return None

    def fields(self, agent: str, some: list[int]) -> tuple:
        name, os_, device = (self.first(k, agent, some) for k in AGENT_KINDS)
        return (_fill(name, "family", 1) or "Other", _version(name, 3), _fill(os_, "family", 1) or "Other", _version(os_, 4),
                _fill(device, "family", 1) or "Other", _fill(device, "brand", None), _fill(device, "model", 1))


def _fill(found: tuple[dict, re.Match] | None, field: str, default_group: int | None) -> str | None:
    """The rule's template with its groups filled in, else the default group."""
    if found is None:
        return None
    rule, m = found
    if rule.get(field):
        filled = re.sub(r"\$([1-9])", lambda g: (m.group(int(g[1])) if int(g[1]) <= m.re.groups else None) or "", rule[field])
        return filled.strip() or None
    return m.group(default_group) if default_group and default_group <= m.re.groups else None


def _version(found: tuple[dict, re.Match] | None, parts: int) -> str | None:
    return ".".join(v for v in (_fill(found, f"v{k}", k + 1) for k in range(1, parts + 1)) if v) or None


def parse_agents(df: DataFrame, agent_rules: DataFrame, agent_col: str = "user_agent", stored: bool = False) -> DataFrame:
    """Ordered first-match agent rules on distinct agents, joined back as ``AGENT_FIELDS``.

    ``agent_rules``: kind (agent, os, device), priority, regex, and any of
    flags, family, v1 to v4, brand, model: templates with ``$1`` to ``$9``.
    Without a template the family and the model are group 1, the parts of a
    version the groups from 2 on, the brand is null.  An agent that no rule of
    a kind matches is ``Other``; a null agent has nulls.

    The rule table is configuration (patterns written by hand, not data).  Its
    required literals meet the agents' grams in a join, so an agent is tested
    only against rules that could match it (``ruleindex``); the tests run in
    ``mapInPandas`` per distinct agent.
    """
    rows = sorted((r.asDict() for r in agent_rules.collect()), key=lambda r: (AGENT_KINDS.index(r["kind"]), r["priority"]))
    keys, every = ruleindex.index_rows({i: ruleindex.required_literals(r["regex"]) for i, r in enumerate(rows)})

    def classify_batches(it):
        rules = _AgentRules(rows, every)
        for pdf in it:
            out = pd.DataFrame([rules.fields(a, list(c)) for a, c in zip(pdf["__agent"], pdf["candidates"])], columns=list(AGENT_FIELDS))
            out.insert(0, "__agent", pdf["__agent"].values)
            yield out

    schema = "__agent string, " + ", ".join(f"{c} string" for c in AGENT_FIELDS)
    df = _stored(df, "agents", stored)
    distinct_agents = df.select(F.col(agent_col).alias("__agent")).where(F.col("__agent").isNotNull()).distinct()
    labelled = ruleindex.candidates(distinct_agents, "__agent", keys).mapInPandas(classify_batches, schema)
    return join_back(df, labelled, agent_col, "__agent").drop("__agent")
