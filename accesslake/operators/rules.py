"""Classification by ordered rules.

A rule set is an ordered list of ``Rule(priority, label, conditions)``;
conditions are ANDed and the first rule whose conditions all hold wins.
Condition operators:

* ``regex``       – Java regex search (``rlike``) on the field
* ``like``        – SQL ``LIKE`` on the field
* ``ilike``       – SQL ``LIKE`` on ``lower(field)``
* ``contains``    – substring test
* ``segment``     – ``split(field, '/')[arg] = pattern`` (1-based; out of
                    range is no match)
* ``segment_like``– same with ``LIKE``

Rules compile to literal ``CASE WHEN`` chains (a literal pattern is compiled
once per task, never per row), split into chunks of ``CHUNK`` rules so the
generated code stays under the JVM method-size limit; chunks are combined
with a short-circuiting ``coalesce``.  Large rule sets over repetitive text
(URLs, agents) run on **distinct values** and join back (``classify_distinct``).
Rules are data: ``rules_from_df`` reads them from a user table
``(rule_set, priority, field, op, arg, pattern, label)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .partitioning import join_back
from .sinks import materialize

CHUNK = 50


@dataclass(frozen=True)
class Cond:
    op: str
    pattern: str
    arg: int | None = None


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    conds: tuple = field(default_factory=tuple)


def cond_expr(c: Cond, value: Column) -> Column:
    if c.op == "regex":
        return value.rlike(c.pattern)
    if c.op == "like":
        return value.like(c.pattern)
    if c.op == "ilike":
        return F.lower(value).like(c.pattern)
    if c.op == "contains":
        return value.contains(c.pattern)
    if c.op in ("segment", "segment_like"):
        seg = F.try_element_at(F.split(value, "/"), F.lit(int(c.arg)))
        return seg == c.pattern if c.op == "segment" else seg.like(c.pattern)
    raise ValueError(f"unknown rule operator {c.op!r}")


def rule_expr(rule: Rule, value: Column) -> Column:
    e = None
    for c in rule.conds:
        x = F.coalesce(cond_expr(c, value), F.lit(False))
        e = x if e is None else (e & x)
    return e if e is not None else F.lit(True)


def sql_string(s: str) -> str:
    """A Spark SQL string literal (backslash escapes are processed by the parser)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def cond_sql(c: Cond, v: str) -> str:
    """One condition as Spark SQL text over the column reference ``v``."""
    p = sql_string(c.pattern)
    if c.op == "regex":
        return f"({v} RLIKE {p})"
    if c.op == "like":
        return f"({v} LIKE {p})"
    if c.op == "ilike":
        return f"(lower({v}) LIKE {p})"
    if c.op == "contains":
        return f"contains({v}, {p})"
    if c.op in ("segment", "segment_like"):
        seg = f"try_element_at(split({v}, '/'), {int(c.arg)})"
        return f"({seg} = {p})" if c.op == "segment" else f"({seg} LIKE {p})"
    raise ValueError(f"unknown rule operator {c.op!r}")


def rule_sql(rule: Rule, v: str) -> str:
    return " AND ".join(f"coalesce({cond_sql(c, v)}, false)" for c in rule.conds) or "true"


def _chunks_sql(name: str, rules: list[Rule], then) -> list[Column]:
    v = f"`{name}`"
    ordered = sorted(rules, key=lambda r: r.priority)
    out = []
    for i in range(0, len(ordered), CHUNK):
        whens = " ".join(f"WHEN {rule_sql(r, v)} THEN {then(r)}" for r in ordered[i:i + CHUNK])
        out.append(F.expr(f"CASE {whens} END"))
    return out


def classify_expr(value: Column | str, rules: list[Rule], default: str | None = None) -> Column:
    """First matching rule's label, else ``default``.

    Given a column **name**, each chunk is one SQL ``CASE`` text parsed in the
    JVM (one call however many rules); given a Column, it is built with the
    Column API.
    """
    if isinstance(value, str):
        chunks = _chunks_sql(value, rules, lambda r: sql_string(r.label))
        return F.coalesce(*chunks, F.lit(default).cast("string"))
    ordered = sorted(rules, key=lambda r: r.priority)
    chunks = []
    for i in range(0, len(ordered), CHUNK):
        e = None
        for r in ordered[i:i + CHUNK]:
            cond = rule_expr(r, value)
            e = F.when(cond, F.lit(r.label)) if e is None else e.when(cond, F.lit(r.label))
        chunks.append(e)
    return F.coalesce(*chunks, F.lit(default).cast("string"))


def first_match_index(value: Column | str, rules: list[Rule]) -> Column:
    """Priority of the winning rule (null when none matches)."""
    if isinstance(value, str):
        return F.coalesce(*_chunks_sql(value, rules, lambda r: str(int(r.priority))))
    ordered = sorted(rules, key=lambda r: r.priority)
    chunks = []
    for i in range(0, len(ordered), CHUNK):
        e = None
        for r in ordered[i:i + CHUNK]:
            cond = rule_expr(r, value)
            e = F.when(cond, F.lit(r.priority)) if e is None else e.when(cond, F.lit(r.priority))
        chunks.append(e)
    return F.coalesce(*chunks)


def all_matches(value: Column | str, rules: list[Rule]) -> Column:
    """Priorities of every rule that matches (for C7 lint)."""
    if isinstance(value, str):
        v = f"`{value}`"
        items = ", ".join(f"CASE WHEN {rule_sql(r, v)} THEN {int(r.priority)} END"
                          for r in sorted(rules, key=lambda r: r.priority))
        return F.expr(f"filter(array({items}), x -> x IS NOT NULL)")
    arr = F.array(*[F.when(rule_expr(r, value), F.lit(r.priority)) for r in sorted(rules, key=lambda r: r.priority)])
    return F.filter(arr, lambda x: x.isNotNull())


def classify(df: DataFrame, value_col: str, rules: list[Rule], out_col: str, default: str | None = None) -> DataFrame:
    return df.withColumn(out_col, classify_expr(value_col, rules, default))


def classify_distinct(df: DataFrame, value_col: str, rules: list[Rule], out_col: str,
                      default: str | None = None, stored: bool = False, indexed: bool = False) -> DataFrame:
    """C1 on distinct values, joined back (values repeat heavily in logs).

    ``df`` is written once (unless it is ``stored`` already): the distinct set
    and the rows come from that.  The distinct set is an aggregate (partial +
    final, so a hot value costs one row per map task); the join back splits
    heavy values.  Null values get the default without entering the join.
    ``indexed`` finds candidate rules by their required literals in a join
    (``ruleindex``) instead of walking all of them: for sets of many hundred
    rules, with the same labels.
    """
    if not stored:
        df = materialize(df, "classify", partition_by=None)
    values = df.select(F.col(value_col).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    if indexed:
        from .ruleindex import first_match
        labelled = first_match(values, "__v", rules).withColumnRenamed("label", "__label")
    else:
        labelled = values.withColumn("__label", classify_expr("__v", rules, default))
    j = join_back(df, labelled, value_col, "__v")
    return j.withColumn(out_col, F.coalesce(F.col("__label"), F.lit(default).cast("string"))).drop("__v", "__label")


def classify_chain(df: DataFrame, value_col: str, stages: list[tuple[list[Rule], str, str | None]], stored: bool = False) -> DataFrame:
    """Labels of labels: each stage (rules, out_col, default) classifies the stage before's label, the first the value.

    All stages run on one set of distinct values, which is joined back once.
    """
    if not stored:
        df = materialize(df, "classify", partition_by=None)
    labelled = df.select(F.col(value_col).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    source, missing = "__v", {}
    for k, (rules, _, default) in enumerate(stages):
        labelled = labelled.withColumn(f"__l{k}", classify_expr(source, rules, default))
        source = f"__l{k}"
    j = join_back(df, labelled, value_col, "__v")
    for k, (rules, out, default) in enumerate(stages):  # null values: the default, and the labels that defaults get
        missing[k] = F.lit(default).cast("string") if k == 0 else classify_expr(F.col(stages[k - 1][1]), rules, default)
        j = j.withColumn(out, F.when(F.col("__v").isNotNull(), F.col(f"__l{k}")).otherwise(missing[k]))
    return j.drop("__v", *(f"__l{k}" for k in range(len(stages))))


def rule_lint(df: DataFrame, value_col: str, rules: list[Rule]) -> DataFrame:
    """Per rule, rows it wins (first match) vs rows it matches at all.

    Values are pre-aggregated with their counts before rules run, so the work
    is per distinct value.  ``shadowed`` rules match rows but never win.
    """
    counted = df.groupBy(F.col(value_col).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    scored = counted.select(
        "__n",
        first_match_index("__v", rules).alias("__first"),
        all_matches("__v", rules).alias("__all"),
    )
    firsts = scored.groupBy(F.col("__first").alias("priority")).agg(F.sum("__n").alias("first_match_rows"))
    anys = (scored.select("__n", F.explode("__all").alias("priority"))
            .groupBy("priority").agg(F.sum("__n").alias("any_match_rows")))
    spark = df.sparkSession
    catalog = spark.createDataFrame([(r.priority, r.label) for r in rules], "priority int, label string")
    out = (catalog.join(F.broadcast(firsts), "priority", "left").join(F.broadcast(anys), "priority", "left")
           .select("priority", "label",
                   F.coalesce("first_match_rows", F.lit(0)).cast("bigint").alias("first_match_rows"),
                   F.coalesce("any_match_rows", F.lit(0)).cast("bigint").alias("any_match_rows")))
    return out.withColumn("shadowed", (F.col("first_match_rows") == 0) & (F.col("any_match_rows") > 0))


def rules_from_df(df: DataFrame) -> dict[str, list[Rule]]:
    """Read a rule table ``(rule_set, priority, field, op, arg, pattern, label)``.

    Rule tables are configuration written by hand; they become literals in the
    plan.
    """
    sets: dict[str, dict[int, Rule]] = {}
    for r in df.orderBy("rule_set", "priority").collect():
        cur = sets.setdefault(r["rule_set"], {})
        rule = cur.get(r["priority"], Rule(r["priority"], r["label"], ()))
        cur[r["priority"]] = Rule(rule.priority, rule.label, rule.conds + (Cond(r["op"], r["pattern"], r["arg"]),))
    return {k: sorted(v.values(), key=lambda x: x.priority) for k, v in sets.items()}


def _rules(spec) -> list[Rule]:
    return [Rule(i + 1, label, tuple(Cond(*c) for c in conds)) for i, (label, conds) in enumerate(spec)]


# --- fixed values: robot / bot classifiers (C2, C3) -----------------------
# One case-sensitive alternation; a null agent is "human".  The last
# alternative really ends in the two characters "/i" (no flag is applied).
ROBOT_AGENT_RX = (
    r"ahrefs|Barkrowler|Baiduspider|bingbot|CCBot|Cliqzbot|cs.daum\.net|DataForSeoBot|"
    r"DomainCrawler|DuckDuckGo|Exabot|Googlebot|linkdexbot|magpi|-crawler|MauiBot|MJ12bot|"
    r"MTRobot|msnbot|OpenLinkProfiler\.org|opensiteexplorer|pingdom|rogerbot|SemrushBot|"
    r"SeznamBot|sogou\.com|tt-rss|Wotbox|YandexBot|YandexImages|ysearch\/slurp|BLEXBot|"
    r"Flamingo_SearchEngine|okhttp|scalaj-http|UptimeRobot|YisouSpider|proximic\.com\/info\/spider/i"
)
# Case-insensitive; bot beats human; anything else is "unknown".
BOT_AGENT_RX = (
    r"(?i)bot|crawl|spider|slurp|selenium|phantom.?js|curl|wget|python|httpclient|scrapy|"
    r"lynx|apis?-?google|facebookexternalhit|scraper|fetcher|checker|monitor|google.?cloud|azure"
)
HUMAN_AGENT_RX = r"(?i)mozilla|chrome|safari|firefox|edge|amazon.*cloudfront"
# ---------------------------------------------------------------------------


def robot_or_human(agent: Column) -> Column:
    """C2."""
    return F.when(F.coalesce(agent.rlike(ROBOT_AGENT_RX), F.lit(False)), F.lit("robot")).otherwise(F.lit("human"))


def bot_human_unknown(agent: Column) -> Column:
    """C3."""
    bot = F.coalesce(agent.rlike(BOT_AGENT_RX), F.lit(False))
    human = F.coalesce(agent.rlike(HUMAN_AGENT_RX), F.lit(False))
    return F.when(bot, F.lit("bot")).when(human, F.lit("human")).otherwise(F.lit("unknown"))


# --- fixed values: per-node request-type rules (C4) -----------------------
# (label, [(op, pattern, arg), ...]) in rule order; default "archive".
REQUEST_TYPE_RULES = {
    "atm": _rules([
        ("PDS ATM Data Set Catalog", [("regex", "atmospheres_data")]),
        ("EPIC", [("regex", "epic"), ("segment", "data_and_services", 2)]),
        ("Mars GCM", [("regex", "mogc_0001")]),
        ("Object Access Library", [("regex", "OAL")]),
        ("NASA Abstracts", [("regex", "nasa_abstracts")]),
        ("LADEE UVS", [("regex", "LADEE"), ("regex", "uvs")]),
        ("LADEE NMS", [("regex", "LADEE"), ("regex", "nms")]),
        ("MAVEN ACC", [("regex", "MAVEN"), ("regex", "acc")]),
        ("MAVEN NGIMS", [("regex", "MAVEN"), ("regex", "ngims")]),
        (" Venus Express", [("regex", "VENUS-EXPRESS")]),
        ("Cassini Data and Resources", [("regex", "Cassini"), ("segment", "data_and_services", 2)]),
    ]),
    "geo": _rules([
        ("Spectral Library", [("segment", "spectrallibrary", 2)]),
        ("Spectral Library", [("segment", "speclib", 2)]),
        ("CRISM Spectral Library", [("regex", "crism"), ("segment", "mro", 2)]),
        ("MakeLabels", [("regex", "makelabels"), ("segment", "tools", 2)]),
        ("LRO LEND Data Viewer", [("regex", "lend"), ("segment", "lro", 2)]),
        ("MRO SHARAD Reader", [("regex", "sharad"), ("segment", "mro", 2)]),
        ("CRISM Analysis Toolkit (CAT)", [("regex", "crism"), ("segment", "mro", 2)]),
        ("OMEGA Analysis Toolkit (OAT)", [("regex", "omega"), ("segment", "mex", 2)]),
    ]),
    "img": _rules([
        ("Planetary Image Atlas III", [("regex", "search"), ("segment", "search", 2)]),
        ("Data Portal", [("regex", "portal"), ("segment", "portal", 2)]),
        ("Data Archive", [("regex", "data"), ("segment", "data", 2)]),
        ("Mars Viewer", [("regex", "marsviewer"), ("segment", "tools", 2)]),
    ]),
    "naif": _rules([
        ("Data Server Area", [("like", "%utilities%"), ("segment_like", "%pub%", 2)]),
        ("Chronos MSL", [("like", "%chronos_msl.pl%")]),
        ("Cosmographia", [("like", "%cosmographia%")]),
        ("Toolkit", [("like", "%toolkit%")]),
        ("Utilities", [("segment", "naif", 3), ("segment", "utilities", 4)]),
        ("Misc", [("segment", "naif", 3), ("segment", "misc", 4)]),
        ("SPICE PDS Archive Subsetter", [("like", "%data_archived.html%")]),
        ("Chronos Apps", [("like", "%chronos%"), ("segment", "cgi_bin", 2)]),
        ("SPICE Announce", [("like", "%spice_announce%")]),
        ("SPICE Discussion", [("like", "%spice_discussion%")]),
    ]),
    "ppi": _rules([
        ("PDS3 Software Pkgs", [("segment", "software", 2)]),
    ]),
    "rings": _rules([
        ("planet viewer", [("regex", "viewer3"), ("segment", "tools", 2)]),
        ("moon tracker", [("regex", "tracker2"), ("segment", "tools", 2)]),
        ("ephemeris", [("regex", "ephem"), ("segment", "tools", 2)]),
        ("galleries", [("regex", "galleries"), ("segment", "galleries", 2)]),
        ("viewmaster", [("regex", "viewmaster"), ("segment", "viewmaster", 2)]),
        ("opus", [("regex", "opus"), ("segment", "opus", 2)]),
    ]),
    "sbn": _rules([
        ("Comet Cross-Identification", [("ilike", "%cxid%")]),
        ("ReadPDS", [("ilike", "%readpds%")]),
        ("Dawn Mission to Ceres", [("ilike", "%pds-ceres%")]),
        ("Dawn Mission to Vesta", [("ilike", "%pds-vesta%")]),
        ("NEAR Shoemaker Mission to 433 Eros", [("ilike", "%pds-eros%")]),
        ("Cassini Mission: Saturn Small Satellites", [("ilike", "%saturn.html%")]),
        ("Cassini Mission: Mimas (Saturn I)", [("ilike", "%pds-mimas%")]),
        ("Cassini Mission: Enceladus (Saturn II)", [("ilike", "%pds-enceladus%")]),
        ("Cassini Mission: Tethys (Saturn III)", [("ilike", "%pds-tethys%")]),
        ("Cassini Mission: Dione (Saturn IV)", [("ilike", "%pds-dione%")]),
        ("Cassini Mission: Tethys (Saturn V)", [("ilike", "%pds-rhea%")]),
        ("Cassini Mission: Tethys (Saturn VIII)", [("ilike", "%pds-lapetus%")]),
        ("Cassini Mission: Phoebe (Saturn IX)", [("ilike", "%pds-phoebe%")]),
        ("Wiki", [("segment", "wiki", 2)]),
        ("SBN Tools, Utilities, and Interfaces", [("segment", "tools", 2)]),
    ]),
}
REQUEST_TYPE_DEFAULT = "archive"
# ---------------------------------------------------------------------------


def node_request_type(node: Column | str, request: Column | str, rule_sets: dict | None = None,
                      default: str = REQUEST_TYPE_DEFAULT) -> Column:
    """C4: the node's own rule set applied to the request text (names → one SQL text)."""
    sets = rule_sets or REQUEST_TYPE_RULES
    if isinstance(node, str) and isinstance(request, str):
        v = f"`{request}`"
        branches = []
        for name, rules in sets.items():
            whens = " ".join(f"WHEN {rule_sql(r, v)} THEN {sql_string(r.label)}"
                             for r in sorted(rules, key=lambda r: r.priority))
            branches.append(f"WHEN `{node}` = {sql_string(name)} THEN CASE {whens} ELSE {sql_string(default)} END")
        return F.expr(f"CASE {' '.join(branches)} ELSE {sql_string(default)} END")
    e = None
    for name, rules in sets.items():
        x = classify_expr(request, rules, default)
        e = F.when(node == name, x) if e is None else e.when(node == name, x)
    return e.otherwise(F.lit(default))


def example_request(rule: Rule) -> str:
    """A request on which all conditions of a request-type rule hold: its segments in place, its texts after them."""
    segments, texts = {}, []
    for c in rule.conds:
        if c.op in ("segment", "segment_like"):
            segments[c.arg] = c.pattern.replace("%", "")
        else:
            texts.append(c.pattern.replace("%", ""))
    path = [segments.get(i, "x") for i in range(2, max([*segments, 1]) + 1)] + texts
    return "GET /" + "/".join(path) + "/f HTTP/1.1"
