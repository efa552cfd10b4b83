"""Dimension tables derived from the shipped tables, plus small rule sets.

In production these are user-supplied (a geo database, a name table, the
public-suffix list, rule tables).  For the query catalogue they are derived
from the given tables by Spark, so they grow with the data:

* ``dns_from_customer``   – one name per customer address;
* ``geo_from_customer``   – one /24 range per customer, country = nation,
  region = region;
* ``sources_from_nation`` – two source prefixes per nation (``<n>/`` and the
  longer ``<n>/web/``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.net import long_to_ipv4
from ..operators.rules import Cond, Rule

# --- fixed values ------------------------------------------------------------
DNS_TLDS = ("com", "net", "org")
PUBLIC_SUFFIXES = ("com", "net", "org", "edu", "gov", "co.uk", "ac.uk",
                   "example.com", "example.net", "example.org")
CDN_COUNTRIES = ("US", "DE", "FR", "JP")
# ------------------------------------------------------------------------------


def customer_address(key: F.Column, last_octet: F.Column) -> F.Column:
    return F.concat_ws(".", F.lit("10"), (key / 250).cast("bigint").cast("string"),
                       F.pmod(key, F.lit(250)).cast("string"), last_octet.cast("string"))


def dns_from_customer(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    tld = F.element_at(F.array(*[F.lit(t) for t in DNS_TLDS]), (F.pmod(F.col("c_nationkey"), F.lit(3)) + 1).cast("int"))
    return customer.select(
        customer_address(k, F.pmod(k, F.lit(4))).alias("address"),
        F.concat(F.lit("host-"), k.cast("string"), F.lit("."), F.lower("c_mktsegment"), F.lit(".example."), tld).alias("name"),
    )


def geo_from_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    base = (F.lit(10) * 16777216 + (k / 250).cast("bigint") * 65536 + F.pmod(k, F.lit(250)) * 256).cast("bigint")
    c = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left") \
                .join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    return c.select(
        base.alias("ip_start"), (base + 255).alias("ip_end"),
        F.col("n_name").alias("country"), F.col("r_name").alias("region"),
        F.concat(F.lit("city-"), F.pmod(k, F.lit(10)).cast("string")).alias("city"),
        (F.col("n_nationkey") * 3.5 - 40.0).alias("lat"),
        (F.col("n_regionkey") * 30.0 - 60.0).alias("lon"),
    )


def public_suffix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s,) for s in PUBLIC_SUFFIXES], "suffix string")


# --- fixed values: rules of every kind over the hosts of ``pages`` -------------
SUFFIX_RULES = ("com", "org", "*.example.net", "*.example.org")
EXCEPTED_DOMAIN = "example.org"  # its second-level names of even length are excepted from the wildcard
# ------------------------------------------------------------------------------


def page_host(url: F.Column) -> F.Column:
    return F.regexp_extract(url, r"^[A-Za-z]+://([^/?#:]+)", 1)


def suffix_rules_from_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Plain and wildcard rules, and one exception for each excepted name that occurs."""
    name = F.regexp_extract(F.lower(page_host(F.col("url"))), r"([^.]+)\.example\.org$", 1)
    excepted = pages.select(name.alias("n")).where("length(n) > 0 AND length(n) % 2 = 0").distinct()
    fixed = spark.createDataFrame([(s,) for s in SUFFIX_RULES], "suffix string")
    return fixed.union(excepted.select(F.concat(F.lit("!"), F.col("n"), F.lit(f".{EXCEPTED_DOMAIN}"))))


def overlapping_geo(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Ranges that nest, overlap and leave gaps: /24 of two customers in three, the first half of some of
    them, ranges that reach into the next /24, and every second /16 as a whole."""
    k = F.col("c_custkey")
    c = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").withColumn(
        "base", (F.lit(10) * 16777216 + F.floor(k / 250) * 65536 + F.pmod(k, F.lit(250)) * 256).cast("bigint"))

    def part(rows, start, end, kind):
        return rows.select(start.alias("ip_start"), end.alias("ip_end"), F.col("n_name").alias("country"), F.lit(kind).alias("region"),
                           F.concat(F.lit("city-"), k.cast("string")).alias("city"), F.lit(None).cast("double").alias("lat"),
                           F.lit(0.0).alias("lon"))

    base = F.col("base")
    return (part(c.where(k % 3 != 0), base, base + 255, "net")
            .unionByName(part(c.where(k % 5 == 0), base, base + 1, "half"))
            .unionByName(part(c.where(k % 7 == 0), base + 2, base + 258, "over"))
            .unionByName(part(c.where((k % 250 == 0) & (F.floor(k / 250) % 2 == 1)), base, base + 65535, "block")))


def nation_slug(name: F.Column) -> F.Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")


def sources_from_nation(nation: DataFrame) -> DataFrame:
    slug = nation_slug(F.col("n_name"))
    base = nation.select(
        F.concat(slug, F.lit("/")).alias("prefix"), F.col("n_name").alias("organization"),
        F.concat(slug, F.lit(".example.org")).alias("url_domain"), F.lit("https").alias("url_scheme"),
        F.lit("web.analytics").alias("dataset"), F.lit("text").alias("cdn_format"))
    web = nation.select(
        F.concat(slug, F.lit("/web/")).alias("prefix"), F.concat(F.col("n_name"), F.lit(" web")).alias("organization"),
        F.concat(F.lit("www."), slug, F.lit(".example.org")).alias("url_domain"), F.lit("https").alias("url_scheme"),
        F.lit("web.http").alias("dataset"), F.lit("text").alias("cdn_format"))
    return base.unionByName(web)


# --- fixed values: synthetic agent rules (kind, priority, regex, flags, family, v1 to v4, brand, model)
AGENT_RULES = (
    ("agent", 1, r"(Googlebot)/(\d+)\.(\d+)", "", None, None, None, None, None, None, None),
    ("agent", 2, r"(Firefox)/(\d+)\.(\d+)", "", None, None, None, None, None, None, None),
    ("agent", 3, r"(curl)/(\d+)\.(\d+)\.(\d+)", "", None, None, None, None, None, None, None),
    ("agent", 4, r"python-requests/(\d+)\.(\d+)", "", "Python Requests", "$1", "$2", None, None, None, None),
    ("agent", 5, r"Version/(\d+)\.(\d+).*Safari/", "", "Safari", "$1", "$2", None, None, None, None),
    ("os", 1, r"Mac OS X (\d+)_(\d+)", "", "Mac OS X", "$1", "$2", None, None, None, None),
    ("os", 2, r"(Android) (\d+)", "", None, None, None, None, None, None, None),
    ("os", 3, r"(Linux)", "", None, None, None, None, None, None, None),
    ("device", 1, r"bot|crawl|spider", "i", "Spider", None, None, None, None, "Spider", "Desktop"),
    ("device", 2, r"Macintosh", "", "Mac", None, None, None, None, "Apple", "Mac"),
    ("device", 3, r"; (Pixel [^;)]+)\)", "", None, None, None, None, None, "Google", "$1"),
)
# ------------------------------------------------------------------------------


def agent_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(AGENT_RULES),
        "kind string, priority int, regex string, flags string, family string, v1 string, v2 string, v3 string, v4 string, brand string, model string")


# --- fixed values: synthetic C1 rule set over "<p_type>/<p_name>/<p_brand>" --
PART_RULES = [
    Rule(1, "economy rings", (Cond("segment", "ECONOMY", 1), Cond("contains", "ring"))),
    Rule(2, "widgets", (Cond("like", "%widget%"),)),
    Rule(3, "red or blue", (Cond("regex", "/(red|blue) "),)),
    Rule(4, "promo brand 1x", (Cond("segment_like", "Brand#1%", 3), Cond("ilike", "promo/%"))),
    Rule(5, "gears", (Cond("regex", "gear"),)),
]
# ------------------------------------------------------------------------------

ADJECTIVES = ("small", "red", "blue", "hot", "cold", "large", "old", "new")
NOUNS = ("ring", "widget", "bolt", "gear", "gizmo", "plate", "rod", "anvil")


def bundle_rules(n: int | None = None) -> list[Rule]:
    """C5-shaped bundle rules built from a rule: one case-insensitive regex per
    (adjective, noun) pair, ``(?i)<adj>.*<noun>`` → ``<adj>_<noun>``; then one
    per noun.  ``n`` repeats the pattern family with numbered variants to size
    the set (the bench uses 268), keeping first-match order meaningful."""
    rules: list[Rule] = []
    for a in ADJECTIVES:
        for w in NOUNS:
            rules.append(Rule(len(rules) + 1, f"{a}_{w}", (Cond("regex", f"(?i){a}.*{w}"),)))
    for w in NOUNS:
        rules.append(Rule(len(rules) + 1, f"any_{w}", (Cond("regex", f"(?i){w}"),)))
    if n is not None:
        i = 0
        base = list(rules)
        rules = []
        while len(rules) < n:
            r = base[i % len(base)]
            v = i // len(base)
            pat = r.conds[0].pattern if v == 0 else r.conds[0].pattern + f".*v{v}\\b"
            rules.append(Rule(len(rules) + 1, r.label if v == 0 else f"{r.label}_v{v}", (Cond("regex", pat),)))
            i += 1
        # keep the unversioned rules last so versioned ones can win
        rules = sorted(rules, key=lambda r: (0 if "_v" in r.label else 1, r.priority))
        rules = [Rule(i + 1, r.label, r.conds) for i, r in enumerate(rules)]
    return rules


def mission_rules() -> list[Rule]:
    """C6-shaped second stage over bundle labels (note ``any_`` rules come last)."""
    return [
        Rule(1, "Ring Mission", (Cond("regex", "(?i)ring"),)),
        Rule(2, "Gear Mission", (Cond("regex", "(?i)gear"),)),
        Rule(3, "Red Mission", (Cond("regex", "(?i)^red"),)),
        Rule(4, "Red Widget Mission", (Cond("regex", "(?i)red_widget"),)),
        Rule(5, "Small Mission", (Cond("regex", "(?i)small"),)),
    ]
