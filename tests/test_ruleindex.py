"""The literal index gives the labels of a plain walk over all rules."""

import random

import pytest

import __spark_entry__ as E
from accesslake.operators import enrich, ruleindex
from accesslake.operators import rules as R
from accesslake.operators.rules import Cond, Rule
from accesslake.plans import dims as D

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("pattern, want", [
    (r"(Googlebot)/(\d+)", ["googlebot/"]), (r"(?i)small.*ring", ["small"]), (r"bot|crawl|spider", None), (r"robot|crawl|spider", ["robot", "crawl", "spider"]),
    (r"Version/(\d+)\.(\d+).*Safari/", ["version/"]), (r"(?:abcd)?efghi", ["efghi"]), (r"(abcdef)*xy", None), (r"(?:long-one|other-one)+z", ["long-one", "other-one"]),
    (r"[Aa]bcd\bef", ["abcdef"]), (r"\p{L}+abcd", None), (r"^a.c", None), (r"(?=needle)n", ["needle"]), (r"(?!needle)thread", ["thread"]), (r"é-naïve-text", ["ve-text"]),
])
def test_required_literals(pattern, want):
    got = ruleindex.required_literals(pattern)
    assert (sorted(got) if got else None) == (sorted(want) if want else None)


WORDS = ["alpha", "bravo", "carbon", "delta", "echo", "fox", "golf", "hotel", "india", "ſilk", "KELVIN", "İstanbul"]


def generated(n, rnd):
    """Patterns of many forms: plain, optional, alternatives, classes, no literal at all."""
    forms = [lambda a, b, k: f"({a})/{k % 40}\\.(\\d+)", lambda a, b, k: f"(?:{a}|{b})-({k % 60})\\b", lambda a, b, k: f"{a}.*({b})",
             lambda a, b, k: f"^{a}[ /-]?(\\w*{k % 9})", lambda a, b, k: f"(?:{a})?{b}{k % 30}", lambda a, b, k: f"[{a[0]}{b[0]}]{k % 50}(\\d)", lambda a, b, k: f"\\d{{{2 + k % 3}}}x"]
    return [rnd.choice(forms)(rnd.choice(WORDS), rnd.choice(WORDS), k) for k in range(n)]


def texts(rnd, n=400):
    out = [" ".join(f"{rnd.choice(WORDS)}{rnd.choice(['/', '-', ' ', ''])}{rnd.randrange(60)}.{rnd.randrange(9)}" for _ in range(rnd.randint(1, 5))) for _ in range(n)]
    return sorted({*out, *(t.swapcase() for t in out[:80])}) + ["", "x", "abc", "100x"]


def test_agents_with_1270_rules(spark):
    rnd = random.Random(3)
    kinds = ["agent"] * 433 + ["os"] * 204 + ["device"] * 633
    rows = [(k, i, p, rnd.choice(["", "i"]), rnd.choice([None, "$1 x", "F$2"]), rnd.choice([None, "$1"]), None, None, None, rnd.choice([None, "Brand $1"]), None)
            for i, (k, p) in enumerate(zip(kinds, generated(len(kinds), rnd)))]
    schema = "kind string, priority int, regex string, flags string, family string, v1 string, v2 string, v3 string, v4 string, brand string, model string"
    names = [c.split()[0] for c in schema.split(", ")]
    agents = texts(rnd)
    out = enrich.parse_agents(spark.createDataFrame([(a,) for a in agents] + [(None,)], "user_agent string"), spark.createDataFrame(rows, schema))
    walk = enrich._AgentRules([dict(zip(names, r)) for r in rows], list(range(len(rows))))  # every rule is tested, in order
    want = {a: walk.fields(a, []) for a in agents} | {None: (None,) * len(enrich.AGENT_FIELDS)}
    got = {r.user_agent: tuple(r[c] for c in enrich.AGENT_FIELDS) for r in out.collect()}
    assert got == want and sum(w[0] != "Other" for w in want.values()) > 100


def test_labels_with_1270_rules(spark):
    rnd = random.Random(4)
    rules = [Rule(i, f"label {i}", (Cond("regex", rnd.choice(["", "(?i)"]) + p),)) for i, p in enumerate(generated(1200, rnd))]
    rules += [Rule(2000 + i, f"like {i}", (Cond("like", f"%{rnd.choice(WORDS)}%{i}%"), Cond("contains", "."))) for i in range(40)]
    rules += [Rule(3000 + i, f"segment {i}", (Cond("segment_like", f"{rnd.choice(WORDS)}%", 1), Cond("ilike", "%alpha%"))) for i in range(29)] + [Rule(9999, "rest", ())]
    assert len(rules) == 1270
    df = spark.createDataFrame([(t,) for t in texts(rnd)] + [(None,)], "v string")
    plain = {r.v: r.label for r in R.classify_distinct(df, "v", rules, "label", "none").collect()}
    out = R.classify_distinct(df, "v", rules, "label", "none", indexed=True)
    assert {r.v: r.label for r in out.collect()} == plain and len(set(plain.values())) > 30
    few = R.classify_distinct(df, "v", rules[:0], "label", "none", indexed=True)
    assert {r.label for r in few.collect()} == {"none"}


def test_candidates_come_from_a_join(spark):
    plan = E.queries()["large_rule_set"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (__gram#" in plan and "= __key#" in plan
    assert plan.count("RLIKE(") == 1 and "RLIKE(__v#" in plan  # one test a candidate, no chain of 1270


def test_agent_details(spark):
    rules = D.agent_rules(spark)
    agents = ["Mozilla/5.0 (Macintosh; Intel Mac OS X 14_1) AppleWebKit/605.1.15 Version/17.1 Safari/605.1.15", "x (Linux; Android 13; Pixel 7) y", "curl/8.4.0"]
    got = {r.user_agent: r for r in enrich.parse_agents(spark.createDataFrame([(a,) for a in agents], "user_agent string"), rules).collect()}
    mac, pixel, curl = (got[a] for a in agents)
    assert (mac.ua_os, mac.ua_os_version, mac.ua_device, mac.ua_device_brand, mac.ua_device_model) == ("Mac OS X", "14.1", "Mac", "Apple", "Mac")
    assert (pixel.ua_os, pixel.ua_os_version, pixel.ua_device, pixel.ua_device_brand, pixel.ua_device_model) == ("Android", "13", "Pixel 7", "Google", "Pixel 7")
    assert (curl.ua_os, curl.ua_os_version, curl.ua_device, curl.ua_device_brand, curl.ua_device_model) == ("Other", None, "Other", None, None)
