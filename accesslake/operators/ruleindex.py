"""Candidate rules by required literals, for rule sets too large to walk.

Every match of most patterns contains some fixed text.  ``required_literals``
reads it off the parsed pattern; of each literal the gram that fewest rules
have is the rule's key.  The grams of the distinct values meet the keys in an
equi-join, and only rules whose key a value contains are tested on it, in
order, beside the few rules without a required literal.  The first match is
the same as that of a walk over all rules.

Grams are compared in lower case, so a key never misses a match of a
case-insensitive rule.
"""

from __future__ import annotations

import re
from collections import Counter
from re import _constants as K
from re import _parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rules import Cond, Rule

GRAM = 4
#: Characters whose upper or lower case lies outside ASCII though a letter of ASCII matches them without case.
_FOLD = ("ſıİK", "siik")


def _char(op, arg) -> str | None:
    """The one character (in lower case) that an element matches, if it is one of ASCII."""
    if op is K.LITERAL and arg < 128:
        return chr(arg).lower()
    if op is K.IN and all(o is K.LITERAL and a < 128 for o, a in arg):
        found = {chr(a).lower() for _, a in arg}
        return found.pop() if len(found) == 1 else None
    return None


def _sets(parsed) -> list[list[str]]:
    """Sets of strings; each match contains a string of every set."""
    out, run = [], ""

    def close():
        nonlocal run
        if run:
            out.append([run])
        run = ""

    for op, arg in parsed:
        c = _char(op, arg)
        if c is not None:
            run += c
            continue
        if op is K.AT:
            continue  # a position, no text
        if op is K.SUBPATTERN:
            inner = arg[3]
            chars = [_char(o, a) for o, a in inner]
            if all(c is not None for c in chars):
                run += "".join(chars)
                continue
            close()
            out += _sets(inner)
            continue
        close()
        if op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT) and arg[0] >= 1:
            out += _sets(arg[2])
        elif op is K.ATOMIC_GROUP:
            out += _sets(arg)
        elif op is K.ASSERT:
            out += _sets(arg[1])
        elif op is K.BRANCH:
            best = [_best(_sets(b)) for b in arg[1]]
            if all(b is not None for b in best):
                out.append([s for b in best for s in b])
    close()
    return out


def _best(sets: list[list[str]]) -> list[str] | None:
    """The set that tells most: long strings, few of them; None if none has grams throughout."""
    usable = [s for s in sets if s and min(map(len, s)) >= GRAM]
    return max(usable, key=lambda s: (min(map(len, s)) / (1 + len(s)), s)) if usable else None


def required_literals(pattern: str) -> list[str] | None:
    """Lower-case strings of which every match contains at least one; None when the pattern shows no such set.

    Patterns that this reader does not know (other dialects) have none: their
    rules are tested on every value.
    """
    if "&&" in pattern or re.search(r"\[[^\]]*\[", pattern):
        return None  # classes within classes mean something else in Java
    try:
        return _best(_sets(_parser.parse(pattern)))
    except Exception:  # not this dialect
        return None


def _condition(c: Cond) -> list[str] | None:
    if c.op == "regex":
        return required_literals(c.pattern)
    if c.op in ("like", "ilike", "segment_like"):
        runs = "".join("\0" if ch in "%_\\" or not ch.isascii() else ch for ch in c.pattern).lower().split("\0")
    elif c.op in ("contains", "segment"):
        runs = "".join(ch if ch.isascii() else "\0" for ch in c.pattern).lower().split("\0")
    else:
        return None
    return _best([[r] for r in runs])


def rule_literals(rule: Rule) -> list[str] | None:
    """Required literals of a rule whose conditions must all hold."""
    return _best([s for s in map(_condition, rule.conds) if s])


def index_rows(literals: dict[int, list[str] | None]) -> tuple[list[tuple[str, int]], list[int]]:
    """``(keys, open)``: (gram, rule) rows, and the rules that have to be tested on every value."""
    grams = {r: [[s[i:i + GRAM] for i in range(len(s) - GRAM + 1)] for s in found] for r, found in literals.items() if found}
    often = Counter(g for found in grams.values() for g in {g for s in found for g in s})
    keys = sorted({(min(s, key=lambda g: (often[g], g)), r) for r, found in grams.items() for s in found})
    return keys, sorted(r for r, found in literals.items() if not found)


def candidates(values: DataFrame, column: str, keys: list[tuple[str, int]]) -> DataFrame:
    """``column`` and candidates (rules in ascending order) of each value of a table of distinct values."""
    text = F.lower(F.translate(F.col(column), *_FOLD))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("__text") - GRAM + 1), lambda i: F.substring(F.col("__text"), i, F.lit(GRAM))))
    met = (values.select(column, text.alias("__text")).where(F.length("__text") >= GRAM)
           .select(column, F.explode(grams).alias("__gram")))
    index = values.sparkSession.createDataFrame(keys, "__key string, __rule int")
    found = met.join(index, met["__gram"] == index["__key"]).groupBy(column).agg(F.sort_array(F.collect_set("__rule")).alias("candidates"))
    found = found.withColumnRenamed(column, "__value")
    out = values.select(column).join(found, F.col(column) == F.col("__value"), "left")
    return out.select(column, F.coalesce("candidates", F.array().cast("array<int>")).alias("candidates"))


def _holds(value: str) -> str:
    """One condition (columns op, pattern, arg) on a value, as SQL."""
    segment = f"try_element_at(split({value}, '/'), arg)"
    return (f"CASE op WHEN 'regex' THEN {value} RLIKE pattern WHEN 'like' THEN {value} LIKE pattern WHEN 'ilike' THEN lower({value}) LIKE pattern"
            f" WHEN 'contains' THEN contains({value}, pattern) WHEN 'segment' THEN {segment} = pattern WHEN 'segment_like' THEN {segment} LIKE pattern END")


def first_match(values: DataFrame, column: str, rules: list[Rule]) -> DataFrame:
    """``column``, label: the label of the first rule that holds on each distinct value that has one.

    Rules without conditions hold on every value.  Null values match nothing.
    """
    ordered = sorted(rules, key=lambda r: r.priority)
    spark = values.sparkSession
    if not ordered:
        return values.where("false").select(column, F.lit(None).cast("string").alias("label"))
    keys, every = index_rows({i: rule_literals(r) for i, r in enumerate(ordered)})
    table = spark.createDataFrame([(i, c.op, c.pattern, c.arg) for i, r in enumerate(ordered) for c in (r.conds or (Cond("like", "%"),))],
                                  "rule int, op string, pattern string, arg int")
    labels = spark.createDataFrame([(i, r.label) for i, r in enumerate(ordered)], "first int, label string")
    met = candidates(values.where(F.col(column).isNotNull()), column, keys)
    tests = met.select(column, F.explode(F.concat("candidates", F.array(*[F.lit(i) for i in every]).cast("array<int>"))).alias("rule")).join(table, "rule")
    good = tests.groupBy(column, "rule").agg(F.bool_and(F.coalesce(F.expr(_holds(f"`{column}`")), F.lit(False))).alias("holds")).where("holds")
    return good.groupBy(column).agg(F.min("rule").alias("first")).join(labels, "first").select(column, "label")
