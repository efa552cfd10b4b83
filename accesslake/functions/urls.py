"""URL analytics (U1–U11) as Column expressions.

The split is RFC-3986 shaped and done by one ``regexp_replace`` + ``split``
pass: scheme, user, address, port, path, query, fragment.  Two deliberate
choices, both documented in the README:

* the port is optional for absolute URLs and ``#`` always starts the fragment
  (path never carries ``#frag``);
* any non-null query is parsed, whichever layout captured it.

The password part of ``user:password@`` is matched but never kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEP = "\u0001"
_URL_RX = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*)://(?:([^:@/?#]*)(?::[^@/?#]*)?@)?"
    r"(\[[0-9A-Fa-f:.]+\]|[^/?#:]*)(?::([0-9]+))?)?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
)
_URL_REPL = _SEP.join(f"${i}" for i in range(1, 8))
_URL_FIELDS = ("scheme", "username", "address", "port", "path", "query", "fragment")


def decode(c: Column) -> Column:
    """Percent-decoding that keeps the text when an escape is malformed."""
    return F.coalesce(F.try_url_decode(c), c)


def url_parts(url: Column) -> Column:
    """U1 regex pass: the seven URL pieces as an array (one regex per row).

    Materialise this as a column (``select``) and read fields with
    ``url_fields``: inside a conditional struct Spark does not share the
    sub-expression, so building the struct straight from the regex would run
    it once per field.
    """
    return F.split(F.regexp_replace(F.replace(url, F.lit(_SEP), F.lit("")), _URL_RX, _URL_REPL), _SEP)


def url_fields(parts: Column, url: Column) -> Column:
    """U1/U2 from ``url_parts``: struct(scheme, username, address, port, path,
    query, fragment, parsed).  ``parsed`` is false when the text is neither
    absolute (``scheme://``) nor a ``/``-rooted path; the whole text is then
    the path."""
    fields = {n: F.nullif(parts[i], F.lit("")) for i, n in enumerate(_URL_FIELDS)}
    parsed = fields["scheme"].isNotNull() | F.coalesce(url.startswith("/"), F.lit(False))
    cols = [F.when(parsed, fields[n]).alias(n) for n in _URL_FIELDS if n != "path"]
    path = F.when(parsed, fields["path"]).otherwise(url).alias("path")
    return F.when(url.isNotNull(), F.struct(*cols, path, parsed.alias("parsed")))


def split_url(url: Column) -> Column:
    """Single-expression form of ``url_fields(url_parts(url), url)`` for
    one-off use; prefer the two-step form on large inputs."""
    return url_fields(url_parts(url), url)


def sanitize_key(k: Column) -> Column:
    """U8: ``.``/``[``/``]`` → ``_``, runs of ``_`` collapsed, edge ``_`` trimmed.

    Keys without any of ``. [ ] _`` are already clean and skip the three
    replacements (one scan instead of three regex passes)."""
    s = F.regexp_replace(k, r"[.\[\]]", "_")
    s = F.regexp_replace(s, "_+", "_")
    s = F.regexp_replace(s, "^_|_$", "")
    return F.when(k.rlike(r"[.\[\]_]"), s).otherwise(k)


def query_multimap(query: Column) -> Column:
    """``a=1&b=2&a=3`` → map(a → [1, 3], b → [2]); null for no pairs.

    Pairs without ``=`` are skipped; values are percent-decoded; keys are
    sanitised and keys that collide after sanitising are merged.
    """
    pairs = F.filter(F.split(query, "&"), lambda x: F.locate("=", x) > 1)
    kv = F.transform(pairs, lambda x: F.struct(
        sanitize_key(F.substring_index(x, "=", 1)).alias("k"),
        decode(F.substr(x, F.locate("=", x) + 1)).alias("v"),
    ))
    keys = F.array_distinct(F.transform(kv, lambda e: e["k"]))
    vals = F.transform(keys, lambda key: F.transform(F.filter(kv, lambda e: e["k"] == key), lambda e: e["v"]))
    return F.when(F.size(keys) > 0, F.map_from_arrays(keys, vals))


def query_parts(params: Column) -> Column:
    """One ``key=value`` string per value; null when there are none."""
    flat = F.flatten(F.transform(F.map_entries(params), lambda e: F.transform(
        e["value"], lambda v: F.concat(e["key"], F.lit("="), v))))
    return F.when(F.size(flat) > 0, flat)


def path_parts(path: Column) -> Column:
    """Non-empty ``/`` segments; null when there are none."""
    segs = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.when(F.size(segs) > 0, segs)


def path_depth(parts: Column) -> Column:
    """Cumulative prefixes ``/a``, ``/a/b``, … of the segments."""
    return F.when(parts.isNotNull(), F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))


def render_multimap(m: Column) -> Column:
    """Flat text form of a multimap for reports: ``k=v1,v2&k2=v`` with sorted keys."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(
        e["key"], F.lit("="), F.array_join(e["value"], ",")))), "&")
