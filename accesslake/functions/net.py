"""IPv4 helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_IPV4_RX = r"^(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})$"


def is_ipv4(c: Column) -> Column:
    return F.coalesce(c.rlike(_IPV4_RX), F.lit(False))


def ipv4_to_long(c: Column) -> Column:
    """Dotted quad → BIGINT; null for anything that is not a valid IPv4 text."""
    o = F.split(c, r"\.")
    val = (o[0].cast("bigint") * 16777216 + o[1].cast("bigint") * 65536
           + o[2].cast("bigint") * 256 + o[3].cast("bigint"))
    return F.when(is_ipv4(c), val)


def long_to_ipv4(c: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(c, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)])
