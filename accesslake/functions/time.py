"""Event-time parsing (P18–P22) as Column expressions.

Every format is tried with a ``try_*`` function, so a bad date gives null
instead of failing the task under ANSI mode.  Text without a zone is read as
UTC (the session zone is pinned to UTC by ``accesslake.session``); an explicit
offset such as ``+0100`` is honoured and normalised to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted event-time formats, in trial order ------------
#   ISO8601 · yyyy-MM-dd HH:mm:ss · EEE MMM dd HH:mm:ss yyyy ·
#   dd/MMM/yyyy:HH:mm:ss Z · dd/MMM/yyyy:HH:mm:ss
# ---------------------------------------------------------------------------
_DAY_NAME = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\s+"


_ISO_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([T ]|$)"
_HTTP_SHAPE = r"^\d{1,2}/[A-Za-z]{3}/\d{4}:"
_HTTP_ZONE_SHAPE = r"^\S+ [+-]\d{4}$"


def parse_event_time(text: Column) -> Column:
    """P19 + P20: tabs become spaces, then the format matching the text's shape.

    The shape is told apart with cheap anchored tests, so each row runs one
    parser (a failed parse costs an exception inside the formatter):
    ISO 8601 / ``yyyy-MM-dd HH:mm:ss`` through Spark's own timestamp cast,
    ``dd/MMM/yyyy:HH:mm:ss [Z]``, and ``EEE MMM dd HH:mm:ss yyyy``.
    """
    t = F.trim(F.replace(text, F.lit("\t"), F.lit(" ")))
    no_day = F.regexp_replace(F.regexp_replace(t, _DAY_NAME, ""), r"\s+", " ")
    return (
        F.when(t.rlike(_ISO_SHAPE), t.try_cast("timestamp"))
        .when(t.rlike(_HTTP_SHAPE),
              F.when(t.rlike(_HTTP_ZONE_SHAPE), F.try_to_timestamp(t, F.lit("dd/MMM/yyyy:HH:mm:ss Z")))
              .otherwise(F.try_to_timestamp(t, F.lit("dd/MMM/yyyy:HH:mm:ss"))))
        .when(t.rlike(_DAY_NAME), F.try_to_timestamp(no_day, F.lit("MMM d HH:mm:ss yyyy")))
    )


def parse_ftp_time(month: Column, day: Column, year: Column, clock: Column) -> Column:
    """The four pieces of a transfer-log stamp → timestamp (UTC)."""
    txt = F.concat_ws(" ", month, day, year, clock)
    return F.try_to_timestamp(txt, F.lit("MMM d yyyy HH:mm:ss"))


def bracket_day(datetime_text: Column) -> Column:
    """``[dd/MMM/yyyy:HH:mm:ss +zone]`` → DATE of the wall-clock day."""
    first = F.split(datetime_text, " ").getItem(0)
    return F.to_date(F.try_to_timestamp(first, F.lit("'['dd/MMM/yyyy:HH:mm:ss")))


def bracket_day_text(datetime_text: Column) -> Column:
    """``dd/Mon/yyyy`` text when the field looks like ``[dd/Mon/yyyy:…]``, else null."""
    looks = datetime_text.rlike(r"\[\d{2}/\w{3}/\d{4}:.+\]")
    return F.when(looks, F.regexp_extract(datetime_text, r"\d{2}/\w{3}/\d{4}", 0))


def first_year(text: Column) -> Column:
    """F12 helper: first run of four digits as INT, 0 when there is none."""
    y = F.regexp_extract(text, r"(\d{4})", 1)
    return F.coalesce(F.try_to_number(F.nullif(y, F.lit("")), F.lit("9999")).cast("int"), F.lit(0))
