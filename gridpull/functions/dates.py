"""Date reading and formatting rules as Column -> Column functions.

``parse_bound`` accepts year-first and month-first dates, alone or with H:M or
H:M:S (unpadded fields, any whitespace run between date and time, an optional
``UTC `` prefix and one trailing ``Z``) and returns ``timestamp_ntz``;
everything else is NULL. Digits are ASCII, seconds 0 to 59; ``25-7-3`` or
``2025-07-03 24:00`` are rejected, and ``try_make_timestamp_ntz`` rejects impossible dates such as
Feb 30. No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_missing, strip_ws

# --- Fixed values -----------------------------------------------------------
# Date-only end bounds are moved to the end of their day.
END_OF_DAY = "23:59:59"
# ---------------------------------------------------------------------------

# Field rules (a year has four digits, year 0 does not exist; a day may be written as blank + digit). A 'T' counts as a blank,
# since every T is turned into one before the formats are tried.
_Y = r"((?!0000)[0-9]{4})"
_MON = r"(1[0-2]|0[1-9]|[1-9])"
_DAY = r"(3[01]|[12][0-9]|0[1-9]|[1-9]|[ T][1-9])"
_HOUR = r"(2[0-3]|[0-1][0-9]|[0-9])"
_MIN = r"([0-5][0-9]|[0-9])"
_SEC = r"([0-5][0-9]|[0-9])"
_SEP = r"[T\s\x1c-\x1f]+"

# One anchored pattern for all six formats on the stripped text: optional
# 'UTC ' prefix (any case) and blanks, a year-first or month-first date,
# optionally a separator run and H:M[:S], optionally one final 'Z'.
# Groups: 1-3 Y m d | 4-6 m d Y | 7-9 H M S.
_BOUND_RX = (
    "(?U)^(?:(?i:UTC )" + r"[\s\x1c-\x1f]*" + ")?"
    + "(?:" + _Y + "-" + _MON + "-" + _DAY + "|" + _MON + "/" + _DAY + "/" + _Y + ")"
    + "(?:" + _SEP + _HOUR + ":" + _MIN + "(?::" + _SEC + ")?)?Z?$"
)


def _bound_parts(col) -> Column:
    """Matching text -> array [Y, m, d, H, M, S] (strings, '' when absent);
    NULL when the text does not match. One regex replace rewrites the text
    into ``Y|m|d|H|M|S`` (month-first groups fill the same slots)."""
    s = strip_ws(col)
    return F.when(s.rlike(_BOUND_RX), F.split(F.regexp_replace(s, _BOUND_RX, "$1$6|$2$4|$3$5|$7|$8|$9"), r"\|"))


def _bound_from_parts(p: Column, is_end: bool) -> Column:
    def num(i: int) -> Column:
        return F.coalesce(F.nullif(F.translate(p.getItem(i), "T ", ""), F.lit("")).try_cast("int"), F.lit(0))

    ts = F.try_make_timestamp_ntz(num(0), num(1), num(2), num(3), num(4), num(5))
    if is_end:
        has_time = p.getItem(3) != F.lit("")
        ts = ts + F.when(has_time, F.expr("INTERVAL '0' SECOND")).otherwise(
            F.expr("INTERVAL '" + END_OF_DAY + "' HOUR TO SECOND")
        )
    return F.when(p.isNotNull(), ts)


def parse_bound(col, is_end: bool = False) -> Column:
    """Sheet date cell -> timestamp_ntz, or NULL when missing / unreadable.

    Date-only spellings give 00:00:00, or 23:59:59 when ``is_end``. The
    parts array is bound once through ``transform`` so the regex work is
    not repeated for every field (Spark does not share subexpressions
    inside conditional branches).
    """
    bound = F.element_at(F.transform(F.array(_bound_parts(col)), lambda p: _bound_from_parts(p, is_end)), 1)
    return F.when(is_missing(col), F.lit(None).cast("timestamp_ntz")).otherwise(bound)


def iso_text(ts) -> Column:
    """timestamp -> 'YYYY-MM-DDTHH:MM:SS' (the bound text a request carries)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def iso_text_fraction(ts) -> Column:
    """timestamp -> ISO text with the fraction only when non-zero, trailing
    zeros removed (``…T00:00:00.5``), as result rows are written."""
    c = F.col(ts) if isinstance(ts, str) else ts
    s = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    s = F.regexp_replace(s, r"\.0+$", "")
    return F.regexp_replace(s, r"(\.\d*[1-9])0+$", "$1")


def day_start(ts) -> Column:
    """Midnight of the timestamp's day (date-only comparison of a bound)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c).cast("timestamp_ntz")


def coerce_ts(col) -> Column:
    """Lenient text -> timestamp_ntz; unreadable -> NULL (sorts last)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("timestamp_ntz")
